"""Schemas of the datasets. All of them are plain Spark types stored as Parquet."""

from __future__ import annotations

RUN = "struct<flags:bigint,addr:bigint,offset:bigint,len:bigint>"
RUNS = f"array<{RUN}>"

ATTR = (
    "struct<flags:bigint,id:bigint,name:string,size:bigint,type:bigint,rd_buf_size:bigint,"
    "rd_buf:string,nrd_allocsize:bigint,nrd_compsize:bigint,nrd_initsize:bigint,"
    f"nrd_skiplen:bigint,nrd_runs:{RUNS}>"
)
ATTRS = f"array<{ATTR}>"

# One row per file-system entry.
ENTRY = (
    "path string, name string, dir_index bigint, name_flags bigint, meta_seq bigint, name_type bigint, "
    "fs_byte_offset bigint, fs_id string, fs_block_size bigint, "
    "created timestamp, written timestamp, accessed timestamp, updated timestamp, "
    "size bigint, meta_flags bigint, uid bigint, gid bigint, meta_type bigint, seq bigint, "
    "mode bigint, content_len bigint, meta_addr bigint, nlink bigint, has_meta boolean, "
    f"attrs {ATTRS}"
)

# Where the bytes of an entry lie in its image.
EXTENTS = f"image string, first_addr bigint, id string, fp string, size bigint, extents {RUNS}"

# Reference hash set, one row per listed file.
REF_FILE = (
    "sha1 binary, md5 binary, crc32 binary, name string, size bigint, "
    "prod_code int, os_code string, special_code string"
)
REF_MFG = "code string, name string"
REF_OS = "code string, name string, version string, mfg_code string"
REF_PROD = (
    "code int, name string, version string, os_code string, mfg_code string, "
    "language string, app_type string"
)

# Digests of the files found in images: two rows per file.
FILE_HASHES = "hash_type string, hash string, image_id string, entry_id string, ts timestamp"

IMAGES = "image_id string, friendly_name string, json string, img_path string"
