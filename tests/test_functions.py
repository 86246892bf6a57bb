"""Golden values of keys, names, times and attributes."""

import datetime

import pytest
from pyspark.sql import functions as F

from tracelake import functions as fn
from tracelake.schema import ATTRS


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def hexed(spark, column):
    return one(spark, F.lower(F.hex(column)))


def unhex(text):
    return F.unhex(F.lit(text))


@pytest.mark.parametrize(
    "name, ext",
    [("foo", ""), ("foo.txt", "txt"), ("foo..txt", "txt"), ("foo.tar.gz", "gz"), ("foo.html_file", "html_file"),
     ("", ""), ("foo.Html", "html"), ("foo.", "")],
)
def test_extension(spark, name, ext):
    assert one(spark, fn.extension(F.lit(name))) == ext


@pytest.mark.parametrize("path, name, full", [("a/path/", "aname", "a/path/aname"), ("a/path", "b", "a/path/b"), ("", "small", "small")])
def test_full_path(spark, path, name, full):
    assert one(spark, fn.full_path(F.lit(path), F.lit(name))) == full


def test_text_id(spark):
    assert one(spark, fn.entry_text_id(F.lit("/my/path/"), F.lit("myname"), F.lit(2))) == "/my/path/myname-2"


def test_entry_key(spark):
    image = "a079c4e779cd991fbb8ce6fa4947dc2a"
    key = fn.entry_key(unhex(image), F.lit("goats/goats/goats"), F.lit(123456))
    assert hexed(spark, key) == "31a079c4e779cd991fbb8ce6fa4947dc2a234bf4105758b58807225c2615c5720001e240"
    assert hexed(spark, fn.entry_key_image(key)) == image


@pytest.mark.parametrize("image, index", [("a079", 1), ("a079c4e779cd991fbb8ce6fa4947dc2a", -1), ("a079c4e779cd991fbb8ce6fa4947dc2a", 2**31)])
def test_entry_key_rejects(spark, image, index):
    assert one(spark, fn.entry_key(unhex(image), F.lit("p"), F.lit(index))) is None


@pytest.mark.parametrize(
    "kind, digest, head",
    [("md5", "8a9111fe05f9815fc55c728137c5b389", "8a9111fe05f9815fc55c728137c5b3890000000000"),
     ("sha1", "64fa477898e268fd30c2bfe272e5a016f5ec31c4", "64fa477898e268fd30c2bfe272e5a016f5ec31c401")],
)
def test_hash_key(spark, kind, digest, head):
    data = b"vassalengine.org/VASSAL 3.1.15"
    key = fn.hash_key(unhex(digest), kind, F.lit(bytearray(data)))
    assert hexed(spark, key) == head + data.hex()
    assert one(spark, fn.hash_key_length(key)) == len(digest) // 2
    assert hexed(spark, fn.hash_key_hash(key)) == digest
    assert one(spark, fn.is_long_hash_key(key)) is True


def test_hash_key_parts(spark):
    image = "baadf00dbaadf00dbaadf00dbaadf00d"
    entry = fn.entry_key(unhex(image), F.lit("/etc/passwd"), F.lit(17))
    key = fn.hash_key(unhex("00" * 16), "md5", entry)
    assert hexed(spark, fn.hash_key_entry_id(key)) == hexed(spark, entry)
    assert hexed(spark, fn.hash_key_image(key)) == image
    assert one(spark, fn.is_long_hash_key(unhex("00" * 20))) is False
    unknown = unhex("00" * 20 + "07" + "aa")
    assert one(spark, fn.hash_key_length(unknown)) == 0


def test_hash_fanout(spark):
    assert one(spark, fn.hash_fanout(F.lit("aabbccddeeff00112233445566778899"))) == "aa/bb"


def test_times(spark):
    assert one(spark, fn.positive_timestamp(F.lit(0))) is None
    assert one(spark, fn.positive_timestamp(F.lit(-5))) is None
    assert one(spark, fn.positive_timestamp(F.lit(10**15))) is None
    assert one(spark, F.unix_seconds(fn.positive_timestamp(F.lit(258970620)))) == 258970620
    for seconds in (0, 258970620, 1700000000):
        want = datetime.datetime.fromtimestamp(seconds, datetime.timezone.utc).ctime()
        assert one(spark, fn.ctime_text(F.lit(seconds))) == want


def attrs(spark, *rows):
    names = ["flags", "type", "name", "rd_buf", "nrd_runs"]
    import json

    return F.from_json(F.lit(json.dumps([dict(zip(names, r)) for r in rows])), ATTRS)


def test_resident_content(spark):
    a = attrs(spark, [4, 16, "$Data", "00", []], [5, 128, "$Other", "01", []], [5, 128, "$Data", "0a0b", []], [5, 128, "$Data", "ff", []])
    assert hexed(spark, fn.resident_content(a)) == "0a0b"
    assert hexed(spark, fn.resident_content(a, F.lit(bytearray(b"\x01")))) == "01"
    assert one(spark, fn.resident_content(attrs(spark, [5, 128, "$Data", "", []]))) is None


def test_byte_extents(spark):
    run = {"flags": 0, "addr": 3, "offset": 1, "len": 2}
    a = attrs(spark, [1, 16, "a", "", [run]], [1, 128, "b", "", []], [2, 128, "c", "", [run, {**run, "addr": 9}]])
    got = one(spark, fn.byte_extents(a, F.lit(100), F.lit(512)))
    assert [tuple(r) for r in got] == [(0, 1636, 512, 1024), (0, 4708, 512, 1024)]
    assert one(spark, fn.byte_extents(attrs(spark, [1, 16, "a", "", []]), F.lit(0), F.lit(1))) is None


def test_once_evaluates_below_filters(spark):
    df = fn.once(spark.range(3), "x", F.col("id") * 2)
    assert [r.x for r in df.where("x > 0").orderBy("id").collect()] == [2, 4]
