"""Whole jobs, writers and the stream, on a small generated image."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake import sinks
from tracelake.operators import known, scripting
from tracelake.operators.content import load_content
from tracelake.operators.search import grep_counts
from tracelake.operators.text import extract_text
from tracelake.plans.analysis import analyse
from tracelake.plans import ingest as ingest_plan
from tracelake.plans.ingest import AlreadyRegistered, ingest
from tracelake.plans.reports import column_max, csv_lines
from tracelake.sources import make_patterns, scan_entries
from tracelake.streaming import stream_entries, write_stream

IMAGE_ID = "a079c4e779cd991fbb8ce6fa4947dc2a"
BLOCK, BASE = 512, 1024
WORDS = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta", "lambda", "epsilon"]


def dump(folder, n=60):
    """An image with one file per record, and the record lines; every seventh file is resident."""
    rng = np.random.default_rng(3)
    data, lines, files = bytearray(rng.bytes(BASE)), [], {}
    for i in range(n):
        body = (f"file {i} " + " ".join(rng.choice(WORDS[(i % 2) * 5 : (i % 2) * 5 + 5], 30)) + (" needle here" if i % 3 else "")).encode()
        name = f"f{i}.txt"
        files[f"/dir{i % 4}/{name}"] = body
        attr = {"flags": 1, "id": 1, "name": "$Data", "type": 128}
        if i % 7 == 0:
            attr |= {"flags": 5, "rd_buf": body.hex()}
        else:
            first = (len(data) - BASE) // BLOCK
            data += body + bytes(-len(body) % BLOCK)
            attr["nrd_runs"] = [{"flags": 0, "addr": first, "offset": 0, "len": -(-len(body) // BLOCK)}]
        doc = {
            "path": f"/dir{i % 4}", "name": {"name": name, "dirIndex": i, "type": 5}, "meta": {"size": len(body), "mtime": 1000 + i},
            "fs": {"byteOffset": BASE, "fsID": "v1", "blockSize": BLOCK}, "attrs": [attr],
        }
        lines.append(json.dumps(doc))
    lines += ["{broken", json.dumps({"path": "/x", "name": {"name": "noindex"}}), json.dumps({"path": "/", "name": {"name": "dir1", "dirIndex": 1}})]
    (folder / "disk.raw").write_bytes(bytes(data))
    (folder / "entries.json").write_text("\n".join(lines) + "\n")
    return files


@pytest.fixture(scope="module")
def ingested(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("evidence")
    files = dump(folder)
    good = hashlib.md5(files["/dir1/f1.txt"]).hexdigest()
    bad = hashlib.sha1(files["/dir2/f2.txt"]).hexdigest()
    sets = [spark.createDataFrame([r], "hash_type string, hash string") for r in (("md5", good), ("sha1", bad))]
    result = ingest(
        spark, str(folder / "entries.json"), IMAGE_ID, str(folder / "disk.raw"), *sets, "2024-01-01 00:00:00", str(folder / "out")
    )
    return folder, files, result


def test_ingest(spark, ingested):
    folder, files, result = ingested
    rows = {r.path + "/" + r.name: r for r in result.entries.collect()}
    assert len(rows) == len(files) + 1
    for path, body in files.items():
        r = rows[path]
        assert bytes(r.content) == body and r.md5 == hashlib.md5(body).hexdigest() and r.sha1 == hashlib.sha1(body).hexdigest()
        assert (r.nsrl, r.bad) == (path == "/dir1/f1.txt", path == "/dir2/f2.txt") and not r.problem
    assert sorted(r.reason for r in result.rejects.collect()) == ["no valid directory index", "not a JSON object"]
    assert result.file_hashes.count() == 2 * len(files)
    assert result.stats.first().problems == 0
    stored = scan_entries(spark.read.parquet(f"{folder}/out/entries"), IMAGE_ID)
    assert stored.count() == len(rows)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(image_id" in plan
    extents = spark.read.parquet(f"{folder}/out/extents")
    assert extents.count() == sum(i % 7 != 0 for i in range(len(files)))
    assert [r.entry_id for r in known.known_bad(result.entries).collect()] == [rows["/dir2/f2.txt"].entry_id]


def test_analysis(spark, ingested):
    folder, files, result = ingested
    images = spark.createDataFrame([(IMAGE_ID, "disk"), ("ff" * 16, "other")], "image_id string, friendly_name string")
    patterns = make_patterns(spark, ["needle", "", "file \\d+", "absent"])
    reports = analyse(result.entries, images, result.file_hashes, IMAGE_ID, patterns, str(folder / "reports"))
    searched = {p: b for p, b in files.items() if p != "/dir1/f1.txt"}
    n_needle = sum(b"needle" in b for b in searched.values())
    assert [tuple(r) for r in reports.keyword_counts.collect()] == [(0, n_needle, "needle"), (1, len(searched), "file \\d+")]
    hits = spark.read.json(f"{folder}/reports/searchHits")
    assert hits.count() == n_needle + len(searched) and set(hits.columns) == {"a", "kw", "p", "fP", "fId"}
    docs = spark.read.json(f"{folder}/reports/docClusters")
    assert {r.fP for r in docs.collect()} == set(searched)
    topics = {r.a: r.n for r in spark.read.json(f"{folder}/reports/docClusterCounts").collect()}
    assert sum(topics.values()) == docs.where("a >= 0").count()
    score = spark.read.json(f"{folder}/reports/similarityScores").first()
    assert score.a == "disk" and score.id == IMAGE_ID and score.is_self


def test_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    dump(tmp_path, 20)
    lines = (tmp_path / "entries.json").read_text().splitlines(keepends=True)
    for step, part in enumerate((lines[:9], lines[9:])):
        (tmp_path / "in" / f"{step}.json").write_text("".join(part))
        stream = stream_entries(spark, str(tmp_path / "in"), IMAGE_ID)
        write_stream(stream, str(tmp_path / "table"), str(tmp_path / "cp")).awaitTermination(120)
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.count() == 21 and table.select("entry_id").distinct().count() == 21


def test_writers(spark, tmp_path):
    pairs = spark.createDataFrame([("k", 1), ("l", 2)], "key string, value bigint")
    sinks.write_pairs(pairs, str(tmp_path / "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ["k\t1", "l\t2"]
    sinks.write_pairs(pairs, str(tmp_path / "p"), "parquet")
    assert spark.read.parquet(str(tmp_path / "p")).schema == pairs.schema
    with pytest.raises(ValueError):
        sinks.write_pairs(pairs, str(tmp_path / "x"), "avro")
    rows = spark.createDataFrame([("a,b", 'say "x"', 1), (None, "", 2)], "a string, b string, n int")
    sinks.write_csv(csv_lines(rows).coalesce(1), str(tmp_path / "c"))
    text = b"".join(p.read_bytes() for p in (tmp_path / "c").glob("part-*"))
    assert sorted(text.split(b"\r\n")) == [b"", b'"","","2"', b'"a,b","say ""x""","1"']
    hashes = spark.range(1000).selectExpr("'md5' hash_type", "md5(cast(id as string)) hash")
    sinks.write_sorted_hashes(hashes, str(tmp_path / "h"), 4)
    ranges = spark.read.parquet(str(tmp_path / "h")).selectExpr("hash", "_metadata.file_name f").groupBy("f").agg({"hash": "min"}).withColumnRenamed("min(hash)", "lo")
    highs = spark.read.parquet(str(tmp_path / "h")).selectExpr("hash", "_metadata.file_name f").groupBy("f").agg({"hash": "max"}).withColumnRenamed("max(hash)", "hi")
    spans = sorted((r.lo, r.hi) for r in ranges.join(highs, "f").collect())
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_large_files_are_searched_and_repeats_count_once(spark, tmp_path):
    big = b"x" * 1_500_000 + b" needle " + b"y" * 300_000
    half = 700 * BLOCK
    image = bytes(BASE) + big[half:].ljust(-(-len(big[half:]) // BLOCK) * BLOCK, b"\0") + big[:half]
    (tmp_path / "disk.raw").write_bytes(image)
    second = -(-len(big[half:]) // BLOCK)
    runs = [{"flags": 0, "addr": second, "offset": 0, "len": 700}, {"flags": 0, "addr": 0, "offset": 700, "len": second}]

    def line(name, index, runs):
        attr = {"flags": 1, "id": 1, "name": "$Data", "type": 128, "nrd_runs": runs}
        meta = {"size": len(big), "mtime": 1000}
        return json.dumps({"path": "/d", "name": {"name": name, "dirIndex": index, "type": 5}, "meta": meta, "fs": {"byteOffset": BASE, "fsID": "v", "blockSize": BLOCK}, "attrs": [attr]})

    huge = [{"flags": 0, "addr": 2**62, "offset": 0, "len": 1}]
    negative = [{"flags": 0, "addr": -900, "offset": 0, "len": 1}]
    lines = [line("big.txt", 1, runs), line("big.txt", 1, runs), line("huge.txt", 2, huge), line("low.txt", 3, negative)]
    (tmp_path / "entries.json").write_text("\n".join(lines) + "\n")
    nothing = spark.createDataFrame([], "hash_type string, hash string")
    args = (spark, str(tmp_path / "entries.json"), IMAGE_ID, str(tmp_path / "disk.raw"), nothing, nothing, "2024-01-01 00:00:00", str(tmp_path / "out"))
    done = ingest(*args)
    rows = {r.name: r for r in done.entries.select("name", "content", "md5", "problem").collect()}
    assert len(rows) == done.entries.count() == 3 and rows["big.txt"].content is None and rows["big.txt"].md5 == hashlib.md5(big).hexdigest()
    assert rows["low.txt"].problem and rows["huge.txt"].md5 is None
    assert [r.reason for r in done.rejects.collect()] == ["runs beyond 64 bits"]
    assert done.file_hashes.where("hash_type = 'md5'").count() == 2
    loaded = load_content(done.entries.select("name", "size", "content", "extents", "image_uri")).where("name = 'big.txt'")
    assert bytes(loaded.first().content) == big
    hits = grep_counts(extract_text(loaded).select("text"), make_patterns(spark, ["needle"])).collect()
    assert [(h.kw, h.n) for h in hits] == [("needle", 1)]
    with pytest.raises(AlreadyRegistered):
        ingest(*args)


def test_a_failed_ingest_can_be_run_again(spark, tmp_path, monkeypatch):
    dump(tmp_path)
    nothing = spark.createDataFrame([], "hash_type string, hash string")
    out = str(tmp_path / "out")
    args = (spark, str(tmp_path / "entries.json"), IMAGE_ID, str(tmp_path / "disk.raw"), nothing, nothing, "2024-01-01 00:00:00", out, "disk")

    def fail(*_, **__):
        raise OSError("disk full")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(ingest_plan, "write_sorted_hashes", fail)
        ingest(*args)
    assert not ingest_plan.is_registered(spark, out, IMAGE_ID)
    with ingest_plan.claimed(spark, out, IMAGE_ID), pytest.raises(ingest_plan.BeingIngested):
        ingest(*args)
    done = ingest(*args)
    assert [(r.image_id, r.friendly_name) for r in spark.read.parquet(f"{out}/images").collect()] == [(IMAGE_ID, "disk")]
    for name, want in (("entries", done.entries), ("extents", done.extents), ("file_hashes", done.file_hashes)):
        stored = spark.read.parquet(f"{out}/{name}")
        assert stored.where(F.col("image_id") == IMAGE_ID).count() == stored.count() == want.count() > 0
    hashes = spark.read.parquet(f"{out}/file_hashes").select(done.file_hashes.columns)
    assert hashes.exceptAll(done.file_hashes).isEmpty()
    assert spark.read.json(f"{out}/rejects").count() == done.rejects.count() > 0
    with pytest.raises(AlreadyRegistered):
        ingest(*args)
    assert not ingest_plan.is_registered(spark, out, "another")


@pytest.mark.parametrize("top, limit", [(0, 100), (40, 100), (100, 200), (101, 202)])
def test_axis_limit(spark, top, limit):
    assert column_max(spark.createDataFrame([(top,)], "n bigint")).first()["limit"] == limit


def test_script_with_state_over_values(spark):
    """The longest run of equal values in a row."""

    def longest_run(key, values, context):
        best, last, n = 0, None, 0
        for value in values:
            n = n + 1 if value == last else 1
            best, last = max(best, n), value
        context.emit(key, best)

    pairs = spark.range(7).selectExpr("'k' key", "if(id < 4, 'a', 'b') value").coalesce(1)
    got = scripting.run_reducer(pairs, longest_run, "text", "long").collect()
    assert [(r.key, r.value) for r in got] == [("k", 4)]
