"""Plans and tasks whose size must not follow the size of a table."""

import numpy as np
from pyspark.sql import functions as F

from tracelake import session
from tracelake.operators import cluster, content, known
from tracelake.sources.lines import numbered_lines


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _vectors(spark, n):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        val = rng.random(4)
        rows.append((i, sorted(rng.choice(12, 4, replace=False).tolist()), (val / np.sqrt((val**2).sum())).tolist()))
    return session.materialize(spark.createDataFrame(rows, cluster.VECTOR), "vectors"), rows


def test_blocks_meet_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(cluster, "BLOCK_VECTORS", 2)
    vectors, rows = _vectors(spark, 90)
    dense = np.zeros((90, 12))
    for i, idx, val in rows:
        dense[i, idx] = val
    distance = 1 - dense @ dense.T
    near = {(r.a, r.b): r.distance for r in cluster.near_pairs(vectors, 0.5).collect()}
    assert set(near) == {(a, b) for a in range(90) for b in range(a + 1, 90) if distance[a, b] < 0.5}
    assert all(abs(d - distance[p]) < 1e-9 for p, d in near.items())
    centres = vectors.where("id % 9 = 0").select(F.col("id").alias("c"), F.inline(F.arrays_zip("idx", "val")))
    found = cluster.assign(vectors, session.materialize(centres, "centres"))
    assert "BroadcastHashJoin" not in _plan(found)
    got = {r.id: r.c for r in found.collect()}
    assert got == {i: int(9 * distance[i, ::9].argmin()) for i in range(90)}


def test_tasks_for_heavy_rows_follow_the_table(spark, monkeypatch):
    stored = session.materialize(spark.range(0, 40000, 1, 1).select("id", F.repeat(F.md5(F.col("id").cast("string")), 4).alias("text")), "rows")
    assert session.spread(stored, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(session, "SPREAD_BYTES", session.stored_bytes(stored) // 20)
    assert session.spread(stored, "id").rdd.getNumPartitions() in (20, 21)


def test_numbered_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a").write_text("x\ny\n")
    lines = numbered_lines(spark, str(tmp_path))
    assert "SortMergeJoin" not in _plan(lines)
    assert [(r.line_no, r.value) for r in lines.orderBy("line_no").collect()] == [(1, "x"), (2, "y")]


def test_order_of_a_stored_set_is_found_without_a_shuffle_of_its_rows(spark, tmp_path):
    from tracelake.catalog.written import _in_order

    rows = [("md5", "a", 1), ("md5", "c", 2), ("md5", "b", 3), ("md5", "b", 4), ("md5", None, 5)]
    spark.createDataFrame(rows, "hash_type string, hash string, v int").coalesce(1).write.parquet(str(tmp_path / "s"))
    spark.createDataFrame([("md5", "c", 6), ("md5", "d", 7)], "hash_type string, hash string, v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "s"))
    found = _in_order(spark.read.parquet(str(tmp_path / "s")), "hash_type", "hash")
    assert {r.v: (r.in_order, r.n_files) for r in found.collect()} == {1: (True, 1), 2: (True, 2), 3: (False, 1), 4: (True, 1), 6: (True, 2), 7: (True, 1)}
    assert "Exchange hashpartitioning" not in _plan(found)


def test_dump_is_shuffled_once(spark):
    kinds = "hash_type string, hash binary, other_hash binary, crc32 binary, filesize bigint, set_label string"
    rows = [("md5", b"\1", b"\2", b"\3", 5, label) for label in ("m/b 1", "m/a 1", "m/b 1")]
    dump = known.dump_hashes(spark.createDataFrame(rows, kinds), 9)
    assert _plan(dump).count("Exchange hashpartitioning") == 1
    assert [r.value for r in dump.collect()] == ["01\t0 => [NSRL => [9 => 1], crc32 => [9 => 03], filesize => [9 => 5], m/a 1 => [9 => 1], m/b 1 => [9 => 1], sha1 => [9 => 02]]"]


def test_product_lists_hold_all_labels_of_a_file_in_one_row_a_kind(spark):
    files = spark.createDataFrame([(bytearray(b"s"), bytearray(b"m"), bytearray(b"c"), 5, 1), (bytearray(b"t"), bytearray(b"n"), bytearray(b"c"), 5, 2)], "sha1 binary, md5 binary, crc32 binary, size bigint, prod_code int")
    products = spark.createDataFrame([(1, "p", "1", "7"), (1, "p", "2", "7"), (2, "q", "1", "8")], "code int, name string, version string, mfg_code string")
    mfgs = spark.createDataFrame([("7", "M")], "code string, name string")
    got = known.product_lists(files, products, mfgs)
    assert sorted((r.hash_type, r.set_labels) for r in got.collect()) == [("md5", ["M/p 1", "M/p 2"]), ("sha1", ["M/p 1", "M/p 2"])]
    lines = known.dump_hashes(known.nsrl_products(files, products, mfgs), 1)
    assert sorted(r.value for r in known.dump_hashes(got, 1).collect()) == sorted(r.value for r in lines.collect())


def test_image_readers_send_small_batches(spark):
    for name, value in (("maxRecordsPerBatch", "10000"), ("maxBytesPerBatch", "67108864b")):
        spark.conf.set(f"spark.sql.execution.arrow.{name}", value)
    content.extract_content(spark.createDataFrame([], "image string, first_addr bigint, id string, fp string, size bigint, extents array<struct<addr:bigint,offset:bigint,len:bigint>>"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 1000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "8388608b"


def _documents(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_large_files_takes_every_document_with_a_text(spark, tmp_path):
    from tracelake.catalog.content import large_files

    sf = _documents(spark, tmp_path, [(7, "seven", "en", "src0"), (502, "even ", "en", "src0"), (1501, "odd", "en", "src0"), (16, "lost", "en", "src0"), (3, "", "en", "src0")])
    got = {r.entry_id: (r.n, r.matches) for r in large_files(spark, sf).collect()}
    assert got == {"7": (5, True), "502": (1_200_000, True), "1501": (3, True), "16": (0, False)}


def test_file_pattern_hits_tries_the_lines_without_a_literal(spark, tmp_path):
    from tracelake.catalog.search import file_pattern_hits

    sf = _documents(spark, tmp_path, [(1, "word 12 xyz 3", "en", "src0"), (2, "other", "en", "src0")])
    got = {(r.doc_id, r.kw): (r.n, r["first"], r["last"]) for r in file_pattern_hits(spark, sf).collect()}
    assert {k: v for k, v in got.items() if k[1] in ("[0-9]+", "x.z")} == {
        (1, "[0-9]+"): (2, "word 12 xyz 3", "word 12 xyz 3"), (1, "x.z"): (1, "word 12 xyz 3", "word 12 xyz 3")
    }
    assert any("ther" in kw for d, kw in got if d == 2)


def _sparse(rng, n, terms, size):
    """Unit vectors over terms of which low numbers are common."""
    idx = [np.unique((terms * rng.random(size) ** 3).astype(np.int32)) for _ in range(n)]
    val = [rng.random(len(i)) + 0.1 for i in idx]
    return idx, [v / np.sqrt((v**2).sum()) for v in val]


def _dense(idx, val, terms):
    out = np.zeros((len(idx), terms))
    for i, (x, v) in enumerate(zip(idx, val, strict=True)):
        out[i, x] = v
    return out


def test_products_are_bounded_by_their_rare_terms(monkeypatch):
    rng = np.random.default_rng(8)
    idx, val = _sparse(rng, 500, 3000, 30)
    idx += [idx[4], np.empty(0, dtype=np.int32), np.array([5000], dtype=np.int32)]
    val += [val[4], np.empty(0), np.ones(1)]
    want = _dense(idx, val, 5001) @ _dense(idx[:200], val[:200], 5001).T
    for places in (cluster.PLACES, 0):
        monkeypatch.setattr(cluster, "PLACES", places)
        block = cluster._Block(range(200), idx[:200], val[:200])
        floor = rng.choice([0.1, 0.35, 0.9, -0.5], len(idx))
        got = np.full(want.shape, -1.0)
        for part, at, to, products in block.reaching(idx, val, floor):
            got[part][at, to] = products
        wanted = want >= floor[:, None]
        assert (got >= floor[:, None] - 1e-8)[wanted].all() and abs(got - want)[wanted].max() < 1e-12
        assert 0.001 < wanted[floor == 0.35].mean() < 0.9
        best = cluster._BestTwo()
        state = best.start(np.arange(len(idx)))
        for at in (0, 100):
            list(best.meet(0, np.arange(len(idx)), idx, val, state, 0, cluster._Block(range(at, at + 100), idx[at : at + 100], val[at : at + 100])))
        assert abs(state[0] - np.sort(want, axis=1)[:, :-3:-1]).max() < 1e-12
        assert (state[1][:500, 0] == want[:500].argmax(axis=1)).all()


def test_centres_of_all_terms_are_not_laid_out_for_each_document():
    import tracemalloc

    rng = np.random.default_rng(9)
    terms = 60_000
    idx, val = _sparse(rng, 1000, terms, 100)
    centres = [np.arange(terms, dtype=np.int32)] * 10, [rng.random(terms) for _ in range(10)]
    once = idx[3], val[3]
    idx[3], val[3] = np.repeat(idx[3], 2), np.repeat(val[3], 2)
    block = cluster._Block(range(10), *centres)
    tracemalloc.start()
    got = np.zeros((1000, 10))
    for part, at, to, products in block.reaching(idx, val, np.full(1000, -np.inf)):
        got[part][at, to] = products
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # 480 MB if each document had a place for every term
    idx[3], val[3] = once
    assert abs(got - np.array([[(v * c[i]).sum() for c in centres[1]] for i, v in zip(idx, val, strict=True)])).max() < 1e-9


def test_order_is_checked_where_rows_lie(spark, tmp_path):
    import random

    from tracelake.catalog import written

    draw, rows = random.Random(4), []
    for file in range(4):
        part = [(draw.choice(["md5", "sha1"]), draw.choice([None, b"\x01", b"\x90", bytes([draw.randrange(256)])]), 1000 * file + i) for i in range(60)]
        part = sorted(part, key=lambda r: (r[0], r[1] or b"")) if file > 1 else part
        rows.append(part)
        spark.createDataFrame(part, "hash_type string, hash binary, v int").coalesce(1).write.mode("append").option("maxRecordsPerFile", 100).parquet(str(tmp_path / "s"))
    key = lambda r: (r[0], r[1] is not None, r[1] or b"")
    want = {}
    for part in rows:
        for i, r in enumerate(part):
            if r[1] is not None:
                want[r[2]] = (not i or key(part[i - 1]) <= key(r), sum(any(key(r) == key(x) for x in p) for p in rows))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = written._in_order(spark.read.parquet(str(tmp_path / "s")), "hash_type", "hash").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert {r.v: (r.in_order, r.n_files) for r in found} == want
    spark.range(100, numPartitions=1).selectExpr("id", "id AS v").write.parquet(str(tmp_path / "t"))
    spark.range(100, 200, numPartitions=1).selectExpr("id", "id AS v").write.mode("append").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t")).select("id", F.col("_metadata.file_path").alias("_file"))
    assert written._shared_ranges(stored, ("id",)).isEmpty()


def test_sorted_hashes_keep_equal_and_missing_labels(spark, tmp_path):
    from tracelake import sinks

    files = spark.createDataFrame([(bytearray(b"s"), bytearray(b"m"), bytearray(b"c"), 5, 1)], "sha1 binary, md5 binary, crc32 binary, size bigint, prod_code int")
    products = spark.createDataFrame([(1, "p", "1", "7"), (1, "p", "1", "7"), (1, None, "1", "7"), (1, "p", "2", "7")], "code int, name string, version string, mfg_code string")
    mfgs = spark.createDataFrame([("7", "M")], "code string, name string")
    sinks.write_sorted_hashes(known.product_lists(files, products, mfgs, repeats=True), str(tmp_path / "h"))
    order = ["hash_type", "hash", "other_hash", "crc32", "filesize", "set_label"]
    plain = known.nsrl_products(files, products, mfgs).select(*order)
    got = spark.read.parquet(str(tmp_path / "h")).select(*order)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.count() == 8


def test_context_ends_at_characters_whatever_their_bytes(spark):
    from tracelake.operators import search
    from tracelake.sources.patterns import pattern_rows

    texts = [(i * 10 + j, (c * i) + "the" + ("é" * j) + "the" + (c * i)) for i in (0, 1, 19, 20, 21, 79, 81, 500) for j, c in enumerate("aé語😀")]
    rows = pattern_rows(spark.createDataFrame([(0, "the")], "a long, kw string"))
    found = search.match_rows(spark.createDataFrame(texts, "id long, text string"), rows, "id", contexts=True)
    want = {i: [t[max(0, m - 20) : m + 23] for m in (t.index("the"), t.rindex("the"))] for i, t in texts}
    assert {r.id: r.hits for r in found.collect()} == want
    assert "-80, 80" in found._jdf.queryExecution().optimizedPlan().toString()
