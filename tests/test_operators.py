"""Operators against brute force on small inputs."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.operators import charset, cluster, content, inventory, known, merge, scripting, search, similarity, text
from tracelake.session import lookup_join, materialize
from tracelake.sources import image_files, image_ranges, load_patterns, make_patterns, pattern_rows, read_pattern_rows
from tracelake.sources.patterns import required_literals

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("pattern", [r"\bthe\b", "an(d|y)", r"(t)(h)\2?", "e", "x*", "(?m)^[A-Z]", "zzz"])
def test_search_context(spark, pattern):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").limit(60)
    more = spark.createDataFrame([(-2, "thethethe" * 20), (-3, ""), (-4, "e"), (-5, "\n\nthe\n"), (-6, None)], "doc_id bigint, text string")
    rows = materialize(docs.unionByName(more))
    got = {r.doc_id: [(h.a, h.p) for h in r.hits] for r in search.grep_hits(rows, make_patterns(spark, ["(", pattern])).collect()}
    texts = {r.doc_id: r.text for r in rows.collect() if r.text}
    assert got.keys() == texts.keys()
    for doc_id, t in texts.items():
        assert got[doc_id] == [(1, t[max(0, m.start() - 20) : m.end() + 20]) for m in re.finditer(pattern, t, re.ASCII)]


def test_search_outside_the_basic_plane(spark):
    rows = spark.createDataFrame([(1, "😀" * 30 + "the" + "😀" * 30)], "doc_id bigint, text string")
    hits = search.grep_hits(rows, make_patterns(spark, ["the"])).first().hits
    assert [h.p for h in hits] == ["😀" * 20 + "the" + "😀" * 20]


def test_counts_agree(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    patterns = make_patterns(spark, ["the", "[", "zzz", "an"])
    direct = search.grep_counts(docs, patterns).collect()
    stored = search.hit_counts(search.grep_hits(docs, patterns), patterns).collect()
    assert [tuple(r) for r in direct] == [tuple(r) for r in stored]
    assert [r.a for r in direct] == [0, 3]


LINES = ["the", r"\bthe\b", "an(d|y)", "(t)(h)\\2?e?", "licen[sc]e", "(", "zzz", "qu+e|the|and", "(?i)THE", "x*", "ab?the", "the{0}n", r"[.]\s", "(?<=t)hen", "(?:the|and) ", r"\\Qthe\\E", "thé", "the"]


def test_patterns_as_rows_find_what_patterns_in_the_plan_find(spark):
    docs = materialize(
        spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").where("n_chars < 2000").limit(40)
        .union(spark.createDataFrame([(-2, "thethethe" * 20), (-3, ""), (-4, "th"), (-5, "\n\nthe\n"), (-6, None), (-7, "😀" * 30 + "the" + "😀" * 30), (0, "the same id")], "doc_id bigint, text string"))
    )
    rows = pattern_rows(spark.createDataFrame(list(enumerate(LINES)), "a long, kw string"))
    listed = make_patterns(spark, LINES)
    assert [(r.a, r.kw, r.valid) for r in rows.orderBy("a").collect()] == [tuple(p) for p in listed]
    hits = search.grep_hits(docs, listed).select("doc_id", F.inline("hits"))
    want = collections.Counter((r.doc_id, r.a, r.p) for r in hits.collect())
    got = search.match_rows(docs, rows, "doc_id", contexts=True)
    assert collections.Counter((r.doc_id, r.a, p) for r in got.collect() for p in r.hits) == want
    shuffled = search.match_rows(docs, rows, "doc_id", max_broadcast_bytes=0)
    assert sum((collections.Counter({(r.doc_id, r.a): r.n}) for r in shuffled.collect()), collections.Counter()) == collections.Counter(x[:2] for x in want.elements())
    counts = {(r.a, r.n, r.kw) for r in search.grep_counts(docs, listed).collect()}
    assert {tuple(r) for r in search.match_counts(docs, rows, "doc_id").collect()} == counts
    assert search.match_counts(docs.limit(0), rows, "doc_id").count() == 0 == search.match_counts(docs, rows.limit(0), "doc_id").count()


def test_the_plan_of_a_search_does_not_grow_with_patterns_as_rows(spark):
    docs = spark.createDataFrame([(1, "some word17 here")], "id long, text string")

    def plan(n):
        rows = pattern_rows(spark.range(n).select(F.col("id").alias("a"), F.concat(F.lit("word"), "id").alias("kw")))
        found = search.match_rows(docs, rows, "id")
        assert {r.kw for r in found.collect()} == {k for k in ("word1", "word17") if int(k[4:]) < n}
        return len(re.sub(r"-?\d+L?", "", found._jdf.queryExecution().optimizedPlan().toString()))

    assert plan(2000) == plan(20)


@pytest.mark.parametrize("seed", range(3))
def test_every_match_holds_a_required_literal(seed):
    rng = random.Random(seed)
    parts = ["abc", "abcd", "b", "ca", "[ab]", "(ab|ca)", "b*", "c?", "a+", "b{1,2}", "(?:abc)?", ".", r"\.", r"\w", "|", "(a[)]b)*"]
    texts = ["".join(rng.choice("abcd.") for _ in range(rng.randrange(3, 40))) for _ in range(60)]
    known = 0
    for _ in range(1500):
        kw = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
        literals = required_literals(kw)
        known += literals is not None
        for t in texts if literals else []:
            assert all(any(x in m.group() for x in literals) for m in re.finditer(kw, t)), (kw, t)
    assert known > 200


def test_lines_of_pattern_files_are_numbered_file_by_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo\r\n")
    (tmp_path / "b.txt").write_text("three\n(\n")
    rows = [(r.a, r.kw, r.valid) for r in read_pattern_rows(spark, str(tmp_path)).orderBy("a").collect()]
    assert rows == [tuple(p) for p in load_patterns(spark, str(tmp_path))] == [(0, "one", True), (1, "two", True), (2, "three", True), (3, "(", False)]


def test_has_hit_is_the_same_as_having_hits(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    patterns = make_patterns(spark, ["licen[sc]e", "(", "que"])
    flagged = {r.doc_id for r in docs.where(search.has_hit(patterns)).collect()}
    assert flagged == {r.doc_id for r in search.grep_hits(docs, patterns).where("size(hits) > 0").collect()}
    assert docs.where(search.has_hit(make_patterns(spark, ["("]))).count() == 0


def test_random_per_key(spark):
    rows = spark.range(3000).selectExpr("id", "cast(id % 3 as string) k", "concat('v', id) v")
    first = {r.k: r.v for r in inventory.random_per_key(rows, "k", "v", "id", 1).collect()}
    assert all(int(v[1:]) % 3 == int(k) for k, v in first.items()) and len(first) == 3
    assert first == {r.k: r.v for r in inventory.random_per_key(rows.repartition(7), "k", "v", "id", 1).collect()}
    picks = {inventory.random_per_key(rows.where("k = '0'"), "k", "v", "id", s).first().v for s in range(8)}
    assert len(picks) > 4


def test_export_by_path(spark):
    rows = [("1", "/a", "x.JPG", b"abc", None, "m"), ("2", "/a", "y.jpg", None, "hdfs://big", None), ("3", "/a", "z.jpg", None, None, "m"), ("4", "/a", "t.txt", b"q", None, "m")]
    e = spark.createDataFrame(rows, "entry_id string, path string, name string, content binary, content_path string, md5 string").withColumn("sha1", F.lit(None).cast("string"))
    for wanted in (["Jpg"], spark.createDataFrame([("JPG",)], "ext string")):
        got = {r.entry_id: (bytes(r.data), r.hdfs_path, r.md5, r.sha1) for r in inventory.export_by_ext(e, wanted).collect()}
        assert got == {"1": (b"abc", "", "m", ""), "2": (b"", "hdfs://big", "", "")}


@pytest.mark.parametrize("most", [1 << 20, 1])
def test_lookup_join_is_exact_for_hot_keys(spark, most):
    big = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 50)) k")
    table = materialize(spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("zz", 4)], "k string, x int"))
    for how in ("inner", "left"):
        want = collections.Counter(map(tuple, big.join(table, "k", how).collect()))
        got = collections.Counter(map(tuple, lookup_join(big, table, "k", how, max_broadcast_bytes=most).select("k", "id", "x").collect()))
        assert got == want
        plan = lookup_join(big, table, "k", how, max_broadcast_bytes=most)._jdf.queryExecution().optimizedPlan().toString()
        assert ("broadcast" in plan) == (most > 1) and "Generate" not in plan  # no copies of the table's rows


def test_mark_known_by_either_hash(spark):
    files = spark.createDataFrame([("1", "a", "A"), ("2", "b", "B"), ("3", "c", "C"), ("4", "a", "A")], "entry_id string, md5 string, sha1 string")
    nsrl = spark.createDataFrame([("md5", "a"), ("md5", "a"), ("sha1", "B"), ("sha1", "c")], "hash_type string, hash string")
    bad = spark.createDataFrame([("sha1", "C")], "hash_type string, hash string")
    got = {r.entry_id: (r.nsrl, r.bad) for r in known.mark_known(files, nsrl, bad).collect()}
    assert got == {"1": (True, False), "2": (True, False), "3": (False, True), "4": (True, False)}


def test_mark_known_beyond_a_broadcast(spark):
    files = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("md5"), F.sha1(F.col("id").cast("string")).alias("sha1")).withColumn("nsrl", F.lit("old"))
    files = files.unionByName(spark.createDataFrame([(-1, None, None, "old"), (-2, None, "x", "old")], "id long, md5 string, sha1 string, nsrl string")).repartition(5)
    members = spark.range(0, 20_000, 40).select(F.lit("md5").alias("hash_type"), F.md5(F.col("id").cast("string")).alias("hash"))
    nsrl = members.union(spark.createDataFrame([("sha1", "x"), ("md5", None)], "hash_type string, hash string")).union(members)
    bad = spark.range(7, 20_000, 90).select(F.lit("sha1").alias("hash_type"), F.sha1(F.col("id").cast("string")).alias("hash"))
    plain = sorted(map(str, known.mark_known(files, nsrl, bad).collect()))
    filtered = known.mark_known(files, nsrl, bad, max_broadcast_bytes=0)
    assert sorted(map(str, filtered.collect())) == plain and filtered.columns == ["id", "md5", "sha1", "nsrl", "bad"]
    flags = materialize(nsrl.union(bad).distinct())
    test = known.possible_members(flags)
    passed = {r.id for r in files.where(test).collect()}
    wanted = {*range(0, 20_000, 40), *range(7, 20_000, 90), -2}
    assert wanted <= passed and len(passed) < len(wanted) + 400
    # What is shuffled comes from behind the filter.
    plan = filtered._jdf.queryExecution().optimizedPlan().toString()
    assert "getbit" in plan.lower() and len(plan) < 40_000
    assert known.possible_members(flags, max_bits=1024) is None
    none = spark.createDataFrame([], "hash_type string, hash string")
    assert known.mark_known(files, none, none, max_broadcast_bytes=-1).where("nsrl OR bad").isEmpty()


def test_merge(spark):
    base = spark.createDataFrame([("1", "x", 1), ("2", "y", 2)], "entry_id string, s string, n int")
    log = spark.createDataFrame([("1", 1, "p", None), ("1", 2, None, 9), ("3", 1, "q", None), ("2", 1, None, None)], "entry_id string, t int, s string, m int")
    out = merge.upsert_entries(base, merge.last_writes(log, "t"))
    assert {tuple(r) for r in out.collect()} == {("1", "p", 1, 9), ("2", "y", 2, None), ("3", "q", None, None)}
    cand = spark.createDataFrame([("a", "n1"), ("b", "n2"), ("b", "n3")], "image_id string, friendly_name string")
    ok, no = merge.register_images(spark.createDataFrame([("a",)], "image_id string"), cand)
    assert [tuple(r) for r in ok.collect()] == [("b", "n2")] and {tuple(r) for r in no.collect()} == {("a", 1), ("b", 1)}


def test_similarity(spark):
    rows = [("md5", h, i) for i, hs in {"R": "aab", "S": "ab", "T": "b", "U": "z"}.items() for h in hs] + [("sha1", "a", "U")]
    hashes = spark.createDataFrame(rows, "hash_type string, hash string, image_id string")
    images = spark.createDataFrame([(i, f"name {i}") for i in "RSTU"], "image_id string, friendly_name string")
    got = {r.id: (r.iif, r.c, r.is_self) for r in similarity.iif_scores(hashes, images, "R").collect()}
    a, b = math.log(4 / 2), math.log(4 / 3)
    for image, score in {"R": a + b, "S": a + b, "T": b}.items():
        assert got[image][0] == pytest.approx(score) and got[image][1] == pytest.approx(score / (math.log(4) * 3))
    assert "U" not in got and got["R"][2] and not got["S"][2]
    links = similarity.device_links(similarity.iif_scores(hashes, images, "R"), images, "R").collect()
    assert {r.target: r.weight for r in links} == {"S": pytest.approx(4 * (a + b)), "T": pytest.approx(4 * b)}


# ---- content ----


@pytest.fixture(scope="module")
def image(tmp_path_factory):
    path = tmp_path_factory.mktemp("img") / "disk.raw"
    data = bytes(i % 256 for i in range(1000)) + np.random.default_rng(1).bytes(3_000_000)
    path.write_bytes(data)
    return str(path), data


def test_extract_content(spark, image):
    path, data = image
    cases = {
        "one": (10, [(42, 10)]), "two": (15, [(42, 10), (7, 10)]), "zero-length first": (5, [(3, 0), (9, 5)]),
        "none": (0, [(5, 0)]), "past the end": (50, [(len(data) - 20, 40)]), "short": (30, [(0, 10)]), "large": (2_000_000, [(500, 1_500_000), (0, 500_000)]),
        "exactly inline": (1_048_576, [(1, 1_048_576)]), "end, then more": (25, [(len(data) - 5, 10), (0, 20)]),
    }
    rows = [(path, x[0][0], k, "/" + k, size, [(0, a, 0, n) for a, n in x]) for k, (size, x) in cases.items()]
    df = spark.createDataFrame(rows, "image string, first_addr bigint, id string, fp string, size bigint, extents array<struct<flags:bigint,addr:bigint,offset:bigint,len:bigint>>")
    out = materialize(content.extract_content(df))
    got = {r.id: r for r in out.collect()}
    for k, (size, x) in cases.items():
        want, r = b"", got[k]
        for a, n in x:
            part = data[a : a + min(n, size - len(want))]
            want += part
            if a + n > len(data):
                break
        assert (r.bytes_read, r.md5, r.sha1) == (len(want), hashlib.md5(want).hexdigest(), hashlib.sha1(want).hexdigest()), k
        assert r.problem == (len(want) != size)
        assert (bytes(r.content) == want) if size <= 1_048_576 else r.content is None
    stats = content.extract_stats(out).first()
    assert (stats.small, stats.big, stats.fragmented, stats.problems) == (8, 1, 4, 3)


def test_block_hashes_and_digest(spark, image):
    path, data = image
    images = image_files(spark, path)
    got = {r.offset: r.md5 for r in content.block_hashes(images).collect()}
    assert got == {i: hashlib.md5(data[i : i + 512]).hexdigest() for i in range(0, len(data), 512)}
    assert content.image_digest(images).first().md5 == hashlib.md5(data).hexdigest()


def test_ranges_cover_the_image(spark, image):
    path, data = image
    rows = image_ranges(image_files(spark, path), 999).orderBy("start").collect()
    assert rows[0].start == 0 and sum(r.length for r in rows) == len(data)
    assert all(a.start + a.length == b.start for a, b in zip(rows, rows[1:]))


# ---- text and clusters ----


@pytest.mark.parametrize(
    ("words", "charsets"),
    [
        ("Привет, мир! Это обычный русский текст, в котором есть и Москва, и Пушкин. Съешь ещё булок.", ["windows-1251", "KOI8-R", "IBM866", "UTF-16LE", "UTF-16BE"]),
        ("これは日本語のテキストです。東京は日本の首都であり、とても大きな都市です。", ["Shift_JIS", "EUC-JP"]),
        ("Größe und Übermut: Straße, Käse, für öde Äpfel – „so“ war’s.", ["windows-1252", "UTF-16LE"]),
        ("Été à Noël, ça va où", ["windows-1252", "IBM850", "macintosh"]),
        ("Zażółć gęślą jaźń, Łódź i Kraków są w Polsce; dziękuję.", ["windows-1250"]),
        ("Αυτό είναι ένα ελληνικό κείμενο, η Αθήνα είναι η πρωτεύουσα.", ["windows-1253"]),
        ("这是一个中文文本，北京是中国的首都，人口很多。", ["GB18030"]),
        ("이것은 한국어 텍스트입니다. 서울은 대한민국의 수도이다.", ["EUC-KR"]),
    ],
)
def test_charsets(words, charsets):
    for name in charsets:
        assert charset.detect(words.encode(name)) == (name, words)
    for mark, name in charset.MARKS:
        assert charset.detect(mark + words.encode(name)) == (name, words)


def test_binary_content_is_no_text(spark):
    rng = np.random.default_rng(4)
    binary = [rng.bytes(500), b"\xff\xd8\xff\xe0\x00\x10JFIF\x00" + rng.bytes(300), b"PK\x03\x04\x14\x00" + rng.bytes(99), bytes(100), b"\x7fELF\x02\x01\x01" + bytes(9) + rng.bytes(60)]
    assert {charset.detect(b) for b in binary} == {(None, None)}
    rows = [(1, binary[0]), (2, None), (3, b""), (4, "é".encode("utf-16")), (5, b"\xef\xbb\xbfx"), (6, "<html><body>\u00e9t\u00e9 \u00e0 No\u00ebl</body></html>".encode("cp1252"))]
    got = {r.id: (r.charset, r.text, r.failed) for r in text.extract_text(spark.createDataFrame(rows, "id int, content binary")).collect()}
    assert got == {1: (None, None, True), 3: ("UTF-8", "", False), 4: ("UTF-16LE", "é", False), 5: ("UTF-8", "x", False), 6: ("windows-1252", "été à Noël", False)}


def test_extract_text(spark):
    pages = [
        (1, b"<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><p>a&nbsp;&amp;\n<b>b</b></p><script>var t='</p>';</script><div>c &eacute;</div></body></html>"),
        (2, "plain <b>text</b>".encode()), (3, b"\xff\xfe\x00\x01"), (4, b"nul\x00byte"), (5, None), (6, b"<html><p>open"),
    ]
    out = text.extract_text(spark.createDataFrame(pages, "id int, content binary"))
    got = {r.id: (r.text, r.failed) for r in out.collect()}
    assert got == {1: ("a &\nb\nc é", False), 2: ("plain <b>text</b>", False), 3: ("\u0100", False), 4: (None, True), 6: ("open", False)}  # 3 is UTF-16 with a mark


def test_term_vectors(spark):
    rows = spark.createDataFrame([(1, "The cat, the DOG; cat 42 été"), (2, "of the and"), (3, "")], "doc_id bigint, text string")
    got = {r.doc_id: [tuple(t) for t in r.terms] for r in text.term_vectors(text.tokens(rows)).collect()}
    assert got == {1: [("42", 1), ("cat", 2), ("dog", 1), ("été", 1)]}


def test_dictionary_is_dense_over_partitions(spark):
    stats = spark.range(5000).selectExpr("concat('t', id) term", "2 cf", "1 df")
    got = [tuple(r) for r in text.dictionary(stats).select("idx", "term").orderBy("idx").collect()]
    assert got == list(enumerate(sorted(f"t{i}" for i in range(5000))))


def vectors_of(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        idx = np.unique(np.concatenate([rng.integers(0, 12, 4), rng.integers(12, 200, 4)]))
        val = rng.random(len(idx)) + 0.1
        rows.append((i, [int(x) for x in idx], [float(x) for x in val / np.sqrt((val**2).sum())]))
    dense = np.zeros((n, 200))
    for i, idx, val in rows:
        dense[i, idx] = val
    return materialize(spark.createDataFrame(rows, cluster.VECTOR).repartition(5)), dense


def sequential_seeds(dense, t2):
    seeds = []
    for i, v in enumerate(dense):
        if all(1 - v @ dense[s] >= t2 for s in seeds):
            seeds.append(i)
    return seeds


def test_canopy_seeds_equal_the_sequential_rule(spark):
    vectors, dense = vectors_of(spark)
    want = sequential_seeds(dense, 0.65)
    got = [r.id for r in cluster.canopy_seeds(vectors, 0.65).orderBy("c").collect()]
    assert len(want) > 5 and got == want


def test_bounds_of_centres_hold_and_spare_products(spark, monkeypatch):
    """Tight groups far apart, one of two lone vectors at a tie: the bounds decide all but what is close."""
    rng = np.random.default_rng(1)
    dense = np.abs(rng.normal(0, 0.02, (120, 40)))
    dense[np.arange(120), np.arange(120) % 6] += 1.0
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    idx = list(range(40))
    vectors = materialize(spark.createDataFrame([(i, idx, v.tolist()) for i, v in enumerate(dense)], cluster.VECTOR))
    entries, nearest = cluster.canopy(vectors)
    means = np.zeros((6, 40))
    for r in entries.collect():
        means[r.c, r.idx] = r.val
    unit = means / np.linalg.norm(means, axis=1, keepdims=True)
    angles = np.arccos(np.clip(dense @ unit.T, -1, 1))
    rows = nearest.collect()
    assert len(rows) == 120
    for r in rows:
        assert r.upper >= angles[r.id, r.c] - 1e-9 and r.lower <= np.delete(angles[r.id], r.c).min() + 1e-9
    assert cluster.undecided(nearest).count() == 0
    members = cluster.reassign(vectors, entries, nearest)
    assert members.where("dot is not null").count() == 0 and {(r.id, r.c) for r in members.collect()} == {(i, i % 6) for i in range(120)}
    # One centre goes over to another group: only documents near it lose their bound, whatever the others think of such a move.
    means[2] = unit[3] + 0.2 * unit[2]
    unit2 = means / np.linalg.norm(means, axis=1, keepdims=True)
    angles = np.arccos(np.clip(dense @ unit2.T, -1, 1))
    turned = np.arccos(np.clip((unit * unit2).sum(axis=1), -1, 1))
    now = spark.createDataFrame([(c, i, float(means[c, i])) for c in range(6) for i in range(40)], "c bigint, idx int, val double")
    shifts = spark.createDataFrame([(c, float(turned[c])) for c in range(6)], "c bigint, shift double")
    for block in (1024, 2):
        monkeypatch.setattr(cluster, "BLOCK_VECTORS", block)
        moved = cluster.moved_bounds(members, shifts, vectors, now)
        for r in moved.collect():
            assert r.upper >= angles[r.id, r.c] - 1e-9 and r.lower <= np.delete(angles[r.id], r.c).min() + 1e-9
        assert {r.c for r in cluster.undecided(moved).collect()} == {2, 3}
        assert {(r.id, r.c) for r in cluster.reassign(vectors, now, moved).collect()} == set(enumerate(angles.argmin(axis=1)))
    tied = spark.createDataFrame([(1, 2, 0.5, 0.5), (2, 2, 0.4, 0.5), (3, 2, 0.5, None)], "id bigint, c bigint, upper double, lower double")
    assert {r.id for r in cluster.undecided(tied).collect()} == {1, 3}


def test_kmeans_against_dense(spark, monkeypatch):
    vectors, dense = vectors_of(spark)
    seeds = sequential_seeds(dense, 0.65)
    centres = np.array([dense[1 - dense @ dense[s] < 0.65].mean(axis=0) for s in seeds])
    monkeypatch.setattr(cluster, "BLOCK_VECTORS", 70)
    entries, nearest = cluster.canopy(vectors)
    assert nearest.count() == len(dense)
    n, number = len(seeds), {c: k for k, c in enumerate(seeds)}
    assert {r.c for r in entries.select("c").distinct().collect()} == set(seeds)
    got = np.zeros_like(centres)
    for r in entries.collect():
        got[number[r.c], r.idx] = r.val
    assert np.allclose(got, centres)
    for _ in range(20):
        unit = centres / np.linalg.norm(centres, axis=1, keepdims=True)
        member = (1 - dense @ unit.T).argmin(axis=1)
        new = np.array([dense[member == c].mean(axis=0) if (member == c).any() else centres[c] for c in range(n)])
        shift = 1 - (new * centres).sum(axis=1) / np.linalg.norm(new, axis=1) / np.linalg.norm(centres, axis=1)
        centres = new
        if (shift <= 0.01).all():
            break
    unit = centres / np.linalg.norm(centres, axis=1, keepdims=True)
    assigned, final = cluster.kmeans(vectors, entries, convergence=0.01)
    distance = 1 - dense @ unit.T
    for r in assigned.collect():
        assert distance[r.id, number[r.c]] == pytest.approx(distance[r.id].min()) and r.distance == pytest.approx(distance[r.id, number[r.c]])
    bounded, _ = cluster.kmeans(vectors, entries, convergence=0.01, start=nearest)
    assert sorted((r.id, r.c, round(r.distance, 9)) for r in bounded.collect()) == sorted((r.id, r.c, round(r.distance, 9)) for r in assigned.collect())
    terms = spark.range(200).selectExpr("concat('t', id) term", "id idx", "1 df")
    topics = cluster.cluster_topics(assigned, final, terms).collect()
    assert sum(t.n for t in topics) == len(dense) and all(len(t.kw.split(", ")) <= 10 for t in topics)
    top = {t.a: t.kw.split(", ")[0] for t in topics}
    assert all(centres[number[a]][int(t[1:])] == pytest.approx(centres[number[a]].max()) for a, t in top.items())
    docs = spark.range(310).selectExpr("id doc_id", "concat('/d', id) doc")
    placed = cluster.cluster_docs(docs, assigned, cluster.cluster_topics(assigned, final, terms))
    assert placed.count() == 310 and placed.where("a = -1").count() == 10


# ---- scripts ----


def entries(spark):
    rows = [("01", "/a", "x.txt", 3, b"abc", 5), ("02", "/a/", "y", None, b"", 5), ("03", "/b", "z.TXT", 7, b"q\nr", 3)]
    return spark.createDataFrame(rows, "entry_id string, path string, name string, size bigint, content binary, name_type bigint")


def test_mapper_sees_entries(spark):
    def mapper(key, entry, context):
        try:
            context.emit(entry.fullPath(), {"e": entry.extension(), "s": int(entry["size"]), "b": len(entry.getStream().read())})
        except KeyError:
            context.warning("no size")

    counters = scripting.JobCounters(spark)
    got = {r.key: r.value for r in scripting.run_mapper(entries(spark), mapper, "text", "json", counters=counters).collect()}
    assert got == {"/a/x.txt": '{"b": 3, "e": "txt", "s": 3}', "/b/z.TXT": '{"b": 3, "e": "txt", "s": 7}'}
    assert counters.values() == {"input_records": 3, "output_records": 2, "warnings": 1, "errors": 0}


def test_reducers(spark):
    pairs = spark.range(100).selectExpr("concat('k', id % 3) key", "id value")
    want = {f"k{k}": sum(range(k, 100, 3)) for k in range(3)}

    def total(key, values, context):
        context.emit(key, sum(values))

    for reducer, kw in (("LongSumReducer", {}), (total, {}), (total, {"combinable": True})):
        got = scripting.run_reducer(pairs, reducer, "text", "long", "long", **kw).collect()
        assert {r.key: r.value for r in got} == want
    assert scripting.run_reducer(pairs, "none").count() == 100
    ordered = [r.key for r in scripting.run_reducer(pairs, "identity").collect()]
    assert ordered == sorted(ordered)


def test_types():
    assert scripting.spark_type("long") == "bigint" and scripting.spark_type("json") == "string"
    with pytest.raises(ValueError):
        scripting.spark_type("int")


def test_run_command(spark):
    got = {r.entry_id: (r.stdout, r.exit_code) for r in scripting.run_command(entries(spark).fillna(0), ["wc", "-c"]).collect()}
    assert {k: (v[0].strip(), v[1]) for k, v in got.items()} == {"01": ("3", 0), "02": ("0", 0)}
    row = scripting.run_command(entries(spark), ["sleep", "5"], timeout=0.2).first()
    assert row.exit_code == -1 and row.stderr == "timed out"
    assert scripting.run_command(entries(spark), ["/no/such/command"]).first().exit_code == -1


def test_files_above_the_inline_limit_are_read(spark, tmp_path):
    big = b"0123456789abcdef" * 100_000
    (tmp_path / "disk.raw").write_bytes(big[800_000:] + big[:800_000])
    runs = [{"addr": 800_000, "len": 800_000}, {"addr": 0, "len": 800_000}]
    md5 = hashlib.md5(big).hexdigest()
    rows = [
        ("1", "/a", "big.jpg", 5, len(big), None, None, md5, runs, str(tmp_path / "disk.raw")),
        ("2", "/a", "small.jpg", 5, 3, b"abc", None, hashlib.md5(b"abc").hexdigest(), None, None),
        ("3", "/a", "absent.jpg", 5, 9, None, None, md5, None, None),
        ("4", "/a", "path.jpg", 5, len(big), None, "hdfs://big", None, runs, str(tmp_path / "disk.raw")),
    ]
    place = "extents array<struct<addr:bigint,len:bigint>>, image_uri string"
    e = spark.createDataFrame(rows, f"entry_id string, path string, name string, name_type bigint, size bigint, content binary, content_path string, md5 string, {place}")
    e = e.withColumn("sha1", F.lit(None).cast("string"))
    assert {r.entry_id: bytes(r.data) for r in inventory.export_by_ext(e, ["jpg"]).collect()} == {"1": big, "2": b"abc", "4": b""}
    assert {r.entry_id for r in inventory.regular_files(e).collect()} == {"1", "2", "4"}
    said = {r.entry_id: r.stdout.strip() for r in scripting.run_command(e, ["wc", "-c"]).collect()}
    assert said == {"1": str(len(big)), "2": "3", "4": str(len(big))}
    assert {r.full_path: r.md5 for r in content.calculated_md5s(e).collect()}["/a/big.jpg"] == md5
    assert {r.entry_id: r.matches for r in content.verify_md5(e).collect()} == {"1": True, "2": True, "3": False, "4": False}
