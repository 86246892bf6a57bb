"""Classifiers, decontamination, URL rules, licences and top-k."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from tracelake.llm import catalog, licenses, url_filter
from tracelake.llm import top_k as lists
from tracelake.llm.decontaminate import TestItems, contamination, without_test_items
from tracelake.llm.language_id import _LETTER, ByteNetwork, Predictor, language_id
from tracelake.llm.top_k import top_k
from tracelake.llm.toxicity import BlockMaxIndex, _model, isotonic, toxicity, without_toxic

from .conftest import DOCS, SF_DIR, prose


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_match_their_sql(spark, name):
    assert compare(catalog.QUERIES[name](spark, SF_DIR), connect(SF_DIR), catalog.ORACLES[name]) is None


def test_block_max_search_is_exact():
    rng = np.random.default_rng(5)
    dense = np.where(rng.random((300, 40)) < 0.1, rng.random((300, 40)) / 10, 0)
    dense[np.arange(300), np.arange(300) // 8] = 1  # as in the model, neighbours have their strongest term in common
    slots, terms = np.nonzero(dense)
    order = np.lexsort((slots, terms))
    index = BlockMaxIndex(300, terms[order], slots[order], dense[slots, terms][order])
    for _ in range(50):
        query = np.where(rng.random(40) < 0.1, rng.random(40), 0)
        at = np.flatnonzero(query)
        got, scores = index.search(at, query[at], 7, without=3)
        want = dense @ query
        want[3] = 0
        best = [i for i in np.lexsort((np.arange(300), -want)) if want[i] > 0][:7]
        assert got.tolist() == best and np.allclose(scores, want[best])
    assert index.opened < 50 * 5


def test_terms_of_both_labels_count_when_they_tell():
    # Term 7 is in 60 % of the toxic and 40 % of the clean examples: nine standard deviations, one and a half times.
    rows = []
    for i in range(2000):
        toxic, share = i % 2, (0.6 if i % 2 else 0.4)
        terms = np.array([7] * (i // 2 % 100 < share * 100) + [9], dtype=np.uint64)
        rows.append({"doc_id": i, "toxic": toxic, "terms": terms.tobytes(), "times": np.ones(len(terms), dtype=np.int32).tobytes()})
    model = _model(rows, 0.5)
    assert model.vocabulary.tolist() == [7] and model.index is not None


def test_common_terms_leave_the_search_exact():
    rng = np.random.default_rng(11)
    dense = np.where(rng.random((1000, 30)) < 0.7, np.round(rng.random((1000, 30)), 1), 0)  # ties too
    slots, terms = np.nonzero(dense)
    order = np.lexsort((slots, terms))
    index = BlockMaxIndex(1000, terms[order], slots[order], dense[slots, terms][order])
    for _ in range(50):
        query = np.where(rng.random(30) < 0.4, np.round(rng.random(30), 1), 0)
        at = np.flatnonzero(query)
        want = np.zeros(1000)
        for t in at:
            want += query[t] * dense[:, t]
        want[5] = 0
        got, scores = index.search(at, query[at], 15, without=5)
        best = [i for i in np.lexsort((np.arange(1000), -want)) if want[i] > 0][:15]
        assert got.tolist() == best and scores.tolist() == want[best].tolist()


def test_isotonic_rises():
    x, y = isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([1, 0, 1, 1]), np.ones(4), 0.5)
    assert (np.diff(y) >= 0).all() and (np.diff(x) >= 0).all()


def test_toxicity_on_held_out_rows(spark):
    rows = toxicity(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    known = rows.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").toPandas()
    hit = (known.predicted == 1) & (known.toxic == 1)
    assert hit.sum() / (known.toxic == 1).sum() > 0.85 and hit.sum() / (known.predicted == 1).sum() > 0.85
    assert ((known.score >= 0) & (known.score <= 1) & ((known.score >= 0.3) == (known.predicted == 1))).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(known.doc_id, known.held_out, strict=True))


def test_toxicity_of_odd_rows(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (4, 0, None), (None, 0, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity(docs, labels).count() == docs.count()
    assert toxicity(docs, labels.limit(0)).where("score <> 0 OR predicted <> 0").count() == 0
    assert toxicity(nothing, labels).count() == 0
    kept = without_toxic(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.97 and rows.score.between(0, 1).all()


def test_language_of_odd_rows(spark, docs, nothing):
    rows = {(r.doc_id, r.lang_pred) for r in language_id(docs).collect()}
    by_text = {r.doc_id: r.text for r in docs.collect()}
    assert all((lang == "und") == (not any(c.isalpha() for c in by_text[i] or "")) for i, lang in rows if i not in (None, 4))
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id(unlabelled).collect()} == {"und"}
    assert [bool(_LETTER.search(t)) for t in ("²", "½ Ⅷ", "①_1", "é", "x²", "日")] == [False, False, False, True, True, True]
    assert language_id(nothing).count() == 0


def test_pair_tables_equal_the_filters():
    network = ByteNetwork.fresh(["a", "b"])
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 128 * 3).astype(np.uint8)
    padded = np.concatenate((data, np.zeros(3, dtype=np.uint8)))
    windows = np.stack([padded[i * 128 : i * 128 + 131] for i in range(3)])
    plain = network.responses(windows).max(axis=1)
    hidden = np.maximum(plain + network.bias, 0) @ network.out
    want = np.exp(hidden) / np.exp(hidden).sum(axis=1, keepdims=True)
    assert np.allclose(Predictor(network).windows(data), want, atol=1e-4)


def tiled(item, text, least=5):
    """Greedy string tiling as its definition has it."""
    mine, theirs, total = [False] * len(item), [False] * len(text), 0
    while True:
        best, places = least - 1, []
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and not mine[i + k] and not theirs[j + k]:
                    k += 1
                if k > best:
                    best, places = k, [(i, j)]
        if not places:
            return total
        i, j = places[0]
        for k in range(best):
            mine[i + k] = theirs[j + k] = True
        total += best


def test_tiles_cover_as_the_definition_says():
    rng = random.Random(6)
    for _ in range(40):
        item = [rng.choice("abcdefghijklmnop") for _ in range(40)]
        at = sorted(rng.sample(range(5, 36), 2))
        parts = [item[: at[0]], item[at[0] : at[1]], item[at[1] :]]
        rng.shuffle(parts)
        text = [w for p in parts for w in [*p, *(rng.choice("xyz") for _ in range(3))]]
        (_,), (share,) = TestItems([1], [" ".join(item)]).found([" ".join(text)])
        assert share == tiled(item, text) / 40


def test_reordered_passages_are_found_and_clean_texts_stay(spark, docs, nothing):
    rng = random.Random(2)
    item = prose(rng, 30).split()
    moved = " ".join([*prose(rng, 50).split(), *item[18:], *prose(rng, 9).split(), *item[:18]])
    benchmark = spark.createDataFrame([(5, " ".join(item)), (5, " ".join(item)), (6, None), (7, ""), (8, "two words")], "item_id long, text string")
    more = spark.createDataFrame([(900, moved, "en", "s", 1), (901, " ".join(item[:12]), "en", "s", 1), (902, "has two, WORDS", "en", "s", 1)], DOCS)
    rows = {r.doc_id: r for r in contamination(docs.select(*more.columns).unionByName(more), benchmark).collect()}
    assert (rows[900].contaminated, rows[900].item_ids, rows[900].coverage) == (True, [5], 1.0)
    assert not rows[901].contaminated and rows[901].coverage == 0.4 and rows[902].item_ids == [8]
    assert sum(r.contaminated for r in rows.values()) == 2
    assert without_test_items(more, benchmark).select("doc_id").collect()[0][0] == 901
    assert contamination(docs, benchmark.limit(0)).where("contaminated").count() == 0
    assert contamination(nothing, benchmark).count() == without_test_items(nothing, benchmark).count() == 0


def test_url_rules_and_parts(spark):
    urls = ["http://A.COM/x", "http://a.com", "x", None, "https://e.net/es/1?a=/fr/#b", "http://www.example.com/en/1", "http://b.EXAMPLE.com/en/", "http://netx/es/", "http://net/fr/", "://"]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert got[0] == ("a.com", "/x", "com/", "allow") and got[1][:3] == ("a.com", "", None) and got[2][:3] == got[3][:3] == got[9][:3] == ("", "", None)
    assert got[4] == ("e.net", "/es/1", "net/es/", "block") and got[5][2:] == ("www.example.com/en/", "allow") and got[6][2:] == ("example.com/en/", "block")
    assert got[7][:3] == ("netx", "/es/", None) and got[8][2] == "net/fr/"
    assert {v[3] for v in got.values()} <= {"allow", "block"}
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_mined_rules_are_those_of_counting(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        tokens = [rng.choice(["a", "b", "c"]), rng.choice(["d", "e"]), rng.choice(["f", "g", "h"])]
        rows.append((sorted(tokens), "block" if tokens[:2] == ["a", "d"] or rng.random() < 0.1 else "allow"))
    got = url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, label string"))
    sets = sorted({(tuple(t), label) for t, label in rows})
    want = []
    for k in (1, 2, 3):
        for part in sorted({c for t, _ in sets for c in combinations(t, k)}):
            for label in ("allow", "block"):
                every = [s for s in sets if set(part) <= set(s[0])]
                hit = [s for s in every if s[1] == label]
                if hit and len(hit) / len(sets) >= url_filter.MIN_SUPPORT and len(hit) / len(every) >= url_filter.MIN_CONFIDENCE:
                    want.append((part, label, len(hit) / len(every), len(hit) / len(sets)))
    assert [(t, label, round(c, 9), round(s, 9)) for t, label, c, s in got] == [(t, label, round(c, 9), round(s, 9)) for t, label, c, s in url_filter.prune(want)]
    index = url_filter.RuleIndex(got)
    for tokens, _ in rows[:50]:
        fits = [i for i, r in enumerate(got) if set(r[0]) <= set(tokens)]
        assert index.best(tokens) == (min(fits) if fits else None)


def test_every_labelled_page_counts(spark):
    # One pattern with numbers holds a third of the labelled pages; each of the others has a pattern of its own.
    urls = [f"http://q.net/es/{i}" for i in range(300)] + [f"http://s{i}.com/w{i}" for i in range(600)]
    pages = spark.createDataFrame([*enumerate(urls), (900, "http://q.org/es/7")], "page_id long, url string")
    labelled = [(["host0=net", "host1=q", "path0=es", "path1=#"], "block")] * 300 + [([f"host1=s{i}", "host0=com"], "allow") for i in range(600)]
    rules = url_filter.mine(spark.createDataFrame(labelled, "tokens array<string>, label string"), each_row=True)
    assert {(t, label, c, round(s, 9)) for t, label, c, s in rules} >= {(("path0=es",), "block", 1.0, round(1 / 3, 9)), (("host0=com",), "allow", 1.0, round(2 / 3, 9))}
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()}
    assert got[900] == "block" and got[0] == "block" and got[300] == "allow"


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def test_licences_of_odd_texts(spark, docs, nothing):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 200)
    texts = [mit, mit.replace(" ", "\n", 30), "  released UNDER the mit license!! ", "Released under the terms", f"x\n\n{mit[:300]}\n{mit[300:]}\n\nLicensed under CC BY 4.0.", None, "", "\n\n"]
    rows = spark.createDataFrame([(i, t, "v") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in licenses.scan(rows).collect()}
    assert [got[i].license for i in range(8)] == ["MIT", "MIT", "MIT", None, "CC-BY-4.0", None, None, None]
    assert got[2].score == 1.0 and [x.name for x in got[4].licenses] == ["CC-BY-4.0", "MIT"]
    assert licenses.scan(docs).count() == docs.count() and licenses.scan(nothing).count() == 0


def test_telling_words_and_bounds_lose_no_match():
    rng = random.Random(8)
    for _, text in licenses.TEMPLATES:
        bigrams = set(licenses.template_bigrams(text))
        low, high = licenses.size_bounds(len(bigrams), licenses.MIN_DICE)
        tells = set(licenses.telling_words(text, licenses.MIN_DICE))
        for _ in range(200):
            some = set(rng.sample(sorted(bigrams), rng.randrange(len(bigrams) + 1))) | {f"x {i}" for i in range(rng.randrange(6))}
            if some and dice(some, bigrams) >= licenses.MIN_DICE:
                assert low <= len(some) <= high and tells & {w for b in some for w in b.split()}


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 0.5]), (40, [0.1, -2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [1.0]), (None, [1.0, 1.0]), (60, [1e9, 1e9]), (8, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = [tuple(r) for r in top_k(vectors, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()]
    usable = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v and len(v) == 2 and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in usable:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q)[:3]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    assert top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def _plain_top(query_id, query, ids, data, k):
    scores = [(-sum(int(a) * int(b) for a, b in zip(query, v)), int(i)) for i, v in zip(ids, data) if i != query_id]
    return [(i, -s) for s, i in sorted(scores)[:k]]


@pytest.mark.parametrize("scale", [1, 3, 2**10, 2**28])
def test_reading_lists_equals_all_products(scale):
    """Ties, repeated ids, zero and negative components, single candidates, and sums beyond 2**53."""
    rng = np.random.default_rng(scale)
    for n, dims in ((1, 1), (2, 3), (90, 4), (300, 12)):
        data = rng.integers(-2, 3, (n, dims)) * scale + (rng.integers(0, 2, (n, dims)) if scale > 1 else 0)
        ids = rng.integers(0, max(2, n * 2 // 3), n)
        block = lists.SortedLists.of(ids, data)
        for query in (*data[:20], np.zeros(dims, dtype=np.int64), -data[0]):
            for k in (1, 5, 400):
                want = _plain_top(1, query, ids, data, k)
                got = list(zip(*(x.tolist() for x in lists.best_of_block(1, query, block, k))))
                assert got == want
                if want:  # with what other blocks made sure
                    floor = want[len(want) // 2][1]
                    got = list(zip(*(x.tolist() for x in lists.best_of_block(1, query, block, k, floor))))
                    assert got == [w for w in want if w[1] >= floor]


def test_nothing_behind_the_stop_is_read():
    """A few candidates stand out, so reading stops early; what lies behind in the lists may be anything."""
    rng = np.random.default_rng(7)
    data = rng.integers(0, 40, (1600, 5))
    data[:30] += 1000
    query, ids = np.array([3, 1, 2, 1, 5]), np.arange(1600)
    want = _plain_top(-1, query, ids, data, 20)
    block = lists.SortedLists.of(ids, data)
    reader = lists.Reader(block, query)
    reader.read(100)
    assert (reader.sums + reader.base <= data @ query).all() and (reader.upper() + reader.base >= data @ query).all()
    assert reader.outsider() + reader.base < want[-1][1]
    block = lists.SortedLists.of(ids, data)
    block.values[:, 100:] = -(2**40)  # every candidate in the running was shown by all lists before
    assert list(zip(*(x.tolist() for x in lists.best_of_block(-1, query, block, 20)))) == want
    untouched = lists.SortedLists.of(ids, data)
    untouched.order, untouched.values = None, None  # a floor out of reach: no list is opened
    assert len(lists.best_of_block(-1, query, untouched, 20, floor=10**6)[0]) == 0


def test_lists_are_read_once_for_all_queries(monkeypatch):
    """The steps of reading follow the blocks, not the pairs of a query and a block."""
    rng = np.random.default_rng(11)
    data = rng.integers(-30, 31, (800, 16))
    steps, read = [], lists.Reader.read
    monkeypatch.setattr(lists.Reader, "read", lambda self, depth: (steps.append(depth), read(self, depth)))
    best = lists.Best(np.arange(0, 800, 4), data[::4], 5)
    for start in (0, 400):
        best.see(lists.SortedLists.of(np.arange(start, start + 400), data[start : start + 400]))
    assert 2 <= len(steps) <= 12
    got = best.rows()
    for q in range(0, 800, 4):
        one = got[got["query_id"] == q]
        assert list(zip(one["vec_id"], one["score"])) == _plain_top(q, data[q], range(800), data, 5)


def test_queries_of_any_size_read_together(monkeypatch):
    """Sums of every kind of number, zero queries, ties and repeated ids side by side; floors come from the blocks before."""
    monkeypatch.setattr(lists, "NUMBERS", tuple((kind, limit, 3) for kind, limit, _ in lists.NUMBERS))
    monkeypatch.setattr(lists, "CELLS", 40)
    rng = np.random.default_rng(12)
    data = rng.integers(-4, 5, (240, 6))
    data[5::40] *= 2**17
    ids = rng.integers(0, 200, 240)
    queries = np.concatenate([data[6:14] * scale for scale in (0, 1, 2**11, 2**30, 2**39)])
    query_ids = np.concatenate((ids[6:14], np.arange(1000, 1032)))
    best = lists.Best(query_ids, queries, 6)
    for start, end in ((0, 3), (3, 100), (100, 170), (170, 240)):
        best.see(lists.SortedLists.of(ids[start:end], data[start:end]))
    got = best.rows()
    found = {}
    for q, i, s in got.itertuples(index=False):
        found.setdefault(q, []).append((i, s))
    distinct = [n for n, q in enumerate(query_ids) if (query_ids == q).sum() == 1]
    assert len(distinct) > 30 and {int(k) for n in distinct for k in lists.kinds(lists.SortedLists.of(ids, data), queries[n : n + 1])} == {0, 1, 2, 3}
    for n in distinct:
        assert found[query_ids[n]] == _plain_top(query_ids[n], queries[n], ids, data, 6)


def test_the_least_long_stands_last_in_its_list():
    block = lists.SortedLists.of([1, 2, 3], [[5], [-(2**63)], [7]])
    assert [x.tolist() for x in lists.best_of_block(0, np.array([1]), block, 2)] == [[3, 1], [7, 5]]


def test_only_scores_beyond_64_bits_are_an_error():
    block = lists.SortedLists.of([1, 2, 3], [[2**40], [5], [-(2**40)]])
    with pytest.raises(OverflowError):
        lists.best_of_block(0, np.array([2**30]), block, 1)
    assert [x.tolist() for x in lists.best_of_block(1, np.array([2**30]), block, 1)] == [[2], [5 * 2**30]]


def test_top_k_over_many_blocks(spark, monkeypatch):
    """Rows that leave the tasks are in proportion to queries and slices, whatever the number of blocks; ties across blocks go to the smaller id."""
    rng = np.random.default_rng(3)
    data = rng.integers(-3, 4, (400, 6)) / 64
    monkeypatch.setattr(lists, "QUERY_BLOCK", 8)
    monkeypatch.setattr(lists, "HELD", 2)
    vectors = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(data)], "vec_id long, embedding array<double>, score string").repartition(9)
    got = top_k(vectors, F.col("vec_id") % 20 == 0, k=7).collect()
    whole = np.floor(data * 64).astype(int)
    want = {(q, r + 1, i, s) for q in range(0, 400, 20) for r, (i, s) in enumerate(_plain_top(q, whole[q], range(400), whole, 7))}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    best = lists.Best(np.array([0, 20]), whole[[0, 20]], 7)
    for start in range(0, 400, 50):
        best.see(lists.SortedLists.of(np.arange(start, start + 50), whole[start : start + 50]))
    assert len(best.rows()) == 14
