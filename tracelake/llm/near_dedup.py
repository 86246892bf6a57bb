"""Near-duplicate documents by MinHash and a multi-index Hamming join.

A text's set holds its distinct runs of five words. Its signature has ``CHUNKS * WIDTH`` MinHash
values of 16 bits each. Two signatures that differ in at most ``2 * CHUNKS - 1`` values agree, by the
pigeonhole principle, in some chunk up to one value. So each chunk is stored under ``WIDTH`` keys,
each leaving out one value, and every such pair meets under an equal key. (Pairs that differ more may
meet too; at a Jaccard similarity of 0.75 a pair stays apart with a probability of 0.367 ** 12.)

Pairs that meet are confirmed on their full sets. Texts with equal sets are one node throughout. In a
group of copies not all pairs are compared. First the shingles are counted that a node shares with no other node
that has a key in common with any: of ``n`` shingles only the ``c`` others can be in an intersection, so nodes with ``c < 0.75 n``
have no link at all, and two nodes none if ``7 min(c, c') < 3 (n + n')``. Then each key links its nodes to
a pivot, the node with the least share of shingles of its own (mostly the text that the others are copies of). Nodes
under keys that still hold several components are grouped by their key's pivot and compared block by block, by counting all overlaps of a block's sets
together; pairs are never rows.

Defined cases: a null or empty text, or one of white space only, has no shingles and is linked with
nothing; a text of fewer than five words has its whole sequence as its one shingle; a row without
``doc_id`` is never linked and gets no component; repeated rows are nodes like any other copies and each
gets its row in the result; columns other than ``doc_id`` and ``text`` are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import components, mix, small_batches, word_hashes, word_windows

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
CHUNKS, WIDTH = 12, 5
VALUES = CHUNKS * WIDTH
#: Pairs with more differing values go unconfirmed: six standard deviations beyond what 0.75 gives.
MAX_DISTANCE = 36
#: Shingles for each bucket in which those of one node only are found. Sets the number of buckets; results don't depend on it.
BUCKET_SHINGLES = 1 << 20

#: Shingles for each block of a group whose nodes are compared; results don't depend on it.
BLOCK_SHINGLES = 300_000
#: Pairs of sets with a member from which on it takes part in a matrix product.
DENSE_PAIRS = 4096
_COLUMNS = 1024
_PAIRS_AT_ONCE = 1 << 14

_rng = np.random.Generator(np.random.PCG64(7))
_FACTORS = _rng.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(1, 1 << 63, VALUES, dtype=np.uint64)
_KEY_FACTORS = _rng.integers(1, 1 << 63, (CHUNKS, WIDTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 8192


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(word_windows(word_hashes(text), SHINGLE_WORDS))


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit identity of a set, 0 for the empty one."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True) if len(shingles) else 0


def signature(shingles: np.ndarray) -> np.ndarray:
    """The lowest 16 bits of each hash function's minimum, after a mix."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        part = shingles[at : at + _BLOCK]
        np.minimum(low, (part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1), out=low)
    return (mix(low) & np.uint64(0xFFFF)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """For each row of signatures its keys: every chunk with each of its values left out in turn."""
    parts = signatures.reshape(-1, CHUNKS, WIDTH).astype(np.uint64) + np.uint64(1)
    weighed = mix(parts * _KEY_FACTORS)
    number = np.arange(CHUNKS * WIDTH, dtype=np.uint64).reshape(CHUNKS, WIDTH)
    return mix(weighed.sum(axis=2, dtype=np.uint64)[:, :, None] - weighed + number).reshape(len(signatures), -1)


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts, nodes, signatures = [], [], []
        for text in batch["text"]:
            shingles = shingle_set(text)
            counts.append(len(shingles))
            nodes.append(set_id(shingles))
            signatures.append(signature(shingles))
        signatures = np.array(signatures, dtype=np.uint16).reshape(-1, VALUES)
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"],
                "n_shingles": pd.Series(counts, dtype="int64"),
                "node": pd.Series(nodes, dtype="int64"),
                "sig": [row.tobytes() for row in signatures],
            }
        )


def _stored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each node and key."""
    for batch in batches:
        for at in range(0, len(batch), _BLOCK):
            part = batch.iloc[at : at + _BLOCK]
            keys = chunk_keys(np.frombuffer(b"".join(part["sig"]), dtype=np.uint16).reshape(-1, VALUES)).view(np.int64)
            times = keys.shape[1]
            yield pd.DataFrame({"node": np.repeat(part["node"].to_numpy(), times), "n": np.repeat(part["n"].to_numpy(), times), "key": keys.ravel()})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingle_set(text) for text in batch["text"]]
        yield pd.DataFrame({"node": pd.Series([set_id(s) for s in sets], dtype="int64"), "shingles": [s.tobytes() for s in sets]})


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        linked = []
        for left, right in zip(batch["left_set"], batch["right_set"], strict=True):
            x, y = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= SIMILARITY_PERCENT * (len(x) + len(y) - both))
        yield batch.loc[linked, ["a", "b"]]


def _near_signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        x, y = (np.frombuffer(b"".join(batch[c]), dtype=np.uint16).reshape(-1, VALUES) for c in ("left_sig", "right_sig"))
        yield batch.loc[(x != y).sum(axis=1) <= MAX_DISTANCE, ["a", "b"]]


_SEVERAL = 0xFFFF


def _deal_shingles(bits: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A row for each batch and bucket: 48 bits of each shingle and the node that has it, or that several have it."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), _SEVERAL - 1):
                batch = whole.iloc[at : at + _SEVERAL - 1]
                sets = [np.frombuffer(b, dtype=np.uint64) for b in batch["shingles"]]
                entries = np.concatenate(sets) & ~np.uint64(_SEVERAL) | np.repeat(np.arange(len(sets), dtype=np.uint64), [len(x) for x in sets])
                entries.sort()
                hashes = entries >> np.uint64(16)
                new = np.concatenate((np.ones(1, dtype=bool), hashes[1:] != hashes[:-1]))
                alone = new & np.append(new[1:], True)
                entries = np.where(alone, entries, entries | np.uint64(_SEVERAL))[new]
                cuts = np.append(np.searchsorted(entries, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), len(entries))
                nodes = batch["node"].to_numpy(dtype=np.int64).tobytes()
                found = [(b, entries[cuts[b] : cuts[b + 1]].tobytes(), nodes) for b in range(1 << bits) if cuts[b] < cuts[b + 1]]
                yield pd.DataFrame(found, columns=["bucket", "entries", "nodes"])

    return deal


def _count_own(bucket: pd.DataFrame) -> pd.DataFrame:
    """``node, own``: the shingles of the bucket that this node alone has."""
    entries = [np.frombuffer(b, dtype=np.uint64) for b in bucket["entries"]]
    nodes = [np.frombuffer(b, dtype=np.int64) for b in bucket["nodes"]]
    base = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum([len(n) for n in nodes])))
    all_, source = np.concatenate(entries), np.repeat(np.arange(len(entries)), [len(e) for e in entries])
    order = np.argsort(all_ >> np.uint64(16), kind="stable")
    hashes, number = all_[order] >> np.uint64(16), (all_[order] & np.uint64(_SEVERAL)).astype(np.int64)
    new = np.concatenate((np.ones(1, dtype=bool), hashes[1:] != hashes[:-1]))
    alone = new & np.append(new[1:], True) & (number != _SEVERAL)
    node, own = np.unique(np.concatenate(nodes)[base[source[order]][alone] + number[alone]], return_counts=True)
    return pd.DataFrame({"node": node, "own": own})


def _may_link() -> F.Column:
    """Sizes and shared shingles with which the similarity can be reached at all."""
    low, high = F.least("n", "n2"), F.greatest("n", "n2")
    return (100 * low >= SIMILARITY_PERCENT * high) & (7 * F.least("c", "c2") >= 3 * (F.col("n") + F.col("n2")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest ``doc_id`` reachable over links; ``kept`` marks that document.
    """
    small_batches(docs)
    found = materialize(
        docs.select("doc_id", "text").mapInPandas(_describe, "doc_id long, n_shingles long, node long, sig binary"), "minhash"
    )
    real = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = materialize(
        real.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")), "nodes"
    )
    stored = nodes.select("node", "n", "sig").mapInPandas(_stored, "node long, n long, key long")
    shared = stored.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("key")
    members = materialize(stored.join(shared, "key"), "members")
    links = _links(docs, nodes, members)
    parts = components(links)
    labelled = nodes.select("node", "doc_id").join(parts, "node", "left").select("node", "doc_id", F.coalesce("comp", "node").alias("comp"))
    smallest = labelled.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    classes = labelled.join(smallest, "comp").select("node", "component_id")
    result = real.select("doc_id", "n_shingles", "node").join(classes, "node").select("doc_id", "n_shingles", "component_id")
    alone = found.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return result.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns; of rows with equal sets and one id all stay."""
    dropped = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def _links(docs: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Confirmed links ``(a, b)`` between nodes that give the components of all links."""
    wanted = members.select("node").distinct().join(nodes.select("node", "doc_id", "n"), "node")
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").join(wanted.select("doc_id"), "doc_id", "left_semi")
    sets = materialize(texts.select("text").mapInPandas(_sets, "node long, shingles binary"), "sets")
    total = wanted.agg(F.sum("n")).first()[0] or 0
    bits = max(2, math.ceil(math.log2(max(1, total / BUCKET_SHINGLES))))
    own = sets.mapInPandas(_deal_shingles(bits), "bucket int, entries binary, nodes binary").groupBy("bucket").applyInPandas(_count_own, "node long, own long")
    own = own.groupBy("node").agg(F.sum("own").alias("own"))
    counted = members.join(own, "node", "left").withColumn("c", F.col("n") - F.coalesce("own", F.lit(0))).where(100 * F.col("c") >= SIMILARITY_PERCENT * F.col("n"))
    rows = materialize(counted.select("key", "node", "n", "c"), "rows")

    def confirmed(pairs: DataFrame) -> DataFrame:
        sigs = nodes.select("node", "sig")
        near = (
            pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("left_sig")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("right_sig")), "b")
            .mapInPandas(_near_signatures, "a long, b long")
        )
        full = near.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left_set")), "a").join(
            sets.select(F.col("node").alias("b"), F.col("shingles").alias("right_set")), "b"
        )
        return materialize(full.mapInPandas(_confirm, "a long, b long"), "links")

    def as_pairs(found: DataFrame) -> DataFrame:
        return found.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()

    of_key = F.struct("node", "n", "c")
    pivots = rows.groupBy("key").agg(
        F.min_by(of_key, F.struct((1 - F.col("c") / F.col("n")).alias("own"), F.xxhash64("node"))).alias("p")
    )
    pivots = pivots.select("key", *(F.col(f"p.{c}").alias(f"{c}2") for c in ("node", "n", "c")))
    links = confirmed(as_pairs(rows.join(pivots, "key").where((F.col("node") != F.col("node2")) & _may_link())))
    state = rows.join(components(links), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    state = materialize(state.select("key", "node", "n", "comp"), "state")
    open_keys = state.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").select("key")
    groups = state.join(open_keys, "key", "left_semi").join(pivots.select("key", F.col("node2").alias("pivot")), "key").select("pivot", "node", "n", "comp").distinct()
    return links.unionByName(_links_between(materialize(groups, "groups"), sets))


def _links_between(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between nodes of different components within each group (``pivot, node, n, comp``).

    Groups are dealt to blocks of about ``BLOCK_SHINGLES`` shingles; every two blocks of a group meet once, and all overlaps of their nodes are
    counted together, so only links leave a block.
    """
    blocks = groups.groupBy("pivot").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    placed = groups.join(blocks, "pivot").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    filled = placed.join(sets, "node").select("pivot", "blocks", "block", "node", "comp", "shingles")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node")  # a set is stored once for each row with its id
        one = rows.iloc[0]
        sizes = np.array([len(b) // 8 for b in rows["shingles"]], dtype=np.int32)
        parts = {"nodes": rows["node"].to_numpy(dtype=np.int64).tobytes(), "comps": rows["comp"].to_numpy(dtype=np.int64).tobytes()}
        return pd.DataFrame([{"pivot": one["pivot"], "blocks": one["blocks"], "block": one["block"], **parts, "sizes": sizes.tobytes(), "data": b"".join(rows["shingles"])}])

    packed = filled.groupBy("pivot", "block").applyInPandas(pack, "pivot long, blocks int, block int, nodes binary, comps binary, sizes binary, data binary")
    columns = ("nodes", "comps", "sizes", "data")
    left = packed.withColumn("other", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
    right = packed.select("pivot", F.col("block").alias("other"), *(F.col(c).alias(f"{c}2") for c in columns))
    return materialize(left.join(right, ["pivot", "other"]).mapInPandas(_block_links, "a long, b long"), "links")


def _block_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            nodes, nodes2 = (np.frombuffer(x, dtype=np.int64) for x in (row.nodes, row.nodes2))
            comps, comps2 = (np.frombuffer(x, dtype=np.int64) for x in (row.comps, row.comps2))
            size, size2 = (np.frombuffer(x, dtype=np.int32).astype(np.int64) for x in (row.sizes, row.sizes2))
            both = overlaps(np.frombuffer(row.data, dtype=np.uint64), size, np.frombuffer(row.data2, dtype=np.uint64), size2)
            linked = (comps[:, None] != comps2[None, :]) & (100 * both >= SIMILARITY_PERCENT * (size[:, None] + size2[None, :] - both))
            at, at2 = np.nonzero(linked)
            yield pd.DataFrame({"a": np.minimum(nodes[at], nodes2[at2]), "b": np.maximum(nodes[at], nodes2[at2])})


def overlaps(left: np.ndarray, sizes: np.ndarray, right: np.ndarray, sizes2: np.ndarray) -> np.ndarray:
    """How many members each left set shares with each right set; the sets stand one after the other."""
    owner, owner2 = np.repeat(np.arange(len(sizes)), sizes), np.repeat(np.arange(len(sizes2)), sizes2)
    known, place, count = np.unique(left, return_inverse=True, return_counts=True)
    place2 = np.minimum(np.searchsorted(known, right), len(known) - 1)
    hit = known[place2] == right
    owner2, place2 = owner2[hit], place2[hit]
    count2 = np.bincount(place2, minlength=len(known))
    total = np.zeros((len(sizes), len(sizes2)), dtype=np.int64)
    # A member in many sets on both sides is one column of a matrix product; of any other the pairs are counted.
    dense = count * count2 >= DENSE_PAIRS
    columns = np.cumsum(dense) - 1
    for at in range(0, int(dense.sum()), _COLUMNS):
        mine = dense[place] & (columns[place] >= at) & (columns[place] < at + _COLUMNS)
        theirs = dense[place2] & (columns[place2] >= at) & (columns[place2] < at + _COLUMNS)
        x, y = np.zeros((len(sizes), _COLUMNS), dtype=np.float32), np.zeros((len(sizes2), _COLUMNS), dtype=np.float32)
        x[owner[mine], columns[place[mine]] - at] = 1
        y[owner2[theirs], columns[place2[theirs]] - at] = 1
        total += (x @ y.T).astype(np.int64)
    few = (~dense) & (count2 > 0)
    mine, theirs = np.flatnonzero(few[place]), np.flatnonzero(few[place2])
    theirs = theirs[np.argsort(place2[theirs], kind="stable")]
    begin = np.searchsorted(place2[theirs], np.arange(len(known)))
    for at in range(0, len(mine), _PAIRS_AT_ONCE):
        part = mine[at : at + _PAIRS_AT_ONCE]
        n = count2[place[part]]
        cuts = np.cumsum(n)
        index = np.arange(cuts[-1]) + np.repeat(begin[place[part]] - (cuts - n), n)
        np.add.at(total, (np.repeat(owner[part], n), owner2[theirs[index]]), 1)
    return total
