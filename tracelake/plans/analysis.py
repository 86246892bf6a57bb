"""The analysis of one image: text, search, clusters, similarity, and their report datasets."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cluster, content, known, search, similarity, text
from ..session import materialize
from ..sinks import write_report
from ..sources import Pattern, scan_entries


class Reports(NamedTuple):
    keyword_counts: DataFrame
    search_hits: DataFrame
    doc_cluster_counts: DataFrame
    doc_clusters: DataFrame
    similarity_scores: DataFrame


def analyse(
    entries: DataFrame,
    images: DataFrame,
    file_hashes: DataFrame,
    image_id: str,
    patterns: list[Pattern],
    out: str | None = None,
) -> Reports:
    """Run all steps for one image. ``entries`` is what ``ingest`` stores; large files are read from the image again.

    Search results are stored once and feed counts, hit rows and clustering. ``out`` names a folder
    for the report datasets (JSON lines).
    """
    mine = known.not_known_good(scan_entries(entries, image_id)).select("entry_id", "path", "name", "size", "content", "extents", "image_uri")
    mine = content.load_content(mine)
    texts = text.extract_text(mine).where("not failed").select("entry_id", "path", "name", "text")
    hits = materialize(search.grep_hits(texts, patterns), "hits")

    docs = materialize(
        search.hit_corpus(hits).select(F.xxhash64("entry_id").alias("doc_id"), "entry_id", "doc", "text"), "corpus"
    )
    vectors = materialize(text.term_vectors(text.tokens(docs)), "term-vectors")
    weights, kept = text.weighted_terms(vectors)
    terms = materialize(text.dictionary(kept), "dictionary")
    points = cluster.document_vectors(weights, terms)
    assignments, centres = cluster.kmeans(points, cluster.canopy(points)[0])
    topics = materialize(cluster.cluster_topics(assignments, centres, terms), "topics")

    names = images.select(F.col("image_id").alias("id"), F.col("friendly_name").alias("a"))
    scores = similarity.iif_scores(file_hashes, images, image_id).join(names, "id", "left")
    reports = Reports(
        search.hit_counts(hits, patterns),
        search.search_hits(hits, patterns),
        topics,
        cluster.cluster_docs(docs, assignments, topics),
        scores.select("a", "id", "c", "iif", "is_self"),
    )
    if out is not None:
        for name, rows in zip(
            ("keywordCounts", "searchHits", "docClusterCounts", "docClusters", "similarityScores"), reports
        ):
            write_report(rows, f"{out}/{name}")
    return reports
