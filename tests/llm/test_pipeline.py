"""The pipeline stage by stage, and whole."""

import corpus_pipeline
from tracelake.llm.decontaminate import contamination
from tracelake.llm.near_dedup import near_duplicates
from tracelake.llm.packing import pieces
from tracelake.llm.suffix_dedup import without_repeats
from tracelake.llm.toxicity import toxicity

SF = "/root/testdata/sf0.01"


def test_each_stage_keeps_what_its_operator_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_dedup", "decontamination", "packing"]

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    a = corpus_pipeline.materialize(stages["toxicity"](spark, docs, SF), "t")
    assert a.columns == docs.columns and ids(a) == ids(toxicity(docs, labels).where("predicted = 0"))
    b = corpus_pipeline.materialize(stages["near_dedup"](spark, a, SF), "t")
    assert b.columns == docs.columns and ids(b) == ids(near_duplicates(a).where("kept"))
    c = corpus_pipeline.materialize(stages["suffix_dedup"](spark, b, SF), "t")
    removed = {r.doc_id: r.n_removed for r in without_repeats(b).collect()}
    before = {r.doc_id: len(r.text.encode()) for r in b.collect()}
    assert c.columns == docs.columns and ids(c) == ids(b)
    assert all(0 <= before[r.doc_id] - removed[r.doc_id] - len(r.text.encode()) <= 8 * (removed[r.doc_id] > 0) + removed[r.doc_id] for r in c.collect())
    d = corpus_pipeline.materialize(stages["decontamination"](spark, c, SF), "t")
    assert d.columns == docs.columns and ids(d) == ids(contamination(c, benchmark).where("NOT contaminated"))
    packed = stages["packing"](spark, d, SF)
    assert packed.count() == pieces(d).count()


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(rows.columns)
