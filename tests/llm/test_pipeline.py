"""The pipeline against its operators' own answers, stage by stage."""

import corpus_pipeline
from tallymart.llm import catalog, decontaminate, exact_dedup, quality, simhash


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{small}/labels.parquet")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        kept = stage(spark, docs, small).cache()
        after = {r.doc_id for r in kept.collect()}
        expected = {
            "quality": lambda d: [r.doc_id for r in quality.classify(d, labels).where("predicted = 1").collect()],
            "exact_dedup": lambda d: [r.doc_id for r in exact_dedup.exact_dedup(d).where("kept").collect()],
            "simhash": lambda d: [r.doc_id for r in simhash.simhash_dedup(d).where("doc_id = component_id").collect()],
            "decontaminate": lambda d: [
                r.doc_id for r in decontaminate.decontaminate(d, bench).where("not contaminated").collect()
            ],
        }[name](docs)
        assert after == set(expected) and after <= before and kept.columns == columns
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    assert {(r.doc_id, r.piece) for r in corpus_pipeline.run(spark, small).collect()} == {(r.doc_id, r.piece) for r in packed}


def test_stages_on_edge_cases(spark, docs, small):
    rows = docs.select("doc_id", "text").selectExpr("*", "'en' lang", "'s' source", "0L n_chars")
    empty = rows.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, rows, small).collect()
        assert stage(spark, empty, small).collect() == []


def test_registered():
    import __spark_entry__ as driver

    names = set(driver.queries())
    assert set(catalog.QUERIES) | {"pipeline"} <= names and set(driver.oracle_sql()) <= names


def test_one_row_of_every_group_stays(spark, prose):
    """Copies with one doc_id or none, and different texts with one doc_id."""
    a, b, c, d, e = (prose(60) for _ in range(5))
    given = [(1, a), (1, a), (2, b), (3, b), (3, c), (None, d), (None, d), (None, e), (9, e), (None, prose(60))]
    frame = spark.createDataFrame([(*r, "en") for r in given], "doc_id long, text string, lang string").repartition(3)
    expected = sorted([(1, a), (2, b), (3, c), (None, d), (9, e), given[-1]], key=str)
    for stage in (corpus_pipeline.exact_stage, corpus_pipeline.simhash_stage):
        got = stage(spark, frame, "")
        assert got.columns == frame.columns
        assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == expected
