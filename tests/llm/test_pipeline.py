"""Every stage of the pipeline on its own input, against brute force."""

from pyspark.sql import functions as F

import corpus_pipeline
from marlstone.llm import packing, quality
from marlstone.llm.folders import kept, released
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    docs = kept(stages["quality_rules"](spark, docs, FOLDER))
    wanted = {d for d, t in texts.items() if not any(r.rejects(quality.Text(t)) for r in quality.RULES)}
    assert {r["doc_id"] for r in docs.collect()} == wanted and docs.columns == columns

    texts = {d: texts[d] for d in wanted}
    docs = kept(stages["near_duplicates"](spark, docs, FOLDER))
    wanted = {d for d, (_, c) in brute.components(texts, 5).items() if d == c}
    assert {r["doc_id"] for r in docs.collect()} == wanted and docs.columns == columns

    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    docs = kept(stages["benchmark_leaks"](spark, docs, FOLDER))
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    leaked = {d for d in wanted if any(item in texts[d] for item in items)}
    assert set(left) == wanted - leaked and docs.columns == columns

    docs = kept(stages["secrets"](spark, docs, FOLDER))
    assert docs.columns == columns and docs.count() == len(left)
    for r in docs.collect():
        assert sum(brute.secrets(r["text"])[:3]) == 0 and r["n_chars"] == len(r["text"])

    pieces = stages["packing"](spark, docs, FOLDER)
    total = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    rows = total.collect()
    assert len(rows) == len(left) and all(r["n"] == r["m"] for r in rows)


def test_near_duplicates_are_judged_row_by_row(spark):
    """Copies go, whatever rows share or lack an id; what is unlike anything stays."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a, "x"), (2, a, "y"), (2, b, "z"), (3, b + " more", "u"), (4, c, "v"), (4, c, "v"), (None, c, "w")]
    rows += [(None, None, "n"), (5, "", "e"), (6, " ", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").selectExpr("*", "1 AS doc", "2 AS component_id")
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, FOLDER)
    assert left.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr)
    assert found == sorted([(1, a), (2, b), (4, c), (None, None), (5, ""), (6, " ")], key=repr)


def test_stages_of_empty_tables_and_nulls(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None)] * 2 + [(1, "", "en", "s", 0)], table.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table.limit(0), FOLDER).count() == 0, name
        assert stage(spark, odd, FOLDER).count() == (0 if name == "quality_rules" else 3), name


def test_run_is_the_stages(spark):
    """The run packs what the stages leave one after the other."""
    pieces = corpus_pipeline.run(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept(stage(spark, docs, FOLDER))
    wanted = packing.pack(docs)
    columns = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    got = pieces.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, wanted.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect())
    )
    assert set(columns) <= set(pieces.columns) and got.count() == docs.count()


def test_tables_are_released(spark):
    with released(spark):
        table = kept(spark.range(100))
        path = table.inputFiles()[0].rsplit("/", 1)[0]
        assert kept(table.filter("id < 5")).count() == 5
    assert spark.read.parquet(path).count() == 0
    assert kept(spark.range(3)).count() == 3
