"""Streams over the given tables: three arrivals of several files each, counted as they come."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.queries import proxies as px
from marlstone.queries.registry import query
from marlstone.session import shared_dir
from marlstone.streaming.words import line_stream, run_to_end, split_words, start_word_count, to_parquet

ARRIVALS = 3
#: The sink fails once behind the writing of this batch, before it is committed.
INTERRUPTED = 1


def _counted_batches(spark, folder, limit=None):
    """Counts per batch and how often each batch was run.

    All documents arrive in three parts. Every arrival is taken in by a query that starts from the
    offsets of the one before, as one batch. One batch is written, lost and run again.
    """
    landing, output = shared_dir(spark, "arrivals"), shared_dir(spark, "word-counts")
    offsets = shared_dir(spark, "word-offsets")
    documents = px.table(spark, folder, "documents")
    part = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(ARRIVALS))
    write, runs = to_parquet(output, limit), []

    def sink(counts, batch_id):
        write(counts, batch_id)
        runs.append(batch_id)
        if batch_id == INTERRUPTED and runs.count(batch_id) == 1:
            raise RuntimeError("lost before the commit")

    def start():
        lines = line_stream(spark, f"{landing}/*", "value string", format="parquet")
        return start_word_count(split_words(lines), sink, offsets, available_now=True)

    for arrival in range(ARRIVALS):
        documents.where(part == arrival).select(F.col("text").alias("value")).write.parquet(f"{landing}/{arrival}")
        run_to_end(start)
    return spark.read.schema("word string, n long, batch_id int").parquet(output), runs


BATCHES = f"""batches AS (
  SELECT CAST(doc_id % {ARRIVALS} AS INTEGER) AS batch_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest({px.words_sql("text")}) AS word FROM documents) GROUP BY ALL)"""


@query("x4_stream_word_count", f"WITH {BATCHES} SELECT batch_id, word, n FROM batches")
def stream_word_count(spark, folder):
    return _counted_batches(spark, folder)[0].select("batch_id", "word", "n")


@query(
    "x5_stream_first_ten",
    f"""WITH {BATCHES} SELECT batch_id, word, n FROM batches
    QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY word) <= 10""",
)
def stream_first_ten(spark, folder):
    return _counted_batches(spark, folder, limit=10)[0].select("batch_id", "word", "n")


@query(
    "x6_stream_restart",
    f"""WITH {BATCHES} SELECT batch_id, CASE batch_id WHEN {INTERRUPTED} THEN 2 ELSE 1 END AS runs,
        count(*) AS n_words, CAST(sum(n) AS BIGINT) AS n FROM batches GROUP BY batch_id""",
)
def stream_restart(spark, folder):
    """How often each batch was run, and what it left: a batch that is run twice leaves its rows once."""
    counted, runs = _counted_batches(spark, folder)
    often = F.create_map(*[F.lit(x) for batch in sorted(set(runs)) for x in (batch, runs.count(batch))])
    return counted.groupBy("batch_id").agg(
        F.any_value(often[F.col("batch_id")]).alias("runs"),
        F.count(F.lit(1)).alias("n_words"),
        F.sum("n").alias("n"),
    )
