"""Word counts per micro-batch, without a running total."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marlstone.functions.text import words

# The batch interval, and the rows shown of each batch.
INTERVAL = "1 second"
SHOWN = 10


def line_stream(
    spark: SparkSession,
    directory: str,
    schema: str | T.StructType = "value string",
    format: str = "text",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream the files of a directory as they arrive; ``files_per_batch`` bounds a batch."""
    reader = spark.readStream.schema(schema).format(format)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(directory)


def split_words(lines: DataFrame, text: str = "value") -> DataFrame:
    return lines.select(F.explode(words(F.col(text))).alias("word"))


def count_words(batch: DataFrame) -> DataFrame:
    return batch.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def first_rows(counts: DataFrame, n: int = SHOWN) -> DataFrame:
    return counts.orderBy("word").limit(n)


def show_batch(counts: DataFrame, batch_id: int) -> None:
    """Sink that prints the first rows of a batch."""
    print(f"batch {batch_id}")
    first_rows(counts).show(truncate=False)


def to_parquet(
    directory: str, limit: int | None = None
) -> Callable[[DataFrame, int], None]:
    """Sink that writes each batch to its own folder.

    A batch that is run again after a failure overwrites its folder, so no row is written twice.
    """

    def write(counts: DataFrame, batch_id: int) -> None:
        rows = counts if limit is None else first_rows(counts, limit)
        rows.write.mode("overwrite").parquet(f"{directory}/batch_id={batch_id}")

    return write


def start_word_count(
    word_stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    interval: str = INTERVAL,
) -> StreamingQuery:
    """Count the words of each batch on their own and hand the counts to ``sink``.

    A streaming aggregation would carry totals from batch to batch; here each batch is counted as an
    ordinary DataFrame. ``available_now`` stops after the files at hand.
    """
    writer = word_stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: sink(count_words(batch), batch_id)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_to_end(start: Callable[[], StreamingQuery], attempts: int = 3) -> int:
    """Start a query over what is at hand and wait for it; after a failure, start it again.

    Each start goes on from the checkpoint: a batch that was not committed is run again with the same
    files and number, and committed batches are not. Returns the number of starts; the last failure of
    ``attempts`` is raised.
    """
    for attempt in range(1, attempts + 1):
        try:
            start().awaitTermination()
            return attempt
        except StreamingQueryException:
            if attempt == attempts:
                raise
    return 0
