"""Monthly or daily activity maintained incrementally.

The log the counts come from grows all the time. Instead of exporting it in full again, the
stream adds what is new: the same counts as the batch operator, closed windows leave the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_log(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*", ts: str = "ts") -> DataFrame:
    """New Parquet files under ``folder`` as a stream; a zoneless time column becomes a timestamp."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def tumbling_counts(events: DataFrame, by: str, ts: str = "ts", window: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Events per window and ``by``; events more than ``delay`` behind the latest are left out."""
    return (
        events.withWatermark(ts, delay)
        .groupBy(F.window(ts, window).alias("w"), by)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), by, "n")
    )


def maintain(counts: DataFrame, table: str, checkpoint: str) -> None:
    """Process all waiting input and add every changed count to ``table``.

    Each micro-batch owns one folder and overwrites it, so a batch that runs twice after a
    failure leaves the same rows. Batches have even folder numbers; ``compact`` takes the odd ones.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={2 * batch_id}")

    query = (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    query.awaitTermination()


def current_counts(spark: SparkSession, table: str, by: str) -> DataFrame:
    """The latest count of each window."""
    schema = f"window_start timestamp, {by} string, n long, batch long"
    return (
        spark.read.schema(schema)
        .parquet(table)
        .groupBy("window_start", by)
        .agg(F.max_by("n", "batch").alias("n"))
    )


def compact(spark: SparkSession, table: str, by: str) -> None:
    """Merge all batch folders into one that holds the latest count of each window.

    To be called while no stream writes. The merged folder counts as later than what it holds and
    is complete before anything is deleted, so readers and a repeated run see the same counts.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(int(f.getPath().getName().split("=")[1]) for f in files.globStatus(path(f"{table}/batch=*")))
    if len(found) < 2:
        return
    # the odd number behind the last batch
    merged = found[-1] if found[-1] % 2 else found[-1] + 1
    folder = f"{table}/batch={merged}"
    if not files.exists(path(f"{folder}/_SUCCESS")):
        # what an interrupted run left there repeats folders that still exist
        files.delete(path(folder), True)
        current_counts(spark, table, by).write.parquet(folder)
    for number in found:
        if number != merged:
            files.delete(path(f"{table}/batch={number}"), True)


def sessions(
    events: DataFrame, by: str, ts: str = "ts", gap: str = "30 minutes", delay: str = "1 hour", event_id: str | None = None
) -> DataFrame:
    """Runs of events of one ``by`` with less than ``gap`` between them: start, end and number.

    A session comes out once, when the watermark (``delay`` behind the latest event) has passed its
    end, and leaves the state with it. With an ``event_id``, an event that is delivered again counts
    once, also when the two come in different batches; its id leaves the state with the watermark,
    after which the event itself would be too late to count.
    """
    seen = events.withWatermark(ts, delay)
    if event_id is not None:
        seen = seen.dropDuplicatesWithinWatermark([event_id])
    return (
        seen.groupBy(F.session_window(ts, gap).alias("w"), by)
        .agg(F.count("*").alias("n"))
        .select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
    )


def append(rows: DataFrame, table: str, checkpoint: str) -> None:
    """Process all waiting input and append what is final to ``table``, exactly once."""
    query = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
