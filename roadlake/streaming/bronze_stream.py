"""Incremental Bronze ingest as a file-source stream.

The batch feeder decides "already loaded?" from the Bronze folders.  The
streaming form lets Spark track it: a CSV file stream with a checkpoint sees
every file exactly once, across restarts and lost executors, and
``trigger(availableNow=True)`` makes each run a bounded job that processes
what arrived since the last one and stops.  Rows land in Bronze partitioned
by their batch date (from the file name), in the layout that the Silver job
reads: ``bronze_date`` folders, each row with its ``situation_date``.

``ingest_available`` keeps each day's own batch; the file sink's log makes the
output exactly-once.  ``ingest_cumulative`` keeps the batch feeder's layout,
whose last day holds every batch, by writes that a replay repeats unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadlake.operators.bronze import bronze_cumulative, sanitize_columns
from roadlake.sources.csv_batches import path_date
from roadlake.sources.store import BRONZE_PARTITION, existing_days, write_bronze


def _daily_rows(spark: SparkSession, input_dir: str, columns: Sequence[str], multi_line: bool) -> DataFrame:
    """A stream of the rows of daily CSV batches, with the day in their names."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in columns])
    rows = (spark.readStream.schema(schema)
            .option("header", "true").option("escape", '"').option("multiLine", str(multi_line).lower())
            .option("enforceSchema", "false").option("mode", "PERMISSIVE" if multi_line else "FAILFAST")
            .option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", "true")  # daily batches may be folders of parts
            .csv(input_dir))
    rows = rows.withColumn("situation_date", path_date(F.col("_metadata.file_path")))
    return sanitize_columns(rows).filter(F.col("situation_date").isNotNull())


def load_batch(rows: DataFrame, number: int, bronze_path: str) -> list[str]:
    """Add micro-batch ``number`` to a cumulative Bronze; returns the days written.

    The rows are stored once in ``_batches/batch=<number>``, which a replay
    overwrites with the same rows.  The days of the batch, the last day and the
    one that was the last before are then written anew from all batches, so the
    store depends only on the batches in it, however often one is replayed.
    """
    spark, base = rows.sparkSession, f"{bronze_path.rstrip('/')}/_batches"
    own = f"{base}/batch={number}"
    rows.write.mode("overwrite").partitionBy("situation_date").parquet(own)
    added = existing_days(spark, own, "situation_date")
    if not added:
        return []
    last = existing_days(spark, base, "situation_date")[-1]
    shown = existing_days(spark, bronze_path)
    days = sorted({*added, last, *shown[-1:]})
    every = spark.read.option("mergeSchema", "true").parquet(base).drop("batch")
    stored = bronze_cumulative(every, last).filter(F.col(BRONZE_PARTITION).isin([F.lit(d).cast("date") for d in days]))
    write_bronze(stored, bronze_path)
    return days


def ingest_cumulative(spark: SparkSession, input_dir: str, columns: Sequence[str], bronze_path: str,
                      checkpoint: str, wait: bool = True, multi_line: bool = True) -> StreamingQuery:
    """Like ``ingest_available``, into the Bronze that the batch feeder would make of the same files.

    Days before the last hold their own batch, the last day holds every batch.
    The cost of a run grows with the store, as the last day holds all of it.
    """
    query = (_daily_rows(spark, input_dir, columns, multi_line).writeStream
             .option("checkpointLocation", checkpoint)
             .foreachBatch(lambda rows, number: load_batch(rows, number, bronze_path))
             .trigger(availableNow=True)
             .start())
    if wait:
        query.awaitTermination()
    return query


def ingest_available(spark: SparkSession, input_dir: str, columns: Sequence[str], bronze_path: str,
                     checkpoint: str, wait: bool = True, multi_line: bool = True) -> StreamingQuery:
    """Process every daily CSV not seen before, then stop.

    ``columns`` is the raw header (streams need a fixed schema; all text).
    """
    rows = _daily_rows(spark, input_dir, columns, multi_line)
    rows = rows.withColumn(BRONZE_PARTITION, F.col("situation_date"))
    query = (rows.writeStream.format("parquet")
             .option("checkpointLocation", checkpoint)
             .partitionBy(BRONZE_PARTITION)
             .trigger(availableNow=True)
             .start(bronze_path))
    if wait:
        query.awaitTermination()
    return query
