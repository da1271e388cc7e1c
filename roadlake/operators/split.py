"""Ordered N-way split of a feed into dated batches.

Row ``i`` (0-based, in ``order_cols`` order, a total order) goes to batch
``min(i // (n // N), N - 1)``: equal chunks with the remainder in the *last*
batch (not ``ntile``, which puts it first); with ``n < N`` every row goes to
the last batch.  Batch ``k`` is dated ``start_date + k`` days.

Scale: a global ``row_number()`` would pull every row into one task.  Instead
the feed is range-partitioned on the order key and sorted inside each
partition; a row's global position is its partition's offset (a running sum
over per-partition counts, one small row per partition, broadcast with that
proven bound) plus its position inside the partition.  The range-partitioned
frame is stored once as parquet (in the shared folder) before it is counted,
so the counts and the positions come from the very same partitions even if a
task is retried or the exchange would be planned twice; the count reads one
column of it, and the lineage of the ingest is cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlake.functions.columns import c
from roadlake.session import materialize

_POS_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def global_position(df: DataFrame, order_cols: Sequence[str], num_partitions: int | None = None,
                    pos_col: str = "_pos", total_col: str = "_total") -> DataFrame:
    """Add the 0-based position of each row in ``order_cols`` order, and the row total."""
    keys = [c(k) for k in order_cols]
    # Without a fixed count AQE may merge neighbouring ranges after the shuffle;
    # a merged partition is still one contiguous key range, so order holds.
    by_range = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = (by_range
              .sortWithinPartitions(*keys)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_part").cast("long"), _POS_BITS)))
    ranged = materialize(ranged)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select(
        "_part",
        (F.sum("_n").over(running) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias(total_col))
    return (ranged.join(F.broadcast(offsets), "_part")
            .withColumn(pos_col, F.col("_offset") + F.col("_local"))
            .drop("_part", "_local", "_offset"))


def ordered_split(df: DataFrame, order_cols: Sequence[str], n_batches: int = 3,
                  start_date: str = "2025-01-01", batch_col: str = "batch",
                  date_col: str = "situation_date", num_partitions: int | None = None) -> DataFrame:
    """Tag each row with its batch number and batch date."""
    pos = global_position(df, order_cols, num_partitions)
    chunk = F.floor(F.col("_total") / n_batches)
    last = F.lit(n_batches - 1)
    batch = (F.when(chunk == 0, last)
             .otherwise(F.least(F.floor(F.col("_pos") / chunk), last))).cast("int")
    return (pos.withColumn(batch_col, batch)
            .withColumn(date_col, F.date_add(F.lit(start_date).cast("date"), F.col(batch_col)))
            .drop("_pos", "_total"))


def batch_counts(batches: DataFrame, batch_col: str = "batch", date_col: str = "situation_date") -> DataFrame:
    return batches.groupBy(batch_col, date_col).agg(F.count(F.lit(1)).alias("n_rows"))
