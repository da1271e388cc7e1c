"""Helpers shared by the operators: inputs, checkpoints, word splitting, unions."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: bytes.split() and these agree: space and \x09-\x0D, nothing else.
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())

#: Lower-cases A-Z and turns every ASCII byte that is neither digit nor letter into a space.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame) -> DataFrame:
    """Write once to the shared checkpoint folder and cut the lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose workers can also import this package where it is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df.mapInArrow(run, schema)


def filter_batches(docs: DataFrame, keep: Callable[[pa.RecordBatch, dict], list[bool]]) -> DataFrame:
    """Whole rows for which ``keep`` is true; its dict lasts for a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            yield batch.filter(pa.array(keep(batch, state), pa.bool_()))

    return map_batches(docs, run, docs.schema)


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text as UTF-8 bytes); a null text is empty, other columns stay behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"").cast("binary")).alias("text"),
    )


def lower_ascii(c):
    return F.translate(c, UPPER, UPPER.lower())


def union_pairs(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union the pairs (i, j) into ``parent`` in place; afterwards every entry names its smallest member."""
    while len(i):
        a, b = parent[i], parent[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up
