"""One large CSV whose quoted cells hold line breaks, read by many tasks.

A line break ends a record only outside quotes, and a task that starts in the
middle of a file cannot see on which side of a quote it is.  The parity of the
quotes before its block tells: quotes stand around cells and are doubled inside
them, so a place is inside a cell exactly if an odd number came before.

1. One scan counts the quotes of each block; a running sum over the blocks of a
   file (one small row a block) gives the parity at each block's start.
2. A second scan carries the parity along the lines of a block and cuts complete
   records; no row is shuffled.  What a block's border cuts comes out as at most
   two fragments a block, joined by block afterwards.
3. Spark's own CSV parser (``from_csv``) parses the records.

A quote that does not stand around a cell breaks the rule; a record is checked to
be well-formed, and a file with one that is not is read by a single task instead.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlake.session import materialize

log = logging.getLogger(__name__)

ORDER = ["_file", "_block", "_row"]
COMPLETE, TAIL, MIDDLE, HEAD = range(4)
_WELL_FORMED = r'(?:"[^"]*(?:""[^"]*)*"|[^",]*)(?:,(?:"[^"]*(?:""[^"]*)*"|[^",]*))*'


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines as they lie in the files; a carriage return stays at the end of its line."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), "value")


def block_parity(lines: DataFrame) -> DataFrame:
    """(_file, _block, _open): whether a block starts inside a quoted cell."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counts = lines.groupBy("_file", "_block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_file", "_block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("_open"))


def _cut(lines: DataFrame) -> DataFrame:
    """(_file, _block, _row, kind, text, odd) from lines with ``_open``; empty records are left out."""
    pattern = _WELL_FORMED
    complete, tail, middle, head = COMPLETE, TAIL, MIDDLE, HEAD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        import numpy as np
        import pyarrow.compute as pc

        well_formed = re.compile(pattern).fullmatch
        place, held, row, inside, at_head = None, [], 0, False, False
        out: list[tuple] = []

        def put(kind: int, text: str) -> None:
            nonlocal row
            if kind == complete:
                text = text.removesuffix("\r")
                text = text.removeprefix("﻿") if place[1] == 0 and row == 0 else text
                if not text:
                    return
            odd = kind == complete and '"' in text and not well_formed(text)
            out.append((*place, row, kind, text, odd))
            row += 1

        def leave() -> None:
            nonlocal held
            if held:
                put(middle if at_head else tail, "\n".join(held))
                held = []

        def table() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 6
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
            out.clear()
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["_file", "_block", "_row", "kind", "text", "odd"]
            )

        for batch in batches:
            values = batch.column("value").to_pylist()
            quotes = pc.count_substring(batch.column("value"), pattern='"').to_numpy(zero_copy_only=False)
            files, blocks = batch.column("_file").to_pylist(), batch.column("_block").to_pylist()
            opened = batch.column("_open").to_pylist()
            borders = [i for i in range(len(values)) if i == 0 or blocks[i] != blocks[i - 1] or files[i] != files[i - 1]]
            for lo, hi in zip(borders, [*borders[1:], len(values)], strict=True):
                if (files[lo], blocks[lo]) != place:
                    if place:
                        leave()
                    place, row, inside = (files[lo], blocks[lo]), 0, opened[lo]
                    at_head = inside
                after = (int(inside) + np.cumsum(quotes[lo:hi])) % 2  # 1: the line ends inside a cell
                start = lo
                for end in (np.flatnonzero(after == 0) + lo + 1).tolist():
                    text = values[start] if end - start == 1 else "\n".join(values[start:end])
                    if held:
                        text = "\n".join([*held, text])
                        held = []
                    put(head if at_head else complete, text)
                    at_head, start = False, end
                held += values[start:hi]
                inside = bool(after[-1])
            yield table()
        if place:
            leave()
        yield table()

    return lines.mapInArrow(run, "_file string, _block long, _row long, kind int, text string, odd boolean")


def _joined(pieces: DataFrame) -> DataFrame:
    """The records that block borders cut, under the block and row where they begin."""
    order = Window.partitionBy("_file").orderBy("_block", "_row")
    parts = pieces.where(F.col("kind") != COMPLETE).withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    whole = parts.groupBy("_file", "record").agg(
        F.sort_array(F.collect_list(F.struct("_block", "_row", "text"))).alias("parts")
    )
    text = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["text"]), "\n"), r"\r\z", "")
    first = F.col("parts")[0]
    whole = whole.select("_file", first["_block"].alias("_block"), first["_row"].alias("_row"), text.alias("text"))

    pattern = _WELL_FORMED

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        well_formed = re.compile(pattern).fullmatch
        for batch in batches:
            odd = [not well_formed(t) for t in batch.column("text").to_pylist()]
            yield batch.append_column("odd", pa.array(odd, pa.bool_()))

    return whole.mapInArrow(check, "_file string, _block long, _row long, text string, odd boolean")


def records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(_file, _block, _row, text, odd): the records of the files, header included; odd ones are not well-formed."""
    lines = _lines(spark, path)
    starts = block_parity(lines)  # one row a block of 128 MB or so: broadcast by that bound
    pieces = materialize(_cut(lines.join(F.broadcast(starts), ["_file", "_block"])))
    names = [*ORDER, "text", "odd"]
    return pieces.where(F.col("kind") == COMPLETE).select(names).unionByName(_joined(pieces).select(names))


def read_quoted_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of CSV files, every cell as text, with the columns ORDER, which order them as they stand in the files.

    Equal to a ``multiLine`` read with the header on and quotes escaped by doubling.  With ``columns``, or more
    than one file, each file's header must hold these names.
    """
    from roadlake.sources.csv_batches import csv_reader, with_file_order

    whole = csv_reader(spark, columns).csv(path)
    names = list(columns) if columns is not None else whole.columns
    found = materialize(records(spark, path))
    if found.where("odd").head(1):
        log.warning("%s: a quote does not stand around its cell; read by one task a file", path)
        rows, order = with_file_order(whole)
        return rows.select(*order, *names)
    ddl = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    # from_csv takes one string a record; line breaks inside it are those of quoted cells
    cells = F.from_csv("text", ddl, {"escape": '"', "multiLine": "true"}).alias("r")
    header = (F.col("_block") == 0) & (F.col("_row") == 0)
    titles = found.where(header).select(cells, "_file")
    if columns is not None or titles.count() > 1:  # one row a file
        differs = F.lit(False)
        for n in names:
            differs = differs | ~F.lower(F.col("r").getField(n)).eqNullSafe(F.lit(n.lower()))
        other = titles.where(differs).select("_file").head(1)
        if other:
            raise ValueError(f"{other[0]._file}: the header is not {names}")
    return found.where(~header).select(*ORDER, cells).select(*ORDER, *[F.col("r").getField(n).alias(n) for n in names])
