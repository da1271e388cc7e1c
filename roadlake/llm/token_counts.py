"""Exact token counts for every context limit from one length histogram.

Documents are encoded once and aggregated by encoded length; suffix sums over
the histogram answer, for each limit, how many tokens survive truncation.  The
histogram has one row per distinct length; its running sums are taken per band
of lengths and joined to the bands' own totals, so that no window holds all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlake.llm.common import id_and_text, map_batches, store
from roadlake.llm.tokens import encoder

BAND = 512
#: What the query asks beside the lengths that occur.
LIMITS = (512, 1024, 2048, 4096, 8192, 16_384, 32_768, 65_536, 131_072)
QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999)


def length_histogram(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(n_tokens, n_docs).  Null and empty texts have length 0; repeated rows count each time."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            n = [len(enc.encode(t.decode())) // 4 for t in batch.column("text").to_pylist()]
            yield pa.record_batch([pa.array(n, pa.int64())], ["n_tokens"])

    counted = map_batches(id_and_text(docs).select("text"), lengths, "n_tokens long")
    return counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def _totals(h: DataFrame) -> tuple:
    """(documents, tokens) of a histogram."""
    return h.agg(F.sum("n_docs"), F.sum(F.col("n_docs") * F.col("n_tokens"))).first()


def answers(histogram: DataFrame, limits=LIMITS, quantiles=QUANTILES) -> DataFrame:
    """What any context limits and quantiles come to, from a stored histogram (n_tokens, n_docs).

    One row per limit (quantile_wanted null) and per quantile, whose limit is
    the shortest length that this share of the documents does not exceed.  The
    columns are those of ``token_counts``.  Bands of lengths are summed once; an
    answer needs the totals of the bands below and the lengths of one band.  No
    document gives no rows.
    """
    spark = histogram.sparkSession
    columns = "quantile_wanted double, context_limit long, n_docs long, docs_fitting long, docs_truncated long, total_tokens long, tokens_within long, truncated_total long, quantile double"
    docs, tokens = _totals(histogram)
    if not docs:
        return spark.createDataFrame([], columns)
    h = histogram.withColumn("band", F.floor(F.col("n_tokens") / BAND))
    mass = F.col("n_docs") * F.col("n_tokens")
    bands = h.groupBy("band").agg(F.sum("n_docs").alias("d"), F.sum(mass).alias("t"))
    running = Window.orderBy("band")  # one row per BAND lengths
    bands = store(bands.select("band", F.sum("d").over(running).alias("d"), F.sum("t").over(running).alias("t")))
    limit = {n: None for n in map(int, limits)}
    wanted: list[tuple[float | None, int]] = [(None, n) for n in limit]
    for q in quantiles:
        rank = min(docs, max(1, math.ceil(round(q * docs, 6))))
        at = bands.where(F.col("d") >= rank).orderBy("band").first()
        below = bands.where(F.col("band") < at.band).orderBy(F.desc("band")).first()
        seen = below.d if below else 0
        for r in h.where(F.col("band") == at.band).orderBy("n_tokens").collect():  # at most BAND lengths
            seen += r.n_docs
            if seen >= rank:
                wanted.append((float(q), r.n_tokens))
                break
    rows = []
    for q, n in wanted:
        below = bands.where(F.col("band") < n // BAND).orderBy(F.desc("band")).first()
        inside = [(r.n_tokens, r.n_docs) for r in h.where((F.col("band") == n // BAND) & (F.col("n_tokens") <= n)).collect()]
        fitting = (below.d if below else 0) + sum(d for _, d in inside)
        within = (below.t if below else 0) + sum(k * d for k, d in inside)
        rows.append((q, n, dict(inside).get(n, 0), fitting, docs - fitting, tokens, within, within + (docs - fitting) * n, fitting / docs))
    return spark.createDataFrame(rows, columns)


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per context limit at which an answer changes (each distinct length).

    context_limit; n_docs of that length; docs_fitting (length <= limit) and
    docs_truncated; total_tokens (of all documents); tokens_within (of fitting
    documents); truncated_total, what is left when each document is cut at the
    limit; quantile, the share of documents that fit.  An empty table gives no rows.
    """
    return from_histogram(store(length_histogram(docs, tokenizer)))


def from_histogram(histogram: DataFrame) -> DataFrame:
    """``token_counts`` of a stored histogram."""
    h = histogram.withColumn("band", F.floor(F.col("n_tokens") / BAND))
    mass = F.col("n_docs") * F.col("n_tokens")
    upward = Window.partitionBy("band").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    inside = h.withColumns({"d": F.sum("n_docs").over(upward), "t": F.sum(mass).over(upward)})
    bands = h.groupBy("band").agg(F.sum("n_docs").alias("bd"), F.sum(mass).alias("bt"))
    over_bands = Window.orderBy("band")  # one row per BAND lengths
    below = bands.select(
        "band",
        (F.sum("bd").over(over_bands) - F.col("bd")).alias("docs_below"),
        (F.sum("bt").over(over_bands) - F.col("bt")).alias("tokens_below"),
    )
    all_docs, total_tokens = (F.lit(n) for n in _totals(h))
    fitting = F.col("d") + F.col("docs_below")
    within = F.col("t") + F.col("tokens_below")
    return (
        inside.join(below, "band")
        .select(
            F.col("n_tokens").alias("context_limit"),
            "n_docs",
            fitting.alias("docs_fitting"),
            (all_docs - fitting).alias("docs_truncated"),
            total_tokens.cast("long").alias("total_tokens"),
            within.alias("tokens_within"),
            (within + (all_docs - fitting) * F.col("n_tokens")).alias("truncated_total"),
            (fitting / all_docs).alias("quantile"),
        )
    )
