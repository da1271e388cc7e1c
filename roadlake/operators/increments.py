"""Adding a day to a store without counting a key twice.

The keys of earlier days are kept with a Bloom filter of them, dealt into words
of 64 bits: a key sets four bits of one word.  Rows whose bits are not all set
are new for certain and never meet the stored keys; only the others take part
in the exact anti join.  The filter can send a new row to the join in vain, it
cannot lose one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake import schema as S
from roadlake.functions.columns import c
from roadlake.session import materialize

#: Words of the filter: 8 MB, for some ten million keys; more keys want more words.
WORDS = 1 << 20


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bits(key: Column) -> Column:
    h = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def key_filter(keys: DataFrame, key: str = S.KEY, words: int = WORDS) -> DataFrame:
    """(word, bits) of the keys: at most ``words`` rows.  Filters of the same size may be put together by a union."""
    return keys.groupBy(_word(c(key), words).alias("word")).agg(F.bit_or(_bits(c(key))).alias("bits"))


def flagged(rows: DataFrame, filters: DataFrame, key: str = S.KEY, words: int = WORDS) -> DataFrame:
    """``rows`` with ``_maybe``: false if the key is in none of the filters for certain."""
    whole = filters.groupBy("word").agg(F.bit_or("bits").alias("_have"))
    probe = rows.withColumns({"word": _word(c(key), words), "_bits": _bits(c(key))})
    seen = F.coalesce(F.col("_have").bitwiseAND(F.col("_bits")) == F.col("_bits"), F.lit(False))
    return probe.join(whole, "word", "left").withColumn("_maybe", seen).drop("word", "_have", "_bits")


def unseen(rows: DataFrame, keys: DataFrame, filters: DataFrame, key: str = S.KEY, words: int = WORDS) -> DataFrame:
    """The rows whose key is not among ``keys``; ``filters`` are those of all of them.  A NULL key is never seen."""
    marked = materialize(flagged(rows, filters, key, words))
    rest = marked.where("_maybe").join(keys.select(key).distinct(), key, "left_anti")
    return marked.where("not _maybe").unionByName(rest).drop("_maybe")
