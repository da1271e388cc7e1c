"""Licence scans: ordered signature rules gated by keywords, in DataFrame functions only.

Texts become words; a document in which no keyword occurs goes no further.  The
rules, some hundreds of regular expressions made from licence families and
phrasings, are joined to a gated document by the keyword that each of them
needs.  All places of all rules are found, and a place that lies inside one of
the same or a higher priority is suppressed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlake.llm.common import lower_ascii, store

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Fixed base phrases and their labels.
BASE = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}

#: label, keyword that stands in each of the names as a word, names of the licence as words, versions.
FAMILIES = [
    ("apache", "apache", "apache(?: software)?", ["1 0", "1 1", "2 0"]),
    ("mit", "mit", "mit", []),
    ("mit", "expat", "expat", []),
    ("mit", "x11", "x11", []),
    ("bsd", "bsd", "bsd", ["2 clause", "3 clause", "4 clause"]),
    ("bsd", "berkeley", "berkeley software distribution", ["2 clause", "3 clause", "4 clause"]),
    ("isc", "isc", "isc", []),
    ("isc", "consortium", "internet systems consortium", []),
    ("gpl", "gpl", "(?:gnu )?gpl", ["v1", "v2", "v3", "2 0", "3 0"]),
    ("gpl", "general", "(?:gnu )?general public", ["1", "2", "3"]),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", ["v2", "v3", "2 1", "3 0"]),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", ["2", "2 1", "3"]),
    ("agpl", "agpl", "(?:gnu )?agpl", ["v3", "3 0"]),
    ("agpl", "affero", "(?:gnu )?affero general public", ["3", "3 0"]),
    ("gfdl", "documentation", "(?:gnu )?free documentation", ["1 1", "1 2", "1 3"]),
    ("mpl", "mozilla", "mozilla public", ["1 0", "1 1", "2 0"]),
    ("mpl", "mpl", "mpl", ["1 1", "2 0"]),
    ("epl", "eclipse", "eclipse public", ["1 0", "2 0"]),
    ("cddl", "cddl", "cddl", ["1 0", "1 1"]),
    ("cddl", "distribution", "common development and distribution", ["1 0", "1 1"]),
    ("eupl", "eupl", "eupl", ["1 1", "1 2"]),
    ("eupl", "european", "european union public", ["1 1", "1 2"]),
    ("artistic", "artistic", "(?:perl )?artistic", ["1 0", "2 0"]),
    ("boost", "boost", "boost software", ["1 0"]),
    ("zlib", "zlib", "zlib(?: libpng)?", []),
    ("unlicense", "unlicense", "unlicense", []),
    ("wtfpl", "wtfpl", "wtfpl", ["2", "2 0"]),
    ("python", "python", "python(?: software foundation)?", ["2 0", "3"]),
    ("postgresql", "postgresql", "postgresql", []),
    ("ofl", "ofl", "ofl", ["1 0", "1 1"]),
    ("ofl", "sil", "sil open font", ["1 0", "1 1"]),
    ("openssl", "openssl", "openssl", []),
    ("php", "php", "php", ["3 0", "3 01"]),
    ("ms-pl", "microsoft", "microsoft public", []),
    ("odbl", "odbl", "odbl", ["1 0"]),
    ("odbl", "database", "open database", ["1 0"]),
    ("cc0", "cc0", "cc0", ["1 0"]),
    ("cc-by", "cc", "cc by", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "cc", "cc by sa", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "cc", "cc by nc", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "cc", "cc by nd", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "cc", "cc by nc sa", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-nd", "cc", "cc by nc nd", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by", "creative", "creative commons attribution", ["2 0", "3 0", "4 0"]),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike", ["3 0", "4 0"]),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial", ["3 0", "4 0"]),
]

#: Phrasings around a name (%s), their priority and weight.
PHRASINGS = [
    (r"(?:re)?licensed under (?:the )?(?:terms of (?:the )?)?(?:%s)(?: licen[sc]e)?", 4, 0.9),
    (r"(?:released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?(?:%s)(?: licen[sc]e)?", 4, 0.85),
    (r"spdx license identifier (?:%s)", 5, 0.95),
    (r"(?:%s) licen[sc]e", 2, 0.6),
    (r"(?:%s) licensed", 2, 0.55),
]

#: label, keyword, words, priority, weight: texts of their own.
SINGLE = [
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 5, 0.95),
    ("isc", "permission", "permission to use copy modify and or distribute this software", 5, 0.9),
    ("bsd", "redistribution", "redistribution and use in source and binary forms", 5, 0.9),
    ("bsd", "redistributions", "redistributions of source code must retain", 4, 0.8),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license", 5, 0.95),
    ("zlib", "provided", "this software is provided as is without any express or implied warranty", 4, 0.7),
    ("cc0", "waive", "waive all copyright and related", 4, 0.8),
    ("cc0", "waives", "waives all copyright and related", 4, 0.8),
    ("cc0", "waived", "waived all copyright and related", 4, 0.8),
    ("public-domain", "domain", "(?:in|into|to) the public domain", 3, 0.7),
    ("public-domain", "domain", "public domain", 2, 0.4),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 5, 0.95),
    ("reserved", "reserved", "all rights reserved", 3, 0.7),
    ("reserved", "reserved", "(?:some|no other) rights reserved", 2, 0.5),
    ("proprietary", "proprietary", "proprietary (?:and confidential|information|software|licen[sc]e)", 3, 0.7),
    ("proprietary", "unauthorized", "unauthorized (?:copying|reproduction|use|distribution)", 3, 0.7),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", 2, 0.5),
    ("copyright", "copyright", "copyright (?:c|by|holders?|notice)", 1, 0.3),
    ("unknown-license", "license", "see (?:the )?(?:file )?license", 1, 0.3),
    ("unknown-license", "licensed", "licensed under", 1, 0.3),
    ("unknown-license", "licence", "(?:under|see) (?:the |this )?licence", 1, 0.3),
]


def rules() -> list[tuple[int, str, str, str, int, float]]:
    """(order, label, keyword, pattern over words, priority, weight), from families and phrasings."""
    out = []
    for label, keyword, name, versions in FAMILIES:
        for phrase, priority, weight in PHRASINGS:
            out.append((label, keyword, phrase % name, priority, weight))
        for v in versions:
            out.append((label, keyword, rf"(?:{name})(?: licen[sc]e)?(?: version)? v?{v}", 4, 0.85))
    out += SINGLE
    return [(n, label, key, f"(?<= )(?:{pattern})(?= )", p, w) for n, (label, key, pattern, p, w) in enumerate(out)]


def _base(words: Column) -> Column:
    """Places of the base phrases as an array of (start, label)."""
    found = []
    for phrase, label in BASE.items():
        last = F.size(words) - len(phrase)
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        needed = _all(F.array_contains(words, w) for w in phrase)
        places = F.filter(F.when(needed, starts).otherwise(F.array().cast("array<int>")), _at(words, phrase))
        found.append(F.transform(places, _named(label)))
    return F.concat(*found)


def _at(words: Column, phrase: tuple[str, ...]):
    return lambda i: _all(F.get(words, i + k) == w for k, w in enumerate(phrase))


def _named(label: str):
    return lambda i: F.struct(i.alias("start"), F.lit(label).alias("label"))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _places(gated: DataFrame, spark: SparkSession) -> DataFrame:
    """All places of all rules: (rid, start, end, order, label, priority, weight) in characters of the words text."""
    names = ("rule", "label", "keyword", "pattern", "priority", "weight")
    each = (F.struct(*(F.lit(v).alias(n) for n, v in zip(names, r, strict=True))) for r in rules())
    table = spark.range(1).select(F.inline(F.array(*each)))
    keywords = sorted({r[2] for r in rules()})
    has = F.filter(F.array(*map(F.lit, keywords)), lambda k: F.col("norm").contains(F.concat(F.lit(" "), k, F.lit(" "))))
    hit = (
        gated.select("rid", "norm", F.explode(has).alias("keyword"))
        .join(F.broadcast(table), "keyword")  # the fixed rules
        .where(F.rlike("norm", F.col("pattern")))
    )
    pieces = F.arrays_zip(
        F.transform(F.expr("split(norm, pattern, -1)"), F.length).alias("gap"),
        F.transform(F.regexp_extract_all("norm", F.col("pattern"), F.lit(0)), F.length).alias("hit"),
    )
    at = hit.select("rid", "rule", "label", "priority", "weight", F.posexplode(pieces).alias("n", "p"))
    before = Window.partitionBy("rid", "rule").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("p.gap") + F.coalesce("p.hit", F.lit(0))).over(before)
    return (
        at.withColumn("end", end)
        .where("p.hit is not null")
        .select("rid", (F.col("end") - F.col("p.hit")).alias("start"), "end", "rule", "label", "priority", "weight")
    )


def kept_places(places: DataFrame) -> DataFrame:
    """Drops each place that lies inside another of the same or a higher priority.

    Of places with the same interval the higher priority stays, of those with
    the same priority too the earlier rule.
    """
    order = Window.partitionBy("rid").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    covered = F.lit(False)
    for p in sorted({r[4] for r in rules()}):
        reach = F.max(F.when(F.col("priority") >= p, F.col("end"))).over(earlier)
        covered = covered | ((F.col("priority") == p) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    return places.withColumn("covered", covered).where("not covered").drop("covered")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document.

    doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    places (array of start, end, label; characters of the words joined by single
    spaces after one space).  A null text is empty; no word gives n_words 0, no
    places and empty labels.  Each row counts for itself, also under a repeated
    or null doc_id.  An empty table gives no rows.  score joins the weights of
    the distinct rules that stay and, where only base phrases occur, 0.5 for each.
    """
    keywords = sorted({r[2] for r in rules()} | {p[0] for p in BASE if p[0] != "all"} | {"reserved"})
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    split = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"),
    )
    gate = F.arrays_overlap("w", F.array(*map(F.lit, keywords)))
    gated = F.when(gate, F.col("w"))
    base = store(
        split.select("rid", "doc_id", F.size("w").alias("n_words"), gated.alias("w")).select(
            "rid",
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            F.when(F.col("w").isNotNull(), _base(F.col("w"))).alias("base"),
            F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("norm"),
        )
    )
    staying = kept_places(_places(base.where("norm is not null"), docs.sparkSession))
    by_rule = staying.groupBy("rid", "rule").agg(
        F.first("label").alias("label"),
        F.first("weight").alias("weight"),
        F.collect_list(F.struct("start", "end", "label")).alias("places"),
    )
    found = by_rule.groupBy("rid").agg(
        F.collect_set("label").alias("found"),
        F.sum(F.log(1 - F.col("weight"))).alias("doubt"),
        F.sort_array(F.flatten(F.collect_list("places"))).alias("places"),
    )
    starts = F.transform("base", lambda b: b.start)
    own = F.array_sort(F.array_distinct(F.coalesce(F.transform("base", lambda b: b.label), F.array().cast("array<string>"))))
    every = F.array_sort(F.array_union(own, F.coalesce("found", F.array().cast("array<string>"))))
    return (
        base.drop("norm")
        .join(found, "rid", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
            F.array_min(starts).cast("long").alias("first_word"),
            F.array_max(starts).cast("long").alias("last_word"),
            F.array_join(own, ",").alias("base_labels"),
            F.array_join(every, ",").alias("labels"),
            (1 - F.coalesce(F.exp("doubt"), F.pow(F.lit(0.5), F.size(own)))).alias("score"),
            F.coalesce("places", F.array().cast("array<struct<start:bigint,end:bigint,label:string>>")).alias("places"),
        )
    )
