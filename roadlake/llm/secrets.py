"""Secret scans: candidate strings judged by a random forest, in DataFrame functions only.

One pattern finds candidates in whole texts: long runs of token characters,
values assigned to credential names, passwords in URLs, whole key blocks and
well-known prefixes.  The
forest sees a candidate's length, the transitions between its character
classes, how much of it dictionary words and frequent letter pairs cover,
whether it is part of a path, and the words beside it; it is trained on
labelled findings and removes the false positives.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlake.llm.common import store

#: What may stand in a token, a path or a URL.
RUN = r"[A-Za-z0-9+/_.~%=-]"
#: Names to which credentials are assigned, as the name ends.
NAMES = (
    r"(?i:pass(?:word|wd|phrase)|pwd|secret|token|api[_.-]?key|access[_.-]?key(?:[_.-]?id)?|private[_.-]?key|"
    r"secret[_.-]?key|credentials?|auth)"
)
#: What may stand in an assigned value: in quotes all but quotes and white space, else also no brackets and separators.
#: Possessive, as greedy repeats of characters of one and two UTF-16 units recurse.
VALUE = r"(?:(?<=[\"'`])[^\s\"'`]{4,}+|(?:(?!&\w{1,40}=)[^\s\"'`,;<>(){}\[\]]){4,}+)"
KEY = r"PRIVATE KEY(?: BLOCK)?-----"
#: A key block up to its END line; one without it up to the last line that can be its own.
BLOCK = (
    rf"-----BEGIN [A-Z0-9 ]{{0,30}}{KEY}"
    rf"(?:(?:(?!-----)[\s\S])*+-----END [A-Z0-9 ]{{0,30}}{KEY}"
    r"|(?:(?:\s|\\[nr])++(?:[A-Za-z0-9+/=]++|[A-Z][A-Za-z-]*+: [^\r\n\\]*+)(?=[\r\n\\\"'`]|$|\z))*+)"
)
#: A run of 16 or more, unless it is a credential name with its value: there the value alone is the candidate.
CANDIDATE = (
    BLOCK + rf"|(?<![A-Za-z0-9])(?:AKIA|ASIA|ghp_|gho_|xox[abp]-|sk_live_|AIza|eyJ){RUN}{{8,}}"
    rf"|(?<=[=:>\s\"'`])(?=[^\s\"'`=:>])(?<=[=:]>?\s{{0,2}}[\"'`]?)(?<={NAMES}[\"'`\]]{{0,2}}\s{{0,2}}:?[=:]>?\s{{0,2}}[\"'`]?){VALUE}"
    r"|(?<=:)(?<=://[^\s/:@]{0,64}:)[^\s/@\"'`<>]++(?=@)"
    rf"|(?<!{RUN})(?={RUN}{{16}})(?![A-Za-z0-9+/_.~%-]*+(?<={NAMES})=(?=[^\s\"'`=:>]){VALUE}){RUN}{{16,}}"
)
CREDENTIAL = r"(?i)(?:pass(?:word|wd|phrase)|pwd|secret|token|api.?key|access.?key|private.?key|credential|bearer|auth)"
INNOCENT = r"(?i)(?:example|sample|dummy|placeholder|changeme|your|sha1|sha256|md5|commit|checksum|digest|hash|uuid|http|www)"
PREFIXED = r"^(?:-----BEGIN|AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|ghp_|gho_|xox[abp]-|sk_live_|AIza|eyJ[A-Za-z0-9_-]+\.)"
#: Dictionary of frequent words of code and prose, three letters or more.
DICTIONARY = (
    "the|and|that|with|from|this|have|not|for|are|was|will|can|all|our|one|out|use|get|set|new|old|key|name|value|user|"
    "file|path|test|data|code|page|index|image|home|main|list|item|type|text|link|html|http|www|com|org|net|example|"
    "sample|dummy|change|password|secret|token|number|version|license|general|public|under|over|also|more|other|time|"
    "year|work|first|about|which|their|would|there|been|were|when|what|your|some|tion|ment|heit|keit|lich|ung|elle|"
    "ción|mente|ieren|able|less|ness|ing"
)
#: Frequent letter pairs of the languages of the corpus.
PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce|li|ch|ll|be|ma|si|om|ur|ei|ge|un|au|ie|qu|ue|ai|oi|la|do|os|ad|ci"

FEATURES = [
    "length", "digits", "uppers", "lowers", "signs", "letter_to_digit", "digit_to_letter", "case_changes", "hex_only",
    "distinct", "dictionary", "pairs", "slashes", "dots", "in_path", "quoted", "assigned", "credential", "innocent",
    "prefixed", "follows_word",
]


def _count(c: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(pattern), F.lit(0))).cast("double")


def _covered(c: Column, pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace(F.lower(c), pattern, "")) / F.greatest(F.length(c), F.lit(1))


def features(found: DataFrame) -> DataFrame:
    """Adds FEATURES to findings (value, before, after)."""
    v, before, after = F.col("value"), F.col("before"), F.col("after")
    n = F.greatest(F.length(v), F.lit(1)).cast("double")
    lead = F.regexp_extract(before, r"((?:\S+\s+){0,2}\S*)$", 1)
    in_url = before.rlike(r"://[^\s/:@]{0,64}:$") & after.startswith("@")
    named = before.rlike(r"[=:]>?\s*[\"'`]?$") & lead.rlike(CREDENTIAL)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    made = {
        "length": n,
        "digits": _count(v, "[0-9]") / n,
        "uppers": _count(v, "[A-Z]") / n,
        "lowers": _count(v, "[a-z]") / n,
        "signs": _count(v, "[^A-Za-z0-9]") / n,
        "letter_to_digit": _count(v, "(?<=[A-Za-z])[0-9]") / n,
        "digit_to_letter": _count(v, "(?<=[0-9])[A-Za-z]") / n,
        "case_changes": _count(v, "(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]") / n,
        "hex_only": flag(v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "dictionary": _covered(v, DICTIONARY),
        "pairs": _covered(v, PAIRS),
        "slashes": _count(v, "/"),
        "dots": _count(v, "[.]"),
        "in_path": flag(
            (v.rlike(r"^/|^\w+/|://|\.(?:com|org|net|html?|php|png|jpg)\b") | before.rlike(r"[/\\:]$"))
            & ~(in_url | named | v.startswith("-----BEGIN"))
        ),
        "quoted": flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        "assigned": flag(before.rlike("[=:]>?\\s*[\"'`]?$")),
        "credential": flag(lead.rlike(CREDENTIAL) | in_url),
        "innocent": flag(lead.rlike(INNOCENT) | v.rlike(INNOCENT)),
        "prefixed": flag(v.rlike(PREFIXED)),
        "follows_word": flag(before.rlike(r"\p{L}\s$")),
    }
    return found.withColumns({k: c.cast("double") for k, c in made.items()})


def candidates(docs: DataFrame, context: int = 48) -> DataFrame:
    """Every candidate of every whole text: (doc_id, text_key, place, start, end, value, before, after).

    start and end are character offsets; place counts the candidates of a text
    from 0; text_key is a hash of the text.  Null and empty texts have none.
    Repeated rows have theirs once each.
    """
    hits = docs.where(F.col("text").rlike(CANDIDATE)).select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.split("text", CANDIDATE, -1).alias("gaps"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("values"),
    )
    each = hits.select(
        "rid",
        "doc_id",
        "text_key",
        F.posexplode(
            F.transform(
                "values",
                lambda v, i: F.struct(
                    v.alias("value"),
                    F.right(F.get("gaps", i), F.lit(context)).alias("before"),
                    F.left(F.get("gaps", i + 1), F.lit(context)).alias("after"),
                    F.length(F.get("gaps", i)).alias("gap"),
                ),
            )
        ).alias("place", "c"),
    ).select("rid", "doc_id", "text_key", "place", "c.*")
    so_far = Window.partitionBy("rid").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(so_far)
    return each.withColumn("end", end).select(
        "doc_id", "text_key", "place", (F.col("end") - F.length("value")).alias("start"), "end", "value", "before", "after"
    )


def findings_by_context(found: DataFrame) -> DataFrame:
    """Labelled findings from the corpus itself, for want of a reviewed table.

    1: a known prefix, or an assignment to a credential name of a value that
    mixes letters and digits; 0: no digit in the value, an innocent word beside
    it, or a path.  The rest have no label and teach nothing.
    """
    x = features(found)
    mixed = (F.col("digits") > 0) & (F.col("uppers") + F.col("lowers") > 0)
    good = (F.col("prefixed") == 1) | ((F.col("credential") == 1) & (F.col("assigned") == 1) & mixed & (F.col("innocent") == 0))
    bad = (F.col("digits") == 0) | (F.col("innocent") == 1) | (F.col("in_path") == 1)
    label = F.when(good, 1.0).when(bad, 0.0)
    return x.withColumn("secret", label).where("secret is not null").select("value", "before", "after", "secret")


def train(labelled: DataFrame, max_rows: int = 20_000, trees: int = 20, depth: int = 6):
    """A forest from at most ``max_rows`` distinct findings of each label.

    If only one label occurs, that label itself is returned; without findings, 0.
    """
    distinct = labelled.where("value is not null and secret in (0, 1)").select(
        "value", F.coalesce("before", F.lit("")).alias("before"), F.coalesce("after", F.lit("")).alias("after"),
        F.col("secret").cast("double").alias("label"),
    ).distinct()
    some = None
    for label in (0.0, 1.0):
        part = distinct.where(F.col("label") == label).orderBy(F.xxhash64("value", "before", "after"), "value").limit(max_rows)
        some = part if some is None else some.unionAll(part)
    x = store(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(some)).select("features", "label"))
    seen = [r.label for r in x.select("label").distinct().collect()]
    if len(seen) < 2:
        return seen[0] if seen else 0.0
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7).fit(x)


def judged(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, text_key, place, start, end, value, kind, score, is_secret.

    ``labelled`` holds findings (value, before, after, secret 0/1); without it
    they are labelled by context.  If only one label occurs, it is every
    candidate's score; without any labelled finding the score is 0.
    """
    found = store(candidates(docs))
    model = train(findings_by_context(found) if labelled is None else labelled)
    kind = (
        F.when(F.col("value").startswith("-----BEGIN"), "private key")
        .when(F.col("value").rlike(PREFIXED), "known prefix")
        .when(F.col("credential") == 1, "credential")
        .otherwise("token")
    )
    x = features(found).withColumn("kind", kind)
    if isinstance(model, float):
        scored = x.withColumn("score", F.lit(model))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(x)).withColumn(
            "score", vector_to_array("probability")[1]
        )
    return scored.select(
        "doc_id", "text_key", "place", "start", "end", "value", "kind", "score", (F.col("score") >= threshold).alias("is_secret")
    )


def _free(taken: list[str], *names: str) -> dict[str, str]:
    """Column names that no column in ``taken`` has, by what they are for."""
    lead = "__"
    while any(t.lower().startswith(lead) for t in taken):
        lead += "_"
    return {n: lead + n for n in names}


def mask(docs: DataFrame, labelled: DataFrame | None = None, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``; in their texts each confirmed secret is replaced by ``mark``.

    Rows without a candidate pass as they are; the others meet their findings
    by doc_id and a hash of the text, so repeated rows are masked alike.  Columns
    of any name pass.
    """
    names = docs.columns
    made = _free(names, "text_key", "gaps", "values", "id", "key", "places")
    confirmed = (
        judged(docs, labelled)
        .where("is_secret")
        .groupBy(F.col("doc_id").alias(made["id"]), F.col("text_key").alias(made["key"]))
        .agg(F.collect_set("place").alias(made["places"]))
    )
    has = F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))
    gaps, values = F.split("text", CANDIDATE, -1), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    some = docs.where(has).withColumns({made["text_key"]: F.xxhash64("text"), made["gaps"]: gaps, made["values"]: values})
    joined = some.join(
        confirmed,
        F.col("doc_id").cast("long").eqNullSafe(F.col(made["id"])) & (F.col(made["text_key"]) == F.col(made["key"])),
        "left",
    )
    found = F.col(made["values"])
    shown = F.transform(
        made["gaps"],
        lambda g, i: F.concat(
            g,
            F.when(i == F.size(found), F.lit(""))
            .when(F.coalesce(F.array_contains(made["places"], i), F.lit(False)), F.lit(mark))
            .otherwise(F.get(found, i)),
        ),
    )
    return docs.where(~has).unionAll(joined.withColumn("text", F.array_join(shown, "")).select(*names))
