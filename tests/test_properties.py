"""Spark results against brute-force Python on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake import schema as S
from roadlake.operators import silver, split

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(n=st.integers(0, 120), parts=st.integers(1, 6), k=st.integers(1, 4))
def test_ordered_split_matches_brute_force(spark, n, parts, k):
    keys = [(i * 7919) % 100003 for i in range(n)]  # distinct, not in input order
    df = spark.createDataFrame([(x,) for x in keys], "seq long").repartition(3)
    got = {r.seq: r.batch for r in split.ordered_split(df, ["seq"], k, num_partitions=parts).collect()}
    chunk = n // k
    want = {x: (k - 1 if chunk == 0 else min(i // chunk, k - 1)) for i, x in enumerate(sorted(keys))}
    assert got == want


TEXT = st.sampled_from(["1", "2", "4", "5", "x", None])
TIMES = st.sampled_from(["2025-01-01 10:00:00", "2025-01-01 11:00:00", "2025-01-02 00:00:00", None])
ROW = st.tuples(st.sampled_from(["A", "B", "C", None]), TEXT, TIMES, TIMES,
                st.sampled_from(["1.5", "bad", None]), st.sampled_from([" Big City ", "x", None]))


def brute_force_accidents(rows):
    shaped = []
    for seq, (id_, sev, start, end, lat, city) in enumerate(rows):
        if id_ is None or start is None or end is None or not start < end or sev not in S.SEVERITY_DOMAIN:
            continue
        try:
            latf = float(lat) if lat is not None else None
        except ValueError:
            latf = None
        shaped.append((seq, id_, sev, start, end, latf, city.strip().lower() if city is not None else None))
    first = {}
    for r in shaped:
        if r[1] not in first or r[0] < first[r[1]][0]:
            first[r[1]] = r
    return sorted((r[1], r[2], r[5], r[6]) for r in first.values() if None not in r)


@SETTINGS
@given(rows=st.lists(ROW, max_size=25))
def test_accidents_conform_matches_brute_force(spark, rows):
    cols = ["seq", "ID", "Severity", "Start_Time", "End_Time", "Start_Lat", "City"]
    schema = T.StructType([T.StructField("seq", T.LongType())] +
                          [T.StructField(c, T.StringType()) for c in cols[1:]])
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, schema)
    # the other contract columns exist and are valid, so only these six decide
    filled = {c: F.lit("2.0" if c == "Start_Lng" else "v") for c in S.ACCIDENT_COLUMNS if c not in cols}
    df = df.withColumns(filled)
    out = silver.conform_accidents(df).collect()
    got = sorted((r.ID, r.Severity, None if r.Start_Lat is None else float(r.Start_Lat), r.City) for r in out)
    assert got == brute_force_accidents(rows)
