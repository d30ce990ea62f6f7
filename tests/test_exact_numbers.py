"""Decimal text and averages, bit for bit against Python."""

import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playgraph.functions.exact import add_parts, average_of, sum_parts, total_of
from playgraph.functions.formats import fixed_decimals, round_half_even_py
from playgraph.operators import runlog

EDGES = [0.0, -0.0, 0.0005, -0.0005, 0.00049999999999999999, 0.00050000000000000001, 0.5, 1.5, 2.5, 0.05, 0.25, 0.125, 2.675, 1e-300, 5e-324, 0.9995, 0.9999999, 999.9995,
         123456789.0005, 4503599627370495.5, 9007199254740993.0, 9.1e18, -1e15 - 0.5, 1e22, float("nan"), float("inf"), float("-inf")]


def _texts(spark, values, digits):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    return [r.t for r in df.select("i", fixed_decimals("v", digits).alias("t")).orderBy("i").collect()]


def test_edges(spark):
    for digits in (0, 1, 2, 3, 7):
        for v, t in zip(EDGES, _texts(spark, EDGES, digits)):
            assert t == (f"{v:.{digits}f}" if not 9.2e18 < abs(v) < math.inf else t), (v, digits)
    assert spark.range(1).select(fixed_decimals(F.lit(None).cast("double"), 3).alias("t")).first().t is None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.floats(-1e9, 1e9), st.floats(-1e-3, 1e-3), st.integers(-(10**7), 10**7).map(lambda n: n / 2000), st.integers(0, 10**6).map(lambda n: (n + 0.5) / 1000)), min_size=40, max_size=80),
    st.integers(0, 4),
)
def test_decimal_text_equals_python(spark, values, digits):
    assert _texts(spark, values, digits) == [f"{v:.{digits}f}" for v in values]


def test_rounding_equals_python(spark):
    values = [n / 60.0 for n in range(0, 20000, 7)] + EDGES[:20]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.t for r in df.select("i", round_half_even_py("v", 1).alias("t")).orderBy("i").collect()]
    assert got == [float(f"{v:.1f}") for v in values]


def test_sums_do_not_depend_on_the_order(spark):
    rng = random.Random(4)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12) for _ in range(3000)] + [1e17, -1e17, 0.1] * 20
    results = set()
    for parts in (1, 3, 8):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        whole = df.agg(*sum_parts("v", "s")).select(total_of("s").alias("t"), average_of("s").alias("a")).first()
        # Totals of totals, as a stream keeps them, are the same.
        split = df.withColumn("g", F.pmod(F.xxhash64("v"), F.lit(5))).groupBy("g").agg(*sum_parts("v", "s"))
        again = split.agg(*add_parts("s")).select(total_of("s").alias("t"), average_of("s").alias("a")).first()
        results |= {tuple(whole), tuple(again)}
    (total, average), = results
    assert math.isclose(total, math.fsum(values), rel_tol=4e-16) and math.isclose(average, math.fsum(values) / len(values), rel_tol=8e-16)


def test_sums_of_odd_values(spark):
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return tuple(df.agg(*sum_parts("v", "s")).select(total_of("s").alias("t"), average_of("s").alias("a")).first())

    assert total() == (None, None) and total(None, None) == (None, None)
    assert total(None, 2.0, 4.0) == (6.0, 3.0) and total(-0.25, -0.5) == (-0.75, -0.375)
    assert total(1e300, 1.0)[0] == 1e300 and total(float("inf"), 1.0)[0] == math.inf and math.isnan(total(float("nan"))[0])
    assert total(*[0.1] * 10)[0] == math.fsum([0.1] * 10)


def test_report_averages_are_the_same_for_any_partitioning(spark):
    rng = random.Random(8)
    rows = [(f"spark_recommendation_{n}_friends_useCache", rng.uniform(0, 1e6)) for n in (10, 25) for _ in range(700)]
    seen = set()
    for parts in (1, 4, 7):
        rng.shuffle(rows)
        log = spark.createDataFrame(rows, "label string, duration_ms double").repartition(parts)
        seen.add(tuple(sorted(map(tuple, runlog.label_averages(log).collect()))))
    assert len(seen) == 1
