import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from velorisk.operators import positions


@pytest.fixture(autouse=True)
def several_ranges(spark):
    """Keep adaptive execution from merging the ranges of these small tables."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture
def scores(spark):
    """Half of the rows share the score 0."""
    rng = random.Random(3)
    rows = [(i, 0.0 if rng.random() < 0.5 else round(rng.uniform(0, 20), 1)) for i in range(1003)]
    return spark.createDataFrame(rows, "id bigint, score double").repartition(7)


@pytest.mark.parametrize("buckets", [1, 4, 10, 2000])
def test_ntile(scores, buckets):
    placed = positions.with_positions(scores, F.asc("score"), F.asc("id"))
    got = {r.id: r.t for r in placed.select("id", positions.ntile(buckets).alias("t")).collect()}
    window = Window.orderBy("score", "id")
    want = {r.id: r.t for r in scores.select("id", F.ntile(buckets).over(window).alias("t")).collect()}
    assert got == want


def test_rank_with_a_dominant_value(scores):
    placed = positions.with_positions(scores, F.desc("score"), F.asc("id"))
    ranked = positions.with_rank(placed, "score")
    got = {r.id: r.risk_rank for r in ranked.collect()}
    want = {r.id: r.k for r in scores.select("id", F.rank().over(Window.orderBy(F.desc("score"))).alias("k")).collect()}
    assert got == want
    # The dominant value fills several ranges, so its rank is agreed between them.
    assert placed.where("score = 0").select("range_no").distinct().count() > 1


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("n", [1, 2, 11, 1003])
def test_exact_quantiles(scores, n, descending):
    part = scores.where(F.col("id") < n)
    order = F.desc("score") if descending else F.asc("score")
    placed = positions.with_positions(part, order, F.asc("id"))
    row = positions.exact_quantiles(placed, "score", [0.4, 0.7, 0.9], descending).first()
    values = [r.score for r in part.collect()]
    assert tuple(row) == pytest.approx(tuple(np.quantile(values, [0.4, 0.7, 0.9])))


def test_empty_table(scores):
    placed = positions.with_positions(scores.where("id < 0"), F.asc("score"), F.asc("id"))
    assert placed.count() == 0
    assert tuple(positions.exact_quantiles(placed, "score", [0.5], False).first()) == (None,)


def test_approximate_quantiles_are_data_values(scores):
    row = positions.approximate_quantiles(scores, "score", [0.4, 0.9]).first()
    values = {r.score for r in scores.collect()}
    assert row.p40 in values and row.p90 in values


@pytest.mark.parametrize("n", [1, 10, 500, 5000])
def test_hash_sample_is_exact_and_repeatable(scores, n):
    first = [r.id for r in positions.smallest_by_hash(scores, "id", n).collect()]
    again = [r.id for r in positions.smallest_by_hash(scores.repartition(3), "id", n).collect()]
    assert first == again
    assert len(first) == min(n, 1003)
    want = [r.id for r in scores.orderBy(F.md5(F.col("id").cast("string"))).limit(n).collect()]
    assert first == want


def test_nulls_keep_their_rank_and_count_for_no_quantile(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 2), (4, None), (5, 1)], "k bigint, v bigint")
    for order, descending in ((F.asc("v"), False), (F.desc("v"), True)):
        placed = positions.with_positions(rows, order, F.asc("k"))
        ranks = {r.k: r.risk_rank for r in positions.with_rank(placed, "v").collect()}
        assert ranks == ({2: 1, 4: 1, 5: 3, 3: 4, 1: 5} if not descending else {1: 1, 3: 2, 5: 3, 2: 4, 4: 4})
        got = positions.exact_quantiles(placed, "v", [0.4, 0.7, 0.9], descending).first()
        assert [round(x, 6) for x in got] == [1.8, 3.2, 4.4]


@pytest.mark.parametrize("bins", [2, 16, 1024])
def test_selected_quantiles_equal_sorted_ones(spark, bins):
    rng = random.Random(11)
    tables = {
        "one": [4.0],
        "equal": [2.5] * 7,
        "dominant": [0.0] * 60 + [rng.uniform(-5, 5) for _ in range(41)],
        "spread": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(53)] + [1.7e308, -1.7e308],
        "tiny": [k * 5e-324 for k in range(9)],
        "infinite": [float("-inf")] * 5 + [1.0, 2.0, 3.0] + [float("inf")] * 5,
    }
    for name, values in tables.items():
        rows = spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, "v double").repartition(3)
        got = tuple(positions.selected_quantiles(rows, "v", [0.0, 0.4, 0.7, 0.9, 1.0], bins).first())
        ordered, want = sorted(values), []
        for q in (0.0, 0.4, 0.7, 0.9, 1.0):
            t = (len(values) - 1) * q
            low, high = ordered[int(np.floor(t))], ordered[int(np.ceil(t))]
            want.append(low if low == high else low + (high - low) * (t - np.floor(t)))
        assert got == pytest.approx(tuple(want), rel=1e-12, abs=0, nan_ok=True), name


def test_selected_quantiles_of_odd_tables(spark):
    nothing = spark.createDataFrame([], "v bigint")
    assert tuple(positions.selected_quantiles(nothing, "v", [0.5]).first()) == (None,)
    nulls = spark.createDataFrame([(None,)], "v bigint")
    assert tuple(positions.selected_quantiles(nulls, "v", [0.4, 0.7]).first()) == (None, None)
    nan = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (float("nan"),)], "v double")
    low, high = positions.selected_quantiles(nan, "v", [0.0, 1.0]).first()
    assert low == 1.0 and np.isnan(high)
    whole = spark.createDataFrame([(k,) for k in range(1, 101)], "v bigint")
    assert tuple(positions.selected_quantiles(whole, "v", [0.4, 0.9]).first()) == pytest.approx((40.6, 90.1))


def test_sketches_of_years_answer_for_any_span(spark):
    rng = random.Random(12)
    rows = [(2000 + i % 5, rng.expovariate(1 / (1 + i % 5))) for i in range(20_000)]
    df = spark.createDataFrame([*rows, (2000, None), (2009, None)], "year int, v double").repartition(6)
    sketches = positions.sketches_by(df, "v", "year")
    for first, last in ((2000, 2004), (2001, 2002), (2003, 2003)):
        values = np.array(sorted(v for y, v in rows if first <= y <= last))
        got = positions.quantiles_of_sketches(sketches.where(F.col("year").between(first, last)), [0.4, 0.9]).first()
        for q, x in zip((0.4, 0.9), got):
            assert abs((values <= x).mean() - q) < 0.005
    assert tuple(positions.quantiles_of_sketches(sketches.where("year > 2005"), [0.4]).first()) == (None,)
    assert tuple(positions.quantiles_of_sketches(sketches.where("year > 2010"), [0.4]).first()) == (None,)
    assert positions.quantiles_of_sketches(sketches, [0.5], "year").count() == 6
