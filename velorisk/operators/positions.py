"""Global order statistics without a single-task window.

``ntile``, ``rank`` and exact quantiles over a whole table need each row's place
in one total order. A window without partitions sends every row to one task.
Here the rows are range-sorted across tasks and stored once with their offset in
their own range; a table of one row per range then shifts the offsets to places.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velorisk.session import materialise

_OFFSET_BITS = 33  # monotonically_increasing_id keeps the offset in the low 33 bits, without a check


def _within_range_limit(rows: Column) -> Column:
    full = F.lit(1 << _OFFSET_BITS)
    return F.when(rows < full, rows).otherwise(
        F.raise_error(F.lit("a range holds 2^33 rows or more: raise spark.sql.shuffle.partitions")).cast("bigint")
    )


def with_positions(df: DataFrame, *order: Column) -> DataFrame:
    """Add ``position`` (from 0), ``row_total`` and ``range_no`` in the given order.

    The order should end in a unique key: then even a value shared by most rows
    is split across ranges. The sort is stored, since a second evaluation may
    choose other range bounds.
    """
    columns = df.columns
    stored = materialise(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "ordered")
    stored = stored.select(
        *columns,
        F.shiftright("_slot", _OFFSET_BITS).alias("range_no"),
        F.col("_slot").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1)).alias("_offset"),
    )
    # One row per range, so at most spark.sql.shuffle.partitions rows from here to the broadcast.
    ranges = stored.groupBy("range_no").agg(_within_range_limit(F.count(F.lit(1))).alias("_rows"))
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = ranges.select(
        "range_no",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(everything).alias("row_total"),
    )
    return stored.join(F.broadcast(starts), "range_no").select(
        *columns, "range_no", (F.col("_start") + F.col("_offset")).alias("position"), "row_total"
    )


def ntile(buckets: int, position: str = "position", total: str = "row_total") -> Column:
    """NTILE from a position: the first ``total mod buckets`` buckets hold one row more."""
    place, size = F.col(position), F.col(total)
    small = F.floor(size / F.lit(buckets)).cast("bigint")
    larger = size % F.lit(buckets)
    in_larger = larger * (small + F.lit(1))
    tile = F.when(place < in_larger, F.floor(place / (small + F.lit(1)))).otherwise(
        larger + F.floor((place - in_larger) / F.greatest(small, F.lit(1)))
    )
    return (tile + F.lit(1)).cast("bigint")


def with_rank(positioned: DataFrame, value: str, name: str = "risk_rank") -> DataFrame:
    """RANK over ``value``, for a table positioned with ``value`` as first sort key.

    Nulls are equal to each other. Equal values share the rank of the first of them. They are looked up per
    (value, range), so a value that fills many ranges is met by many small groups.
    """
    runs = positioned.groupBy("range_no", value).agg(F.min("position").alias("_first"))
    runs = runs.select(
        "range_no", value, (F.min("_first").over(Window.partitionBy(value)) + F.lit(1)).cast("bigint").alias(name)
    )
    runs = runs.withColumnsRenamed({"range_no": "_range", value: "_value"})
    same = (F.col("range_no") == F.col("_range")) & F.col(value).eqNullSafe(F.col("_value"))
    return positioned.join(runs, same).drop("_range", "_value")


def exact_quantiles(positioned: DataFrame, value: str, quantiles: Sequence[float], descending: bool) -> DataFrame:
    """One row with the interpolated quantiles ``p40``, ``p70``, … of a positioned table.

    Nulls don't count. They stand at one end of the order: first if ascending, last
    if descending, as Spark sorts by default. Only the two neighbours of each
    quantile are read: a handful of rows.
    """
    nulls = positioned.agg(F.count_if(F.col(value).isNull()).alias("_nulls"))
    positioned = positioned.crossJoin(F.broadcast(nulls)).where(F.col(value).isNotNull())  # one row
    last = F.col("row_total") - F.col("_nulls") - F.lit(1)
    ascending = (last - F.col("position")) if descending else F.col("position") - F.col("_nulls")
    picks, results = [], []
    wanted = F.lit(False)
    for q in quantiles:
        label = f"p{round(q * 100)}"
        target = last * F.lit(float(q))
        low, high = F.floor(target), F.ceil(target)
        wanted = wanted | (ascending == low) | (ascending == high)
        picks += [
            F.max(F.when(ascending == low, F.col(value))).alias(f"_{label}_low"),
            F.max(F.when(ascending == high, F.col(value))).alias(f"_{label}_high"),
            F.max(target - low).alias(f"_{label}_share"),
        ]
        lower, upper = F.col(f"_{label}_low"), F.col(f"_{label}_high")
        results.append((lower + (upper - lower) * F.col(f"_{label}_share")).alias(label))
    return positioned.where(wanted).agg(*picks).select(*results)


_BINS = 1024


def selected_quantiles(df: DataFrame, value: str, quantiles: Sequence[float], bins: int = _BINS) -> DataFrame:
    """One row with the interpolated quantiles ``p40``, ``p70``, … of any table, without a sort. Nulls don't count.

    A histogram over the span of the values tells in which bin each wanted place lies;
    the next pass divides those bins alone, between the least and the largest value that
    they really hold, until a place falls on a bound or on a bin of equal values. Only
    histograms reach the driver: ``bins`` rows for each place and pass. ``df`` is read
    once a pass, three or four times as a rule; a costly one should be stored before.
    Infinite values and NaN, the largest of all, stand in bins of their own.
    """
    x = F.col(value).cast("double")
    finite = F.abs(x) < F.lit(float("inf"))  # false for NaN, which is larger than any number
    rows = df.where(F.col(value).isNotNull()).select(x.alias("_x"), finite.alias("_finite"))
    span = rows.agg(F.count(F.lit(1)).alias("n"), *[f(F.when(F.col("_finite"), F.col("_x"))).alias(a) for f, a in ((F.min, "low"), (F.max, "high"))]).first()
    names = [f"p{round(q * 100)}" for q in quantiles]
    schema = ", ".join(f"{name} double" for name in names)
    if not span.n:
        return df.sparkSession.createDataFrame([tuple(None for _ in names)], schema)
    targets = [(span.n - 1) * q for q in quantiles]
    open_places = {p for t in targets for p in (math.floor(t), math.ceil(t))}
    known: dict[int, float] = {}
    # Spans of values still to be divided, with the number of rows below each.
    spans = [(span.low, span.high, None)] if span.low is not None else [(0.0, 0.0, None)]
    while open_places:
        which = F.when(~F.col("_finite"), F.lit(-1)) if spans[0][2] is None else F.when(F.lit(False), F.lit(-1))
        share = F.lit(0.0)
        for i, (low, high, _) in enumerate(spans):
            inside = F.col("_finite") & F.col("_x").between(low, high)
            which = which.when(inside, F.lit(i))
            gap, scale = high - low, 1.0
            if math.isinf(gap):
                gap, scale = high / 2 - low / 2, 0.5
            if gap > 0:
                share = F.when(inside, (F.col("_x") * scale - low * scale) / gap).otherwise(share)
        # -inf comes first, inf and NaN last.
        odd = F.when(F.isnan("_x"), F.lit(bins + 1)).when(F.col("_x") > 0, F.lit(bins)).otherwise(F.lit(-1))
        cell = F.when(F.col("_finite"), F.least(F.floor(share * bins), F.lit(bins - 1))).otherwise(odd).cast("int")
        held = rows.select(which.alias("_span"), cell.alias("_bin"), "_x").where(F.col("_span").isNotNull())
        found = held.groupBy("_span", "_bin").agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high")).collect()
        following = []
        for i, (_, _, below) in enumerate(spans):
            first = below is None
            below = below or 0
            for r in sorted((r for r in found if r["_span"] == i or first), key=lambda r: r["_bin"]):
                here = {p for p in open_places if below <= p < below + r.n}
                settled = {p: r.low if p == below else r.high for p in here if r.low == r.high or p in (below, below + r.n - 1)}
                if r["_span"] == -1:
                    settled = {p: r.low for p in here}
                known |= settled
                open_places -= settled.keys()
                if here - settled.keys():
                    following.append((r.low, r.high, below))
                below += r.n
        spans = following
    results = []
    for t in targets:
        low, high = known[math.floor(t)], known[math.ceil(t)]
        results.append(low if low == high else low + (high - low) * (t - math.floor(t)))
    return df.sparkSession.createDataFrame([tuple(map(float, results))], schema)


def sketches_by(df: DataFrame, value: str, *keys: str, k: int = 2000) -> DataFrame:
    """A mergeable sketch of ``value`` for each combination of ``keys``: a few ten kB, whatever the number of rows.

    Stored by day or year, sketches answer for any span of time without the rows. Ranks
    are off by about 2.3 / ``k`` at most; nulls don't count.
    """
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def quantiles_of_sketches(sketches: DataFrame, quantiles: Sequence[float], *keys: str, k: int = 2000) -> DataFrame:
    """Quantiles ``p40``, ``p70``, … of all rows behind the sketches, in all or for each combination of ``keys``; null without rows."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("_merged"))
    rows = F.kll_sketch_get_n_double("_merged")
    return merged.select(
        *keys,
        *[F.when(rows > 0, F.kll_sketch_get_quantile_double("_merged", F.lit(float(q)))).alias(f"p{round(q * 100)}") for q in quantiles],
    )


def approximate_quantiles(df: DataFrame, value: str, quantiles: Sequence[float], accuracy: int = 10000) -> DataFrame:
    """One row of approximate quantiles; each is a value of the data, and the sketch has a bounded size."""
    sketch = F.percentile_approx(value, F.array(*[F.lit(float(q)) for q in quantiles]), F.lit(accuracy))
    return df.agg(sketch.alias("_q")).select(
        *[F.col("_q")[i].alias(f"p{round(q * 100)}") for i, q in enumerate(quantiles)]
    )


def smallest_by_hash(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``rows`` rows, spread evenly and the same on every run: those with the smallest md5 of ``key``.

    A plain limit sends up to ``rows`` rows of every task to one reducer. Here a
    histogram over the first four hex digits (at most 65,536 groups) finds the
    digits up to which enough rows lie, and only those rows are sorted.
    """
    hashed = df.withColumn("_md5", F.md5(F.col(key).cast("string")))
    digits = F.substring("_md5", 1, 4)
    counted = hashed.groupBy(digits.alias("_digits")).agg(F.count(F.lit(1)).alias("_rows"))
    upto = Window.orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_before", F.coalesce(F.sum("_rows").over(upto), F.lit(0)))
    cutoff = counted.where(F.col("_before") < F.lit(rows)).agg(F.max("_digits").alias("_cutoff"))
    return (
        hashed.join(F.broadcast(cutoff), digits <= F.col("_cutoff"))
        .orderBy("_md5", key)
        .limit(rows)
        .drop("_md5", "_cutoff")
    )
