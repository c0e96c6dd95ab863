"""Exact quantiles and summaries that stay distributed for groups of any size.

`percentile` keeps every distinct value of a group in one task. Here a value is found digit by digit: as a
64-bit number that orders as the value does, in three digits of about 21 bits. For each digit the counts are added up over its
values, and only those that hold a wanted rank go on to the next digit. So whatever the distribution, no task sees more than one digit's
values of one group.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
#: How far a value's number is shifted for its first, second and third digit.
SHIFTS = (43, 21, 0)


def ordered_number(value: Column) -> Column:
    """A number that orders as the double does: sign, exponent and 52 bits of the fraction. Infinities come at the ends."""
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("int")
    # The logarithm may be off by one at powers of two; values too small for a full fraction share their exponent.
    low = F.lit(-1022)
    guess = F.greatest(guess, low)
    exponent = F.when(F.pow(F.lit(2.0), guess) > size, F.greatest(guess - 1, low)).when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1).otherwise(guess)
    exponent = F.least(exponent, F.lit(1023))
    # Below the smallest full fraction the quotient is under one, which orders them below all others of their exponent.
    fraction = (size / F.pow(F.lit(2.0), exponent) * F.lit(float(1 << 52))).cast("bigint")
    # The fraction holds the leading one of all but the smallest values, which is the exponent's lowest bit once more.
    number = F.shiftleft((exponent + 1022).cast("bigint"), 52) + fraction
    number = F.when(size == 0, F.lit(0).cast("bigint")).when(size == float("inf"), F.lit(2047 << 52)).otherwise(number)
    return F.when(value < 0, -number).otherwise(number)


def value_counts(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """How often each value occurs (per group): columns by..., v, n. NaN counts as missing; infinities are values."""
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return known.groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet each other; the key columns appear once."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def quantiles_of_counts(counts: DataFrame, probs: dict[str, float], by: list[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles from `value_counts` output: by..., count, <names>."""
    by = list(by)
    counts = counts.withColumn("number", ordered_number(F.col("v")))

    def position(p: float) -> Column:
        return (F.col("total") - 1) * F.lit(float(p))

    def holds(rank: Column) -> Column:
        return (rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto"))

    ranks = [(f"_{side}_{name}", rank) for name, p in probs.items() for side, rank in (("lo", F.floor(position(p))), ("hi", F.ceil(position(p))))]
    wanted = F.lit(False)
    for _, rank in ranks:
        wanted = wanted | holds(rank)

    found = None  # the leading digits that hold a wanted rank, with the rows before them
    for k, shift in enumerate(SHIFTS):
        step = counts.withColumn("digits", F.shiftright("number", shift))
        if k:
            step = null_safe_join(step.withColumn("leading", F.shiftright("number", SHIFTS[k - 1])), found, [*by, "leading"])
        keys = [*by, "digits"] if not k else [*by, "leading", "digits", "before", "total"]
        cells = step.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("v").alias("v"))
        group = (by if not k else [*by, "leading"]) or [F.lit(0)]
        running = F.sum("n").over(Window.partitionBy(*group).orderBy("digits"))
        if not k:
            cells = cells.withColumn("total", F.sum("n").over(Window.partitionBy(*group))).withColumn("before", F.lit(0).cast("bigint"))
        cells = cells.withColumn("upto", running + F.col("before")).where(wanted)
        if k + 1 < len(SHIFTS):
            found = cells.select(*by, F.col("digits").alias("leading"), (F.col("upto") - F.col("n")).alias("before"), "total")

    picks = [F.max("total").alias("count")] + [F.max(F.when(holds(rank), F.col("v"))).alias(name) for name, rank in ranks]
    ends = cells.groupBy(*by).agg(*picks).where(F.col("count").isNotNull())

    def between(name: str, p: float) -> Column:
        at = (F.col("count") - 1) * F.lit(float(p))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        # Equal ends are the value itself, which also keeps two infinities from making NaN.
        return F.when((low == high) | (at == F.floor(at)), low).otherwise(low + (high - low) * (at - F.floor(at))).alias(name)

    return ends.select(*by, "count", *[between(name, p) for name, p in probs.items()])


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: list[str] = ()) -> DataFrame:
    """Exact quantiles of a column, per group if asked: by..., count, <names>."""
    return quantiles_of_counts(value_counts(df, value, by), probs, by)


def medians(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """by..., count (of non-NULL values), median."""
    return quantiles(df, value, {"median": 0.5}, by)


def describe(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max of a column, per group if asked."""
    counts = value_counts(df, value, by)
    v, n = F.col("v"), F.col("n")
    total, mean = F.sum(n), F.sum(v * n) / F.sum(n)
    moments = counts.groupBy(*by).agg(
        mean.alias("mean"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        total.alias("_n"),
    )
    moments = moments.where(F.col("_n").isNotNull())
    # The squares are taken around the mean, in a second pass over the counts.
    spread = (
        null_safe_join(counts, moments.select(*by, "mean"), list(by)) if by
        else counts.withColumn("mean", moments.select("mean").scalar())
    )
    spread = spread.groupBy(*by).agg(
        F.sqrt(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))) / F.nullif(F.sum(n) - 1, F.lit(0))).alias("std")
    )
    out = quantiles_of_counts(counts, QUARTILES, by)
    columns = [*by, "count", "mean", "std", "min", "q1", "median", "q3", "max"]
    if by:
        joined = null_safe_join(null_safe_join(out, moments, list(by)), spread, list(by))
    else:
        joined = out.withColumns({c: moments.select(c).scalar() for c in ("mean", "min", "max")})
        joined = joined.withColumn("std", spread.select("std").scalar())
    return joined.select(*columns)


def box_stats(df: DataFrame, value: str, by: list[str], reach: float = 1.5) -> DataFrame:
    """Quartiles and whiskers: the last values within `reach` x IQR of the box."""
    counts = value_counts(df, value, by)
    box = quantiles_of_counts(counts, QUARTILES, by)
    fence = F.lit(reach) * (F.col("q3") - F.col("q1"))
    v = F.col("v")
    ends = (
        null_safe_join(counts, box, list(by))
        .groupBy(*by)
        .agg(
            F.min(F.when(v >= F.col("q1") - fence, v)).alias("low"),
            F.max(F.when(v <= F.col("q3") + fence, v)).alias("high"),
        )
    )
    return null_safe_join(box, ends, list(by)).select(
        *by,
        F.col("count").alias("n"),
        F.least("low", "q1").alias("whisker_low"),
        "q1",
        "median",
        "q3",
        F.greatest("high", "q3").alias("whisker_high"),
    )


def with_share(counted: DataFrame, count: str, total: DataFrame | Column, out: str = "pct", places: int = 1) -> DataFrame:
    """Add 100 x count / total, rounded."""
    total = total.scalar() if isinstance(total, DataFrame) else total
    return counted.withColumn(out, F.round(F.col(count) * 100.0 / total, places))
