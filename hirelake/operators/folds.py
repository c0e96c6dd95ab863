"""Stratified folds in which no group (company) is split."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hashed parts of every cell, ranked one by one whatever the cell's size.
PARTS = 1024


def assign_group_folds(df: DataFrame, group: str, label: str, classes: list[str], folds: int = 5) -> DataFrame:
    """One fold per group: columns `group`, fold.

    Groups are dealt to the folds back and forth, in the order of how many rows
    of the rarest class they hold, then of the next rarest, then by size. Counts
    are ordered by their power of two, so there are at most a few thousand
    classes of groups ("cells") however many groups exist. Every cell is dealt in
    the same number of hashed parts; a running total over cells, then over the parts
    of each, gives a part its place in the deal, and groups are ranked within their part.
    """
    counts = [F.count_if(F.col(label) == c).alias(f"n{i}") for i, c in enumerate(classes)]
    groups = df.where(F.col(label).isNotNull()).groupBy(group).agg(*counts, F.count(F.lit(1)).alias("size"))

    totals = df.agg(*[F.count_if(F.col(label) == c).alias(f"t{i}") for i, c in enumerate(classes)])
    by_rarity = F.array_sort(F.array(*[F.struct(F.col(f"t{i}").alias("t"), F.lit(i).alias("i")) for i in range(len(classes))]))
    order = totals.select(F.transform(by_rarity, lambda s: s["i"])).scalar()

    magnitude = F.array(*[F.floor(F.log2(F.col(f"n{i}") + 1)).cast("int") for i in range(len(classes))])
    groups = groups.withColumn("_m", magnitude).withColumn("_order", order)
    groups = groups.withColumn("cell", F.expr("transform(_order, i -> _m[i])")).select(group, "cell", "size")

    part = F.conv(F.substring(F.md5(F.col(group)), 1, 8), 16, 10).cast("bigint") % PARTS
    groups = groups.withColumn("part", part)
    parts = groups.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("n"))
    cells = parts.groupBy("cell").agg(F.sum("n").alias("n"))  # a few thousand rows at most
    upto = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("cell")))
    cells = cells.select("cell", (upto - F.col("n")).alias("before_cell"))
    in_cell = F.sum("n").over(Window.partitionBy("cell").orderBy("part"))
    offsets = parts.withColumn("before_part", in_cell - F.col("n")).join(cells, "cell")
    offsets = offsets.select("cell", "part", (F.col("before_cell") + F.col("before_part")).alias("before"))

    in_part = Window.partitionBy("cell", "part").orderBy(F.desc("size"), group)
    place = F.col("before") + F.row_number().over(in_part) - 1
    turn, seat = F.floor(F.col("place") / folds), F.col("place") % folds
    placed = groups.join(offsets, ["cell", "part"]).withColumn("place", place)
    return placed.select(group, F.when(turn % 2 == 0, seat).otherwise(folds - 1 - seat).cast("int").alias("fold"))


def with_folds(df: DataFrame, group: str, label: str, classes: list[str], folds: int = 5) -> DataFrame:
    """Labelled rows with the fold of their group; fold 0 is the test set."""
    assigned = assign_group_folds(df, group, label, classes, folds)
    return df.where(F.col(label).isNotNull()).join(assigned, group)


def leaks(df: DataFrame, group: str, fold: str = "fold") -> DataFrame:
    """Groups found in more than one fold; no rows if the folds are right."""
    per_group = df.groupBy(group).agg(F.min(fold).alias("first"), F.max(fold).alias("last"))
    return per_group.where("first <> last")


def balance(df: DataFrame, label: str, classes: list[str], fold: str = "fold") -> DataFrame:
    """Rows, share and class counts per fold."""
    counted = df.groupBy(fold).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(label) == c).alias(c) for c in classes]
    )
    return counted.withColumn("share", F.round(F.col("rows") / df.agg(F.count(F.lit(1))).scalar(), 6))
