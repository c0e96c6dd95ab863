"""Locations: "City, ST" and its variants, and metro areas named after a city."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import fixed, text

_NAME_TO_CODE = {name.lower(): code for code, name in fixed.US_STATES.items()}


def _state_code(name: Column) -> Column:
    bare = F.regexp_replace(text.strip(name), rf"(?i)[{text.SPACE}]+(metropolitan area|area)$", "")
    return text.literal_map(_NAME_TO_CODE)[F.lower(bare)]


def parse_location(location) -> Column:
    """struct(city, state, location_level) by the first rule that fits.

    The level says which rule it was, so "Nowhere, United States" is of level
    "state" with no state. Level "other" is left for `resolve_metros`.
    """
    loc = F.coalesce(F.col(location) if isinstance(location, str) else location, F.lit(""))
    parts = F.transform(F.split(loc, ","), text.strip)
    n = F.size(parts)
    first, second, third = (F.try_element_at(parts, F.lit(i)) for i in (1, 2, 3))
    us = "United States"
    code = F.upper(second)

    def place(level: str, city=None, state=None) -> Column:
        null = F.lit(None).cast("string")
        return F.struct(
            (null if city is None else city).alias("city"),
            (null if state is None else state).alias("state"),
            F.lit(level).alias("location_level"),
        )

    return (
        F.when(loc.isin("", us), place("country"))
        .when((n == 2) & text.literal_map({c: 1 for c in fixed.US_STATES})[code].isNotNull(), place("city", first, code))
        .when((n == 2) & (second == us), place("state", state=_state_code(first)))
        .when((n == 2) & _state_code(second).isNotNull(), place("state", state=_state_code(second)))
        .when((n == 3) & (third == us), place("city", first, _state_code(second)))
        .when((n == 1) & _state_code(first).isNotNull(), place("state", state=_state_code(first)))
        .otherwise(place("other"))
    )


def modal(df: DataFrame, by: str, value: str) -> DataFrame:
    """Most frequent value per group, the smallest on a tie: by, value, count."""
    counted = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(by).agg(
        F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v")))["v"].alias(value),
        F.sum("n").alias("count"),
    )


def city_dictionary(parsed: DataFrame, min_count: int = 5) -> DataFrame:
    """Cities seen at least `min_count` times, with their most frequent state."""
    known = parsed.where(F.col("city").isNotNull() & F.col("state").isNotNull())
    return modal(known, "city", "state").where(F.col("count") >= min_count).select("city", "state")


def _pieces(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(rf"[{text.WORD}]+|[^{text.WORD}]+"), F.lit(0))


def resolve_metros(locations: DataFrame, cities: DataFrame, location: str = "location") -> DataFrame:
    """The known city each location names: location, city, state.

    The earliest mention wins, then the longest name. Instead of trying every
    city on every location, each distinct location is cut at its word edges and
    the stretches between two edges, up to the longest city name, are joined to
    the cities by equality.
    """
    longest = cities.select(F.max(F.size(_pieces(F.col("city"))))).scalar()
    pieces = F.col("pieces")
    n = F.size(pieces)
    starts_with_word = F.element_at(pieces, 1).rlike(f"^[{text.WORD}]")
    ends_with_word = F.element_at(pieces, -1).rlike(f"^[{text.WORD}]")
    first = F.when(starts_with_word, 1).otherwise(2)
    last = F.when(ends_with_word, n).otherwise(n - 1)

    def stretches(i: Column) -> Column:
        until = F.least(F.col("last"), i + F.col("longest") - 1)
        before = F.concat_ws("", F.slice(pieces, F.lit(1), i - 1))
        return F.transform(
            F.sequence(i, until),
            lambda j: F.struct(
                F.length(before).alias("pos"),
                F.concat_ws("", F.slice(pieces, i, j - i + 1)).alias("city"),
            ),
        )

    candidates = (
        locations.select(location)
        .where(F.col(location).isNotNull())
        .distinct()
        .withColumn("pieces", _pieces(F.col(location)))
        .where(n > 0)
        .withColumn("first", first)
        .withColumn("last", last)
        .withColumn("longest", longest)
        .where((F.col("first") <= F.col("last")) & (F.col("longest") > 0))
        .select(location, F.inline(F.flatten(F.transform(F.sequence("first", "last"), stretches))))
    )
    best = F.min(F.struct("pos", (-F.length("city")).alias("len"), "city", "state")).alias("best")
    return candidates.join(cities, "city").groupBy(location).agg(best).select(location, "best.city", "best.state")


def with_location(df: DataFrame, location: str = "location", min_count: int = 5) -> DataFrame:
    """Add city, state and location_level; levels are city, state, country, metro, other."""
    parsed = df.withColumn("_place", parse_location(location)).select("*", "_place.*").drop("_place")
    cities = city_dictionary(parsed, min_count)
    open_ = F.coalesce(F.col("location_level") == "other", F.lit(False))
    other = parsed.where(open_)
    metros = resolve_metros(other, cities, location).select(
        F.col(location).alias("_loc"), F.col("city").alias("_city"), F.col("state").alias("_state")
    )
    found = F.col("_city").isNotNull()
    named = (
        other.join(metros, F.col(location) == F.col("_loc"), "left")
        .withColumn("city", F.when(found, F.col("_city")).otherwise(F.col("city")))
        .withColumn("state", F.when(found, F.col("_state")).otherwise(F.col("state")))
        .withColumn("location_level", F.when(found, "metro").otherwise(F.col("location_level")))
        .drop("_loc", "_city", "_state")
    )
    return parsed.where(~open_).unionByName(named)  # only places that are still open are joined
