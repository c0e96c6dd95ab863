"""Written intermediate tables.

Every stage that several jobs read is written once, as Parquet, under the
shared folder of the session, and read back. That also cuts the lineage: a lost
executor re-reads files instead of repeating the steps before.
"""

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from hirelake.session import work_dir


#: Parts that a shuffle of a stored table is cut into at first; adaptive execution joins small ones up to its advisory size. Beyond 200
#: Spark sorts rows before it writes them, which spilled links.
FIRST_PARTS = 200
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def fine_shuffles(spark: SparkSession, parts: int = FIRST_PARTS) -> Iterator[None]:
    """Shuffles planned meanwhile start from at least so many parts, so that what a task sorts is bounded by the advisory size
    and does not grow with the table where `spark.sql.shuffle.partitions` is a small fixed number."""
    before = spark.conf.get(_INITIAL, None)
    spark.conf.set(_INITIAL, str(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")), int(before or 0))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_INITIAL)
        else:
            spark.conf.set(_INITIAL, before)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` to a folder of its own and return it read back."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/hirelake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(_schema_of(df, partition_by)).parquet(path)


def _schema_of(df: DataFrame, partition_by: tuple[str, ...]):
    order = [c for c in df.columns if c not in partition_by] + list(partition_by)
    return df.select(*order).schema


class StageStore:
    """Tables written at most once per session and input folder.

    Inputs are taken as unchanging while the application runs; `refresh` forgets
    what was written for one folder.
    """

    def __init__(self):
        self._tables: dict[tuple[str, str, str], DataFrame] = {}

    def get(self, spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame], partition_by=()) -> DataFrame:
        key = (spark.sparkContext.applicationId, folder, name)
        if key not in self._tables:
            with fine_shuffles(spark):
                self._tables[key] = materialize(build(), name, partition_by)
        return self._tables[key]

    def refresh(self, folder: str) -> None:
        self._tables = {k: v for k, v in self._tables.items() if k[1] != folder}


STORE = StageStore()
