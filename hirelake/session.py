"""Session settings and the folder for written intermediate tables."""

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, memory: str = "12g", app: str = "hirelake") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written tables: what `spark.checkpoint.dir` names.

    Where it is unset, a session whose only machine is this one gets a temporary folder, one for the
    application; a cluster gets an error, since a machine-local folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    if context.applicationId not in _OWN_FOLDERS:
        _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="hirelake-")
    return _OWN_FOLDERS[context.applicationId]


_OWN_FOLDERS: dict[str, str] = {}


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores on an input of few files, for work that is heavy per row.

    A table with at least as many partitions as the cluster has cores is returned
    as it is, so large tables are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
