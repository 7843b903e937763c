"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits the join partitions of hot keys and merges small ones
# at run time. Spark broadcasts only sides whose known or measured size is below
# its threshold; operators ask for it only where the row count is bounded.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Counts and extremes come from file footers where a scan can give them (footer_scan).
    "spark.sql.parquet.aggregatePushdown": "true",
    # Values that do not fit their type are errors.
    "spark.sql.ansi.enabled": "true",
}


def apply_settings(spark: SparkSession) -> None:
    """Give a running session the settings that results depend on."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


def local_session(
    app_name: str = "farebox",
    cores: int | str = "*",
    memory: str | None = None,
    folder: str | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
    )
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``. Where that is unset, it is a folder within the
    session's warehouse. On a cluster that must not be a folder of the driver's machine,
    which executors cannot reach: without a shared one there, this is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
        local = spark.sparkContext.master.split("[")[0] == "local"
        if not local and (folder.startswith("file:") or "://" not in folder):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` materialised by a reliable checkpoint in the shared folder."""
    folder = shared_folder(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()
