"""Session defaults and the shared folder for cut lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "ledgerlake") -> SparkSession:
    """Single-machine session for tests and the bench; a cluster brings its own."""
    parallel = 8 if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Long documents make wide rows; fewer of them go to Python at a time.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    The session's ``spark.checkpoint.dir`` always wins. Only a local session
    without it gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-"))
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/ledgerlake/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one costly result feeds several jobs: the Parquet copy survives
    lost executors, is pruned by column, and gives Catalyst true sizes.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
