"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. The number of shuffle partitions is
# left to the cluster: AQE coalesces or splits from whatever it starts with.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot keys in shuffle joins even when the split costs another shuffle
    # later on: one key may hold a third of the rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods beyond 8000 bytes; wide cleaning projections
    # are far faster as split per-operator code than as one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


#: Of local sessions without ``spark.checkpoint.dir``, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohortloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # No call-site capture per column expression: it dominates plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that the cluster names in ``spark.checkpoint.dir``.
    Only a local-mode session without that setting gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        # The setting cannot be changed in a session, so the folder is kept here.
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="cohortloom-checkpoint-")
        folder = _LOCAL_FOLDERS[app]
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, max_rows: int = 0) -> DataFrame:
    """Like ``checkpointed``, but as a Parquet table: compressed, and read by column, in files of
    ``max_rows`` at most if given.

    The tables lie in one folder per application, which can be deleted with it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", max_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
