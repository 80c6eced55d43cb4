"""Session helpers: a local session for tests, and the shared scratch folder of a cluster."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, app: str = "candor") -> SparkSession:
    """A `local[n]` session for tests and the bench; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CANDOR_DRIVER_MEMORY", "6g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Of keys that repeat in a JSON object the last one counts, as for most readers.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        # Splits of about one row group, so that small files still use all cores.
        .config("spark.sql.files.maxPartitionBytes", "1m")
        # Recording the Python call site of every expression costs seconds on plans this wide.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Java methods of more bytes of code than this are never compiled to machine code (HugeMethodLimit of HotSpot).
COMPILED_BYTES = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def prefer_compiled(spark: SparkSession) -> None:
    """Has steps whose generated method the JVM would only interpret run as several smaller ones, as Spark's documentation advises for HotSpot.

    Scoring is a wide projection; fused into one method it can pass that limit, and then costs about twice the time. Results don't depend on it. A session that names a limit of its own keeps it.
    """
    if spark.conf.get(_METHOD_LIMIT) == "65535":
        spark.conf.set(_METHOD_LIMIT, str(COMPILED_BYTES))


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in `spark.checkpoint.dir`.

    A local session that names none, as in tests, uses a folder in its warehouse.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        if not context.getCheckpointDir():
            context.setCheckpointDir(root)
        return root
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch")
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared scratch folder, in a folder of this application that goes when its driver ends."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{scratch_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{folder.toString()}/{name}-{uuid.uuid4().hex}"
