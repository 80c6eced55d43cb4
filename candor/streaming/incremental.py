"""Scoring of newly landed candidate files, resumable and without double counting."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from candor.config import DEFAULTS

KEYS = ["query_id", "candidate_idx"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Keeps state in files next to the executors, with a cache; Spark's default holds every key that ever landed in the heap.
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TooManyFailures(RuntimeError):
    """A batch failed for more of its rows than allowed."""


def landed(spark: SparkSession, path: str, schema: StructType | str, file_filter: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the Parquet files that land below `path`."""
    reader = spark.readStream.schema(schema)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def without_duplicates(df: DataFrame, keys: list[str] | None = None, landing_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """One row per key. On a stream the state of a key is dropped `delay` after it landed."""
    keys = keys or KEYS
    if df.isStreaming:
        if landing_time is None:
            raise ValueError("a stream needs a landing time, or its state would grow without bound")
        return df.withWatermark(landing_time, delay).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def guard(rows: int, failed: int, max_rate: float = DEFAULTS.max_failure_rate) -> None:
    """Raises when too many rows of a batch failed."""
    if failed > rows * max_rate:
        raise TooManyFailures(f"{failed} of {rows} rows failed")


def score_landed(
    stream: DataFrame, score: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
    failed: Column | None = None, max_rate: float = DEFAULTS.max_failure_rate, keys: list[str] | None = None,
    reads: list[str] | None = None,
) -> StreamingQuery:
    """Scores all files that have landed and stops. A second run only sees files that came since.

    A key is scored once, however often it lands: the stream keeps the keys it has seen as state next to its progress, so the work of a batch
    depends on the batch and not on what came before. Only keys that other streams wrote to the same sink are read from there. Keys are dropped before anything is
    scored. `keys` are KEYS unless named; an empty list turns this off. A stream can't see which columns a batch will use, so all of them would move to the state of
    their key: `reads` names the columns that `score` and `failed` use besides the keys, and only those move (all unless named). The keys are kept on disk, unless the
    session names a state store of its own; a stream that goes on keeps the store it began with.

    A batch is read once: rows and failures are counted on the way, by the pass that writes. It writes to a folder that readers don't see, which is renamed when the
    counts allow it, so a batch that fails leaves nothing visible. Each batch of each stream has one folder of its own that a repeated attempt replaces.
    """
    root = sink.rstrip("/")
    owner = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    keys = KEYS if keys is None else keys

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if keys:
            others = _written_by_others(spark, root, owner)
            if others is not None:
                # Keys may be NULL, and a NULL key is a key as well.
                same = reduce(and_, [batch[k].eqNullSafe(others[k]) for k in keys])
                batch = batch.join(others.select(*keys).distinct(), same, "left_anti")
        counts = Observation()
        watched = batch.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(F.lit(False) if failed is None else failed).alias("failed"))
        pending = f"{root}/_pending/stream={owner}/batch={batch_id}"
        score(watched).write.mode("overwrite").parquet(pending)
        guard(counts.get["rows"], counts.get["failed"], max_rate)
        _publish(spark, pending, f"{root}/stream={owner}/batch={batch_id}")

    if reads is not None:
        stream = stream.select(*dict.fromkeys([*keys, *reads]))
    once = stream.dropDuplicates(keys) if keys else stream
    writer = once.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    conf = stream.sparkSession.conf
    if conf.get(_PROVIDER, None) is not None:
        return writer.trigger(availableNow=True).start()
    # A query copies the settings when it starts.
    conf.set(_PROVIDER, _ON_DISK)
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.unset(_PROVIDER)


def _publish(spark: SparkSession, pending: str, path: str) -> None:
    """Puts a written folder in its place, instead of what an earlier attempt of the batch left there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(pending), hadoop.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"could not rename {pending} to {path}")


def _written_by_others(spark: SparkSession, root: str, owner: str) -> DataFrame | None:
    """What other streams wrote to the sink; None if there is nothing. Folders of this stream are not even listed file by file."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    paths = [f"{root}/{n}" for n in names if n.startswith("stream=") and n != f"stream={owner}"]
    return spark.read.option("basePath", root).parquet(*paths) if paths else None
