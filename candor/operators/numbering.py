"""Row numbers within groups that also hold when one group is a third of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.session import scratch_root

_ROW_BITS = 33
#: Parts of a group that are ranked apart before the whole group is.
_BUCKETS = 64
#: Ranks up to which a group is sliced that way: the last step sees _BUCKETS times as many rows of a group at most.
_RANKS = 20_000


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str, start: int | Column = 0, spread: bool = False) -> DataFrame:
    """Adds `name`: start, start+1, ... within each group of `keys`, in `order` (which must be total).

    The plan depends on what the groups are, never on their size. The candidates of one query are a group for a window. With `spread`, for groups
    such as splits that can hold a third of the table, rows are range-partitioned over keys and order, so that each group lies in many tasks.
    """
    start = start if isinstance(start, Column) else F.lit(start)
    if spread:
        return _number_spread(df, keys, order, name, start)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, (F.row_number().over(window).cast("long") - 1 + start).cast("int"))


def _number_spread(df: DataFrame, keys: list[str], order: list[str], name: str, start: Column) -> DataFrame:
    """Position in the globally sorted table minus the position of the group's first row."""
    spark = df.sparkSession
    scratch_root(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds come from a sample, so positions are pinned by a checkpoint before they are used twice.
    placed = (
        df.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
    )
    part = F.shiftright("_at", _ROW_BITS)
    # One row per partition: small by construction, whatever the table size.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    located = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    located = located.withColumn("_pos", F.col("_offset") + F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1))
    firsts = located.groupBy(*keys).agg(F.min("_pos").alias("_first"))
    # Keys as text in new columns: a shuffle of its own for this side, so that a hot key can be split.
    firsts = firsts.select(*[F.concat(F.col(k).cast("string"), F.lit("")).alias(f"_key_{k}") for k in keys], "_first")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).cast("string").eqNullSafe(F.col(f"_key_{key}"))
    numbered = located.join(firsts, same).withColumn(name, F.col("_pos") - F.col("_first") + start)
    return numbered.drop("_at", "_part", "_offset", "_pos", "_first", *[f"_key_{k}" for k in keys])


def first_per_group(df: DataFrame, keys: list[str], order: list[str], count: int) -> DataFrame:
    """The first `count` rows of each group. Spark trims each partition to that many rows per group before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= count).drop("_rank")


def slice_per_group(df: DataFrame, keys: list[str], order: list[str], offset: int, limit: int | None) -> DataFrame:
    """Skips `offset` rows of each group, then takes `limit` (all the rest when None).

    Spark trims partitions before the shuffle only up to a threshold of ranks. Beyond it, rows of a group are first ranked in parts that a hash of the order deals out,
    so that no task holds a group; what is left of each part is ranked together. Very far slices number the whole table in range partitions.
    """
    last = None if limit is None else offset + limit
    if last is None or last > _RANKS:
        ranked = number_rows(df, keys, order, "_rank", 1, spread=True)
        return ranked.where((F.col("_rank") > offset) & (F.lit(True) if last is None else F.col("_rank") <= last)).drop("_rank")
    if last > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        df = first_per_group(df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(_BUCKETS))), [*keys, "_bucket"], order, last).drop("_bucket")
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= last)
    return ranked.where(F.col("_rank") > offset).drop("_rank")
