"""Candidate and prompt files. All readers are lazy; none of the writers overwrites what it reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.functions.messages import first_user_text
from candor.operators.joins import skip_completed
from candor.operators.numbering import first_per_group
from candor.operators.selection import dataset_version, filter_quality
from candor.schema import normalize_schema


def load_candidates(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """One or several candidate files or globs, with the file each row came from. Merging schemas reads the footer of every file."""
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)
    return df.withColumn("source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def load_normalized(spark: SparkSession, *paths: str) -> DataFrame:
    """Candidate files in the flat layout. Each path may have a layout of its own, so each is normalized before they are put together."""
    return reduce(DataFrame.unionByName, [normalize_schema(spark.read.parquet(path)) for path in paths])


def write_prompts(df: DataFrame, path: str) -> None:
    """Prompt table partitioned so that one split of one version is one folder."""
    df.withColumn("version", dataset_version(F.col("split"))).write.partitionBy("version", "split").mode("errorifexists").parquet(path)


def load_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Prompts of one split from the version that holds it; both filters prune folders."""
    wanted = dataset_version(F.lit(split))
    return spark.read.parquet(path).where((F.col("split") == split) & (F.col("version") == wanted))


def load_dataset(spark: SparkSession, path: str, split: str | None = None, kind: str = "parquet", schema: str | None = None) -> DataFrame:
    """Any prompt file. Text formats need a schema: inferring one would read the data twice."""
    if kind != "parquet" and schema is None:
        raise ValueError(f"{kind} input needs a schema")
    reader = spark.read.format(kind)
    df = (reader.schema(schema) if schema else reader).load(path)
    return df if split is None else df.where(F.col("split") == split)


def resume(spark: SparkSession, prompts: DataFrame, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Prompts still to do, and the rows a former run has already written."""
    existing = spark.read.parquet(checkpoint)
    return skip_completed(prompts, existing), existing


def write_candidates(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per split. Rows stay where they are: a split can be a third of the data."""
    df.write.partitionBy("split").option("maxRecordsPerFile", rows_per_file).mode("errorifexists").parquet(path)


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Writes `root/v=<version>`; earlier versions remain as the backup."""
    path = f"{root.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_training_set(df: DataFrame, path: str) -> None:
    filter_quality(df).write.mode("errorifexists").parquet(path)


def control_samples(df: DataFrame, order: list[str], messages: Column, count: int = 2) -> DataFrame:
    """The first rows of each split that have a question; rows are counted before the question check."""
    first = first_per_group(df, ["split"], order, count).withColumn("query", first_user_text(messages))
    return first.where(F.col("query") != "")


def control_report(samples: DataFrame, order: list[str]) -> DataFrame:
    """Text blocks of a control sample list, one row per sample, ready for `write.text`."""
    from pyspark.sql import Window

    # A handful of rows per split by construction.
    position = F.row_number().over(Window.partitionBy("split").orderBy(*order))
    title = F.concat(
        F.lit("=== "), F.upper(F.translate("split", "_", " ")), F.lit(" SAMPLE "), position.cast("string"), F.lit(" ===")
    )
    return samples.select("split", position.alias("sample"), F.concat_ws("\n\n", title, F.concat(F.lit("Query: "), F.col("query"))).alias("value"))


def write_control_report(report: DataFrame, path: str) -> None:
    report.orderBy("split", "sample").select("value").write.mode("errorifexists").text(path)
