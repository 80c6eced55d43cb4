"""The table of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.operators.reports import run_statistics
from candor.schema import RUNS


def run_rows(spark: SparkSession, runs: list[dict]) -> DataFrame:
    """Run descriptions as rows of the `runs` layout; missing fields become NULL."""
    names = [field.split()[0] for field in RUNS.split(", ")]
    return spark.createDataFrame([tuple(run.get(n) for n in names) for run in runs], RUNS)


def with_statistics(runs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Fills totals and average rates of each run from its candidates."""
    stats = run_statistics(candidates).withColumn("run_id", F.col("run_id").cast("string"))
    replaced = [c for c in stats.columns if c != "run_id"]
    return runs.drop(*replaced).join(stats, "run_id", "left")


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def load_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

