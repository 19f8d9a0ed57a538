"""Run results: single-document JSON in, partitioned tables in and out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from replyloom.domain import BASELINE_ROW, ROUTED_ROW
from replyloom.functions.numeric import share
from replyloom.functions.settle import settle
from replyloom.sources.documents import array_elements


def read_run_document(spark: SparkSession, path, row: T.StructType = ROUTED_ROW) -> DataFrame:
    """Rows of run documents ``{mode, results: [...]}`` with their position: run_id, position and the fields
    of ``row``. A document is one JSON object, but its blocks are read by as many tasks (``documents``);
    an element that is no such row fails the job."""
    elements, fields = array_elements(spark, path)
    named = fields.filter(F.col("key").isin("mode", "model")).groupBy(F.col("file").alias("_file")).agg(
        F.coalesce(F.max(F.when(F.col("key") == "mode", F.col("value"))), F.max("value")).alias("run_id")
    )
    read = elements.join(named, F.col("file") == F.col("_file"), "left")
    # settled: what is asked of a row later must not be asked of other parts of the document
    return settle(read, {"_r": F.from_json("text", row, {"mode": "FAILFAST"})}).select("run_id", F.col("position").cast("int").alias("position"), "_r.*")


def baseline_metrics(spark: SparkSession, path: str | None) -> DataFrame:
    """One row with a baseline document's accuracy; none if the document is absent."""
    empty = spark.createDataFrame([], "accuracy double")
    if path is None:
        return empty
    try:
        rows = read_run_document(spark, path, BASELINE_ROW)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    return rows.groupBy("run_id").agg(share(F.col("correct")).alias("accuracy")).select("accuracy")


def explode_calls(results: DataFrame) -> DataFrame:
    """One row per call of a routed result, numbered from 1."""
    return results.select(
        "request_id", "run_id", "route", F.posexplode("calls").alias("_i", "_c")
    ).select("request_id", "run_id", "route", (F.col("_i") + 1).alias("call_no"), "_c.*")


def write_run(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Results partitioned by run, so that comparing two runs reads only those.
    With dynamic overwrite a re-run replaces its own partitions only."""
    results.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def read_runs(spark: SparkSession, path: str, *run_ids: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.col("run_id").isin(*run_ids)) if run_ids else df


def write_summary(summary: DataFrame, config: dict, path: str, mode: str = "overwrite") -> None:
    """One row per run: its configuration and its rounded figures."""
    fixed = [F.lit(v).alias(f"config_{k}") for k, v in config.items()]
    summary.select("*", *fixed).write.mode(mode).parquet(path)
