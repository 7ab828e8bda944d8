"""Workflow metadata documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Failures nest without limit, so each stays a variant.
SCHEMA = """
    id string, workflowName string, status string, `start` timestamp, `end` timestamp,
    calls map<string, array<struct<shardIndex: bigint, attempt: int, executionStatus: string,
        backendStatus: string, `start`: timestamp, `end`: timestamp, stdout: string, subWorkflowId: string,
        failures: array<variant>>>>
"""


def scan_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per job: run_id, call_name, shard, attempt, status, dur_min, stdout,
    and failures as JSON texts."""
    docs = spark.read.schema(SCHEMA).json(path, multiLine=True)
    jobs = (docs.select("id", F.explode("calls").alias("call_name", "_jobs"))
            .select("id", "call_name", F.explode("_jobs").alias("j")))
    status = F.concat_ws("_", "j.executionStatus", "j.backendStatus")
    minutes = (F.col("j.end").cast("double") - F.col("j.start").cast("double")) / 60
    return jobs.select(F.col("id").alias("run_id"), "call_name", F.col("j.shardIndex").alias("shard"),
                       F.col("j.attempt").alias("attempt"), F.col("j.executionStatus").alias("status"),
                       status.alias("full_status"), F.col("j.start").alias("start_ts"), minutes.alias("dur_min"),
                       F.col("j.stdout").alias("stdout"), F.col("j.subWorkflowId").alias("sub_id"),
                       F.transform("j.failures", lambda x: F.to_json(x)).alias("failures"))
