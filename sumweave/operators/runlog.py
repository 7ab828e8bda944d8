"""Summaries of workflow metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sumweave.session import scratch_path

#: Doublings after which a tree that still moves must be a cycle.
MAX_DOUBLINGS = 64


def latest_attempts(jobs: DataFrame) -> DataFrame:
    """The last attempt of every shard of every call."""
    rest = F.struct(*[c for c in jobs.columns if c not in ("run_id", "call_name", "shard")])
    return (jobs.groupBy("run_id", "call_name", "shard").agg(F.max_by(rest, "attempt").alias("_row"))
            .select("run_id", "call_name", "shard", "_row.*"))


def status_text(jobs: DataFrame) -> Column:
    """The status with the backend's where there is one."""
    plain = F.col("status")
    return F.coalesce(F.col("full_status"), plain) if "full_status" in jobs.columns else plain


def status_counts(jobs: DataFrame) -> DataFrame:
    """Per run, call and status of any kind: how many shards' last attempts have it."""
    last = latest_attempts(jobs)
    return last.groupBy("run_id", "call_name", status_text(last).alias("status")).agg(F.count("*").alias("n"))


def base_path(stdout: Column) -> Column:
    """Folder of a call: the path of a job's output without shard and attempt."""
    return F.regexp_replace(stdout, "((shard|attempt)-[0-9]+/)+stdout|/stdout", "")


def workflow_summary(jobs: DataFrame) -> DataFrame:
    """Per run and call: counts of done, failed and other jobs, finished ones, the shortest and longest of them.

    The first two jobs are given by their output path where the table has one, else by shard.
    """
    last = latest_attempts(jobs)
    ended = F.col("dur_min").isNotNull()
    job = "stdout" if "stdout" in jobs.columns else "shard"
    paths = [F.min(F.when(F.col("sub_id").isNull(), base_path(F.col("stdout")))).alias("base_path")] \
        if {"stdout", "sub_id"} <= set(jobs.columns) else []
    return last.groupBy("run_id", "call_name").agg(
        F.count_if(F.col("status") == "Done").alias("n_done"),
        F.count_if(F.col("status") == "Failed").alias("n_failed"),
        F.count_if(~F.col("status").isin("Done", "Failed") | F.col("status").isNull()).alias("n_other"),
        F.count_if(ended).alias("n_finished"),
        F.min("dur_min").alias("min_min"), F.max("dur_min").alias("max_min"), F.sum("dur_min").alias("total_min"),
        F.avg("dur_min").alias("avg_min"),
        F.min_by(job, F.when(ended, F.struct("dur_min", "shard"))).alias("min_job"),
        F.max_by(job, F.when(ended, F.struct("dur_min", -F.col("shard")))).alias("max_job"), *paths)


def tree_roots(parents: DataFrame) -> DataFrame:
    """(run_id, root) of every run in (run_id, parent_id), however deep.

    Pointer doubling: each round takes every run as far again, so the rounds grow with the
    logarithm of the depth. Each is written to the shared folder. A run whose parent is not listed
    has that parent as its root.
    """
    spark = parents.sparkSession
    tree = parents.select("run_id", F.coalesce("parent_id", "run_id").alias("root"))
    for _ in range(MAX_DOUBLINGS):
        up = tree.select(F.col("run_id").alias("_at"), F.col("root").alias("_next"))
        stepped = tree.join(up, F.col("root") == F.col("_at"), "left").select(
            "run_id", F.coalesce("_next", "root").alias("root"), (F.coalesce("_next", "root") != F.col("root")).alias("_moved"))
        path = scratch_path(spark, "roots")
        stepped.write.parquet(path)
        stepped = spark.read.parquet(path)
        tree = stepped.select("run_id", "root")
        if stepped.filter("_moved").isEmpty():
            return tree
    raise ValueError("the runs' parents form a cycle")


def workflow_totals(jobs: DataFrame, parents: DataFrame) -> DataFrame:
    """Status counts per call over a run and all its sub-workflows.

    ``parents`` has (run_id, parent_id). Counts are made per run first, so only small rows follow
    the tree.
    """
    counts = status_counts(jobs)
    return (counts.join(tree_roots(parents), "run_id").groupBy("root", "call_name", "status").agg(F.sum("n").alias("n")))


def deepest_message(failure: Column) -> Column:
    """Message at the end of the chain of first causes of a failure, a JSON text of any depth."""
    steps = F.sequence(F.lit(1), F.greatest(F.regexp_count(failure, F.lit('"causedBy"')), F.lit(1)))
    leaf = F.aggregate(steps, F.parse_json(failure),
                       lambda at, _: F.coalesce(F.try_variant_get(at, "$.causedBy[0]", "variant"), at))
    return F.try_variant_get(leaf, "$.message", "string")


def workflow_failures(jobs: DataFrame) -> DataFrame:
    """Deepest message along the first causes of every failure of the jobs whose last attempt failed.

    ``failures`` is an array of JSON texts ``{"message": ..., "causedBy": [...]}``.
    """
    failed = latest_attempts(jobs).filter(F.col("status") == "Failed").withColumn("_f", F.explode("failures"))
    return failed.select("run_id", "call_name", "shard", "attempt", deepest_message(F.col("_f")).alias("message"))


def recent_runs(jobs: DataFrame, n: int = 10) -> DataFrame:
    """The last n log rows."""
    return jobs.orderBy(F.col("start_ts").desc(), F.col("event_id").desc()).limit(n)
