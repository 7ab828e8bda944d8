"""Genome build of each study, from chromosome 21 positions known in one build or the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def detect_build(df: DataFrame, maps: DataFrame, by: str = "study_ord", strict: bool = False,
                 studies: DataFrame | None = None) -> DataFrame:
    """Per study: rows at positions of each build map, and the build with more of them.

    Ties go to b38. A study without any hit, be it that it has no chromosome 21, has no build;
    ``strict`` fails the job for it. The maps are reduced to one row per position, so the join
    cannot multiply rows, and only (study, chr, pos) is read from the studies. Where ``df`` holds the
    mapped regions only (:func:`sumweave.sources.regions.scan_regions`), ``studies`` names them all.
    """
    sites = maps.filter(F.col("chr") == 21).groupBy("pos").agg(
        F.max((F.col("build") == "b37").cast("bigint")).alias("in37"),
        F.max((F.col("build") == "b38").cast("bigint")).alias("in38"))
    # Rows are counted before the join, on the map side. Those of other chromosomes become one
    # row per study without a position, so that no study is lost.
    places = (df.groupBy(by, F.when(F.col("chr") == 21, F.col("pos")).alias("pos"))
              .agg(F.count("*").alias("n")))
    if studies is not None:
        places = places.unionByName(studies.select(by, F.lit(None).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("n")))
    hits = places.join(sites, "pos", "left").groupBy(by).agg(
        F.coalesce(F.sum(F.col("n") * F.col("in37")), F.lit(0)).alias("n_b37"),
        F.coalesce(F.sum(F.col("n") * F.col("in38")), F.lit(0)).alias("n_b38"))
    none = (F.col("n_b37") == 0) & (F.col("n_b38") == 0)
    missing = F.raise_error(F.concat(F.lit("study "), F.col(by).cast("string"), F.lit(" has no row at a known position"))
                            ).cast("string") if strict else F.lit(None).cast("string")
    build = F.when(none, missing).when(F.col("n_b37") > F.col("n_b38"), "b37").otherwise("b38")
    return hits.withColumn("build", build)
