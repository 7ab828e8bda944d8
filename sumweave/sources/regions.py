"""Region look-up in a stored table: a zone map names the files, and only those are opened."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Positions of a region that meet the rows of one bin.
BIN = 65536


def zone_path(path: str) -> str:
    return path.rstrip("/") + ".zones"


def write_zones(spark: SparkSession, path: str, by: Sequence[str] = ("chr",), place: str = "pos") -> None:
    """The zone map of a stored table: file, its ``by`` values, least and greatest position, rows. Only the position column is read."""
    stored = spark.read.parquet(path)
    (stored.groupBy(F.col("_metadata.file_path").alias("file"), *by)
     .agg(F.min(place).alias("least"), F.max(place).alias("greatest"), F.count("*").alias("n_rows"))
     .coalesce(1).write.mode("overwrite").parquet(zone_path(path)))


def named_files(spark: SparkSession, path: str, regions: DataFrame, chrom: str = "chr") -> list[str]:
    """The files of the table whose zone meets a region. One row per file is looked at, not the table."""
    zones = spark.read.parquet(zone_path(path))
    spans = regions.select(F.col("chr").alias(chrom), "start", "end")
    met = zones.join(spans, (zones[chrom] == spans[chrom]) & (zones["least"] <= spans["end"]) & (zones["greatest"] >= spans["start"]), "left_semi")
    return sorted(unquote(r["file"]) for r in met.select("file").distinct().collect())


def scan_regions(spark: SparkSession, path: str, regions: DataFrame, chrom: str = "chr", place: str = "pos") -> DataFrame:
    """The rows of a table stored by :func:`sumweave.sources.sinks.write_indexed` that lie in some region.

    ``regions`` has chr, start and end, both ends inside; a position list has start = end. Files whose
    zone meets no region are not opened. A row comes once, however many regions hold it.
    """
    files = named_files(spark, path, regions, chrom)
    stored = spark.read.parquet(path)
    if not files:
        return stored.limit(0)
    rows = spark.read.schema(stored.schema).option("basePath", path).parquet(*files)
    spans = regions.select(F.col("chr").alias("_chr"), F.col("start").alias("_start"), F.col("end").alias("_end"), F.explode(
        F.sequence(F.expr(f"start div {BIN}"), F.expr(f"end div {BIN}"))).alias("_bin"))
    return rows.join(spans, (F.col(chrom) == F.col("_chr")) & (F.expr(f"{place} div {BIN}") == F.col("_bin"))
                     & F.col(place).between(F.col("_start"), F.col("_end")), "left_semi")


def as_points(positions: DataFrame) -> DataFrame:
    """A position list (chr, pos) as regions."""
    return positions.select("chr", F.col("pos").alias("start"), F.col("pos").alias("end"))
