"""Scans of delimited study, site, list and chain files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sumweave.functions.values import chrom_code, plot_chrom, to_position
from sumweave.sources import blockgzip

# Header of a sites file.
SITES_HEADER = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file_order) of every line: plain text, gzip by extension, or block-gzip where the path ends in ``.bgz``.

    ``file_order`` is (file name, block start, row number): it increases along each file however its blocks are
    scheduled, and over the part files of a folder by their names.
    """
    if path.endswith(".bgz"):
        name = F.substring_index("file", "/", -1)
        return blockgzip.scan_lines(spark, path).select("value", F.struct(name.alias("file"), "block", "row").alias("file_order"))
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select("value", place.alias("file_order"))


def read_header(spark: SparkSession, path: str, sep: str = r"\s+", skip: str = "##") -> list[str]:
    """The first line that is not a comment, split into names. Only the file's beginning is read."""
    if path.endswith(".bgz"):
        line = blockgzip.first_line(spark, path, skip)
    else:
        row = spark.read.text(path).filter(~F.col("value").startswith(skip)).first()
        line = row["value"] if row else None
    if line is None:
        raise ValueError(f"{path} is empty")
    return re.split(sep, line.strip() if sep == r"\s+" else line)


def scan_study(spark: SparkSession, path: str, columns: dict[str, str] | Sequence[tuple[str, str]] | None = None,
               tab_only: bool = True, count_fields: bool = False) -> DataFrame:
    """Study rows as text columns named by the header, plus ``file_order``.

    Plain, ``.gz`` or ``.bgz`` text. Block-gzip is read in parallel (see :mod:`sumweave.sources.blockgzip`);
    plain gzip is not splittable: convert it to Parquet once (:func:`sumweave.sources.sinks.write_indexed`)
    and read that. Fields are cut at tabs, or with
    ``tab_only=False`` at any run of blanks; quotes are ordinary characters. ``columns`` gives (header
    name, new name) pairs and selects only them, one header as often as it has roles; a missing name
    raises before any job runs on the data. A line of too few fields has NULLs; ``count_fields`` adds
    ``n_fields``, the true number of each line, for the check that a file is square.
    """
    sep = "\t" if tab_only else r"\s+"
    header = read_header(spark, path, sep)
    lines = read_lines(spark, path).select((F.col("value") if tab_only else F.trim("value")).alias("_line"), "file_order")
    fields = lines.filter(F.col("_line") != F.lit("")).select("file_order", F.split("_line", sep).alias("_f"))
    # The header line may sit in any split: it is the one whose fields are the names.
    body = fields.filter(F.col("_f") != F.array(*[F.lit(n) for n in header]))
    pairs = [(n, n) for n in header] if columns is None else list(columns.items() if isinstance(columns, dict) else columns)
    missing = [c for c, _ in pairs if c not in header]
    if missing:
        raise ValueError(f"{path} lacks column(s) {', '.join(missing)}")
    field = lambda name: F.nullif(F.get("_f", F.lit(header.index(name))), F.lit(""))
    extra = [F.size("_f").alias("n_fields")] if count_fields else []
    # Generated, not projected: filters on fields would be pushed below a projection, where each of their conditions
    # cuts the line again.
    return body.select("file_order", F.inline(F.array(F.struct(*[field(c).alias(new) for c, new in pairs], *extra)))).select(
        *[F.col(f"`{new}`") for _, new in pairs], *[c for c in ["n_fields"] if count_fields], "file_order")


def scan_sites(spark: SparkSession, path: str) -> DataFrame:
    """A sites file: ``##`` lines are skipped and the eight-column header is required.

    ``chrom`` is as written, ``chr`` its number (NULL for other sequences), so the result can be
    given to :func:`sumweave.operators.annotate.add_rsids`.
    """
    found = spark.read.text(path).filter(F.col("value").startswith("#") & ~F.col("value").startswith("##")).first()
    header = found["value"].split("\t") if found else None
    if header != SITES_HEADER:
        raise ValueError(f"unexpected header in {path}: {header}")
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    lines = spark.read.text(path).select("value", place.alias("seq")).filter(~F.col("value").startswith("#"))
    f = F.split("value", "\t")
    return lines.select(f[0].alias("chrom"), chrom_code(f[0]).alias("chr"), f[1].cast("bigint").alias("pos"), f[2].alias("id"), f[3].alias("ref"),
                        f[4].alias("alt_list"), "seq")


def scan_reference(spark: SparkSession, path: str) -> DataFrame:
    """The reference panel, one table partitioned by ``pop``: a join on pop prunes partitions."""
    return spark.read.parquet(path)


def scan_manifest(spark: SparkSession, path: str, names: Sequence[str], sep: str = "\t") -> DataFrame:
    """A headerless list with the given columns; lines starting with # are skipped."""
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.schema(schema).csv(path, sep=sep, comment="#")


def scan_shortlist(spark: SparkSession, path: str) -> DataFrame:
    """Blank-separated variants, fields 2 to 5 being chr, pos, ref and alt."""
    f = F.split("value", " ")
    return spark.read.text(path).select(F.concat_ws(":", f[1], f[2], f[3], f[4]).alias("snp"))


def scan_chain(spark: SparkSession, path: str) -> DataFrame:
    """Aligned blocks of a chain file, in forward coordinates of both builds.

    Chains are parted by blank lines, so each is one record of a splittable scan. A block line holds
    its size and the gaps to the next one: its place is the running sum of the lines before it in
    its chain. Chains are spread over the tasks; the largest one, some hundred thousand short lines,
    is the most that one task orders. A block line that follows no chain's header fails the job.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
    # Line ends of Windows would hide the blank lines; chains that no blank line parts share a record.
    records = spark.read.option("lineSep", "\n\n").text(path).select(place.alias("record"), F.split("value", r"\r?\n").alias("lines"))
    lines = records.select("record", F.posexplode("lines").alias("at", "line")).withColumn("line", F.trim("line")).filter(
        (F.col("line") != "") & ~F.col("line").startswith("#"))
    lines = lines.withColumn("_f", F.split("line", r"\s+")).withColumn("_head", F.col("line").startswith("chain"))
    along = Window.partitionBy("record").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tagged = lines.select("*", F.sum(F.col("_head").cast("int")).over(along).alias("_number"),
                          F.last(F.when(F.col("_head"), F.col("_f")), ignorenulls=True).over(along).alias("_chain"))
    gap = lambda i: F.coalesce(F.get("_f", F.lit(i)).cast("bigint"), F.lit(0))
    orphan = F.raise_error(F.concat(F.lit("chain file: no header before "), F.col("line"))).cast("array<string>")
    body = tagged.filter(~F.col("_head")).select(
        "record", "_number", F.coalesce("_chain", orphan).alias("_chain"), "at", gap(0).alias("size"), gap(1).alias("dt"), gap(2).alias("dq"))
    before = Window.partitionBy("record", "_number").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    t = F.coalesce(F.sum(F.col("size") + F.col("dt")).over(before), F.lit(0))
    q = F.coalesce(F.sum(F.col("size") + F.col("dq")).over(before), F.lit(0))
    c = F.col("_chain")
    src = c[5].cast("bigint") + t
    dst = c[10].cast("bigint") + q
    forward = F.when(c[9] == "-", c[8].cast("bigint") - dst - F.col("size")).otherwise(dst)
    return body.select(plot_chrom(c[2]).alias("chr"), src.alias("src_start"), (src + F.col("size")).alias("src_end"),
                       plot_chrom(c[7]).alias("dst_chr"), forward.alias("dst_start"), c[9].alias("strand"))


def scan_positions(spark: SparkSession, path: str) -> DataFrame:
    """(chr, pos) of a position list: blank-separated chromosome and position, or ``chr:pos``; # starts a comment."""
    f = F.split(F.trim("value"), r"[\s:]+")
    lines = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return lines.select(plot_chrom(f[0]).alias("chr"), to_position(F.get(f, F.lit(1))).alias("pos"))


def scan_build_map(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(build, chr, pos) of one position list per build, as :func:`sumweave.operators.build.detect_build` takes them."""
    lists = [scan_positions(spark, path).select(F.lit(name).alias("build"), "chr", "pos") for name, path in paths.items()]
    return reduce(DataFrame.unionByName, lists)


def scan_result(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Named columns of a stored result; Parquet reads no others."""
    return spark.read.parquet(path).select(*[F.col(f"`{c}`") for c in columns])
