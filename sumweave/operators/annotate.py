"""Annotation, selection and filtering of result tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sumweave.functions.alleles import variant_id


def add_rsids(df: DataFrame, sites: DataFrame, order: str = "seq") -> DataFrame:
    """Add ``rsid`` from a site list: same position and ref, alt in the comma list, else NA.

    The first site in file order wins. Sites are reduced to one id per variant before the join, which
    merges: Spark takes the reduced list for as small as the columns it is made of and would broadcast it.
    """
    listed = sites.select("chr", "pos", "ref", F.explode(F.split("alt_list", ",")).alias("alt"), "id",
                          F.col(order).alias("_at"))
    ids = listed.groupBy("chr", "pos", "ref", "alt").agg(F.min_by("id", "_at").alias("_id"))
    joined = df.join(ids.hint("merge"), ["chr", "pos", "ref", "alt"], "left")
    return joined.select(*df.columns, F.coalesce("_id", F.lit("NA")).alias("rsid"))


def shortlist(df: DataFrame, names: DataFrame) -> DataFrame:
    """Rows whose ``snp`` is on the list."""
    return df.join(names.select("snp"), "snp", "left_semi")


def significant_hits(df: DataFrame, p: str, threshold: float) -> DataFrame:
    return df.filter(F.col(p) < threshold)


def post_filter(df: DataFrame, min_studies: int = 2) -> DataFrame:
    """Variants seen in enough studies, with key, rsid and the overall and leave-most-out results."""
    chosen = [c for c in df.columns if re.match(r"(all_|lmso_)", c) and re.search(r"_meta_|_het_", c)]
    kept = df.filter(F.col("all_meta_Nstudies") >= min_studies)
    return kept.select("#CHR", "POS", "REF", "ALT", "SNP", F.col("rsid").alias("RSID"), *chosen)


def filter_cols(df: DataFrame) -> DataFrame:
    """The first five columns, every ``all_`` column but the sample N, and the rsid."""
    rest = [c for c in df.columns[5:]
            if (c.startswith("all_") and c != "all_meta_sample_N") or c.startswith("rsid")]
    return df.select(*df.columns[:5], *rest)


def neff_floor(df: DataFrame, neff: str, chr_col: str = "chr", autosome: int | None = None) -> DataFrame:
    """Rows with at least two thirds of the largest effective size of their class.

    Chromosome 23 is one class, the rest the other; ``autosome`` takes the rest's maximum from one
    chromosome only. The maxima are two rows, joined by class.
    """
    is_x = (F.col(chr_col) == 23).alias("_x")
    counted = df if autosome is None else df.filter((F.col(chr_col) == autosome) | (F.col(chr_col) == 23))
    floors = counted.groupBy(is_x).agg(F.floor(F.max(neff) * 2 / 3).alias("_floor"))
    joined = df.withColumn("_x", is_x).join(F.broadcast(floors), "_x")
    return joined.filter(F.col(neff) >= F.col("_floor")).select(*df.columns)


def sample_af(members: str | Column, n: str = "n", af: str = "af_alt") -> dict[str, Column]:
    """Sample N and N-weighted frequency over an array of studies.

    Frequencies of exactly 0.5 stand for unknown: they count for N, not for the mean.
    """
    rows = F.filter(members, lambda m: m[af].isNotNull())
    real = F.filter(rows, lambda m: m[af] != 0.5)
    size = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda acc, m: acc + m[n])
    total = F.aggregate(real, F.lit(0.0), lambda acc, m: acc + m[af] * m[n])
    return {"all_meta_sample_N": size(rows), "all_meta_AF": F.try_divide(total, F.nullif(size(real), F.lit(0)))}


def pval_long(df: DataFrame, p_cols: Sequence[str], chr_col: str = "chr", pos_col: str = "pos") -> DataFrame:
    """All p-value columns in one pass, as (chr, pos, p_col, pval)."""
    return df.unpivot([chr_col, pos_col], list(p_cols), "p_col", "pval")


def combine(parts: Sequence[DataFrame]) -> DataFrame:
    """Per-chromosome results under one header."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_snp(df: DataFrame) -> DataFrame:
    return df.withColumn("snp", variant_id(F.col("chr"), F.col("pos"), F.col("ref"), F.col("alt")))
