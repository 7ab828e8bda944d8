"""Row-level quality filters and the per-study report on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sumweave.functions.alleles import is_acgt, is_placeholder
from sumweave.functions.values import NUMERIC_CHROM, normalize_chrom, to_position


def rename_cols(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Configured names to canonical ones; the match is on the whole name."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the table: {', '.join(missing)}")
    return df.withColumnsRenamed(columns)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def quality_condition(df: DataFrame, min_af: float = 0.001, min_info: float = 0.6, info: str = "info",
                      skip: Sequence[str] = (), na_per_field: bool = False) -> Column:
    """True for rows that pass, over a table with canonical names and chr as delivered.

    The chromosome is tested before it is normalised: a filter on a computed column would be
    pushed below the projection and work the name out once per condition.
    No field may be empty, and the line may not contain NA: by default anywhere in the text of
    the row, or with ``na_per_field`` as a whole field. Only text columns can hold either.
    """
    fields = [f for f in df.schema.fields if f.name not in skip]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    number = lambda name: F.col(name).try_cast("double")
    # A text that is not empty is not null either; the shorter the condition, the sooner its code gets compiled.
    present = _all([F.col(f.name) != "" if f.name in texts else F.col(f.name).isNotNull() for f in fields])
    if na_per_field:
        no_na = _all([F.col(t) != "NA" for t in texts])
    else:
        no_na = ~F.concat_ws("\t", *texts).contains("NA")
    return (present & no_na & F.col("chr").rlike(NUMERIC_CHROM) & (number("pval") > 0)
            & (number("beta") > -1e6) & (number("beta") < 1e6)
            & (number("af_alt") >= min_af) & (1 - number("af_alt") >= min_af) & (number(info) >= min_info))


def qc_filter(df: DataFrame, columns: dict[str, str], min_af: float = 0.001, min_info: float = 0.6,
              info: str = "info", skip: Sequence[str] = (), na_per_field: bool = False) -> DataFrame:
    """Rename, normalise chromosome and position, and keep the rows that pass every filter."""
    df = rename_cols(df, columns)
    # Generated, not projected: a filter that is pushed below works values out once per condition, in one method too large
    # to be compiled.
    df = df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    keep = quality_condition(df, min_af, min_info, info, skip, na_per_field)
    return (df.filter(keep).withColumn("chr", normalize_chrom(F.col("chr")))
            .withColumn("pos", to_position(F.col("pos"))))


def drop_placeholder_alleles(df: DataFrame) -> DataFrame:
    return df.filter(~is_placeholder(F.col("ref"), F.col("alt")))


def acgt_only(df: DataFrame) -> DataFrame:
    return df.filter(is_acgt(F.col("ref")) & is_acgt(F.col("alt")))


def one_chrom(df: DataFrame, chrom: int) -> DataFrame:
    return df.filter(F.col("chr") == chrom)


def sort_variants(df: DataFrame, *ties: str) -> DataFrame:
    """Global sort by position: a range-partitioned sort, so every task holds one stretch."""
    return df.orderBy("chr", "pos", *ties)


def qc_report(df: DataFrame, columns: dict[str, str], n_fields: Column, by: str = "study_ord", **options) -> DataFrame:
    """Per study: rows before and after filtering, chromosomes left, and whether it is square.

    The flags, not the numbers, decide whether a study goes on: at least 22 chromosomes and one
    field count throughout.
    """
    df = rename_cols(df, columns)
    ok = quality_condition(df, **options)
    df = df.withColumn("_ok", ok)
    # Distinct counts go through one row per (study, chr, fields), which the map side builds.
    cells = (df.select(by, "_ok", F.when(F.col("_ok"), normalize_chrom(F.col("chr"))).alias("_chr"),
                       n_fields.alias("_fields"))
             .groupBy(by, "_chr", "_fields")
             .agg(F.count("*").alias("_n"), F.count_if("_ok").alias("_kept")))
    return (cells.groupBy(by)
            .agg(F.sum("_n").alias("n_before"), F.sum("_kept").alias("n_after"),
                 F.count_distinct("_chr").alias("n_chrom"), F.count_distinct("_fields").alias("n_field_counts"))
            .withColumn("enough_chroms", F.col("n_chrom") >= 22)
            .withColumn("is_square", F.col("n_field_counts") == 1))


def require_square(report: DataFrame) -> DataFrame:
    """Pass the report through; fail the job for a study that is not square or misses chromosomes."""
    problem = (F.when(~F.col("is_square"), "lines of the study differ in their number of fields")
               .when(~F.col("enough_chroms"), "the study has rows of fewer than 22 chromosomes"))
    checked = F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(F.col("n_after"))
    return report.withColumn("n_after", checked.cast("bigint"))
