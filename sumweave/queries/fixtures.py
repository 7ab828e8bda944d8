"""Study tables derived from the driver tables, defined in FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STUDY_ORDS = [0, 1, 2, 3, 4, 5]
ANCESTRIES = ["EUR", "FIN", "AFR", "EAS", "AMR", "SAS"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# Lookup lists for the raw study rows: chromosome name by (prefix, number), and the alleles by
# (variant class, orientation as base, swapped, complemented, both). One lookup per column keeps
# the generated code small when filters are pushed onto these columns.
NUMBERS = [str(c) for c in range(1, 23)] + ["X", "Y", "MT"]
CHROM_NAMES = [prefix + number for prefix in ("", "0", "chr") for number in NUMBERS]
BASES = [("A", "C"), ("A", "G"), ("C", "T"), ("A", "T"), ("A", "AT")]
COMPLEMENT = str.maketrans("ACGT", "TGCA")
SPELLINGS = [pair for ref, alt in BASES
             for pair in ((ref, alt), (alt, ref), (ref.translate(COMPLEMENT), alt.translate(COMPLEMENT)),
                          (alt.translate(COMPLEMENT), ref.translate(COMPLEMENT)))]


def base_alleles(v: Column) -> tuple[Column, Column]:
    return pick(v % 5, [ref for ref, _ in BASES]), pick(v % 5, [alt for _, alt in BASES])


def study(spark: SparkSession, sf: str) -> DataFrame:
    o = (F.col("s_suppkey") % 6).cast("int")
    return (table(spark, sf, "supplier").select(o.alias("study_ord")).distinct()
            .select("study_ord",
                    F.concat(F.lit("S"), F.col("study_ord").cast("string"), F.lit("_"),
                             pick(F.col("study_ord"), ANCESTRIES)).alias("study"),
                    (200 * (F.col("study_ord") + 1)).cast("bigint").alias("n_cases"),
                    (2000 * (F.col("study_ord") + 1) + 17).cast("bigint").alias("n_controls")))


def sumstats(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows: chromosome and p-value are text, alleles in four orientations."""
    v = F.col("l_partkey")
    name = pick(F.col("l_suppkey") % 3 * 25 + v % 25, CHROM_NAMES)
    spelling = v % 5 * 4 + F.col("l_orderkey") % 4
    n = (F.col("l_quantity") * 100).cast("bigint")
    beta, se = F.col("l_discount") - 0.05, F.col("l_tax") + 0.01
    return table(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 6).cast("int").alias("study_ord"),
        name.alias("chr_raw"), (v * 100).alias("pos"),
        pick(spelling, [ref for ref, _ in SPELLINGS]).alias("ref"),
        pick(spelling, [alt for _, alt in SPELLINGS]).alias("alt"),
        (F.col("l_linenumber") / 10).alias("af_alt"),
        (5 * F.col("l_discount") + 0.5).alias("info"),
        beta.alias("beta"), se.alias("se"),
        F.when(F.col("l_orderkey") % 97 == 0, "NA").otherwise(
            ((F.col("l_orderkey") * 7919 + F.col("l_linenumber")) % 9973).cast("string")).alias("pval_raw"),
        n.alias("n"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", n.alias("n"), beta.alias("beta"),
                 se.alias("se")).alias("file_order"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def munged(spark: SparkSession, sf: str) -> DataFrame:
    """Quality-filtered rows with a typed variant; the statistics as the meta stage reads them."""
    from sumweave.operators.qc import qc_filter

    clean = qc_filter(sumstats(spark, sf), {"chr_raw": "chr", "pval_raw": "pval"}, skip=["file_order"])
    return clean.select("study_ord", F.col("chr").cast("int").alias("chr"), "pos", "ref", "alt", "af_alt",
                        "info", "beta", "se", (F.col("pval").try_cast("double") / 9973).alias("pval"), "n",
                        "file_order")


def reference(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("p_partkey")
    ref, alt = base_alleles(v)
    alts = F.when(v % 5 == 0, F.array(alt, F.lit("G"))).otherwise(F.array(alt))
    return (table(spark, sf, "part")
            .withColumn("pop", F.explode(F.array(F.lit("nfe"), F.lit("fin"), F.lit("afr"))))
            .withColumn("alt", F.explode(alts))
            .select("pop", (v % 25 + 1).cast("int").alias("chr"), (v * 100).alias("pos"), ref.alias("ref"), "alt",
                    F.when(F.col("p_size") % 17 == 0, F.lit(None).cast("double"))
                    .otherwise((F.col("p_size") % 50) / 50).alias("af"),
                    F.when(v % 11 == 0, "AC0").otherwise("PASS").alias("filter_"),
                    (F.col("p_size") * 1000).cast("bigint").alias("an")))


def rsid(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("p_partkey")
    ref, alt = base_alleles(v)
    return table(spark, sf, "part").filter(v % 3 != 0).select(
        (v % 25 + 1).cast("int").alias("chr"), (v * 100).alias("pos"),
        F.concat(F.lit("rs"), v.cast("string")).alias("id"), ref.alias("ref"),
        F.concat(alt, F.when(v % 4 == 0, ",GG").otherwise("")).alias("alt_list"), v.alias("seq"))


def chain(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("p_partkey")
    return table(spark, sf, "part").filter(v % 19 != 0).select(
        (v % 25 + 1).cast("int").alias("chr"), (v * 100 - 40).alias("src_start"), (v * 100 + 40).alias("src_end"),
        (v % 25 + 1).cast("int").alias("dst_chr"), (v * 100 - 40 + 137 * (v % 7)).alias("dst_start"),
        F.when(v % 13 == 0, "-").otherwise("+").alias("strand"))


def build_map(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("p_partkey")
    return table(spark, sf, "part").filter((v % 25 == 20) & (v % 3 == 0)).select(
        F.when(v % 2 == 0, "b37").otherwise("b38").alias("build"), F.lit(21).alias("chr"), (v * 100).alias("pos"))


def files(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("s_suppkey")
    text = lambda c: c.cast("string")
    return table(spark, sf, "supplier").select(
        s.alias("seq"),
        F.concat(F.lit("gs://bucket"), text(F.col("s_nationkey")), F.lit("/COH"), text(s % 9), F.lit("_Sur_"),
                 pick(s % 4, ["WE", "WQ", "NE", "NQ"]), F.when(s % 8 < 4, "1.3").otherwise("2.3"),
                 F.lit("_F"), text(s % 3 + 1), F.lit("_ALL_ALL_"), pick(s % 5, ["EUR", "FIN", "SAS", "AFR", "ARB"]),
                 F.lit("_"), text(100 + s), F.lit("_"), text(1000 + s),
                 F.when(s % 2 == 0, "_REGENIE_2022").otherwise("_SAIGE_2022"),
                 F.when(s % 10 == 9, "XX").otherwise("04"), F.lit("11.txt.gz")).alias("uri"))


def dotted(spark: SparkSession, sf: str) -> DataFrame:
    """File names of the dot-separated form, some malformed in one field."""
    s = F.col("s_suppkey")
    text = lambda c: c.cast("string")
    cohort = pick(s % 11, ["UKBB", "23andMe", "FinnGen", "HOSTAGE", "Italy_HOSTAGE", "CCHC", "GENOMICC", "CHULA",
                           "Egypt_hgCOVID", "BQC19", "MVP"])
    return table(spark, sf, "supplier").select(
        s.alias("seq"),
        F.concat(F.lit("gs://up"), text(s % 4), F.lit("/"), cohort, F.lit(".Sur.ANA_"),
                 pick(s % 7, ["A1", "A2", "B1", "B2", "C1", "C2", "Z9"]), F.lit("_V2."),
                 F.when(s % 23 == 5, "five").otherwise("5"), F.lit("."),
                 F.when(s % 13 == 0, "gt_60").when(s % 13 == 1, "LT_60").otherwise("ALL"), F.lit("."),
                 F.when(s % 6 == 0, "F").when(s % 6 == 1, "Male").when(s % 29 == 3, "x").otherwise("ALL"), F.lit("."),
                 pick(s % 8, ["EUR", "FIN", "AFR", "EAS", "AMR", "HIS", "MID", "XXX"]), F.lit("."),
                 text(100 + s), F.lit("."), text(1000 + s), F.lit(".SAIGE.20220411"),
                 F.when(s % 17 == 4, ".extra").otherwise(""), F.lit(".txt.gz")).alias("uri"))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    return table(spark, sf, "events").select(
        (F.col("user_id") % 30).alias("run_id"), F.col("event_type").alias("call_name"),
        F.col("user_id").alias("shard"), F.row_number().over(w).alias("attempt"),
        F.when(F.col("event_id") % 7 == 0, "Failed").when(F.col("event_id") % 11 == 0, "Aborted")
        .when(F.col("event_id") % 13 == 0, "RetryableFailure").otherwise("Done").alias("status"),
        F.col("ts").alias("start_ts"), F.col("value").alias("dur_min"), "event_id")


def shortlist(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("p_partkey")
    ref, alt = base_alleles(v)
    return table(spark, sf, "part").filter(v % 10 == 0).select(
        F.concat_ws(":", (v % 25 + 1).cast("string"), (v * 100).cast("string"), ref, alt).alias("snp"))
