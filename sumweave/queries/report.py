"""Genomic-control and plot-data queries."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumweave.functions import values
from sumweave.operators import annotate, qcdata
from sumweave.queries import fixtures as fx
from sumweave.queries.base import query, rnd, sql_rnd, sql_z
from sumweave.session import scratch_path


def p_table(spark, sf) -> DataFrame:
    """Two p-value columns over the quality-filtered rows; ``row`` makes every row distinct."""
    return fx.munged(spark, sf).select(
        "chr", "pos", F.col("pval").alias("all_p"),
        F.when(F.col("n") % 3 == 0, F.col("pval") * F.col("pval")).alias("lmso_p"), "file_order")


_P = "(SELECT chr, pos, pval AS all_p, CASE WHEN n % 3 = 0 THEN pval * pval END AS lmso_p, ford FROM munged)"
_LONG = f"""(SELECT chr, pos, 'all_p' AS p_col, all_p AS pval, ford FROM {_P} UNION ALL
    SELECT chr, pos, 'lmso_p', lmso_p, ford FROM {_P})"""


def long_table(spark, sf) -> DataFrame:
    return p_table(spark, sf).unpivot(["chr", "pos", "file_order"], ["all_p", "lmso_p"], "p_col", "pval")


@query("pval_long", f"SELECT chr, pos, p_col, pval FROM {_LONG}", ("munged",))
def pval_long(spark, sf):
    return annotate.pval_long(p_table(spark, sf), ["all_p", "lmso_p"])


# The expected quantiles, from the normal distribution.
_Q = ", ".join(f"({q}, {NormalDist().inv_cdf((1 + q) / 2) ** 2:.17e})" for q in (0.7, 0.5, 0.1, 0.01, 0.001))


@query("lambda_gc", f"""
    WITH x AS (SELECT p_col, {sql_z('pval')} AS z FROM {_LONG} WHERE pval IS NOT NULL),
    c AS (SELECT p_col, quantile_cont(z * z, [0.7, 0.5, 0.1, 0.01, 0.001]) AS v FROM x GROUP BY p_col),
    e AS (SELECT * FROM (VALUES {_Q}) t(quantile, expected)),
    i AS (SELECT p_col, unnest(v) AS v, unnest([0.7, 0.5, 0.1, 0.01, 0.001]) AS quantile FROM c)
    SELECT p_col, i.quantile::DOUBLE AS quantile, round(v / expected, 3) AS lambda FROM i JOIN e ON i.quantile = e.quantile""", ("munged",))
def lambda_gc(spark, sf):
    return qcdata.lambda_gc(long_table(spark, sf))


@query("lambda_text", f"""
    WITH x AS (SELECT p_col, {sql_z('pval')} AS z FROM {_LONG} WHERE pval IS NOT NULL),
    c AS (SELECT p_col, quantile_cont(z * z, [0.7, 0.5, 0.1, 0.01, 0.001]) AS v FROM x GROUP BY p_col),
    e AS (SELECT * FROM (VALUES {_Q}) t(quantile, expected)),
    i AS (SELECT p_col, unnest(v) AS v, unnest([0.7, 0.5, 0.1, 0.01, 0.001]) AS quantile FROM c)
    SELECT p_col, string_agg(i.quantile::DOUBLE || ':' || round(v / expected, 3), ' ' ORDER BY i.quantile DESC) AS text
    FROM i JOIN e ON i.quantile = e.quantile GROUP BY p_col""", ("munged",))
def lambda_text(spark, sf):
    # Written as one line per p-value column, and read back.
    path = scratch_path(spark, "lambda")
    qcdata.lambda_text(qcdata.lambda_gc(long_table(spark, sf))).write.partitionBy("p_col").text(path)
    return spark.read.text(path).select("p_col", F.col("value").alias("text"))


@query("plot_chrom", """
    SELECT chr_raw, CASE WHEN chr_raw LIKE '%MT' THEN 25 WHEN chr_raw LIKE '%X' THEN 23
      WHEN chr_raw LIKE '%Y' THEN 24 ELSE replace(chr_raw, 'chr', '')::INTEGER END AS chr, count(*) AS n FROM fx_sumstats GROUP BY ALL""", ("fx_sumstats",))
def plot_chrom(spark, sf):
    df = fx.sumstats(spark, sf).groupBy("chr_raw").agg(F.count("*").alias("n"))
    return df.select("chr_raw", values.plot_chrom(F.col("chr_raw")).alias("chr"), "n")


def _scientific(x: str, digits: int) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'NA' ELSE regexp_replace(format('{{:.{digits}e}}', {x}), '0+e', 'e') END"


@query("scientific", f"""
    SELECT l_orderkey, l_linenumber, pos, {_scientific('af_alt', 5)} AS af, {_scientific('-beta', 5)} AS beta, {_scientific('se / 7', 5)} AS se,
      {_scientific('pv', 3)} AS p FROM (SELECT *, TRY_CAST(pval_raw AS DOUBLE) / 9973 AS pv FROM fx_sumstats)""", ("fx_sumstats",))
def scientific(spark, sf):
    p = F.col("pval_raw").try_cast("double") / 9973
    shown = {"af": (F.col("af_alt"), 5), "beta": (-F.col("beta"), 5), "se": (F.col("se") / 7, 5), "p": (p, 3)}
    return fx.sumstats(spark, sf).select("l_orderkey", "l_linenumber", "pos", *[values.scientific(c, n).alias(k) for k, (c, n) in shown.items()])


@query("qq_points", f"""
    WITH x AS (SELECT *, row_number() OVER (PARTITION BY p_col ORDER BY pval, chr, pos, ford) AS rank, count(*) OVER (PARTITION BY p_col) AS n
      FROM {_LONG} WHERE pval > 0 AND pval < 1)
    SELECT p_col, chr, pos, rank, {sql_rnd('-log10((rank - 0.5) / n)')} AS expected, {sql_rnd('-log10(pval)')} AS observed FROM x""", ("munged",))
def qq_points(spark, sf):
    out = qcdata.qq_points(long_table(spark, sf), ties=("chr", "pos", "file_order"))
    return out.select("p_col", "chr", "pos", "rank", rnd("expected").alias("expected"), rnd("observed").alias("observed"))


@query("qq_thinned", f"""
    WITH x AS (SELECT *, floor(-log10(pval) * 100 + 1e-9) AS bin, row_number() OVER (PARTITION BY p_col ORDER BY pval, chr, pos, ford) AS rank,
        count(*) OVER (PARTITION BY p_col) AS n FROM {_LONG} WHERE pval > 0 AND pval < 1),
    b AS (SELECT *, max(rank) OVER (PARTITION BY p_col, bin) AS upto FROM x)
    SELECT p_col, rank, {sql_rnd('-log10((rank - 0.5) / n)')} AS expected, {sql_rnd('-log10(pval)')} AS observed
    FROM b WHERE upto <= 1000 OR rank = upto""", ("munged",))
def qq_thinned(spark, sf):
    out = qcdata.qq_thinned(long_table(spark, sf), ties=("chr", "pos", "file_order"))
    return out.select("p_col", "rank", rnd("expected").alias("expected"), rnd("observed").alias("observed"))


_LL = "CASE WHEN l < 3 THEN l ELSE 3 * log10(l) / log10(3) END"


@query("manhattan", f"""
    WITH x AS (SELECT *, -log10(pval) AS l FROM {_LONG} WHERE pval < 0.01 AND pval > 0),
    e AS (SELECT p_col, chr, max(pos) AS top FROM x GROUP BY 1, 2),
    s AS (SELECT p_col, chr, coalesce(sum(top) OVER (PARTITION BY p_col ORDER BY chr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM e)
    SELECT x.p_col, x.chr, pos, {sql_rnd('pval')} AS pval, pos + start AS place, {sql_rnd('l')} AS log10p, {sql_rnd(_LL)} AS loglog10p,
      {sql_rnd(f'pow(10, -({_LL}))')} AS p_scaled FROM x JOIN s ON x.p_col = s.p_col AND x.chr = s.chr""", ("munged",))
def manhattan(spark, sf):
    out = qcdata.manhattan(long_table(spark, sf), loglog=3.0)
    return out.select("p_col", "chr", "pos", rnd("pval").alias("pval"), "place", rnd("log10p").alias("log10p"),
                      rnd("loglog10p").alias("loglog10p"), rnd("p_scaled").alias("p_scaled"))
