"""Genomic-control lambdas and the data behind QQ, Manhattan and frequency plots."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sumweave.functions.numeric import chi2_quantile_1df, z_from_p
from sumweave.session import shared_dir

QUANTILES = (0.7, 0.5, 0.1, 0.01, 0.001)


def global_rank(df: DataFrame, group: str, value: str, ties: Sequence[str]) -> DataFrame:
    """Add ``rank`` (1..n by ``value`` within ``group``, ties broken by ``ties``) and ``n``.

    No window over a whole group: rows are range-partitioned and sorted by (group, value, ties),
    numbered inside their partition, and shifted by the row counts of the partitions before. The
    tie columns take part in the ranges, so one value that fills a third of the rows still spreads
    over many partitions. The sorted rows are checkpointed, which fixes the partition boundaries
    between the two uses and lets the job survive lost executors.
    """
    shared_dir(df.sparkSession)
    order = [group, value, *ties]
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_id", F.monotonically_increasing_id())
              .checkpoint())
    # The id is the partition number shifted by 33 bits, plus the row number.
    part = F.shiftright("_id", 33)
    counts = ranged.groupBy(group, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    # One row per (partition, group): as many as there are partitions, whatever the data's size.
    w = Window.partitionBy(group)
    offsets = counts.select(
        group, "_part", "_first", F.sum("_n").over(w).alias("n"),
        (F.sum("_n").over(w.orderBy("_part")) - F.col("_n")).alias("_before"))
    joined = ranged.withColumn("_part", part).join(F.broadcast(offsets), [group, "_part"])
    return joined.select(*df.columns, (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("rank"), "n")


#: Bins per halving of p, in which order statistics are looked for.
BINS = 256


def lambda_gc(long: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Observed over expected chi-square per p-value column and quantile, three decimals.

    The quantile is interpolated between order statistics. Chi-square falls as p rises, so these are
    picked by p, from the largest down, without sorting the rows: counts per bin of -log p tell
    which few bins hold the wanted places, and only the distinct values of those are put in order.
    """
    rows = long.filter(F.col("pval").isNotNull()).select("p_col", "pval").withColumn(
        "_bin", F.when(F.col("pval") > 0, F.floor(-F.log2("pval") * BINS)).otherwise(1 << 20))
    # One row per column and bin, whatever the number of rows.
    bins = rows.groupBy("p_col", "_bin").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy("p_col")
    bins = bins.select("p_col", "_bin", F.sum("_n").over(whole).alias("n"), F.col("_n"),
                       (F.sum("_n").over(whole.orderBy("_bin")) - F.col("_n")).alias("_before"))
    wanted = F.explode(F.array(*[F.struct(F.lit(q).alias("quantile"), F.lit(chi2_quantile_1df(q)).alias("expected"))
                                 for q in quantiles]))
    h = (F.col("n") - 1) * F.col("_q.quantile")
    low = F.floor(h)

    def holds(place, first, size):
        return (place >= first) & (place < first + size)

    wanted = bins.select("*", wanted.alias("_q")).filter(
        holds(low, F.col("_before"), F.col("_n")) | holds(low + 1, F.col("_before"), F.col("_n"))).drop("_n")
    # Two bins per column and quantile at most.
    values = rows.join(F.broadcast(wanted.select("p_col", "_bin").distinct()), ["p_col", "_bin"]).groupBy(
        "p_col", "_bin", "pval").agg(F.count("*").alias("_size"))
    down = Window.partitionBy("p_col", "_bin").orderBy(F.desc("pval"))
    values = values.withColumn("_from", F.sum("_size").over(down) - F.col("_size"))
    first = F.col("_before") + F.col("_from")
    picked = values.join(F.broadcast(wanted), ["p_col", "_bin"]).filter(
        holds(low, first, F.col("_size")) | holds(low + 1, first, F.col("_size")))
    chi2 = F.pow(z_from_p(F.col("pval")), F.lit(2.0))
    ends = (picked.withColumn("_chi2", chi2).withColumn("_first", first)
            .groupBy("p_col", F.col("_q.quantile").alias("quantile"), F.col("_q.expected").alias("_expected"), (h - low).alias("_weight"))
            .agg(F.max(F.when(holds(low, F.col("_first"), F.col("_size")), F.col("_chi2"))).alias("_low"),
                 F.max(F.when(holds(low + 1, F.col("_first"), F.col("_size")), F.col("_chi2"))).alias("_high")))
    return ends.select("p_col", "quantile", F.round(
        (F.col("_low") + F.when(F.col("_weight") > 0, F.col("_weight") * (F.col("_high") - F.col("_low"))).otherwise(0.0))
        / F.col("_expected"), 3).alias("lambda"))


def lambda_text(lambdas: DataFrame) -> DataFrame:
    """One line per p-value column: ``quantile:lambda`` separated by blanks."""
    item = F.concat_ws(":", F.col("quantile").cast("string"), F.col("lambda").cast("string"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("quantile")).alias("_at"), item.alias("item"))))
    return lambdas.groupBy("p_col").agg(F.concat_ws(" ", listed["item"]).alias("text"))


def qq_points(long: DataFrame, ties: Sequence[str] = ("chr", "pos")) -> DataFrame:
    """Expected and observed -log10 p of every point with 0 < p < 1.

    Expected quantiles are (i - a) / (n + 1 - 2a), a = 3/8 up to ten points and 1/2 beyond.
    """
    usable = long.filter((F.col("pval") > 0) & (F.col("pval") < 1))
    ranked = global_rank(usable, "p_col", "pval", ties)
    a = F.when(F.col("n") <= 10, 0.375).otherwise(0.5)
    expected = (F.col("rank") - a) / (F.col("n") + 1 - 2 * a)
    return ranked.select("p_col", *ties, "rank", (-F.log10(expected)).alias("expected"),
                         (-F.log10("pval")).alias("observed"))


#: Bins per factor of ten of p for a thinned QQ plot, and points of the tail that are all kept.
THIN_BINS, TAIL = 100, 1000


def qq_thinned(long: DataFrame, bins: int = THIN_BINS, tail: int = TAIL, ties: Sequence[str] = ("chr", "pos")) -> DataFrame:
    """(p_col, rank, expected, observed): the points of a QQ plot that can be told apart, without sorting the rows.

    Counts per bin of -log10 p add up to exact ranks at the bins' edges. The bins of the smallest
    p-values that hold at most ``tail`` points together give every point, with its exact rank; every
    other bin gives its last one, the largest p. A column has at most ``tail`` points and one per bin.
    """
    rows = long.filter((F.col("pval") > 0) & (F.col("pval") < 1)).withColumn(
        "_bin", F.floor(-F.log10("pval") * bins + 1e-9).cast("int"))
    counts = rows.groupBy("p_col", "_bin").agg(F.count("*").alias("_n"), F.max("pval").alias("_last"))
    # One row per column and bin: the order of the bins is that of falling -log10 p.
    down = Window.partitionBy("p_col").orderBy(F.desc("_bin"))
    counts = counts.select("p_col", "_bin", "_last", F.sum("_n").over(down).alias("_upto"),
                           F.sum("_n").over(Window.partitionBy("p_col")).alias("n"))
    inside = counts.filter(F.col("_upto") <= tail).select("p_col", "_bin", "n")
    order = Window.partitionBy("p_col").orderBy("pval", *ties)
    detail = rows.join(inside, ["p_col", "_bin"]).select(
        "p_col", F.row_number().over(order).cast("bigint").alias("rank"), "pval", "n")
    edges = counts.filter(F.col("_upto") > tail).select("p_col", F.col("_upto").alias("rank"), F.col("_last").alias("pval"), "n")
    a = F.when(F.col("n") <= 10, 0.375).otherwise(0.5)
    return detail.unionByName(edges).select(
        "p_col", "rank", (-F.log10((F.col("rank") - a) / (F.col("n") + 1 - 2 * a))).alias("expected"), (-F.log10("pval")).alias("observed"))


def manhattan(long: DataFrame, loglog: float = 10.0, p_max: float = 0.01) -> DataFrame:
    """Manhattan points with p below ``p_max``, placed along the genome, plain and log-log.

    ``chr`` must be numeric. A chromosome starts where the one before ends, at its largest position
    among the plotted points: a sum over one row per chromosome and column, which every task gets.
    """
    points = long.filter((F.col("pval") < p_max) & (F.col("pval") > 0) & F.col("chr").isNotNull())
    ends = points.groupBy("p_col", "chr").agg(F.max("pos").alias("_end"))
    w = Window.partitionBy("p_col").orderBy("chr").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("p_col", "chr", F.coalesce(F.sum("_end").over(w), F.lit(0)).alias("_start"))
    logs = -F.log10("pval")
    scaled = F.when(logs < loglog, logs).otherwise(loglog * F.log10(logs) / math.log10(loglog))
    return (points.join(F.broadcast(starts), ["p_col", "chr"])
            .select("p_col", "chr", "pos", "pval", (F.col("pos") + F.col("_start")).alias("place"),
                    logs.alias("log10p"), scaled.alias("loglog10p"))
            .withColumn("p_scaled", F.pow(F.lit(10.0), -F.col("loglog10p"))))


def af_density(df: DataFrame, af: str = "af_alt", ref_af: str = "af_gnomad", bins: int = 100) -> DataFrame:
    """Study against reference frequency, counted in square cells."""
    cell = lambda c: F.floor(F.col(c) * bins).cast("bigint")
    return (df.filter(F.col(af).isNotNull() & F.col(ref_af).isNotNull())
            .groupBy(cell(af).alias("af_bin"), cell(ref_af).alias("ref_bin")).agg(F.count("*").alias("n")))
