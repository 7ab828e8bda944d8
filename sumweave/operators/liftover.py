"""Coordinate lifting between builds.

A position lies in an aligned block: a range join. Both sides are cut into bins of fixed width, a
block being listed in every bin it touches, so the join is an equi-join on (chr, bin) with the
range as a residual. Both sides are sorted, where adaptive execution splits a hot bin: the blocks are
not broadcast, as Spark's estimate, made before they are computed, may be far below their size.

The blocks of a chain must cover a source base at most once, so that a row finds one block at most
and needs no regrouping afterwards. Blocks that overlap share a bin, where the join's side of
blocks checks it and fails the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sumweave.functions.alleles import flip_effect, flip_frequency, strand_flip, variant_id
from sumweave.operators.sequence import reverse_strand

BIN_WIDTH = 65536


def overlapping_blocks(chain: DataFrame) -> DataFrame:
    """Blocks that start before an earlier block of their chromosome ends; empty for a sound chain."""
    before = Window.partitionBy("chr").orderBy("src_start", "src_end").rowsBetween(Window.unboundedPreceding, -1)
    return chain.withColumn("_end", F.max("src_end").over(before)).filter("src_start < _end").drop("_end")


def liftover(df: DataFrame, chain: DataFrame, ref_bases: DataFrame | None = None,
             recover_swapped: bool = True, windows: DataFrame | None = None) -> DataFrame:
    """Add ``new_chr, new_pos, new_ref, new_alt, swapped, lift_status`` to every row.

    ``chain`` has chr, src_start, src_end (0-based, half open), dst_chr, dst_start and strand, the
    destination in forward coordinates. ``ref_bases`` gives the target's base at (chr, pos): a
    reference allele that disagrees is rejected, unless the other allele agrees and
    ``recover_swapped`` is set; then the alleles swap. ``windows`` holds the target's sequence
    (:func:`sumweave.operators.sequence.windows_of`): with it, alleles of several bases on a reverse
    block are written anew for the other strand, indels anchored and left-aligned, and checked
    against the whole reference allele. The statuses: OK, NoTarget, CrossesBlock, ReverseStrandIndel
    (no sequence there), MismatchedRefAllele.
    """
    blocks = chain.select(
        F.col("chr").alias("_chr"), "src_start", "src_end", "dst_chr", "dst_start", "strand",
        F.explode(F.sequence(F.expr(f"src_start div {BIN_WIDTH}"),
                             F.expr(f"(src_end - 1) div {BIN_WIDTH}"))).alias("_bin"))
    before = Window.partitionBy("_chr", "_bin").orderBy("src_start", "src_end").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_end", F.max("src_end").over(before)).withColumn("src_start", F.when(
        F.col("src_start") < F.col("_end"), F.raise_error(F.lit("blocks of the chain overlap")).cast("bigint")
    ).otherwise(F.col("src_start"))).drop("_end")
    start = F.col("pos") - 1
    joined = df.withColumn("_pbin", F.expr(f"(pos - 1) div {BIN_WIDTH}")).join(
        blocks.hint("merge"), (F.col("chr") == F.col("_chr")) & (F.col("_pbin") == F.col("_bin"))
        & (start >= F.col("src_start")) & (start < F.col("src_end")), "left")

    span = F.greatest(F.length("ref"), F.length("alt"))
    single = (F.length("ref") == 1) & (F.length("alt") == 1)
    reverse = F.col("strand") == "-"
    width = F.col("src_end") - F.col("src_start")
    offset = start - F.col("src_start")
    lifted0 = F.when(reverse, F.col("dst_start") + width - 1 - offset).otherwise(F.col("dst_start") + offset)
    # Single bases need no reversal on the other strand, only the complement.
    lifted = joined.select(
        *df.columns, F.col("dst_chr").alias("new_chr"), (lifted0 + 1).alias("new_pos"),
        F.when(reverse, strand_flip(F.col("ref"))).otherwise(F.col("ref")).alias("new_ref"),
        F.when(reverse, strand_flip(F.col("alt"))).otherwise(F.col("alt")).alias("new_alt"),
        F.when(F.col("_chr").isNull(), "NoTarget")
        .when(start + span > F.col("src_end"), "CrossesBlock")
        .when(reverse & ~single, "ReverseStrandIndel")
        .otherwise("OK").alias("lift_status"))
    checked_here = F.lit(False)
    if windows is not None:
        turned = reverse_strand(lifted, windows, F.col("lift_status") == "ReverseStrandIndel")
        known, agrees_all = F.coalesce("rs_known", F.lit(False)), F.col("rs_match")
        value = lambda new, old: F.when(known, F.col(new)).otherwise(F.col(old)).alias(old)
        lifted = turned.select(
            *df.columns, "new_chr", value("rs_pos", "new_pos"), value("rs_ref", "new_ref"), value("rs_alt", "new_alt"), known.alias("_turned"),
            F.when(known & agrees_all, "OK").when(known, "MismatchedRefAllele").otherwise(F.col("lift_status")).alias("lift_status"))
        checked_here = F.col("_turned")
    if ref_bases is None:
        return _finish(lifted, df.columns, F.lit(False), F.col("lift_status"))
    bases = ref_bases.select(F.col("chr").alias("_bchr"), F.col("pos").alias("_bpos"), F.col("base").alias("_base"))
    checked = lifted.join(bases.hint("merge"), (F.col("new_chr") == F.col("_bchr")) & (F.col("new_pos") == F.col("_bpos")), "left")
    ok = (F.col("lift_status") == "OK") & ~checked_here
    agrees = F.substring("new_ref", 1, 1) == F.col("_base")
    swap = (ok & F.lit(recover_swapped) & (F.length("new_ref") == 1) & (F.length("new_alt") == 1)
            & ~F.coalesce(agrees, F.lit(False)) & F.coalesce(F.col("new_alt") == F.col("_base"), F.lit(False)))
    status = F.when(ok & ~F.coalesce(agrees, F.lit(False)) & ~swap, "MismatchedRefAllele").otherwise(F.col("lift_status"))
    return _finish(checked, df.columns, swap, status)


def _finish(df: DataFrame, columns: list[str], swap, status) -> DataFrame:
    """Swap recovered alleles and blank the target of rows that were not lifted."""
    out = df.select(*columns, "new_chr", "new_pos",
                    F.when(swap, F.col("new_alt")).otherwise(F.col("new_ref")).alias("new_ref"),
                    F.when(swap, F.col("new_ref")).otherwise(F.col("new_alt")).alias("new_alt"),
                    swap.alias("swapped"), status.alias("lift_status"))
    kept = F.col("lift_status") == "OK"
    return out.select(*columns, *[F.when(kept, F.col(c)).alias(c)
                                  for c in ("new_chr", "new_pos", "new_ref", "new_alt")],
                      (kept & F.col("swapped")).alias("swapped"), "lift_status")


def lift_rejects(lifted: DataFrame) -> DataFrame:
    return lifted.filter(F.col("lift_status") != "OK")


def rewrite_lifted(lifted: DataFrame) -> DataFrame:
    """Rows in the new build with their old place kept as ``b37_*``.

    Swapped alleles turn the effect and the frequency. Targets outside chromosomes 1..24 go.
    """
    columns = [c for c in lifted.columns
               if c not in ("new_chr", "new_pos", "new_ref", "new_alt", "swapped", "lift_status")]
    kept = lifted.filter((F.col("lift_status") == "OK") & F.col("new_chr").between(1, 24))
    values = {"chr": F.col("new_chr"), "pos": F.col("new_pos"), "ref": F.col("new_ref"), "alt": F.col("new_alt"),
              "af_alt": flip_frequency(F.col("swapped"), F.col("af_alt")),
              "beta": flip_effect(F.col("swapped"), F.col("beta"))}
    old = [F.col(c).alias(f"b37_{c}") for c in ("chr", "pos", "ref", "alt")]
    return kept.select(*[values.get(c, F.col(c)).alias(c) for c in columns], *old,
                       F.when(F.col("swapped"), "SwappedAlleles").otherwise("Lifted").alias("liftover_info"))


def mark_current_build(df: DataFrame) -> DataFrame:
    """The same columns for a study that is in the target build already."""
    none = F.lit(None)
    return df.filter(F.col("chr").between(1, 24)).select(
        *df.columns, none.cast("int").alias("b37_chr"), none.cast("bigint").alias("b37_pos"),
        none.cast("string").alias("b37_ref"), none.cast("string").alias("b37_alt"),
        F.lit("AlreadyB38").alias("liftover_info"))


def lift_apply(df: DataFrame, lifted_sites: DataFrame) -> DataFrame:
    """Bring coordinates lifted elsewhere to the study rows: an equi-join on the old variant.

    ``lifted_sites`` is one row per site: chr, pos, ref, alt as they were, the ``new_*`` columns
    and ``swapped``. It is made unique first, so study rows do not multiply.
    """
    sites = lifted_sites.select("chr", "pos", "ref", "alt", "new_chr", "new_pos", "new_ref", "new_alt", "swapped")
    joined = df.join(sites.dropDuplicates(["chr", "pos", "ref", "alt"]), ["chr", "pos", "ref", "alt"])
    return rewrite_lifted(joined.select(*df.columns, "new_chr", "new_pos", "new_ref", "new_alt", "swapped",
                                        F.lit("OK").alias("lift_status")))


def lift_back(df: DataFrame, chain: DataFrame) -> DataFrame:
    """Results in the other build: coordinates exchanged with ``anew_chr, anew_pos``, SNP rebuilt."""
    rest = [c for c in df.columns if c not in ("chr", "pos", "ref", "alt", "snp")]
    kept = liftover(df, chain).filter(F.col("lift_status") == "OK")
    return kept.select(
        F.col("new_chr").alias("chr"), F.col("new_pos").alias("pos"), "ref", "alt",
        variant_id(F.col("new_chr"), F.col("new_pos"), F.col("ref"), F.col("alt")).alias("snp"),
        *rest, F.col("chr").alias("anew_chr"), F.col("pos").alias("anew_pos"))


def bed_interval(df: DataFrame) -> DataFrame:
    """The half-open, 0-based interval of every variant, ``chrom, start, end``, as long as its longer allele; then its columns."""
    from sumweave.functions.values import chrom_label

    span = F.greatest(F.length("ref"), F.length("alt"))
    return df.select(chrom_label(F.col("chr")).alias("chrom"), (F.col("pos") - 1).alias("start"), (F.col("pos") + span - 1).alias("end"), *df.columns)


def export_sites(df: DataFrame) -> DataFrame:
    """The study's sites in VCF column order, ready for a text sink."""
    from sumweave.functions.values import chrom_label
    from sumweave.operators.qc import drop_placeholder_alleles

    label = chrom_label(F.col("chr"))
    dot = F.lit(".")
    return drop_placeholder_alleles(df).select(
        label.alias("CHROM"), F.col("pos").alias("POS"),
        variant_id(label, F.col("pos"), F.col("ref"), F.col("alt")).alias("ID"),
        F.col("ref").alias("REF"), F.col("alt").alias("ALT"),
        dot.alias("QUAL"), dot.alias("FILTER"), dot.alias("INFO"))
