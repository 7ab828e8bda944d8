"""Best-match join of study variants to a reference allele-frequency panel.

Shuffles: the panel is grouped per (population, position, key) into its few candidate alleles;
study rows join that one-to-one, so they never multiply, and a hot position is a skewed join
partition that adaptive execution splits. The join is always a merge: Spark takes the grouped panel for
as small as the columns it is made of and would collect it in the driver. Duplicates are then resolved by an aggregation, whose
partial step works before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sumweave.functions.alleles import flip_effect, flip_frequency, is_reversed, reference_key

#: Stands for the fold change against a frequency of zero.
INFINITE_FOLD = 1e9


def usable_reference(ref: DataFrame, passing_only: bool = False, min_an: int = 0) -> DataFrame:
    if passing_only:
        ref = ref.filter(F.col("filter_") == "PASS")
    return ref.filter(F.col("an") >= min_an) if min_an > 0 else ref


def af_compare(af: Column, ref_af: Column) -> dict[str, Column]:
    """Fold change and absolute difference to the reference frequency; -1 where one is unknown."""
    fold = F.when(ref_af == 0, F.when(af.isNotNull(), F.lit(INFINITE_FOLD))).otherwise(F.try_divide(af, ref_af))
    return {"af_fc": fold, "af_abs_diff": F.coalesce(F.abs(af - ref_af), F.lit(-1.0))}


def _candidates(ref: DataFrame, pre_aligned: bool, order: str | None) -> DataFrame:
    """Per key, the panel's distinct alleles and frequencies in file order.

    Repeats of one entry collapse on the map side. What remains is the number of different
    frequencies the panel states for at most four spellings of one variant.
    """
    place = F.col(order) if order else F.lit(0)
    entries = ref.groupBy("pop", "chr", "pos", "ref", "alt", "af", "filter_").agg(F.min(place).alias("_at"))
    entry = F.struct("_at", "ref", "alt", "af", "filter_")
    return (entries.groupBy("pop", "chr", "pos", reference_key(F.col("ref"), F.col("alt"), pre_aligned).alias("_key"))
            .agg(F.sort_array(F.collect_list(entry)).alias("_cands")))


def _best(pre_aligned: bool) -> tuple[Column, Column]:
    """The spelling preferred on ties, and the candidate with the smallest frequency difference.

    Candidates with a frequency re-orient the row one after the other, so that on equal
    differences the one spelled like the last of them is preferred, else the first in file order.
    """
    def turned(c: Column) -> Column:
        if pre_aligned:
            return F.col("af_alt")
        return flip_frequency(is_reversed(F.col("ref"), F.col("alt"), c["ref"], c["alt"]), F.col("af_alt"))

    cands = F.col("_cands")
    own = F.concat_ws("|", F.col("ref"), F.col("alt"))
    if pre_aligned:
        current = own
    else:
        known = F.filter(cands, lambda c: c["af"].isNotNull())
        last = F.element_at(known, -1)
        current = F.when((F.size(known) > 0) & F.col("af_alt").isNotNull(),
                         F.concat_ws("|", last["ref"], last["alt"])).otherwise(own)

    def rank(c: Column, i: Column) -> Column:
        diff = F.coalesce(F.abs(turned(c) - c["af"]), F.lit(1.0))
        preferred = F.concat_ws("|", c["ref"], c["alt"]) == F.col("_current")
        return F.struct(diff.alias("diff"), F.when(preferred, 0).otherwise(1).alias("other"),
                        F.when(preferred, -i).otherwise(i).alias("at"), c.alias("c"))
    return current, F.array_min(F.transform(cands, rank))["c"]


#: What rows and candidates meet by, and what both are bucketed by when stored.
MEET = ["pop", "chr", "pos", "_key"]


def _store(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    (df.repartition(buckets, *MEET).write.mode("overwrite").option("path", path).bucketBy(buckets, *MEET).sortBy(*MEET).saveAsTable(table))
    return df.sparkSession.table(table)


def store_panel(ref: DataFrame, table: str, path: str, buckets: int, *, pre_aligned: bool = False, order: str | None = None,
                passing_only: bool = False, min_an: int = 0) -> DataFrame:
    """The panel's candidates, grouped and bucketed once: a join with them needs no exchange of the panel.

    Give the result as ``stored`` to :func:`harmonize`, with the same ``pre_aligned``. One bucket is one
    file, read and sorted by one task; choose as many as a study join should have tasks.
    """
    return _store(_candidates(usable_reference(ref, passing_only, min_an), pre_aligned, order), table, path, buckets)


def store_studies(df: DataFrame, table: str, path: str, buckets: int, *, pre_aligned: bool = False) -> DataFrame:
    """Study rows bucketed like the panel, with their key; joined to it, neither side is exchanged."""
    return _store(df.withColumn("_key", reference_key(F.col("ref"), F.col("alt"), pre_aligned)), table, path, buckets)


def match_reference(df: DataFrame, ref: DataFrame | None, *, pre_aligned: bool = False,
                    order: str | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Orient every row like its best reference match and attach af_gnomad and filt_gnomad.

    ``stored`` is a panel of :func:`store_panel` and takes the place of ``ref``.
    """
    candidates = _candidates(ref, pre_aligned, order) if stored is None else stored
    keyed = df if "_key" in df.columns else df.withColumn("_key", reference_key(F.col("ref"), F.col("alt"), pre_aligned))
    df = df.drop("_key")
    joined = keyed.join(candidates.hint("merge"), MEET, "left")
    current, best = _best(pre_aligned)
    joined = joined.withColumn("_current", current).withColumn("_best", F.when(F.col("_cands").isNotNull(), best))
    found = F.col("_best").isNotNull()
    turn = found & ~F.lit(pre_aligned) & is_reversed(F.col("ref"), F.col("alt"), F.col("_best.ref"), F.col("_best.alt"))
    values = {
        "ref": F.when(found & ~F.lit(pre_aligned), F.col("_best.ref")).otherwise(F.col("ref")),
        "alt": F.when(found & ~F.lit(pre_aligned), F.col("_best.alt")).otherwise(F.col("alt")),
        "beta": flip_effect(turn, F.col("beta")),
        "af_alt": flip_frequency(turn, F.col("af_alt")),
    }
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in df.columns],
                         F.col("_best.af").alias("af_gnomad"), F.col("_best.filter_").alias("filt_gnomad"),
                         found.alias("in_reference"))


def total_n(df: DataFrame, constant: int | None) -> Column:
    """The row's own N where the table has the column, else the given constant."""
    return F.col("n").cast("bigint") if "n" in df.columns else F.lit(constant).cast("bigint")


def resolve_duplicates(df: DataFrame, by: str = "study_ord", order: str = "file_order",
                       keep_best: bool = False) -> DataFrame:
    """Variants that occur more than once in a study: drop them all, or keep the closest one.

    The closest has the smallest frequency difference, unknown differences last, then file order.
    """
    keys = [by, "chr", "pos", "ref", "alt"]
    rest = [c for c in df.columns if c not in keys]
    unknown = F.col("af_abs_diff") < 0
    if keep_best:
        ranked = F.struct(unknown.alias("_u"), F.col("af_abs_diff").alias("_d"), F.col(order).alias("_o"), *rest)
    else:
        ranked = F.struct(F.col(order).alias("_o"), *rest)
    best = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(ranked).alias("_row"))
    if not keep_best:
        best = best.filter("_n = 1")
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def harmonize(df: DataFrame, ref: DataFrame | None, *, by: str = "study_ord", require_ref: bool = False,
              passing_only: bool = False, min_an: int = 0, max_abs_diff: float = 1.0, pre_aligned: bool = False,
              keep_best_duplicate: bool = False, n_total: int | None = None, order: str = "file_order",
              ref_order: str | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Harmonise studies to the reference population named in each row's ``pop``.

    Adds af_gnomad, af_fc, filt_gnomad (NA where unmatched) and Ntotal. Duplicates are resolved
    before the reference and difference filters, which then judge the row that is left. With
    ``stored``, a panel of :func:`store_panel`, ``ref`` is None and the filters on the panel are those of
    its storing.
    """
    panel = None if ref is None else usable_reference(ref, passing_only, min_an)
    matched = match_reference(df, panel, pre_aligned=pre_aligned, order=ref_order, stored=stored)
    compared = af_compare(F.col("af_alt"), F.col("af_gnomad"))
    full = (matched.withColumns(compared).withColumn("Ntotal", total_n(df, n_total))
            .withColumn("filt_gnomad", F.coalesce("filt_gnomad", F.lit("NA"))))
    unique = resolve_duplicates(full, by, order, keep_best_duplicate)
    if require_ref:
        # "In the reference" means a known frequency, as a match without one cannot be judged.
        unique = unique.filter(F.col("af_gnomad").isNotNull())
    return unique.filter(F.col("af_abs_diff") <= max_abs_diff).drop("in_reference")
