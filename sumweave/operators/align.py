"""Allele-aware alignment of many studies, variant by variant.

The studies are kept as one long table. Rows that spell the same variant (up to strand and allele
order) share an equi-key, so the N-way full outer join is a single grouping shuffle, whatever the
number of studies.

Sizes: exact duplicates within a study are removed first, with map-side pruning, so a variant
repeated in a third of all rows leaves one row per map task. After that a group holds at most four
spellings per study, which bounds every array built here by 4 x studies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sumweave.functions.arrays import bind
from sumweave.functions.alleles import (
    canonical_key, clean_allele, flip_effect, flip_frequency, is_acgt, is_reversed, spelling_code,
)

VARIANT = ["chr", "pos", "ref", "alt"]
#: Key order for shuffles and sorts: sorts compare a prefix of the first column, so the position,
#: which has many values, goes before the chromosome and the study.
SORT_KEYS = ["pos", "chr", "ref", "alt"]


def dedup_first(df: DataFrame, by: Sequence[str] = ("study_ord",), order: str = "file_order") -> DataFrame:
    """The first row of every exact variant within ``by``.

    A row_number = 1 filter is pruned on the map side, before the shuffle.
    """
    w = Window.partitionBy(*SORT_KEYS, *by).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def align_groups(df: DataFrame, by: Sequence[str] = (), order: str = "file_order",
                 dedup: bool = True) -> DataFrame:
    """One row per output variant with the contributing studies as an array.

    ``df`` has one row per study and variant: ``study_ord``, the variant, ``order`` and the
    statistics, of which ``beta`` and ``af_alt`` follow the effect allele. ``by`` adds grouping
    columns such as a phenotype. Result: ``by``, chr, pos, ref, alt in the spelling of the first
    study that has the variant, ``occ`` (which of several equivalent rows of one study this is),
    and ``members`` sorted by study_ord. Pass ``dedup=False`` only for input that holds each
    variant once per study, such as harmonised tables; it saves a shuffle.
    """
    by = list(by)
    payload = [c for c in df.columns if c not in {*by, *VARIANT, "study_ord", order}]
    df = (df.withColumn("ref", clean_allele("ref")).withColumn("alt", clean_allele("alt"))
          .filter(is_acgt(F.col("ref")) & is_acgt(F.col("alt"))))
    if dedup:
        df = dedup_first(df, [*by, "study_ord"], order)
    keyed = df.withColumn("_key", canonical_key(F.col("ref"), F.col("alt")))
    row = F.struct("study_ord", F.col(order).alias("_order"),
                   spelling_code(F.col("ref"), F.col("alt"), F.col("_key")).alias("_spelling"),
                   "ref", "alt", *payload)
    # Dealt by position only: every later grouping by variant, that of the wide table too, finds its
    # rows together and needs no further shuffle.
    grouped = keyed.repartition("pos", "chr", *by).groupBy("pos", "chr", "_key", *by).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    slots = grouped.select(*by, "chr", "pos", F.posexplode(_slots()).alias("occ", "_members"))
    return (slots.withColumn("_anchor", F.col("_members")[0])
            .select(*by, "chr", "pos", F.col("_anchor.ref").alias("ref"), F.col("_anchor.alt").alias("alt"),
                    "occ", F.transform("_members", _oriented(payload)).alias("members")))


def _oriented(payload: list[str]):
    def orient(m: Column) -> Column:
        flip = (m["_spelling"] % 2) != (F.col("_anchor._spelling") % 2)
        fields = []
        for name in payload:
            value = m[name]
            if name == "beta":
                value = flip_effect(flip, value)
            elif name == "af_alt":
                value = flip_frequency(flip, value)
            fields.append(value.alias(name))
        return F.struct(m["study_ord"].alias("study_ord"), *fields)
    return orient


def _slots() -> Column:
    """Split ``_rows`` into arrays with at most one row per study.

    Round r takes one row from every study that still has one: the row spelled like the round's
    anchor if there is one, else the first in file order. The anchor is the first remaining row of
    the lowest study, so the anchors of all rounds come out of one pass over the studies in order:
    a study with more rows than there are anchors so far supplies the next ones.
    """
    rows = F.col("_rows")
    ords = F.col("_rows.study_ord")
    studies = F.array_distinct(ords)
    no_ints = F.array().cast("array<int>")
    no_slots = F.array().cast("array<struct<i:int,occ:int>>")

    def take(state: Column, anchor: Column) -> Column:
        left = state["left"]
        exact = F.filter(left, lambda c: c["spelling"] == anchor)
        first = F.coalesce(F.get(exact, 0), F.get(left, 0))["i"]
        return F.when(F.size(left) == 0, state).otherwise(bind(first, lambda pick: F.struct(
            F.filter(left, lambda c: c["i"] != pick).alias("left"),
            F.concat(state["picked"], F.array(pick)).alias("picked"))))

    def add_study(acc: Column, study: Column, codes: Column) -> Column:
        mine = F.filter(codes, lambda c: c["study"] == study)
        start = F.struct(mine.alias("left"), no_ints.alias("picked"))

        def extend(state: Column) -> Column:
            picked = F.concat(state["picked"], F.transform(state["left"], lambda c: c["i"]))
            return F.struct(
                F.concat(acc["anchors"], F.transform(state["left"], lambda c: c["spelling"])).alias("anchors"),
                F.concat(acc["out"], F.transform(
                    picked, lambda i, r: F.struct(i.alias("i"), r.alias("occ")))).alias("out"))
        return bind(F.aggregate(acc["anchors"], start, take), extend)

    def fold(codes: Column) -> Column:
        start = F.struct(no_ints.alias("anchors"), no_slots.alias("out"))
        return F.aggregate(studies, start, lambda acc, study: add_study(acc, study, codes), lambda acc: acc["out"])

    def by_round(folded: Column) -> Column:
        rounds = F.sequence(F.lit(0), F.array_max(F.transform(folded, lambda o: o["occ"])))
        return F.transform(rounds, lambda r: F.transform(
            F.filter(folded, lambda o: o["occ"] == r), lambda o: F.get(rows, o["i"])))

    codes = F.transform(rows, lambda r, i: F.struct(
        i.alias("i"), r["study_ord"].alias("study"), r["_spelling"].alias("spelling")))
    split = bind(bind(codes, fold), by_round)
    # Nearly every group has one row per study: it is one slot as it stands.
    return F.when(F.size(studies) == F.size(ords), F.array(rows)).otherwise(split)


def align_studies(df: DataFrame, by: Sequence[str] = (), order: str = "file_order",
                  dedup: bool = True) -> DataFrame:
    """The aligned table in long form: one row per output variant and contributing study."""
    return align_groups(df, by, order, dedup).select(*by, *VARIANT, "occ", F.inline("members"))


def left_align(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join of one study to another on the variant, the match oriented like the left row.

    The right side gives its beta and af_alt as ``match_beta`` and ``match_af``. It is reduced to
    one row per spelling first (map-side); of several equivalent spellings the one that comes
    first in file order matches, as in a forward read.
    """
    key = canonical_key(F.col("ref"), F.col("alt"))
    candidates = (dedup_first(right, [])
                  .groupBy("chr", "pos", key.alias("_key"))
                  .agg(F.min(F.struct("file_order", "ref", "alt", "beta", "af_alt")).alias("_m")))
    joined = left.withColumn("_key", key).join(candidates, ["chr", "pos", "_key"], "left")
    flip = is_reversed(F.col("_m.ref"), F.col("_m.alt"), F.col("ref"), F.col("alt"))
    return joined.select(*left.columns, flip_effect(flip, F.col("_m.beta")).alias("match_beta"),
                         flip_frequency(flip, F.col("_m.af_alt")).alias("match_af"))


def order_violations(df: DataFrame, by: Sequence[str] = ("study_ord",), order: str = "file_order",
                     block: str | None = None) -> DataFrame:
    """Number of rows per study whose (chr, pos) lies before that of the row read just before.

    The work is cut into blocks of the file order so that one large study does not fall to one
    task: violations inside a block are counted there, and the blocks' first and last rows are then
    compared in a table with one row per block. ``block`` names a column that does not decrease
    along ``order``, such as the block start of a scan; without it the rows are cut by ranges of ``order``.
    """
    if block is None:
        df = df.repartitionByRange(*by, order)
    block_col = F.col(block) if block else F.spark_partition_id()
    place = F.struct("chr", "pos")
    keyed = df.select(*by, F.col(order).alias("_order"), block_col.alias("_block"), place.alias("_place"))
    w = Window.partitionBy(*by, "_block").orderBy("_order")
    inside = (keyed.withColumn("_bad", (F.col("_place") < F.lag("_place").over(w)).cast("int"))
              .groupBy(*by, "_block")
              .agg(F.coalesce(F.sum("_bad"), F.lit(0)).alias("_bad"), F.count("*").alias("_rows"),
                   F.min_by("_place", "_order").alias("_first"), F.max_by("_place", "_order").alias("_last")))
    edges = Window.partitionBy(*by).orderBy("_block")
    across = (F.col("_first") < F.lag("_last").over(edges)).cast("int")
    return (inside.withColumn("_edge", F.coalesce(across, F.lit(0)))
            .groupBy(*by).agg(F.sum("_rows").alias("n_rows"),
                              F.sum(F.col("_bad") + F.col("_edge")).alias("n_violations")))
