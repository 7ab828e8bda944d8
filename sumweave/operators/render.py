"""The wide result table and its text form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sumweave.functions.alleles import variant_id
from sumweave.functions.values import or_na, scientific
from sumweave.operators.meta import RESULT
from sumweave.sources.config import EXTRA

STUDY_COLUMNS = {"beta": "beta", "sebeta": "se", "pval": "pval", "af_alt": "af_alt", "INFO": "info", "Nsamples": "n"}
META_NAMES = dict(zip(RESULT, ["meta_beta", "meta_sebeta", "meta_p", "meta_Ncases", "meta_Ncontrols",
                               "meta_Neffective", "meta_af_alt", "meta_info", "het_p"]))


def _stat_columns(prefix: str, method: str, cell: Column, het: bool, het_name: str) -> list[Column]:
    out = []
    for field in RESULT:
        if field == "het_p" and not het:
            continue
        name = het_name if field == "het_p" else META_NAMES[field]
        out.append(cell[field].alias(f"{prefix}_{method}_{name}"))
    return out


def _study_row(study_ord: int) -> Column:
    return F.get(F.filter("_members", lambda m: m["study_ord"] == study_ord), 0)


def to_wide(results: DataFrame, studies: Sequence[tuple[int, str]], methods: Sequence[str], *,
            het: bool = False, leave_one_out: bool = False, leave_most_sig_out: bool = False,
            pairwise_with_first: bool = False, extra_cols: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """One row per variant: key, every study's columns, then each family's results.

    ``results`` comes from :func:`sumweave.operators.meta.meta` with ``keep=["members"]``; the rows
    of a variant, one per family and method of the request, are gathered into one map. ``studies`` is (study_ord, name) in order.
    """
    keys = [*by, "chr", "pos", "ref", "alt", "occ"]
    cell = F.struct(*RESULT)
    # Families and methods are those of the request, so a map has a fixed number of entries.
    entry = F.struct(F.concat_ws("|", "family", "method"), cell)
    head = F.struct("family", F.struct("left_out", "n_studies", "n_samples"))
    gathered = results.groupBy(*keys).agg(
        F.first("members", ignorenulls=True).alias("_members"),
        F.map_from_entries(F.collect_list(entry)).alias("_cells"),
        F.map_from_entries(F.collect_set(head)).alias("_heads"))
    names = {o: name for o, name in studies}
    label = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])

    def result(family: str, method: str) -> Column:
        return F.try_element_at(F.col("_cells"), F.lit(f"{family}|{method}"))

    def head_of(family: str) -> Column:
        return F.try_element_at(F.col("_heads"), F.lit(family))

    out = [*by, F.col("chr").alias("#CHR"), F.col("pos").alias("POS"), F.col("ref").alias("REF"),
           F.col("alt").alias("ALT"),
           variant_id(F.col("chr"), F.col("pos"), F.col("ref"), F.col("alt")).alias("SNP")]
    for i, (o, name) in enumerate(studies):
        row = _study_row(o)
        out += [row[field].alias(f"{name}_{column}") for column, field in STUDY_COLUMNS.items()]
        out += [row[EXTRA + c].alias(f"{name}_{c}") for c in extra_cols]
        if pairwise_with_first and i > 0:
            for method in methods:
                out += _stat_columns(f"{studies[0][1]}_{name}", method, result(f"pair_{o}", method), het, "meta_het_p")
    everyone = head_of("all")
    out += [everyone["n_studies"].cast("bigint").alias("all_meta_Nstudies"),
            everyone["n_samples"].alias("all_meta_Nsamples")]
    for method in methods:
        out += _stat_columns("all", method, result("all", method), het, "het_p")
    if leave_most_sig_out:
        lmso = head_of("lmso")
        out += [F.try_element_at(label, lmso["left_out"]).alias("lmso_meta_removed_study_name"),
                lmso["n_samples"].alias("lmso_meta_Nsamples")]
        for method in methods:
            out += _stat_columns("lmso", method, result("lmso", method), het, "het_p")
    if leave_one_out:
        for o, name in studies:
            out.append(head_of(f"leave_{o}")["n_samples"].alias(f"leave_{name}_Nsamples"))
            for method in methods:
                out += _stat_columns(f"leave_{name}", method, result(f"leave_{o}", method), het, "meta_het_p")
    return gathered.select(*out)


def render(df: DataFrame, precision: int = 5) -> DataFrame:
    """All columns as text: doubles in scientific form, NULL as NA."""
    out = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        double = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        out.append((scientific(value, precision) if double else or_na(value)).alias(f.name))
    return df.select(*out)
