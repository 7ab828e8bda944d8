"""Formatted studies to harmonised studies: clean, detect the build, lift, match the reference."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumweave.operators.build import detect_build
from sumweave.operators.harmonize import harmonize
from sumweave.operators.liftover import liftover, mark_current_build, rewrite_lifted
from sumweave.operators.qc import qc_filter, qc_report, require_square

#: Canonical names of a formatted study to the names used from here on.
FORMATTED = {"CHR": "chr", "POS": "pos", "Allele1": "ref", "Allele2": "alt", "AF_Allele2": "af_alt",
             "imputationInfo": "info", "BETA": "beta", "SE": "se", "p.value": "pval", "N": "n"}


@dataclass(frozen=True)
class MungeOptions:
    min_af: float = 0.001
    min_info: float = 0.6
    harmonize: dict = field(default_factory=dict)


def gates(raw: DataFrame, options: MungeOptions = MungeOptions(), order: str = "file_order") -> DataFrame:
    """Per study the counts of :func:`sumweave.operators.qc.qc_report`; reading them fails the job for a study
    whose lines differ in their number of fields or that has too few chromosomes."""
    skip = [c for c in (order, "pop", "study_ord", "n_fields") if c in raw.columns]
    return require_square(qc_report(raw, FORMATTED, F.col("n_fields"), skip=skip, min_af=options.min_af, min_info=options.min_info))


def clean(raw: DataFrame, options: MungeOptions = MungeOptions(), order: str = "file_order", gated: bool = False) -> DataFrame:
    """Quality-filtered rows of all studies with typed columns.

    ``raw`` is the union of the formatted studies with ``study_ord``, ``pop`` and the row order.
    ``gated`` reads it once more for :func:`gates`, whose few rows go to every task.
    """
    if gated:
        # One row per study; the rows kept depend on the count, so that the check can't be pruned away.
        passed = gates(raw, options, order).select("study_ord", "n_after")
        raw = raw.join(F.broadcast(passed), "study_ord").filter("n_after >= 0").drop("n_after")
    skip = [c for c in (order, "pop", "study_ord", "n_fields") if c in raw.columns]
    rows = qc_filter(raw, FORMATTED, options.min_af, options.min_info, skip=skip)
    number = lambda c: F.col(c).try_cast("double").alias(c)
    return rows.select("study_ord", "pop", F.col("chr").cast("int").alias("chr"), "pos", "ref", "alt",
                       *[number(c) for c in ("af_alt", "info", "beta", "se", "pval")],
                       F.col("n").try_cast("double").cast("bigint").alias("n"), order)


def munge(cleaned: DataFrame, build_maps: DataFrame, chain: DataFrame, reference: DataFrame,
          ref_bases: DataFrame | None = None, options: MungeOptions = MungeOptions()) -> DataFrame:
    """All studies in the target build and oriented like the reference, in one plan.

    The build of each study is a small table, joined back by study; each branch then filters on it
    before its own joins, so a row is lifted or not, never both. Lifted studies count as aligned to
    the reference already. ``cleaned`` is read once per branch: store it first when scanning text.
    """
    builds = detect_build(cleaned, build_maps, strict=True).select("study_ord", "build")
    placed = cleaned.join(builds, "study_ord")
    old = placed.filter(F.col("build") == "b37").drop("build")
    new = placed.filter(F.col("build") == "b38").drop("build")
    lifted = rewrite_lifted(liftover(old, chain, ref_bases))
    given = dict(options.harmonize)
    aligned = {**given, "pre_aligned": True}
    return (harmonize(lifted, reference, **aligned)
            .unionByName(harmonize(mark_current_build(new), reference, **given)))
