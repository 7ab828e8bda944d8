"""A manifest of vendor files to one table of formatted studies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sumweave.operators.dialects import CANONICAL, col, normalize
from sumweave.sources.delimited import scan_study


@dataclass(frozen=True)
class Entry:
    """A line of the manifest: a study's file, how its vendor writes it, and its reference population."""

    study_ord: int
    path: str
    dialect: str
    pop: str
    tab_only: bool = True


def format_studies(spark: SparkSession, entries: Sequence[Entry]) -> DataFrame:
    """Canonical columns of all studies with ``study_ord``, ``pop``, ``n_fields`` and ``file_order``.

    The result is what :func:`sumweave.plans.munge.clean` takes. Each file is one branch of a union,
    so the plan grows with the number of files; rows of a file are only read when the union is.
    """
    if not entries:
        raise ValueError("the manifest is empty")
    tables = []
    for entry in entries:
        rows = normalize(scan_study(spark, entry.path, tab_only=entry.tab_only, count_fields=True), entry.dialect)
        # Some dialects work values out: text again, so that a union does not turn the others' texts into numbers. As one
        # struct that is generated, so that no filter is pushed below and works them out once per condition.
        texts = F.struct(*[col(c).cast("string").alias(c) for c in CANONICAL])
        rest = [F.col(f"`{c}`") for c in rows.columns if c not in CANONICAL]
        tables.append(rows.select(F.inline(F.array(texts)), *rest, F.lit(entry.study_ord).alias("study_ord"), F.lit(entry.pop).alias("pop")))
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole
