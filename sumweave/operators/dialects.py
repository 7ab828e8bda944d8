"""Vendor result tables to the canonical ten columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sumweave.functions.numeric import P_FLOOR

# The canonical columns.
CANONICAL = ["CHR", "POS", "Allele1", "Allele2", "AF_Allele2", "imputationInfo", "BETA", "SE", "p.value", "N"]


def col(name: str) -> Column:
    """A column by its whole name, which may hold dots."""
    return F.col(f"`{name}`")


def _log10p(name: str) -> Column:
    # 10^-L underflows to 0 beyond L = 323.3, and p = 0 is dropped later on: keep the floor.
    p = F.pow(F.lit(10.0), -col(name).try_cast("double"))
    return F.when(p.isNotNull(), F.greatest(p, F.lit(P_FLOOR)))


def _total(a: str, b: str) -> Column:
    return (col(a).try_cast("double") + col(b).try_cast("double")).cast("bigint")


@dataclass(frozen=True)
class Dialect:
    """Where each canonical column comes from: a source name, or a function of the table."""

    columns: dict[str, str | Callable[[DataFrame], Column]] = field(default_factory=dict)
    needs: tuple[str, ...] = ()
    keep: Callable[[DataFrame], Column] | None = None

    def sources(self) -> list[str]:
        named = [self.columns.get(c, c) for c in CANONICAL]
        return [n for n in named if isinstance(n, str)] + list(self.needs)


#: Columns that scans and plans add to a vendor's; they have no position and stay as they are.
ADDED = ("file_order", "n_fields", "study_ord", "pop")


def _nth(df: DataFrame, position: int) -> Column | None:
    """The vendor's column at a 1-based position, or None where the table is narrower."""
    names = [c for c in df.columns if c not in ADDED]
    return col(names[position - 1]) if len(names) >= position else None


def _not_failed(df: DataFrame) -> Column:
    marker = _nth(df, 14)
    return F.lit(True) if marker is None else F.coalesce(marker != "TEST_FAIL", F.lit(True))


def _packed(position: int) -> Callable[[DataFrame], Column]:
    """A value of the packed 22nd field, ``key=beta;key=se;key=info``."""
    def value(df: DataFrame) -> Column:
        packed = _nth(df, 22)
        if packed is None:
            raise ValueError("the packed 22nd field is missing")
        return F.get(F.split(packed, "[;=]"), position)
    return value


_SUMMED = {"N": lambda df: _total("N.Cases", "N.Controls")}
_SUMMED_NEEDS = ("N.Cases", "N.Controls")
_ALLELES_01 = {"Allele1": "ALLELE0", "Allele2": "ALLELE1", "AF_Allele2": "A1FREQ", "imputationInfo": "INFO",
               "p.value": lambda df: _log10p("LOG10P")}

# The vendors' column names and which of them stand for which canonical one.
DIALECTS = {
    "SAIGE": Dialect(),
    "EXCEED": Dialect({"POS": "BP", "p.value": "P"}),
    "REGENIE": Dialect({"CHR": "CHROM", "POS": "GENPOS", **_ALLELES_01}, ("LOG10P",), _not_failed),
    "JAPAN": Dialect(_SUMMED, _SUMMED_NEEDS),
    "PMBB": Dialect({"CHR": "#CHROM", **_ALLELES_01}, ("LOG10P",)),
    "US": Dialect({"BETA": "Beta"}),
    "HELIX": Dialect(
        {"CHR": "Chr", "POS": "Pos", "Allele1": "Ref", "Allele2": "Alt", "AF_Allele2": "AAF",
         "imputationInfo": _packed(5), "BETA": _packed(1), "SE": _packed(3), "p.value": "Pval",
         "N": lambda df: _total("Num_Cases", "Num_Controls")},
        ("Num_Cases", "Num_Controls"),
        lambda df: (F.coalesce(_packed(3)(df), F.lit("")) != "NA") & (F.coalesce(col("Pval"), F.lit("")) != "NA")),
    "GENOTEK": Dialect({"BETA": "Beta", **_SUMMED}, _SUMMED_NEEDS),
}


def normalize(df: DataFrame, dialect: str) -> DataFrame:
    """Project a vendor table onto the canonical columns and those a scan added; unknown dialects and names raise."""
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}; known: {', '.join(DIALECTS)}")
    rule = DIALECTS[dialect]
    missing = [c for c in rule.sources() if c not in df.columns]
    if missing:
        raise ValueError(f"{dialect} table lacks column(s) {', '.join(missing)}")
    if rule.keep is not None:
        df = df.filter(rule.keep(df))
    out = []
    for name in CANONICAL:
        source = rule.columns.get(name, name)
        value = col(source) if isinstance(source, str) else source(df)
        out.append(value.alias(name))
    return df.select(*out, *[c for c in ADDED if c in df.columns])
