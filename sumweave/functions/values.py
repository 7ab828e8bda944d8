"""Chromosome names, lenient numbers and number formatting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chromosome names accepted by the meta-analysis stage.
CHROM_CODES = {
    **{f"chr{c}": c for c in range(1, 23)},
    **{str(c): c for c in range(1, 25)},
    "X": 23, "Y": 24, "MT": 25, "chrX": 23, "chrY": 24, "chrMT": 25,
}


#: Names that normalise to a number. Possessive, so that a lone "0" is stripped, not kept.
NUMERIC_CHROM = "^0?+(chr)?+([XY][0-9]*|[0-9]+)$"


def normalize_chrom(c: Column) -> Column:
    """Munge-stage names: drop a leading 0, then chr; a leading X or Y becomes 23 or 24."""
    for pattern, value in [("^0?(chr)?", ""), ("^X", "23"), ("^Y", "24")]:
        c = F.regexp_replace(c, pattern, value)
    return c


def chrom_code(c: Column) -> Column:
    """Meta-stage names to 1..25; NULL for anything that is not in the fixed list."""
    table = F.create_map(*[F.lit(x) for pair in CHROM_CODES.items() for x in pair])
    return F.try_element_at(table, c)


def plot_chrom(c: Column) -> Column:
    """QC-stage names: chr removed anywhere, X/Y/M/MT to 23/24/25, NULL if not a number."""
    for pattern, value in [("chr", ""), ("X", "23"), ("Y", "24"), ("MT|M", "25")]:
        c = F.regexp_replace(c, pattern, value)
    return c.try_cast("int")


def chrom_label(c: Column) -> Column:
    """Number to label with chr prefix: 23, 24, 25 are X, Y, M."""
    c = c.cast("string")
    name = F.when(c == "23", "X").when(c == "24", "Y").when(c == "25", "M").otherwise(c)
    return F.when(name.startswith("chr"), name).otherwise(F.concat(F.lit("chr"), name))


def to_position(pos: Column) -> Column:
    """Integer position, also from scientific notation such as 1e6."""
    return pos.try_cast("double").cast("bigint")


def all_or_null(columns: dict[str, Column]) -> dict[str, Column]:
    """Parse to double; one bad value makes the whole set NULL."""
    parsed = {name: c.try_cast("double") for name, c in columns.items()}
    good = reduce(lambda a, b: a & b, [c.isNotNull() for c in parsed.values()])
    return {name: F.when(good, c) for name, c in parsed.items()}


def lenient_stats(af: Column, info: Column, pval: Column, effect: Column,
                  se: Column, n: Column) -> dict[str, Column]:
    """The study columns as numbers: the first four stand or fall together, so do se and n."""
    stats = all_or_null({"af_alt": af, "info": info, "pval": pval, "effect": effect})
    support = all_or_null({"se": se, "n": n})
    support["n"] = support["n"].cast("bigint")
    return {**stats, **support}


def to_beta(effect: Column, effect_type: Column) -> Column:
    """Log odds of an odds ratio; ratios that are not positive have no logarithm and give NULL."""
    log_odds = F.when(effect > 0, F.ln(effect))
    return F.when(F.lower(effect_type) == "or", log_odds).otherwise(effect)


def scientific(x: Column, precision: int = 5) -> Column:
    """Scientific text with at most ``precision`` decimals, NA for NULL."""
    text = F.regexp_replace(F.format_string(f"%.{precision}e", x), "0+e", "e")
    # The JVM prints the smallest double with two digits, shortest-form printing with one.
    return (F.when(x.isNull(), "NA").when(F.isnan(x), "nan")
            .when(x == 5e-324, "5.e-324").otherwise(text))


def or_na(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("NA"))
