"""Allele algebra: strand, order, and the key under which spellings of one variant agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_allele(a: Column) -> Column:
    return F.upper(F.trim(a))


def strand_flip(a: Column) -> Column:
    """Complement base by base. Multi-base alleles keep their direction."""
    return F.translate(a, "ACGT", "TGCA")


def is_palindromic(ref: Column, alt: Column) -> Column:
    return F.concat(ref, alt).isin("AT", "TA", "CG", "GC")


def is_acgt(a: Column) -> Column:
    return a.rlike("(?i)^[ACGT]+$")


def is_placeholder(ref: Column, alt: Column) -> Column:
    """Indel codes I/D and the marks *, ! and N stand for no sequence."""
    either = lambda mark: (ref == mark) | (alt == mark)
    return F.concat(ref, alt).isin("ID", "DI") | either("*") | either("!") | either("N")


def _pair(ref: Column, alt: Column) -> Column:
    return F.concat_ws("|", ref, alt)


def canonical_key(ref: Column, alt: Column) -> Column:
    """The least of the four spellings of a variant.

    The spellings are closed under swap and complement, so two variants at one position are the
    same up to strand and order exactly when their keys are equal: an equi-join key.
    """
    cref, calt = strand_flip(ref), strand_flip(alt)
    return F.least(_pair(ref, alt), _pair(alt, ref), _pair(cref, calt), _pair(calt, cref))


def reference_key(ref: Column, alt: Column, pre_aligned: bool = False) -> Column:
    """Key for matching a reference panel: palindromes, and pre-aligned data, only as spelled."""
    if pre_aligned:
        return _pair(ref, alt)
    return F.when(is_palindromic(ref, alt), _pair(ref, alt)).otherwise(canonical_key(ref, alt))


def spelling_code(ref: Column, alt: Column, key: Column) -> Column:
    """How a spelling relates to its key: 0 same, 1 swapped, 2 complemented, 3 both.

    Two rows of one key have opposite effect directions when their codes differ in the low bit.
    The order of the tests makes swap win over complement, as palindromes need.
    """
    return (F.when(_pair(ref, alt) == key, 0).when(_pair(alt, ref) == key, 1)
            .when(_pair(strand_flip(ref), strand_flip(alt)) == key, 2).otherwise(3)).cast("int")


def is_reversed(ref: Column, alt: Column, to_ref: Column, to_alt: Column) -> Column:
    """True where the row's effect allele is the other allele of an equivalent target spelling."""
    cref, calt = strand_flip(ref), strand_flip(alt)
    return (F.when((ref == to_ref) & (alt == to_alt), False)
            .when((ref == to_alt) & (alt == to_ref), True)
            .when((cref == to_ref) & (calt == to_alt), False)
            .otherwise(True))


def flip_effect(flag: Column, beta: Column) -> Column:
    return F.when(flag, 0.0 - beta).otherwise(beta)


def flip_frequency(flag: Column, af: Column) -> Column:
    return F.when(flag, 1.0 - af).otherwise(af)


def variant_id(chr_: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat_ws(":", chr_.cast("string"), pos.cast("string"), ref, alt)


def parse_variant_id(vid: Column) -> dict[str, Column]:
    """chr, pos, ref and alt of a ``chr:pos:ref:alt`` id; NULL where a part is missing."""
    parts = F.split(vid, ":")
    return {"chr": F.get(parts, 0), "pos": F.get(parts, 1).try_cast("bigint"),
            "ref": F.get(parts, 2), "alt": F.get(parts, 3)}
