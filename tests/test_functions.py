import math
from itertools import product
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from sumweave.functions import alleles, numeric, values


def test_erfc_matches_standard_library(spark):
    xs = [i / 50 for i in range(0, 1320)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", numeric.erfc(F.col("x")).alias("y")).collect()
    assert max(abs(r.y - math.erfc(r.x)) / math.erfc(r.x) for r in rows if math.erfc(r.x) > 1e-300) < 1e-14


def test_z_from_p_matches_standard_library_and_tails(spark):
    ps = [10 ** -(i / 7) for i in range(1, 2000)]
    df = spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0, 1.5, 5e-324]], "p double")
    rows = {r.p: r.z for r in df.select("p", numeric.z_from_p(F.col("p")).alias("z")).collect()}
    for p in ps:
        assert rows[p] == pytest.approx(-NormalDist().inv_cdf(p / 2), rel=1e-12)
    assert rows[0.0] == math.inf and rows[1.0] == 0.0 and rows[1.5] is None
    assert rows[5e-324] == pytest.approx(38.4854083, abs=1e-6)


def test_p_from_z_floor_and_null(spark):
    df = spark.createDataFrame([(0.0,), (-1.96,), (60.0,), (None,)], "z double")
    got = [r.p for r in df.select(numeric.p_from_z(F.col("z")).alias("p")).collect()]
    assert got[0] == 1.0 and got[1] == pytest.approx(0.04999579) and got[2] == 5e-324 and got[3] is None


def test_chi2_sf_small_df_and_edges(spark):
    df = spark.createDataFrame([(3.0, 1), (3.0, 2), (7.5, 3), (0.0, 4), (-1.0, 2), (5.0, 0), (2000.0, 2)], "x double, k int")
    got = [r.p for r in df.select(numeric.chi2_sf(F.col("x"), F.col("k")).alias("p")).collect()]
    assert got[0] == pytest.approx(math.erfc(math.sqrt(1.5)))
    assert got[1] == pytest.approx(math.exp(-1.5))
    expected = math.erfc(math.sqrt(3.75)) + 2 * math.sqrt(3.75 / math.pi) * math.exp(-3.75)
    assert got[2] == pytest.approx(expected)
    assert got[3] == 1.0 and got[4] == 1.0 and got[5] is None and got[6] < 1e-300


ALLELES = ["A", "C", "G", "T", "AT", "GA"]
COMP = str.maketrans("ACGT", "TGCA")


def same_variant(a, b):
    """Two spellings of one variant, and whether the effect turns (None: different)."""
    if a == b:
        return False
    if a == b[::-1]:
        return True
    flipped = tuple(x.translate(COMP) for x in b)
    if b in (("A", "T"), ("T", "A"), ("C", "G"), ("G", "C")):
        return None
    if a == flipped:
        return False
    return True if a == flipped[::-1] else None


def test_canonical_key_and_direction_for_all_pairs(spark):
    pairs = list(product(ALLELES, ALLELES))
    rows = [(*a, *b) for a in pairs for b in pairs]
    df = spark.createDataFrame(rows, "r1 string, a1 string, r2 string, a2 string")
    c = F.col
    got = df.select("*", (alleles.canonical_key(c("r1"), c("a1")) == alleles.canonical_key(c("r2"), c("a2"))).alias("eq"),
                    alleles.is_reversed(c("r1"), c("a1"), c("r2"), c("a2")).alias("rev"),
                    (alleles.spelling_code(c("r1"), c("a1"), alleles.canonical_key(c("r1"), c("a1"))) % 2).alias("s1"),
                    (alleles.spelling_code(c("r2"), c("a2"), alleles.canonical_key(c("r2"), c("a2"))) % 2).alias("s2")).collect()
    for r in got:
        turn = same_variant((r.r1, r.a1), (r.r2, r.a2))
        assert r.eq == (turn is not None), r
        if turn is not None and r.r1 != r.a1:
            assert r.rev == turn, r
            assert (r.s1 != r.s2) == turn, r


def test_reference_key_palindromes_only_exact(spark):
    c = F.col
    df = spark.createDataFrame([("A", "T"), ("T", "A"), ("A", "C"), ("G", "T")], "r string, a string")
    keys = [r.k for r in df.select(alleles.reference_key(c("r"), c("a")).alias("k")).collect()]
    assert keys[0] != keys[1] and keys[2] == keys[3]
    fixed = [r.k for r in df.select(alleles.reference_key(c("r"), c("a"), True).alias("k")).collect()]
    assert len(set(fixed)) == 4


def test_chromosome_names(spark):
    names = ["01", "chrX", "X", "0chrY", "MT", "22", "0", "00", "chr0", "GL1", ""]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    got = df.select("c", values.normalize_chrom(F.col("c")).alias("m"), values.chrom_code(F.col("c")).alias("k"),
                    F.col("c").rlike(values.NUMERIC_CHROM).alias("num"), values.plot_chrom(F.col("c")).alias("q")).collect()
    by = {r.c: r for r in got}
    assert [by[n].m for n in names] == ["1", "23", "23", "24", "MT", "22", "", "0", "0", "GL1", ""]
    for r in got:
        assert r.num == r.m.isdigit(), r
    assert (by["chrX"].k, by["MT"].k, by["22"].k, by["01"].k) == (23, 25, 22, None)
    assert (by["chrX"].q, by["MT"].q, by["GL1"].q) == (23, 25, None)


def test_scientific_text(spark):
    df = spark.createDataFrame([(0.05,), (0.123456789,), (0.0,), (100.0,), (-2.5e-7,), (5e-324,), (None,)], "x double")
    got = [r.t for r in df.select(values.scientific(F.col("x")).alias("t")).collect()]
    assert got == ["5.e-02", "1.23457e-01", "0.e+00", "1.e+02", "-2.5e-07", "5.e-324", "NA"]


def test_lenient_numbers_and_odds_ratio(spark):
    df = spark.createDataFrame([("0.1", "x", "1", "2", "3", "4.0"), ("0.1", "0.9", "1", "2", "3", "?")],
                               "af string, i string, p string, e string, s string, n string")
    out = values.lenient_stats(*[F.col(c) for c in ("af", "i", "p", "e", "s", "n")])
    a, b = df.select(*[c.alias(k) for k, c in out.items()]).collect()
    assert a.af_alt is None and a.effect is None and a.se == 3.0 and a.n == 4
    assert b.af_alt == 0.1 and b.se is None and b.n is None
    odds = spark.createDataFrame([(math.e, "OR"), (0.0, "or"), (-1.0, "or"), (0.5, "beta")], "e double, t string")
    got = [r.b for r in odds.select(values.to_beta(F.col("e"), F.col("t")).alias("b")).collect()]
    assert got == [pytest.approx(1.0), None, None, 0.5]
