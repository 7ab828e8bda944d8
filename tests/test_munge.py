import random

import pytest
from pyspark.sql import functions as F

from sumweave.operators import cohorts, manifest, qc, qcdata
from sumweave.operators.build import detect_build
from sumweave.operators.dialects import DIALECTS, normalize
from sumweave.operators.harmonize import harmonize
from sumweave.operators.liftover import BIN_WIDTH, liftover, overlapping_blocks, rewrite_lifted

STUDY = "study_ord int, pop string, chr int, pos bigint, ref string, alt string, af_alt double, beta double, n bigint, file_order bigint"
REF = "pop string, chr int, pos bigint, ref string, alt string, af double, filter_ string, an bigint, at bigint"


def study(spark, data):
    return spark.createDataFrame([(0, "nfe", 1, pos, r, a, af, b, 7, i) for i, (pos, r, a, af, b) in enumerate(data)], STUDY)


def panel(spark, data):
    return spark.createDataFrame([("nfe", 1, pos, r, a, af, "PASS", 100, i) for i, (pos, r, a, af) in enumerate(data)], REF)


COMP = str.maketrans("ACGT", "TGCA")


def one_row(row, cands, pre_aligned):
    """Brute force of the best match: candidates one by one, the row turning on the way."""
    pos, r, a, af, b = row
    pal = lambda x, y: x + y in ("AT", "TA", "CG", "GC")

    def turn(state, target):
        (sr, sa, saf, sb), (tr, ta) = state, target
        if (sr, sa) == (tr, ta):
            return state
        if pal(tr, ta):
            return None
        if (sr, sa) == (ta, tr):
            return tr, ta, 1 - saf if saf is not None else None, -sb
        cr, ca = tr.translate(COMP), ta.translate(COMP)
        if (sr, sa) == (cr, ca):
            return tr, ta, saf, sb
        if (sr, sa) == (ca, cr):
            return tr, ta, 1 - saf if saf is not None else None, -sb
        return None

    state, found = (r, a, af, b), []
    for _, cr, ca, caf in cands:
        new = state if (state[0], state[1]) == (cr, ca) else (None if pre_aligned else turn(state, (cr, ca)))
        if new is None:
            continue
        diff = 1
        if caf is not None and state[2] is not None:
            state = new
            diff = round(abs(state[2] - caf), 12)
        found.append((diff, cr, ca, caf))
    if not found:
        return state, None
    best = None
    for f in found:
        if best is None or f[0] < best[0] or (f[0] == best[0] and (f[1], f[2]) == (state[0], state[1])):
            best = f
    if not pre_aligned:
        state = turn(state, (best[1], best[2]))
    return state, best


@pytest.mark.parametrize("pre_aligned", [False, True])
def test_best_match_against_brute_force(spark, pre_aligned):
    rng = random.Random(5)
    alleles = [("A", "C"), ("C", "A"), ("T", "G"), ("G", "T"), ("A", "T"), ("T", "A"), ("A", "G")]
    rows, cands = [], []
    for pos in range(1, 120):
        rows.append((pos, *rng.choice(alleles), rng.choice([None, 0.25, 0.5, 0.125]), 0.5))
        for r, a in rng.sample(alleles, rng.randint(0, 4)):
            cands.append((pos, r, a, rng.choice([None, 0.25, 0.75, 0.0, 0.5])))
    out = harmonize(study(spark, rows), panel(spark, cands), pre_aligned=pre_aligned, ref_order="at").collect()
    got = {r.pos: r for r in out}
    for row in rows:
        state, best = one_row(row, [c for c in cands if c[0] == row[0]], pre_aligned)
        r = got[row[0]]
        assert (r.ref, r.alt, r.beta) == (state[0], state[1], state[3]), row
        assert r.af_alt == (pytest.approx(state[2]) if state[2] is not None else None)
        assert r.af_gnomad == (best[3] if best else None)
        assert r.filt_gnomad == ("PASS" if best else "NA")


def test_duplicates_and_filters(spark):
    rows = [(1, "A", "C", 0.3, 0.1), (1, "C", "A", 0.9, 0.2), (2, "A", "C", 0.9, 0.3), (3, "A", "G", 0.5, 0.4)]
    ref = panel(spark, [(1, "A", "C", 0.25), (2, "A", "C", 0.1)])
    df = study(spark, rows)
    assert {r.pos for r in harmonize(df, ref).collect()} == {2, 3}
    best = {r.pos: r for r in harmonize(df, ref, keep_best_duplicate=True).collect()}
    assert best[1].beta == 0.1 and best[1].Ntotal == 7 and best[3].af_fc is None
    assert {r.pos for r in harmonize(df, ref, keep_best_duplicate=True, max_abs_diff=0.2).collect()} == {1, 3}
    assert {r.pos for r in harmonize(df, ref, keep_best_duplicate=True, require_ref=True).collect()} == {1, 2}
    assert {r.pos for r in harmonize(df, ref, min_an=101, require_ref=True).collect()} == set()


CHAIN = "chr int, src_start bigint, src_end bigint, dst_chr int, dst_start bigint, strand string"


def test_liftover_against_brute_force(spark):
    blocks = [(1, 0, 100, 1, 1000, "+"), (1, 100, 3 * BIN_WIDTH, 2, 50, "-"), (1, 4 * BIN_WIDTH, 4 * BIN_WIDTH + 10, 1, 7, "+")]
    rng = random.Random(1)
    places = [1, 99, 100, 101, BIN_WIDTH, BIN_WIDTH + 1, 3 * BIN_WIDTH, 3 * BIN_WIDTH + 1, 4 * BIN_WIDTH + 10] + \
             [rng.randint(1, 5 * BIN_WIDTH) for _ in range(200)]
    df = spark.createDataFrame([(1, p, "A", "C") for p in places], "chr int, pos bigint, ref string, alt string")
    chain = spark.createDataFrame(blocks, CHAIN)
    assert overlapping_blocks(chain).count() == 0
    for r in liftover(df, chain).collect():
        hit = [b for b in blocks if b[1] <= r.pos - 1 < b[2]]
        if not hit:
            assert r.lift_status == "NoTarget" and r.new_pos is None
            continue
        _, s, e, dc, ds, strand = hit[0]
        off = r.pos - 1 - s
        want = ds + (e - s - 1 - off if strand == "-" else off) + 1
        assert (r.lift_status, r.new_chr, r.new_pos) == ("OK", dc, want)
        assert (r.new_ref, r.new_alt) == (("T", "G") if strand == "-" else ("A", "C"))


def test_liftover_reference_check_and_swap(spark):
    chain = spark.createDataFrame([(1, 0, 100, 1, 0, "+"), (25, 0, 100, 25, 0, "+")], CHAIN)
    df = spark.createDataFrame(
        [(1, 10, "A", "C", 0.2, 1.0), (1, 11, "A", "C", 0.2, 1.0), (1, 12, "A", "C", 0.2, 1.0), (1, 100, "AT", "A", 0.2, 1.0),
         (25, 5, "A", "C", 0.2, 1.0)], "chr int, pos bigint, ref string, alt string, af_alt double, beta double")
    bases = spark.createDataFrame([(1, 10, "A"), (1, 11, "C"), (1, 12, "G"), (25, 5, "A")], "chr int, pos bigint, base string")
    out = liftover(df, chain, bases)
    status = {(r.chr, r.pos): r.lift_status for r in out.collect()}
    assert status == {(1, 10): "OK", (1, 11): "OK", (1, 12): "MismatchedRefAllele", (1, 100): "CrossesBlock", (25, 5): "OK"}
    rows = {r.b37_pos: r for r in rewrite_lifted(out).collect()}
    assert set(rows) == {10, 11}
    assert (rows[11].ref, rows[11].alt, rows[11].beta, rows[11].liftover_info) == ("C", "A", -1.0, "SwappedAlleles")
    assert rows[11].af_alt == pytest.approx(0.8)


def test_build_detection(spark):
    df = spark.createDataFrame([(0, 21, 10), (0, 21, 20), (1, 21, 30), (2, 21, 99), (3, 5, 10), (0, 5, 30)], "study_ord int, chr int, pos bigint")
    maps = spark.createDataFrame([("b37", 21, 10), ("b37", 21, 20), ("b38", 21, 20), ("b38", 21, 30), ("b37", 21, 30)],
                                 "build string, chr int, pos bigint")
    got = {r.study_ord: (r.n_b37, r.n_b38, r.build) for r in detect_build(df, maps).collect()}
    assert got == {0: (2, 1, "b37"), 1: (1, 1, "b38"), 2: (0, 0, None), 3: (0, 0, None)}
    with pytest.raises(Exception, match="has no row at a known position"):
        detect_build(df, maps, strict=True).collect()


def test_quality_filter(spark):
    good = ("01", "1e3", "A", "C", "0.2", "0.9", "0.1", "0.05", "0.5", "100")
    change = lambda i, v: tuple(v if j == i else x for j, x in enumerate(good))
    rows = [good, change(0, "MT"), change(8, "0"), change(6, "1e6"), change(4, "0.0005"), change(4, "0.9999"),
            change(5, "0.5"), change(2, ""), change(3, "NAA"), change(9, None), change(0, "chrX")]
    names = ["CHR", "POS", "Allele1", "Allele2", "AF_Allele2", "imputationInfo", "BETA", "SE", "p.value", "N"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    from sumweave.plans.munge import FORMATTED
    out = qc.qc_filter(df, FORMATTED).collect()
    assert [(r.chr, r.pos) for r in out] == [("1", 1000), ("23", 1000)]
    assert qc.qc_filter(df, FORMATTED, na_per_field=True).count() == 3
    with pytest.raises(ValueError):
        qc.qc_filter(df.drop("SE"), FORMATTED)


def test_square_gate(spark):
    report = spark.createDataFrame([(0, 5, True, False)], "study_ord int, n_after bigint, is_square boolean, enough_chroms boolean")
    with pytest.raises(Exception, match="fewer than 22 chromosomes"):
        qc.require_square(report).collect()


def test_dialects_refuse_unknown_and_incomplete(spark):
    df = spark.createDataFrame([("1",)], "CHR string")
    with pytest.raises(ValueError):
        normalize(df, "PLINK")
    for dialect in DIALECTS:
        with pytest.raises(ValueError):
            normalize(df, dialect)


def test_log10p_keeps_the_floor(spark):
    names = ["#CHROM", "POS", "ALLELE0", "ALLELE1", "A1FREQ", "INFO", "BETA", "SE", "LOG10P", "N"]
    df = spark.createDataFrame([("1",) * 8 + ("400", "5")], ", ".join(f"`{n}` string" for n in names))
    assert normalize(df, "PMBB").collect()[0]["p.value"] == 5e-324


def test_ranks_and_lambda_against_plain_sort(spark):
    rng = random.Random(2)
    # One value holds a third of the rows.
    ps = [0.3 if rng.random() < 0.33 else rng.random() for _ in range(3000)]
    df = spark.createDataFrame([("p", i % 25 + 1, i, p) for i, p in enumerate(ps)], "p_col string, chr int, pos bigint, pval double")
    ranked = qcdata.global_rank(df, "p_col", "pval", ["chr", "pos"]).collect()
    order = sorted(range(len(ps)), key=lambda i: (ps[i], i % 25 + 1, i))
    assert {r.pos: r.rank for r in ranked} == {i: k + 1 for k, i in enumerate(order)}
    from statistics import NormalDist
    chi = sorted(NormalDist().inv_cdf(p / 2) ** 2 for p in ps)
    got = {r.quantile: r["lambda"] for r in qcdata.lambda_gc(df).collect()}
    for q in qcdata.QUANTILES:
        h = (len(chi) - 1) * q
        lo = int(h)
        x = chi[lo] + (h - lo) * (chi[min(lo + 1, len(chi) - 1)] - chi[lo])
        assert got[q] == pytest.approx(x / NormalDist().inv_cdf((1 + q) / 2) ** 2, abs=6e-4)
    text = qcdata.lambda_text(qcdata.lambda_gc(df)).collect()[0].text
    assert text.startswith("0.7:") and len(text.split(" ")) == 5


def test_file_names(spark):
    names = ["gs://b/MVP_Li_NQ1.3_F2_ALL_ALL_EUR_10_20_SAIGE_20220411.txt.gz", "gs://b/MVP_Li_F2.zip",
             "gs://b/MVP_Li_NQ1.4_F2_ALL_ALL_EUR_10_20_SAIGE_20220411.txt.gz"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "uri string, seq int")
    assert [r.kind for r in manifest.classify_files(df).orderBy("seq").collect()] == ["results", "sampleinfo", "unrecognised"]


def test_rollup_routes():
    routes = {(t, s): (via, rank) for t, s, via, rank in cohorts._routes()}
    assert routes[("B2", "A1")][0] == ["A2"] or set(routes[("B2", "A1")][0]) >= {"A2"}
    assert [s for t, s, _, rank in sorted(cohorts._routes(), key=lambda r: r[3]) if t == "C2"] == ["C1", "B2", "B1", "A2", "A1"]


@pytest.mark.parametrize("both", [True, False])
def test_stored_panel_is_not_exchanged(spark, both):
    import os

    from sumweave.operators.harmonize import match_reference
    from sumweave.queries.munge import _stored

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, panel = _stored(spark, sf, both=both)
        df = match_reference(rows, None, stored=panel)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == (0 if both else 1) and "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert df.count() == rows.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
