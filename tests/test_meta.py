import math
import random

import pytest
from pyspark.sql import functions as F

from sumweave.operators.align import align_groups, align_studies, left_align, order_violations
from sumweave.operators.meta import meta, with_sizes
from sumweave.operators.render import to_wide

SCHEMA = ("study_ord int, chr int, pos bigint, ref string, alt string, af_alt double, info double, beta double, "
          "se double, pval double, n bigint, file_order bigint")
SIZES = "study_ord int, n_cases bigint, n_controls bigint"


def rows(spark, data):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], SCHEMA)


def sizes(spark, k):
    return spark.createDataFrame([(i, 100 * (i + 1), 1000 * (i + 1)) for i in range(k)], SIZES)


def row(study, ref, alt, beta=0.1, se=0.05, p=0.04, af=0.2, n=1000, pos=10, info=0.9):
    return (study, 1, pos, ref, alt, af, info, beta, se, p, n)


@pytest.mark.parametrize("spelling, sign", [(("A", "C"), 1), (("C", "A"), -1), (("T", "G"), 1), (("G", "T"), -1)])
def test_orientation_to_first_study(spark, spelling, sign):
    out = align_studies(rows(spark, [row(0, "A", "C"), row(1, *spelling, beta=0.3, af=0.1)])).orderBy("study_ord").collect()
    assert [(r.ref, r.alt) for r in out] == [("A", "C")] * 2
    assert out[1].beta == pytest.approx(0.3 * sign)
    assert out[1].af_alt == pytest.approx(0.1 if sign > 0 else 0.9)


def test_palindrome_matches_only_by_swap_and_turns(spark):
    out = align_studies(rows(spark, [row(0, "A", "T"), row(1, "T", "A", beta=0.3)])).orderBy("study_ord").collect()
    assert len(out) == 2 and out[1].beta == pytest.approx(-0.3)


def test_lower_case_and_non_sequence_alleles(spark):
    out = align_studies(rows(spark, [row(0, "a", "c"), row(1, "A", "C"), row(1, "I", "D"), row(0, "A", "<DEL>")]))
    assert out.count() == 2 and out.select("ref").distinct().collect()[0].ref == "A"


def greedy(data):
    """Brute force of the alignment rounds over rows (study, ref, alt, id) of one class."""
    left = list(data)
    seen, unique = set(), []
    for r in left:
        if r[:3] not in seen:
            seen.add(r[:3])
            unique.append(r)
    left, slots = unique, []
    while left:
        low = min(r[0] for r in left)
        anchor = next(r for r in left if r[0] == low)
        slot = []
        for s in sorted({r[0] for r in left}):
            mine = [r for r in left if r[0] == s]
            pick = next((r for r in mine if r[1:3] == anchor[1:3]), mine[0])
            slot.append(pick)
        left = [r for r in left if r not in slot]
        slots.append((anchor[1:3], tuple(r[3] for r in slot)))
    return slots


def test_rounds_match_brute_force(spark):
    rng = random.Random(7)
    spellings = [("A", "C"), ("C", "A"), ("T", "G"), ("G", "T")]
    data, expected = [], {}
    for pos in range(60):
        group = []
        for study in range(5):
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                ref, alt = rng.choice(spellings)
                group.append((study, ref, alt, len(data)))
                data.append(row(study, ref, alt, n=len(data), pos=pos))
        expected[pos] = greedy(group)
    out = align_groups(rows(spark, data)).collect()
    got = {}
    for r in out:
        got.setdefault(r.pos, {})[r.occ] = ((r.ref, r.alt), tuple(m.n for m in r.members))
    for pos, slots in expected.items():
        assert [got.get(pos, {})[i] for i in range(len(slots))] == slots
        assert len(got.get(pos, {})) == len(slots)


def test_hot_variant_keeps_one_row_per_study(spark):
    hot = spark.range(200_000).select(
        (F.col("id") % 3).cast("int").alias("study_ord"), F.lit(1).alias("chr"), F.lit(5).cast("bigint").alias("pos"),
        F.lit("A").alias("ref"), F.lit("C").alias("alt"), F.lit(0.2).alias("af_alt"), F.lit(0.9).alias("info"),
        (F.col("id") / 1e6).alias("beta"), F.lit(0.1).alias("se"), F.lit(0.5).alias("pval"),
        F.lit(10).cast("bigint").alias("n"), F.col("id").alias("file_order"))
    df = align_groups(hot)
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()
    (only,) = df.collect()
    assert [m.beta for m in only.members] == [0.0, 1e-6, 2e-6]


def reference_meta(study_rows, method):
    """Plain restatement of the three weightings; rows are (beta, se, p, af, info, n, cases, controls)."""
    from statistics import NormalDist
    w = wb = score = spread = 0.0
    for beta, se, p, af, info, n, ca, co in study_rows:
        z = -NormalDist().inv_cdf(p / 2)
        neff = 4 * ca * co / (ca + co)
        wi = {"inv_var": 1 / se**2, "n": math.sqrt(neff), "variance": z / se}[method]
        w += wi
        wb += wi * beta
        sign = (beta > 0) - (beta < 0)
        score += {"inv_var": wi * beta, "n": wi * sign * z, "variance": wi * sign}[method]
        spread += {"inv_var": wi, "n": neff, "variance": 1 / se**2}[method]
    return wb / w, math.erfc(abs(score) / math.sqrt(spread) / math.sqrt(2))


@pytest.fixture(scope="module")
def three(spark):
    data = [row(0, "A", "C", 0.1, 0.05, 0.0455, 0.2, 1000), row(1, "A", "C", 0.3, 0.1, 0.0027, 0.3, 2000),
            row(2, "A", "C", -0.05, 0.04, 0.2113, 0.25, 500)]
    return align_groups(with_sizes(rows(spark, data), sizes(spark, 3)))


def test_methods_and_families(spark, three):
    out = meta(three, ["inv_var", "n", "variance"], het=True, leave_one_out=True, leave_most_sig_out=True,
               pairwise_with_first=True, study_ords=[0, 1, 2]).collect()
    got = {(r.family, r.method): r for r in out}
    base = [(0.1, 0.05, 0.0455, 0.2, 0.9, 1000, 100, 1000), (0.3, 0.1, 0.0027, 0.3, 0.9, 2000, 200, 2000),
            (-0.05, 0.04, 0.2113, 0.25, 0.9, 500, 300, 3000)]
    sets = {"all": [0, 1, 2], "leave_0": [1, 2], "leave_1": [0, 2], "leave_2": [0, 1], "lmso": [0, 2],
            "pair_1": [0, 1], "pair_2": [0, 2]}
    for family, members in sets.items():
        for method in ("inv_var", "n", "variance"):
            beta, p = reference_meta([base[i] for i in members], method)
            r = got[(family, method)]
            assert r.beta == pytest.approx(beta) and r.pval == pytest.approx(p)
            assert (r.se is not None) == (method == "inv_var")
            assert r.n_cases == sum(base[i][6] for i in members)
    r = got[("all", "inv_var")]
    q = sum((b[0] - r.beta) ** 2 / b[1] ** 2 for b in base)
    assert r.het_p == pytest.approx(math.exp(-q / 2))
    assert r.n_eff == int(sum(c * (1 - c / (c + k)) for *_, c, k in base))
    assert r.af_alt == pytest.approx((200 + 600 + 125) / 3500) and r.n_samples == 3500
    assert got[("lmso", "inv_var")].left_out == 1


def test_single_pair_and_empty_families(spark):
    data = [row(0, "A", "C"), row(0, "A", "C", pos=20), row(1, "A", "C", 0.2, pos=20, p=0.04)]
    g = align_groups(with_sizes(rows(spark, data), sizes(spark, 2)))
    out = meta(g, het=True, leave_one_out=True, leave_most_sig_out=True, study_ords=[0, 1]).collect()
    got = {(r.pos, r.family): r for r in out}
    one = got[(10, "all")]
    assert (one.beta, one.se, one.pval, one.het_p, one.n_studies) == (0.1, 0.05, 0.04, None, 1)
    assert got[(10, "leave_0")].beta is None and got[(10, "leave_0")].n_samples == 0
    assert got[(10, "leave_1")].beta == 0.1
    assert got[(10, "lmso")].beta is None and got[(10, "lmso")].n_samples is None
    tie = got[(20, "lmso")]
    assert tie.left_out == 0 and tie.beta == 0.2 and tie.n_studies == 1


@pytest.mark.parametrize("change", [{"se": 0.0}, {"se": None}, {"n": 0}, {"n": None}, {"beta": None}])
def test_missing_values_void_the_whole_result(spark, change):
    g = align_groups(with_sizes(rows(spark, [row(0, "A", "C"), row(1, "A", "C", **change)]), sizes(spark, 2)))
    (r,) = meta(g).collect()
    assert r.beta is None and r.pval is None and r.n_cases is None and r.n_studies == 2


def test_invariances(spark):
    rng = random.Random(3)
    turns = [lambda r, a: (r, a, 1), lambda r, a: (a, r, -1)]
    plain, turned = [], []
    for pos in range(30):
        for s in range(4):
            b, se, af = rng.gauss(0, 0.1), rng.uniform(0.02, 0.2), rng.uniform(0.05, 0.95)
            plain.append(row(s, "A", "G", b, se, 0.5, af, pos=pos))
            ref, alt, sign = turns[rng.random() < 0.5 if s else 0]("A", "G")
            turned.append(row(s, ref, alt, b * sign, se, 0.5, af if sign > 0 else 1 - af, pos=pos))
    k = sizes(spark, 4)
    left = {r.pos: r for r in meta(align_groups(with_sizes(rows(spark, plain), k)), het=True).collect()}
    right = {r.pos: r for r in meta(align_groups(with_sizes(rows(spark, turned), k)), het=True).collect()}
    for pos, r in left.items():
        for field in ("beta", "se", "pval", "af_alt", "het_p"):
            assert getattr(right[pos], field) == pytest.approx(getattr(r, field))


def test_equal_effects_have_no_heterogeneity(spark):
    g = align_groups(with_sizes(rows(spark, [row(s, "A", "C", 0.25, 0.5) for s in range(3)]), sizes(spark, 3)))
    (r,) = meta(g, het=True).collect()
    assert r.het_p == pytest.approx(1.0)


def test_wide_columns(spark, three):
    options = {"het": True, "leave_one_out": True, "leave_most_sig_out": True, "pairwise_with_first": True}
    res = meta(three, study_ords=[0, 1, 2], keep=["members"], **options)
    wide = to_wide(res, [(0, "A"), (1, "B"), (2, "C")], ["inv_var"], **options)
    assert wide.columns[:11] == ["#CHR", "POS", "REF", "ALT", "SNP", "A_beta", "A_sebeta", "A_pval", "A_af_alt", "A_INFO",
                                 "A_Nsamples"]
    assert len(wide.columns) == 5 + 18 + 2 * 9 + 2 + 9 + 2 + 9 + 3 * 10
    (r,) = wide.collect()
    assert r["lmso_meta_removed_study_name"] == "B" and r["all_meta_Nstudies"] == 3
    assert r["B_beta"] == 0.3 and r["leave_B_Nsamples"] == 1500
    assert r["A_B_inv_var_meta_Ncases"] == 300


def test_left_align_and_order(spark):
    left = rows(spark, [row(0, "A", "C"), row(0, "A", "G", pos=20)])
    out = {r.pos: r.match_beta for r in left_align(left, rows(spark, [row(1, "C", "A", 0.3), row(1, "T", "G", 0.9)])).collect()}
    assert out == {10: pytest.approx(-0.3), 20: None}
    bad = rows(spark, [row(0, "A", "C", pos=p) for p in (1, 5, 3, 9, 8)]).withColumn("block", F.expr("file_order div 2"))
    for block in (None, "block"):
        (r,) = order_violations(bad, block=block).collect()
        assert (r.n_rows, r.n_violations) == (5, 2)


def test_unknown_method_and_missing_columns(spark, three):
    with pytest.raises(ValueError):
        meta(three, ["fisher"])
    with pytest.raises(ValueError):
        meta(align_groups(rows(spark, [row(0, "A", "C")]).drop("se")))


def test_subsets_beyond_one_word(spark):
    from sumweave.operators.meta import subset_table

    k = sizes(spark, 3)
    rules = {f"s{i}": F.col("study_ord") == i % 3 if i < 69 else F.col("study_ord") < 2 for i in range(70)}
    g = align_groups(with_sizes(rows(spark, [row(s, "A", "C", 0.1 * s) for s in range(3)]), k)
                     .join(subset_table(k, rules), "study_ord"))
    out = {r.family: r for r in meta(g, subsets=list(rules), everything=False).collect()}
    assert len(out) == 70 and out["subset_s65"].beta == pytest.approx(0.2) and out["subset_s65"].n_studies == 1
    assert out["subset_s69"].beta == pytest.approx(0.05) and out["subset_s69"].n_studies == 2


def test_wide_table_needs_no_shuffle_after_the_alignment(spark):
    from sumweave.queries import meta as queries

    plan = queries.wide(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    # Of the rows: one for duplicates, one for the alignment. The third and fourth make the study list.
    assert plan.count("Exchange hashpartitioning(pos") == 2
    assert "Exchange hashpartitioning(chr" not in plan


def test_queries_return_the_wide_table_in_full(spark):
    from sumweave.operators import annotate
    from sumweave.queries import ORACLE, QUERIES, meta as queries

    sf = "/root/testdata/sf0.001"
    whole = queries.wide(spark, sf)
    got = QUERIES["wide_table"](spark, sf).columns
    assert len(got) == len(whole.columns) == 5 + 6 * 6 + 2 + 9 + 2 + 9 + 6 * 10
    assert {"all_inv_var_meta_beta", "all_inv_var_meta_mlog10p", "all_inv_var_het_p", "lmso_inv_var_meta_beta", "leave_S5_SAS_inv_var_meta_het_p"} <= set(got)
    kept = annotate.post_filter(whole.withColumn("rsid", F.lit("NA"))).columns
    assert len(QUERIES["wide_post_filter"](spark, sf).columns) == len(kept) == 6 + 2 + 9 + 2 + 9
    assert {"wide_table", "wide_post_filter"} <= set(ORACLE)


def test_leave_one_out_of_many_studies(spark):
    """Fifty studies against sums taken one by one; one study lacks a value."""
    import random

    rng = random.Random(8)
    base = [dict(study=o, beta=rng.gauss(0, .3), se=rng.uniform(.01, 2), n=rng.randint(50, 9000), p=rng.random()) for o in range(50)]
    table = lambda: with_sizes(rows(spark, [row(ref="A", alt="C", **b) for b in base]), sizes(spark, 50))
    g = align_groups(table())
    df = meta(g, het=True, leave_one_out=True, leave_most_sig_out=True, study_ords=list(range(51)))
    got = {r.family: r for r in df.collect()}
    least = min(base, key=lambda r: r["p"])["study"]
    for label, out in [("all", None), ("lmso", least), *((f"leave_{o}", o) for o in range(51))]:
        kept = [r for r in base if r["study"] != out]
        w = [1 / r["se"] ** 2 for r in kept]
        beta = sum(x * r["beta"] for x, r in zip(w, kept)) / sum(w)
        q = sum(x * (r["beta"] - beta) ** 2 for x, r in zip(w, kept))
        r = got[label]
        assert r.n_studies == len(kept) and r.n_samples == sum(k["n"] for k in kept)
        assert r.beta == pytest.approx(beta, rel=1e-12) and r.se == pytest.approx(sum(w) ** -.5, rel=1e-12)
        assert r.het_p == pytest.approx(brute_chi2(q, len(kept) - 1), rel=1e-7, abs=1e-12)
    # No array of the studies' rows per family: families carry sums.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "array<array" not in df.schema.simpleString() and "members" not in plan.split("Generate explode")[0]
    base[7]["se"] = None
    g = align_groups(table())
    got = {r.family: r for r in meta(g, het=True, leave_one_out=True, study_ords=list(range(50))).collect()}
    assert got["all"].beta is None and got["leave_6"].beta is None and got["leave_7"].beta is not None and got["leave_7"].het_p is not None


def brute_chi2(q, df):
    """Upper tail by a sum over the density."""
    import math

    import numpy as np

    x = np.linspace(0, q, 400_001)[1:]
    log = (df / 2 - 1) * np.log(x) - x / 2 - df / 2 * math.log(2) - math.lgamma(df / 2)
    density = np.exp(log)
    h = q / 400_000
    return 1 - h * (density.sum() - density[-1] / 2)
