"""Alignment and meta-analysis queries."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumweave.functions import alleles, numeric, values
from sumweave.operators import align as al
from sumweave.operators import annotate, manifest, meta as mt, render
from sumweave.plans import meta as plan
from sumweave.queries import fixtures as fx
from sumweave.queries.base import (
    key_sql, mlog10, query, reversed_sql, rnd, sql_chi2, sql_mlog10, sql_p, sql_rnd, sql_z,
)
from sumweave.session import scratch_path
from sumweave.sources.config import parse_config

KEY = ["chr", "pos", "ref", "alt", "occ"]
KEYS = ", ".join(KEY)
STUDIES = [(o, f"S{o}_{a}") for o, a in enumerate(fx.ANCESTRIES)]


def groups(spark, sf) -> DataFrame:
    return al.align_groups(mt.with_sizes(fx.munged(spark, sf), fx.study(spark, sf)))


def results(spark, sf, methods: Sequence[str] = ("inv_var",), **options) -> DataFrame:
    return mt.meta(groups(spark, sf), methods, study_ords=fx.STUDY_ORDS, **options)


def shown(df: DataFrame, *extra: str) -> DataFrame:
    """Key, counts and rounded statistics."""
    return df.select(*KEY, *extra, F.col("n_studies").cast("bigint").alias("n_studies"), "n_samples",
                     rnd("beta").alias("beta"), rnd("se").alias("se"), mlog10("pval").alias("mlog10p"))


# SQL of a family's results: `fam` has one row per member study, `label` names its family columns.

def sql_sums(source: str, label: str = "") -> str:
    by = KEYS + (", " + label if label else "")
    return f"""
        SELECT {by}, count(*) AS k, sum(n)::BIGINT AS n_samples, sum(1/(se*se)) AS w, sum(beta/(se*se)) AS wb,
          sum(af_alt*n)/sum(n) AS af, sum(info*n)/sum(n) AS info, sum(n_cases)::BIGINT AS n_cases, sum(n_controls)::BIGINT AS n_controls,
          trunc(sum(n_cases*(1-n_cases/(n_cases+n_controls)::DOUBLE)))::BIGINT AS n_eff,
          any_value(beta) AS b1, any_value(se) AS se1, any_value(pval) AS p1
        FROM {source} GROUP BY {by}"""


def sql_shown(label: str = "", k: str = "k") -> str:
    by = KEYS + (", " + label if label else "")
    return f"""
        SELECT {by}, {k} AS n_studies, n_samples, {sql_rnd('CASE WHEN k > 1 THEN wb/w ELSE b1 END')} AS beta,
          {sql_rnd('CASE WHEN k > 1 THEN sqrt(1/w) ELSE se1 END')} AS se,
          {sql_mlog10(f"CASE WHEN k > 1 THEN {sql_p('z')} ELSE p1 END")} AS mlog10p
        FROM (SELECT *, wb/sqrt(w) AS z FROM sums)"""


@query("align_studies", f"""
    SELECT {KEYS}, study_ord, {sql_rnd('beta')} AS beta, {sql_rnd('af_alt')} AS af_alt, se, n FROM aligned""", ("aligned",))
def align_studies(spark, sf):
    df = al.align_studies(fx.munged(spark, sf))
    return df.select(*KEY, "study_ord", rnd("beta").alias("beta"), rnd("af_alt").alias("af_alt"), "se", "n")


@query("left_align", f"""
    SELECT l.chr, l.pos, l.ref, l.alt, {sql_rnd(f"CASE WHEN {reversed_sql('m.ref', 'm.alt', 'l.ref', 'l.alt')} THEN 0-m.beta ELSE m.beta END")} AS match_beta,
      {sql_rnd(f"CASE WHEN {reversed_sql('m.ref', 'm.alt', 'l.ref', 'l.alt')} THEN 1-m.af_alt ELSE m.af_alt END")} AS match_af
    FROM (SELECT * FROM keyed WHERE study_ord = 0) l LEFT JOIN
      (SELECT * FROM keyed WHERE study_ord = 1 QUALIFY row_number() OVER (PARTITION BY chr, pos, k ORDER BY ford) = 1) m
      ON l.chr = m.chr AND l.pos = m.pos AND l.k = m.k""", ("keyed",))
def left_align(spark, sf):
    rows = fx.munged(spark, sf)
    left = al.dedup_first(rows.filter("study_ord = 0"))
    out = al.left_align(left, rows.filter("study_ord = 1"))
    return out.select("chr", "pos", "ref", "alt", rnd("match_beta").alias("match_beta"), rnd("match_af").alias("match_af"))


@query("dedup_first", "SELECT study_ord, chr, pos, ref, alt, beta, se, n FROM dedup", ("dedup",))
def dedup_first(spark, sf):
    return al.dedup_first(fx.munged(spark, sf)).select("study_ord", "chr", "pos", "ref", "alt", "beta", "se", "n")


@query("meta_inv_var", f"WITH sums AS ({sql_sums('aligned')}) {sql_shown()}", ("aligned",))
def meta_inv_var(spark, sf):
    return shown(results(spark, sf))


def _score_sql(w: str, score: str, spread: str) -> str:
    return f"""
    WITH m AS (SELECT *, {sql_z('pval')} AS z, 4.0*n_cases*n_controls/(n_cases+n_controls) AS neff FROM aligned),
    s AS (SELECT {KEYS}, count(*) AS k, sum(n)::BIGINT AS n_samples, sum({w}) AS w, sum({w}*beta) AS wb, sum({score}) AS score,
      sum({spread}) AS spread, any_value(beta) AS b1, any_value(se) AS se1, any_value(pval) AS p1 FROM m GROUP BY {KEYS})
    SELECT {KEYS}, k AS n_studies, n_samples, {sql_rnd('CASE WHEN k > 1 THEN wb/w ELSE b1 END')} AS beta,
      {sql_rnd('CASE WHEN k = 1 THEN se1 END')} AS se,
      {sql_mlog10(f"CASE WHEN k > 1 THEN {sql_p('zz')} ELSE p1 END")} AS mlog10p
    FROM (SELECT *, score/sqrt(spread) AS zz FROM s)"""


@query("meta_n", _score_sql("sqrt(neff)", "sqrt(neff)*sign(beta)*z", "neff"), ("aligned",))
def meta_n(spark, sf):
    return shown(results(spark, sf, ["n"]))


@query("meta_variance", _score_sql("z/se", "z/se*sign(beta)", "1/(se*se)"), ("aligned",))
def meta_variance(spark, sf):
    return shown(results(spark, sf, ["variance"]))


@query("het_test", f"""
    WITH s AS ({sql_sums('aligned')}),
    q AS (SELECT {', '.join('a.' + k for k in KEY)}, any_value(s.k) AS k,
      sum(1/(a.se*a.se)*(a.beta - s.wb/s.w)*(a.beta - s.wb/s.w)) AS q FROM aligned a JOIN s USING ({KEYS}) GROUP BY {', '.join('a.' + k for k in KEY)})
    SELECT {KEYS}, k AS n_studies, {sql_rnd(f"CASE WHEN k > 1 THEN {sql_chi2('q', '(k-1)')} END")} AS het_p FROM q""", ("aligned",))
def het_test(spark, sf):
    df = results(spark, sf, het=True)
    return df.select(*KEY, F.col("n_studies").cast("bigint").alias("n_studies"), rnd("het_p").alias("het_p"))


@query("meta_counts", f"""
    WITH s AS ({sql_sums('aligned')})
    SELECT {KEYS}, k AS n_studies, n_samples, n_cases, n_controls, n_eff FROM s""", ("aligned",))
def meta_counts(spark, sf):
    return results(spark, sf).select(*KEY, F.col("n_studies").cast("bigint").alias("n_studies"), "n_samples",
                                     "n_cases", "n_controls", "n_eff")


@query("weighted_af_info", f"""
    WITH s AS ({sql_sums('aligned')}) SELECT {KEYS}, {sql_rnd('af')} AS af_alt, {sql_rnd('info')} AS info FROM s""", ("aligned",))
def weighted_af_info(spark, sf):
    return results(spark, sf).select(*KEY, rnd("af_alt").alias("af_alt"), rnd("info").alias("info"))


@query("meta_single", f"""
    SELECT {KEYS}, {sql_rnd('any_value(beta)')} AS beta, {sql_rnd('any_value(se)')} AS se, {sql_mlog10('any_value(pval)')} AS mlog10p,
      any_value(n_cases) AS n_cases, any_value(n_controls) AS n_controls FROM aligned GROUP BY {KEYS} HAVING count(*) = 1""", ("aligned",))
def meta_single(spark, sf):
    return results(spark, sf).filter("n_studies = 1").select(
        *KEY, rnd("beta").alias("beta"), rnd("se").alias("se"), mlog10("pval").alias("mlog10p"), "n_cases", "n_controls")


_VARIANTS = f"(SELECT DISTINCT {KEYS} FROM aligned)"


@query("leave_one_out", f"""
    WITH fam AS (SELECT a.*, l.study_ord AS left_out FROM aligned a JOIN fx_study l ON a.study_ord <> l.study_ord),
    sums AS ({sql_sums('fam', 'left_out')}),
    res AS ({sql_shown('left_out')})
    SELECT {', '.join('v.' + k for k in KEY)}, s.study_ord AS left_out, coalesce(n_studies, 0) AS n_studies, coalesce(n_samples, 0) AS n_samples,
      beta, se, mlog10p FROM {_VARIANTS} v JOIN fx_study s ON true
    LEFT JOIN res r ON {' AND '.join(f'v.{k} = r.{k}' for k in KEY)} AND r.left_out = s.study_ord""", ("aligned", "fx_study"))
def leave_one_out(spark, sf):
    return shown(results(spark, sf, leave_one_out=True, everything=False), "left_out")


@query("leave_most_sig_out", f"""
    WITH top AS (SELECT {KEYS}, arg_min(study_ord, (pval, study_ord)) AS o, arg_min(study, (pval, study_ord)) AS study, count(*) AS kk
                 FROM aligned GROUP BY {KEYS}),
    fam AS (SELECT a.* FROM aligned a JOIN top t USING ({KEYS}) WHERE a.study_ord <> t.o),
    sums AS ({sql_sums('fam')}), res AS ({sql_shown()})
    SELECT {', '.join('t.' + k for k in KEY)}, CASE WHEN kk > 1 THEN t.o END AS left_out, coalesce(n_studies, 0) AS n_studies,
      n_samples, beta, se, mlog10p FROM top t LEFT JOIN res r ON {' AND '.join(f't.{k} = r.{k}' for k in KEY)}""", ("aligned",))
def leave_most_sig_out(spark, sf):
    return shown(results(spark, sf, leave_most_sig_out=True, everything=False), "left_out")


@query("pairwise_first", f"""
    WITH fam AS (SELECT a.*, o.study_ord AS other FROM aligned a
        JOIN (SELECT {KEYS}, study_ord FROM aligned WHERE study_ord > 0) o USING ({KEYS})
        WHERE a.study_ord IN (0, o.study_ord)),
    sums AS ({sql_sums('fam', 'other')}), res AS ({sql_shown('other')})
    SELECT {', '.join('v.' + k for k in KEY)}, 'pair_' || s.study_ord AS family, beta, se, mlog10p
    FROM {_VARIANTS} v JOIN (SELECT * FROM fx_study WHERE study_ord > 0) s ON true
    LEFT JOIN (SELECT * FROM res WHERE n_studies = 2) r ON {' AND '.join(f'v.{k} = r.{k}' for k in KEY)} AND r.other = s.study_ord""",
       ("aligned", "fx_study"))
def pairwise_first(spark, sf):
    df = results(spark, sf, pairwise_with_first=True, everything=False)
    return df.select(*KEY, "family", rnd("beta").alias("beta"), rnd("se").alias("se"), mlog10("pval").alias("mlog10p"))


_SUBSET_SQL = """(SELECT study_ord, unnest(CASE WHEN study LIKE '%\\_EUR' ESCAPE '\\' OR study LIKE '%\\_FIN' ESCAPE '\\' THEN
    ['all','leave_ukbb','leave_genomicc','leave_23andme','leave_ukbb_23andme','leave_prs','eur','eur_leave_23andme','eur_leave_ukbb','eur_leave_ukbb_23andme']
    WHEN study LIKE '%\\_AFR' ESCAPE '\\' THEN ['all','leave_ukbb','leave_genomicc','leave_23andme','leave_ukbb_23andme','leave_prs','admixed','admixed_leave_23andme','afr','afr_leave_23andme']
    WHEN study LIKE '%AMR' THEN ['all','leave_ukbb','leave_genomicc','leave_23andme','leave_ukbb_23andme','leave_prs','admixed','admixed_leave_23andme','his','his_leave_23andme']
    WHEN study LIKE '%\\_EAS' ESCAPE '\\' THEN ['all','leave_ukbb','leave_genomicc','leave_23andme','leave_ukbb_23andme','leave_prs','eas']
    ELSE ['all','leave_ukbb','leave_genomicc','leave_23andme','leave_ukbb_23andme','leave_prs'] END) AS subset_id FROM fx_study)"""


@query("meta_by_subset", f"""
    WITH fam AS (SELECT a.*, 'subset_' || u.subset_id AS family FROM aligned a JOIN {_SUBSET_SQL} u USING (study_ord)),
    sums AS ({sql_sums('fam', 'family')}) {sql_shown('family')}""", ("aligned", "fx_study"))
def meta_by_subset(spark, sf):
    study = fx.study(spark, sf)
    rules = mt.standard_subsets(F.col("study"))
    rows = mt.with_sizes(fx.munged(spark, sf), study).join(mt.subset_table(study, rules), "study_ord")
    return shown(mt.meta(al.align_groups(rows), subsets=list(rules), everything=False), "family")


# Two phenotypes that share files, with cohorts that every exclusion rule meets, from files on disk.

COHORTS = ["UKBB_EUR", "GENOMICC_AFR", "23andMe_AMR", "BelCovid_FIN", "CHULA_EAS", "Egypt_hgCOVID_AFR"]
PHENOS = {"P1": [0, 1, 2, 3], "P2": [4, 5, 0, 2]}
# The subsets of each cohort, written out by hand.
_IN_SUBSETS = {
    0: "all leave_genomicc leave_23andme leave_prs eur eur_leave_23andme",
    1: "all leave_ukbb leave_23andme leave_ukbb_23andme leave_prs admixed admixed_leave_23andme afr afr_leave_23andme",
    2: "all leave_ukbb leave_genomicc leave_prs admixed his",
    3: "all leave_ukbb leave_genomicc leave_23andme leave_ukbb_23andme eur eur_leave_23andme eur_leave_ukbb eur_leave_ukbb_23andme",
    4: "all leave_ukbb leave_genomicc leave_23andme leave_ukbb_23andme leave_prs",
    5: "all leave_ukbb leave_genomicc leave_23andme leave_ukbb_23andme leave_prs",
}
_MEMBERS = ", ".join(f"('{p}', {o}, {i}, '{COHORTS[o]}', {200 * (o + 1)}, {2000 * (o + 1) + 17})" for p, os in PHENOS.items() for i, o in enumerate(os))
_FAMILIES = ", ".join(f"({o}, '{name}')" for o, names in _IN_SUBSETS.items() for name in names.split())


def _pheno_ctes() -> str:
    """Alignment by phenotype, round by round, in each phenotype's own order of studies."""
    out = f"""mem(pheno, study_ord, place, study, n_cases, n_controls) AS (VALUES {_MEMBERS}),
    p0 AS MATERIALIZED (SELECT k.* EXCLUDE (study_ord), pheno, place AS study_ord, mem.study_ord AS cohort, mem.study, mem.n_cases, mem.n_controls
      FROM keyed k JOIN mem USING (study_ord))"""
    for r in range(4):
        out += f""",
    t{r} AS MATERIALIZED (SELECT p.* EXCLUDE (rn), {r} AS occ FROM (SELECT r.*, a.aref, a.aalt, row_number() OVER (PARTITION BY r.pheno, r.chr, r.pos, r.k, r.study_ord
        ORDER BY (CASE WHEN r.ref = a.aref AND r.alt = a.aalt THEN 0 ELSE 1 END), r.ford) AS rn FROM p{r} r JOIN (
          SELECT pheno, chr, pos, k, arg_min(ref, (study_ord, ford)) AS aref, arg_min(alt, (study_ord, ford)) AS aalt FROM p{r} GROUP BY ALL) a
        ON r.pheno = a.pheno AND r.chr = a.chr AND r.pos = a.pos AND r.k = a.k) p WHERE rn = 1),
    p{r + 1} AS MATERIALIZED (SELECT * FROM p{r} s WHERE NOT EXISTS (SELECT 1 FROM t{r} p WHERE p.ford = s.ford AND p.pheno = s.pheno))"""
    union = " UNION ALL ".join(f"SELECT * FROM t{r}" for r in range(4))
    return out + f""",
    al AS MATERIALIZED (SELECT pheno, chr, pos, aref AS ref, aalt AS alt, occ, cohort, study, CASE WHEN flip THEN 0 - beta ELSE beta END AS beta,
        se, pval, n, n_cases, n_controls FROM (SELECT *, {reversed_sql('ref', 'alt', 'aref', 'aalt')} AS flip FROM ({union})))"""


@query("meta_phenos", f"""
    WITH {_pheno_ctes()}, sub(cohort, name) AS (VALUES {_FAMILIES}),
    fam AS (SELECT *, 'all' AS family, NULL AS left_study FROM al
      UNION ALL SELECT al.*, 'subset_' || name, NULL FROM al JOIN sub USING (cohort)
      UNION ALL SELECT al.*, 'leave', o.study FROM al JOIN mem o ON al.pheno = o.pheno AND al.study <> o.study),
    s AS (SELECT pheno, {KEYS}, family, left_study, count(*) AS k, sum(n)::BIGINT AS n_samples, sum(1/(se*se)) AS w, sum(beta/(se*se)) AS wb,
        any_value(beta) AS b1, any_value(se) AS se1, any_value(pval) AS p1 FROM fam GROUP BY ALL)
    SELECT pheno, {KEYS}, family, left_study, k AS n_studies, n_samples, {sql_rnd('CASE WHEN k > 1 THEN wb/w ELSE b1 END')} AS beta,
      {sql_rnd('CASE WHEN k > 1 THEN sqrt(1/w) ELSE se1 END')} AS se, {sql_mlog10(f"CASE WHEN k > 1 THEN {sql_p('z')} ELSE p1 END")} AS mlog10p
    FROM (SELECT *, wb/sqrt(w) AS z FROM s)""", ("keyed",))
def meta_phenos(spark, sf):
    path = scratch_path(spark, "studies")
    columns = {"chr": "CHR", "pos": "POS", "ref": "REF", "alt": "ALT", "af_alt": "af_alt", "info": "imputationInfo", "beta": "beta", "se": "sebeta",
               "pval": "pval", "n": "N"}
    rows = fx.munged(spark, sf).repartitionByRange("study_ord", "file_order").sortWithinPartitions("study_ord", "file_order")
    rows.select("study_ord", *[F.col(c).alias(name) for c, name in columns.items()]).write.partitionBy("study_ord").csv(path, sep="\t", header=True)
    entry = {**manifest.CONFIG_COLUMNS, "chr": "CHR", "effect_type": "beta"}
    configs = {p: parse_config(json.dumps({"meta": [
        {**entry, "name": COHORTS[o], "file": f"{path}/study_ord={o}", "n_cases": 200 * (o + 1), "n_controls": 2000 * (o + 1) + 17} for o in os]}))
        for p, os in PHENOS.items()}
    out = plan.run_metas(spark, configs, rules=mt.standard_subsets, leave_one_out=True)
    stored = scratch_path(spark, "metas")
    plan.write_metas(out, stored)
    back = spark.read.parquet(stored).filter("n_studies > 0")
    label = F.when(F.col("left_study").isNotNull(), "leave").otherwise(F.col("family"))
    return back.select("pheno", *KEY, label.alias("family"), "left_study", F.col("n_studies").cast("bigint").alias("n_studies"), "n_samples",
                       rnd("beta").alias("beta"), rnd("se").alias("se"), mlog10("pval").alias("mlog10p"))


@query("extra_cols", f"""
    SELECT {KEYS}, {", ".join(f"max(CASE WHEN p.study_ord = {o} THEN x END) AS {name}_x" for o, name in STUDIES)}
    FROM (SELECT chr, pos, aref AS ref, aalt AS alt, occ, study_ord, 'r' || n AS x FROM
      (SELECT * FROM pick0 UNION ALL SELECT * FROM pick1 UNION ALL SELECT * FROM pick2 UNION ALL SELECT * FROM pick3)) p
    GROUP BY {KEYS}""", ("pick0", "pick1", "pick2", "pick3"))
def extra_cols(spark, sf):
    rows = fx.munged(spark, sf).withColumn("x", F.concat(F.lit("r"), F.col("n").cast("string")))
    g = al.align_groups(rows)
    one = lambda o: F.get(F.filter("members", lambda m: m["study_ord"] == o), 0)["x"]
    return g.select(*KEY, *[one(o).alias(f"{name}_x") for o, name in STUDIES])


def wide(spark, sf) -> DataFrame:
    g = groups(spark, sf)
    options = {"het": True, "leave_one_out": True, "leave_most_sig_out": True}
    res = mt.meta(g, study_ords=fx.STUDY_ORDS, keep=["members"], **options)
    return render.to_wide(res, STUDIES, ["inv_var"], **options)


def _sci(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'NA' ELSE regexp_replace(format('{{:.3e}}', {x}), '0+e', 'e') END"


@query("render_wide", f"""
    WITH s AS ({sql_sums('aligned')})
    SELECT chr::VARCHAR AS "#CHR", pos::VARCHAR AS POS, ref AS REF, alt AS ALT, chr||':'||pos||':'||ref||':'||alt AS SNP,
      coalesce(max(CASE WHEN study_ord = 0 THEN n END)::VARCHAR, 'NA') AS S0_EUR_Nsamples,
      coalesce(max(CASE WHEN study_ord = 4 THEN n END)::VARCHAR, 'NA') AS S4_AMR_Nsamples,
      (sum(n) - coalesce(max(CASE WHEN study_ord = 4 THEN n END), 0))::BIGINT::VARCHAR AS leave_S4_AMR_Nsamples,
      {_sci('max(CASE WHEN study_ord = 0 THEN se END)')} AS S0_EUR_sebeta,
      count(*)::VARCHAR AS all_meta_Nstudies, sum(n)::BIGINT::VARCHAR AS all_meta_Nsamples,
      any_value(n_cases)::VARCHAR AS all_inv_var_meta_Ncases
    FROM (SELECT a.* EXCLUDE (n_cases), s.n_cases FROM aligned a JOIN s USING ({KEYS})) GROUP BY {KEYS}""", ("aligned",))
def render_wide(spark, sf):
    text = render.render(wide(spark, sf), precision=3)
    return text.select("#CHR", "POS", "REF", "ALT", "SNP", "S0_EUR_Nsamples", "S4_AMR_Nsamples",
                       "leave_S4_AMR_Nsamples", "S0_EUR_sebeta", "all_meta_Nstudies",
                       "all_meta_Nsamples", "all_inv_var_meta_Ncases")


_ALL_SQL = f"""all_res AS (SELECT *, chr||':'||pos||':'||ref||':'||alt AS snp, wb/w AS beta_meta, wb/sqrt(w) AS z FROM ({sql_sums('aligned')}))"""


@query("post_filter", f"""
    WITH {_ALL_SQL}, sites AS (SELECT chr, pos, ref, unnest(string_split(alt_list, ',')) AS alt, id, seq FROM fx_rsid),
    ids AS (SELECT chr, pos, ref, alt, arg_min(id, seq) AS id FROM sites GROUP BY ALL)
    SELECT a.chr AS "#CHR", a.pos AS POS, a.ref AS REF, a.alt AS ALT, snp AS SNP, coalesce(id, 'NA') AS RSID, k AS all_meta_Nstudies,
      n_samples AS all_meta_Nsamples, {sql_rnd('beta_meta')} AS all_inv_var_meta_beta, n_eff AS all_inv_var_meta_Neffective
    FROM all_res a LEFT JOIN ids i ON a.chr = i.chr AND a.pos = i.pos AND a.ref = i.ref AND a.alt = i.alt WHERE k > 1""",
       ("aligned", "fx_rsid"))
def post_filter(spark, sf):
    table = wide(spark, sf).withColumnsRenamed({"#CHR": "chr", "POS": "pos", "REF": "ref", "ALT": "alt"})
    named = annotate.add_rsids(table, fx.rsid(spark, sf)).withColumnsRenamed(
        {"chr": "#CHR", "pos": "POS", "ref": "REF", "alt": "ALT"})
    return annotate.post_filter(named).select(
        "#CHR", "POS", "REF", "ALT", "SNP", "RSID", "all_meta_Nstudies", "all_meta_Nsamples",
        rnd("all_inv_var_meta_beta").alias("all_inv_var_meta_beta"), "all_inv_var_meta_Neffective")


# The wide table in full: each family's results as columns, every one of them compared.

_WIDE_CELLS = f"""top AS (SELECT {KEYS}, arg_min(study_ord, (pval, study_ord)) AS o, count(*) AS kk FROM aligned GROUP BY {KEYS}),
    fam AS (
      SELECT 'all' AS family, a.* FROM aligned a
      UNION ALL SELECT 'lmso', a.* FROM aligned a JOIN top t USING ({KEYS}) WHERE a.study_ord <> t.o
      UNION ALL SELECT 'leave_' || l.study_ord, a.* FROM aligned a JOIN fx_study l ON a.study_ord <> l.study_ord),
    sums AS ({sql_sums('fam', 'family')}),
    q AS (SELECT {', '.join('f.' + k for k in KEY)}, f.family, sum(1/(f.se*f.se)*(f.beta - s.wb/s.w)*(f.beta - s.wb/s.w)) AS q
      FROM fam f JOIN sums s USING ({KEYS}, family) GROUP BY {', '.join('f.' + k for k in KEY)}, f.family),
    cells AS (SELECT {KEYS}, family, k, n_samples, n_cases, n_controls, n_eff, {sql_rnd('af')} AS af, {sql_rnd('info')} AS info,
        {sql_rnd('CASE WHEN k > 1 THEN wb/w ELSE b1 END')} AS beta, {sql_rnd('CASE WHEN k > 1 THEN sqrt(1/w) ELSE se1 END')} AS se,
        {sql_mlog10(f"CASE WHEN k > 1 THEN {sql_p('z')} ELSE p1 END")} AS mlog10p,
        {sql_rnd(f"CASE WHEN k > 1 THEN {sql_chi2('q', '(k-1)')} END")} AS het
      FROM (SELECT *, wb/sqrt(w) AS z FROM sums JOIN q USING ({KEYS}, family))),
    own AS (SELECT {KEYS}, {', '.join(
        f'max(CASE WHEN study_ord = {o} THEN {value} END) AS "{name}_{column}"' for o, name in STUDIES for column, value in [
            ('beta', sql_rnd('beta')), ('sebeta', sql_rnd('se')), ('mlog10p', sql_mlog10('pval')), ('af_alt', sql_rnd('af_alt')),
            ('INFO', sql_rnd('info')), ('Nsamples', 'n')])} FROM aligned GROUP BY {KEYS})"""


def _cells_sql(family: str, prefix: str, het: str) -> list[str]:
    """A family's nine statistics as columns of `cells`, pivoted."""
    names = {"beta": "meta_beta", "se": "meta_sebeta", "mlog10p": "meta_mlog10p", "n_cases": "meta_Ncases", "n_controls": "meta_Ncontrols",
             "n_eff": "meta_Neffective", "af": "meta_af_alt", "info": "meta_info", "het": het}
    return [f"""max(CASE WHEN family = '{family}' THEN {c} END) AS "{prefix}_inv_var_{name}\"""" for c, name in names.items()]


def _samples_sql(family: str) -> str:
    return f"max(CASE WHEN family = '{family}' THEN n_samples END)"


_OVERALL_SQL = ["max(CASE WHEN family = 'all' THEN k END) AS all_meta_Nstudies", f"{_samples_sql('all')} AS \"all_meta_Nsamples\"",
                *_cells_sql("all", "all", "het_p"), f"{_samples_sql('lmso')} AS \"lmso_meta_Nsamples\"", *_cells_sql("lmso", "lmso", "het_p")]
_LEFT_SQL = [x for o, name in STUDIES for x in (f"coalesce({_samples_sql(f'leave_{o}')}, 0) AS \"leave_{name}_Nsamples\"",
                                                *_cells_sql(f"leave_{o}", f"leave_{name}", "meta_het_p"))]
_REMOVED_SQL = f"(SELECT {KEYS}, CASE WHEN kk > 1 THEN study END AS lmso_meta_removed_study_name FROM top JOIN fx_study ON o = study_ord)"


def comparable(table: DataFrame) -> DataFrame:
    """All columns of a wide table, the doubles rounded for comparison and the p-values as -log10."""
    def one(name: str, kind: str):
        if kind != "double":
            return F.col(f"`{name}`")
        if name.endswith(("_pval", "_meta_p")):
            return mlog10(F.col(f"`{name}`")).alias(name.removesuffix("pval").removesuffix("_p").rstrip("_") + "_mlog10p")
        return rnd(F.col(f"`{name}`")).alias(name)

    return table.select(*[one(*x) for x in table.dtypes])


@query("wide_table", f"""
    WITH {_WIDE_CELLS}, pivoted AS (SELECT {KEYS}, {', '.join(_OVERALL_SQL + _LEFT_SQL)} FROM cells GROUP BY {KEYS})
    SELECT chr AS "#CHR", pos AS POS, ref AS REF, alt AS ALT, chr||':'||pos||':'||ref||':'||alt AS SNP,
      own.* EXCLUDE ({KEYS}), pivoted.* EXCLUDE ({KEYS}), lmso_meta_removed_study_name
    FROM own JOIN pivoted USING ({KEYS}) JOIN {_REMOVED_SQL} r USING ({KEYS})""", ("aligned", "fx_study"))
def wide_table(spark, sf):
    return comparable(wide(spark, sf))


@query("wide_post_filter", f"""
    WITH {_WIDE_CELLS}, pivoted AS (SELECT {KEYS}, {', '.join(_OVERALL_SQL)} FROM cells GROUP BY {KEYS}),
    sites AS (SELECT chr, pos, ref, unnest(string_split(alt_list, ',')) AS alt, id, seq FROM fx_rsid),
    ids AS (SELECT chr, pos, ref, alt, arg_min(id, seq) AS id FROM sites GROUP BY ALL)
    SELECT p.chr AS "#CHR", p.pos AS POS, p.ref AS REF, p.alt AS ALT, p.chr||':'||p.pos||':'||p.ref||':'||p.alt AS SNP, coalesce(id, 'NA') AS RSID,
      p.* EXCLUDE (chr, pos, ref, alt, occ), lmso_meta_removed_study_name
    FROM pivoted p JOIN {_REMOVED_SQL} r USING ({KEYS}) LEFT JOIN ids i ON p.chr = i.chr AND p.pos = i.pos AND p.ref = i.ref AND p.alt = i.alt
    WHERE all_meta_Nstudies > 1""", ("aligned", "fx_study", "fx_rsid"))
def wide_post_filter(spark, sf):
    table = wide(spark, sf).withColumnsRenamed({"#CHR": "chr", "POS": "pos", "REF": "ref", "ALT": "alt"})
    named = annotate.add_rsids(table, fx.rsid(spark, sf)).withColumnsRenamed(
        {"chr": "#CHR", "pos": "POS", "ref": "REF", "alt": "ALT"})
    return comparable(annotate.post_filter(named))


@query("filter_cols", f"""
    WITH {_ALL_SQL} SELECT chr, pos, ref, alt, snp, k AS all_meta_Nstudies, n_samples AS all_meta_N, {sql_rnd('beta_meta')} AS all_beta,
      'NA' AS rsid FROM all_res WHERE k > 1""", ("aligned",))
def filter_cols(spark, sf):
    df = annotate.with_snp(results(spark, sf).filter("n_studies > 1")).select(
        "chr", "pos", "ref", "alt", "snp", F.col("n_studies").cast("bigint").alias("all_meta_Nstudies"),
        F.col("n_samples").alias("all_meta_N"), rnd("beta").alias("all_beta"), F.lit(0).alias("all_meta_sample_N"),
        F.lit("x").alias("S0_EUR_beta"), F.lit("NA").alias("rsid"))
    return annotate.filter_cols(df)


@query("filter_cols_wide", f"""
    WITH {_WIDE_CELLS}, pivoted AS (SELECT {KEYS}, {', '.join([x for x in _OVERALL_SQL if 'lmso' not in x])} FROM cells GROUP BY {KEYS}),
    sites AS (SELECT chr, pos, ref, unnest(string_split(alt_list, ',')) AS alt, id, seq FROM fx_rsid),
    ids AS (SELECT chr, pos, ref, alt, arg_min(id, seq) AS id FROM sites GROUP BY ALL)
    SELECT p.chr, p.pos, p.ref, p.alt, p.chr||':'||p.pos||':'||p.ref||':'||p.alt AS SNP, p.* EXCLUDE (chr, pos, ref, alt, occ), coalesce(id, 'NA') AS rsid
    FROM pivoted p LEFT JOIN ids i ON p.chr = i.chr AND p.pos = i.pos AND p.ref = i.ref AND p.alt = i.alt""", ("aligned", "fx_study", "fx_rsid"))
def filter_cols_wide(spark, sf):
    # The wide table of six studies, of which the columns of single studies and of the families that leave one out go.
    table = wide(spark, sf).withColumnsRenamed({"#CHR": "chr", "POS": "pos", "REF": "ref", "ALT": "alt"})
    return comparable(annotate.filter_cols(annotate.add_rsids(table, fx.rsid(spark, sf))))


@query("add_rsids", f"""
    WITH sites AS (SELECT chr, pos, ref, unnest(string_split(alt_list, ',')) AS alt, id, seq FROM fx_rsid),
    ids AS (SELECT chr, pos, ref, alt, arg_min(id, seq) AS id FROM sites GROUP BY ALL)
    SELECT v.chr, v.pos, v.ref, v.alt, v.occ, coalesce(id, 'NA') AS rsid FROM {_VARIANTS} v
    LEFT JOIN ids i ON v.chr = i.chr AND v.pos = i.pos AND v.ref = i.ref AND v.alt = i.alt""", ("aligned", "fx_rsid"))
def add_rsids(spark, sf):
    return annotate.add_rsids(groups(spark, sf).select(*KEY), fx.rsid(spark, sf))


@query("shortlist", f"""
    WITH {_ALL_SQL} SELECT snp, occ, k AS n_studies FROM all_res WHERE snp IN (SELECT snp FROM fx_shortlist)""",
       ("aligned", "fx_shortlist"))
def shortlist(spark, sf):
    df = annotate.shortlist(annotate.with_snp(results(spark, sf)), fx.shortlist(spark, sf))
    return df.select("snp", "occ", F.col("n_studies").cast("bigint").alias("n_studies"))


@query("significant_hits", f"""
    WITH sums AS ({sql_sums('aligned')}), r AS ({sql_shown()})
    SELECT {KEYS}, beta, mlog10p FROM r WHERE mlog10p > -log10(0.05)""", ("aligned",))
def significant_hits(spark, sf):
    return annotate.significant_hits(results(spark, sf), "pval", 0.05).select(
        *KEY, rnd("beta").alias("beta"), mlog10("pval").alias("mlog10p"))


@query("neff_floor", f"""
    WITH {_ALL_SQL}, m AS (SELECT chr = 23 AS x, floor(max(n_eff) * 2 / 3) AS floor_ FROM all_res GROUP BY 1)
    SELECT {KEYS}, n_eff FROM all_res a JOIN m ON (a.chr = 23) = m.x WHERE n_eff >= floor_""", ("aligned",))
def neff_floor(spark, sf):
    return annotate.neff_floor(results(spark, sf), "n_eff").select(*KEY, "n_eff")


@query("sample_af", f"""
    SELECT {KEYS}, sum(n)::BIGINT AS all_meta_sample_N, {sql_rnd("sum(CASE WHEN af_alt <> 0.5 THEN af_alt*n END)/sum(CASE WHEN af_alt <> 0.5 THEN n END)")} AS all_meta_AF
    FROM aligned GROUP BY {KEYS}""", ("aligned",))
def sample_af(spark, sf):
    out = groups(spark, sf).select(*KEY, *[c.alias(n) for n, c in annotate.sample_af("members").items()])
    return out.withColumn("all_meta_AF", rnd("all_meta_AF"))


@query("combine_chroms", f"""
    WITH {_ALL_SQL} SELECT {KEYS}, n_samples FROM all_res WHERE chr BETWEEN 1 AND 24""", ("aligned",))
def combine_chroms(spark, sf):
    # The parts are files of one chromosome each, which one job wrote.
    path = scratch_path(spark, "chroms")
    mt.meta(groups(spark, sf)).select(*KEY, "n_samples").write.partitionBy("chr").parquet(path)
    whole = spark.read.parquet(path)
    return annotate.combine([whole.filter(F.col("chr") == c).select(*KEY, "n_samples") for c in range(1, 25)])


@query("one_chrom", "SELECT study_ord, chr, pos, ref, alt, n FROM munged WHERE chr = 21", ("munged",))
def one_chrom(spark, sf):
    from sumweave.operators.qc import one_chrom as only
    return only(fx.munged(spark, sf), 21).select("study_ord", "chr", "pos", "ref", "alt", "n")


# Scalar functions over the study rows.

@query("canonical_key", f"SELECT l_orderkey, l_linenumber, pos, {key_sql()} AS k FROM fx_sumstats", ("fx_sumstats",))
def canonical_key(spark, sf):
    return fx.sumstats(spark, sf).select("l_orderkey", "l_linenumber", "pos",
                                         alleles.canonical_key(F.col("ref"), F.col("alt")).alias("k"))


@query("orient", f"""
    SELECT l_orderkey, l_linenumber, pos, {sql_rnd('CASE WHEN f THEN 0-beta ELSE beta END')} AS beta,
      {sql_rnd('CASE WHEN f THEN 1-af_alt ELSE af_alt END')} AS af_alt
    FROM (SELECT s.*, {reversed_sql('s.ref', 's.alt', 'r.bref', 'r.balt')} AS f FROM
      (SELECT *, row_number() OVER (ORDER BY {'l_orderkey, l_linenumber, l_partkey, l_suppkey, n, beta, se'}) AS i FROM fx_sumstats) s
      JOIN (SELECT bref, balt, row_number() OVER (ORDER BY {'l_orderkey, l_linenumber, l_partkey, l_suppkey, n, beta, se'}) AS i FROM fx_raw) r USING (i))""",
       ("fx_sumstats", "fx_raw"))
def orient(spark, sf):
    bref, balt = fx.base_alleles(F.col("l_partkey"))
    flip = alleles.is_reversed(F.col("ref"), F.col("alt"), bref, balt)
    return fx.sumstats(spark, sf).select(
        "l_orderkey", "l_linenumber", "pos", rnd(alleles.flip_effect(flip, F.col("beta"))).alias("beta"),
        rnd(alleles.flip_frequency(flip, F.col("af_alt"))).alias("af_alt"))


@query("strand_flip", """
    SELECT ref, alt, translate(ref, 'ACGT', 'TGCA') AS cref, translate(alt, 'ACGT', 'TGCA') AS calt, count(*) AS n
    FROM fx_sumstats GROUP BY ALL""", ("fx_sumstats",))
def strand_flip(spark, sf):
    df = fx.sumstats(spark, sf).groupBy("ref", "alt").agg(F.count("*").alias("n"))
    return df.select("ref", "alt", alleles.strand_flip(F.col("ref")).alias("cref"),
                     alleles.strand_flip(F.col("alt")).alias("calt"), "n")


@query("palindromic", """
    SELECT ref, alt, ref||alt IN ('AT','TA','CG','GC') AS is_palindrome, count(*) AS n FROM fx_sumstats GROUP BY ALL""", ("fx_sumstats",))
def palindromic(spark, sf):
    df = fx.sumstats(spark, sf)
    return df.groupBy("ref", "alt", alleles.is_palindromic(F.col("ref"), F.col("alt")).alias("is_palindrome")).agg(
        F.count("*").alias("n"))


@query("variant_id", "SELECT chr||':'||pos||':'||ref||':'||alt AS snp, n FROM munged", ("munged",))
def variant_id(spark, sf):
    return annotate.with_snp(fx.munged(spark, sf)).select("snp", "n")


@query("parse_variant_id", """
    SELECT snp, split_part(snp, ':', 1) AS chr, split_part(snp, ':', 2)::BIGINT AS pos, split_part(snp, ':', 3) AS ref,
      split_part(snp, ':', 4) AS alt FROM fx_shortlist""", ("fx_shortlist",))
def parse_variant_id(spark, sf):
    parts = alleles.parse_variant_id(F.col("snp"))
    return fx.shortlist(spark, sf).select("snp", *[c.alias(n) for n, c in parts.items()])


@query("z_from_p", f"SELECT l_orderkey, l_linenumber, pos, {sql_rnd(sql_z('p'))} AS z FROM "
       "(SELECT *, (TRY_CAST(pval_raw AS DOUBLE) + 1) / 9974 AS p FROM fx_sumstats)", ("fx_sumstats",))
def z_from_p(spark, sf):
    p = (F.col("pval_raw").try_cast("double") + 1) / 9974
    return fx.sumstats(spark, sf).withColumn("p", p).select(
        "l_orderkey", "l_linenumber", "pos", rnd(numeric.z_from_p(F.col("p"))).alias("z"))


@query("p_from_z", f"SELECT l_orderkey, l_linenumber, pos, {sql_mlog10(sql_p('z'))} AS mlog10p FROM "
       "(SELECT *, beta / se AS z FROM fx_sumstats)", ("fx_sumstats",))
def p_from_z(spark, sf):
    df = fx.sumstats(spark, sf).withColumn("z", F.col("beta") / F.col("se"))
    return df.select("l_orderkey", "l_linenumber", "pos", mlog10(numeric.p_from_z(F.col("z"))).alias("mlog10p"))


@query("chi2_sf", f"SELECT l_orderkey, l_linenumber, l_quantity, {sql_rnd(sql_chi2('l_quantity', 'l_linenumber'))} AS sf FROM lineitem")
def chi2_sf(spark, sf):
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        rnd(numeric.chi2_sf(F.col("l_quantity"), F.col("l_linenumber"))).alias("sf"))


@query("neff", f"""
    SELECT study, {sql_rnd('4.0*n_cases*n_controls/(n_cases+n_controls)')} AS neff,
      {sql_rnd('n_cases*(1-n_cases/(n_cases+n_controls)::DOUBLE)')} AS neff_logistic FROM fx_study""", ("fx_study",))
def neff(spark, sf):
    c, k = F.col("n_cases"), F.col("n_controls")
    return fx.study(spark, sf).select("study", rnd(numeric.effective_size(c, k)).alias("neff"),
                                      rnd(numeric.logistic_effective_size(c, k)).alias("neff_logistic"))


@query("or_to_beta", f"""
    SELECT l_orderkey, l_linenumber, pos, {sql_rnd('CASE WHEN study_ord % 2 = 1 THEN (CASE WHEN beta > 0 THEN ln(beta) END) ELSE beta END')} AS beta
    FROM fx_sumstats""", ("fx_sumstats",))
def or_to_beta(spark, sf):
    kind = F.when(F.col("study_ord") % 2 == 1, "OR").otherwise("beta")
    return fx.sumstats(spark, sf).select("l_orderkey", "l_linenumber", "pos",
                                         rnd(values.to_beta(F.col("beta"), kind)).alias("beta"))


@query("lenient_parse", """
    SELECT l_orderkey, l_linenumber, pos, CASE WHEN p IS NOT NULL THEN af_alt END AS af_alt, CASE WHEN p IS NOT NULL THEN info END AS info,
      p AS pval, CASE WHEN p IS NOT NULL THEN beta END AS effect, CASE WHEN l_linenumber <> 3 THEN se END AS se,
      CASE WHEN l_linenumber <> 3 THEN n END AS n FROM (SELECT *, TRY_CAST(pval_raw AS DOUBLE) AS p FROM fx_sumstats)""", ("fx_sumstats",))
def lenient_parse(spark, sf):
    text = lambda c: F.col(c).cast("string")
    n = F.when(F.col("l_linenumber") == 3, "?").otherwise(text("n"))
    stats = values.lenient_stats(text("af_alt"), text("info"), F.col("pval_raw"), text("beta"), text("se"), n)
    return fx.sumstats(spark, sf).select("l_orderkey", "l_linenumber", "pos", *[c.alias(k) for k, c in stats.items()])


@query("chrom_norm", """
    SELECT chr_raw, regexp_replace(regexp_replace(regexp_replace(regexp_replace(chr_raw, '^0', ''), '^chr', ''), '^X', '23'), '^Y', '24') AS chr,
      count(*) AS n FROM fx_sumstats GROUP BY ALL""", ("fx_sumstats",))
def chrom_norm(spark, sf):
    df = fx.sumstats(spark, sf).groupBy("chr_raw").agg(F.count("*").alias("n"))
    return df.select("chr_raw", values.normalize_chrom(F.col("chr_raw")).alias("chr"), "n")


@query("chrom_map", """
    SELECT chr_raw, CASE WHEN regexp_matches(chr_raw, '^(chr)?([1-9]|1[0-9]|2[0-2])$') THEN replace(chr_raw, 'chr', '')::INTEGER
      WHEN chr_raw IN ('23', 'X', 'chrX') THEN 23 WHEN chr_raw IN ('24', 'Y', 'chrY') THEN 24 WHEN chr_raw IN ('MT', 'chrMT') THEN 25 END AS chr,
      count(*) AS n FROM fx_sumstats GROUP BY ALL""", ("fx_sumstats",))
def chrom_map(spark, sf):
    df = fx.sumstats(spark, sf).groupBy("chr_raw").agg(F.count("*").alias("n"))
    return df.select("chr_raw", values.chrom_code(F.col("chr_raw")).alias("chr"), "n")


@query("pos_int", "SELECT pos, pos AS pos_int, count(*) AS n FROM fx_sumstats GROUP BY ALL", ("fx_sumstats",))
def pos_int(spark, sf):
    df = fx.sumstats(spark, sf).groupBy("pos").agg(F.count("*").alias("n"))
    text = F.concat((F.col("pos") / 100).cast("string"), F.lit("e2"))
    return df.select("pos", values.to_position(text).alias("pos_int"), "n")
