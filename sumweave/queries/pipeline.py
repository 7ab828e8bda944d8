"""From vendors' raw files to the annotated result in one query."""

from __future__ import annotations

from pyspark.sql import functions as F

from sumweave.operators.align import align_groups
from sumweave.operators.meta import meta, with_sizes
from sumweave.operators.render import to_wide
from sumweave.plans.format import Entry, format_studies
from sumweave.plans.meta import finish
from sumweave.plans.munge import clean, munge
from sumweave.queries import fixtures as fx
from sumweave.queries.base import comp, key_sql, mlog10, query, reversed_sql, rnd, sql_mlog10, sql_p, sql_rnd
from sumweave.queries.munge import _BASES, _PAL, SAIGE, _A01, bases
from sumweave.session import scratch_path
from sumweave.sources import delimited, sinks

#: Study, dialect and reference population; the columns as the vendor names them.
DIALECTS = {0: ("SAIGE", "nfe", SAIGE), 1: ("REGENIE", "fin", {"chr": "CHROM", "pos": "GENPOS", **_A01}), 2: ("US", "afr", {**SAIGE, "beta": "Beta"})}
NAMES = ["S0_EUR", "S1_FIN", "S2_AFR"]

_DRAW = "((l_orderkey * 7919 + l_linenumber) % 9973)"


def _raw(spark, sf, study: int, names: dict[str, str]) -> str:
    """A study as its vendor writes it: gzip parts with a header each, whose names and rows are in file order."""
    draw = (F.col("l_orderkey") * 7919 + F.col("l_linenumber")) % 9973
    p = F.when(F.col("l_orderkey") % 97 == 0, "NA").otherwise(((draw + 1) / 9975).cast("string"))
    source = {"chr": "chr_raw", "pos": "pos", "a1": "ref", "a2": "alt", "af": "af_alt", "info": "info", "beta": "beta", "se": "se", "n": "n"}
    columns = {name: p if k == "p" else F.col(source[k]).cast("string") for k, name in names.items()}
    if study == 1:
        columns |= {"LOG10P": (draw / 1000).cast("string"), "ID": F.lit("."), "TEST": F.lit("ADD"), "CHISQ": F.lit("1"),
                    "EXTRA": F.when(F.col("l_linenumber") == 7, "TEST_FAIL").otherwise("NA.")}
    rows = fx.sumstats(spark, sf).filter(F.col("study_ord") == study)
    line = F.concat_ws("\t", *columns.values())
    path = scratch_path(spark, f"raw{study}")
    lines = rows.select("file_order", line.alias("value")).repartitionByRange("file_order").sortWithinPartitions("file_order").select("value")
    sinks.with_header(lines, "\t".join(columns)).write.text(path, compression="gzip")
    return path


def _harmonized(name: str, source: str, pre_aligned: bool) -> str:
    """Best reference match of every row, and the rows whose variant then comes once in its study."""
    key = "ref||'|'||alt" if pre_aligned else f"CASE WHEN {_PAL} THEN ref||'|'||alt ELSE {key_sql()} END"
    turn = "false" if pre_aligned else reversed_sql("s.ref", "s.alt", "r.rref", "r.ralt")
    return f"""
    {name}_r AS MATERIALIZED (SELECT pop, chr, pos, ref AS rref, alt AS ralt, af, {key} AS hk FROM fx_reference),
    {name}_c AS (SELECT s.*, r.rref, r.ralt, r.af, {turn} AS turn FROM (SELECT *, list_extract(['nfe','fin','afr'], study_ord + 1) AS pop, {key} AS hk FROM {source}) s
      LEFT JOIN {name}_r r ON s.pop = r.pop AND s.chr = r.chr AND s.pos = r.pos AND s.hk = r.hk),
    {name}_b AS (SELECT * FROM {name}_c QUALIFY row_number() OVER (PARTITION BY ford ORDER BY
      coalesce(abs(CASE WHEN turn THEN 1 - af_alt ELSE af_alt END - af), 1), rref, ralt) = 1),
    {name}_h AS (SELECT study_ord, chr, pos, n, ford, se, pval, {'ref' if pre_aligned else 'coalesce(rref, ref)'} AS ref, {'alt' if pre_aligned else 'coalesce(ralt, alt)'} AS alt,
      CASE WHEN turn AND rref IS NOT NULL THEN 0 - beta ELSE beta END AS beta FROM {name}_b),
    {name} AS MATERIALIZED (SELECT * FROM {name}_h QUALIFY count(*) OVER (PARTITION BY study_ord, chr, pos, ref, alt) = 1)"""


def _aligned(source: str) -> str:
    """Studies side by side: in each round one row of every study that has one left."""
    out = f"q0 AS MATERIALIZED (SELECT *, {key_sql()} AS k FROM {source})"
    for r in range(4):
        out += f""",
    a{r} AS MATERIALIZED (SELECT p.* EXCLUDE (rn), {r} AS occ FROM (SELECT r.*, a.aref, a.aalt, row_number() OVER (PARTITION BY r.chr, r.pos, r.k, r.study_ord
        ORDER BY (CASE WHEN r.ref = a.aref AND r.alt = a.aalt THEN 0 ELSE 1 END), r.ford) AS rn FROM q{r} r JOIN (
          SELECT chr, pos, k, arg_min(ref, (study_ord, ford)) AS aref, arg_min(alt, (study_ord, ford)) AS aalt FROM q{r} GROUP BY ALL) a
        ON r.chr = a.chr AND r.pos = a.pos AND r.k = a.k) p WHERE rn = 1),
    q{r + 1} AS MATERIALIZED (SELECT * FROM q{r} s WHERE NOT EXISTS (SELECT 1 FROM a{r} p WHERE p.ford = s.ford))"""
    union = " UNION ALL ".join(f"SELECT * FROM a{r}" for r in range(4))
    return out + f""",
    al AS MATERIALIZED (SELECT chr, pos, aref AS ref, aalt AS alt, occ, study_ord, CASE WHEN flip THEN 0 - beta ELSE beta END AS beta, se, pval, n
      FROM (SELECT *, {reversed_sql('ref', 'alt', 'aref', 'aalt')} AS flip FROM ({union})))"""


_QC = """regexp_matches(chr_text, '^[0-9]+$') AND concat_ws(' ', chr_raw, ref, alt) NOT LIKE '%NA%' AND pval > 0
      AND beta > -1e6 AND beta < 1e6 AND af_alt >= 0.001 AND 1 - af_alt >= 0.001 AND info >= 0.6"""


@query("end_to_end", f"""
    WITH f0 AS (SELECT *, CASE WHEN study_ord = 1 THEN pow(10, -({_DRAW} / 1000)) WHEN l_orderkey % 97 <> 0 THEN ({_DRAW} + 1) / 9975 END AS pval,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(chr_raw, '^0', ''), '^chr', ''), '^X', '23'), '^Y', '24') AS chr_text,
        row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, n, beta, se) AS ford
      FROM fx_sumstats WHERE study_ord < 3 AND NOT (study_ord = 1 AND l_linenumber = 7)),
    m AS MATERIALIZED (SELECT * EXCLUDE (chr_raw, chr_text), chr_text::INTEGER AS chr FROM f0 WHERE {_QC}),
    build AS (SELECT study_ord, count(*) FILTER (b.build = 'b37') > count(*) FILTER (b.build = 'b38') AS is37
      FROM m LEFT JOIN fx_build b ON m.chr = 21 AND m.pos = b.pos GROUP BY 1),
    j AS (SELECT m.*, c.dst_chr, c.strand, CASE WHEN c.strand = '-' THEN c.dst_start + (c.src_end - c.src_start) - 1 - (m.pos - 1 - c.src_start)
        ELSE c.dst_start + (m.pos - 1 - c.src_start) END + 1 AS lp, CASE WHEN c.strand = '-' THEN {comp('m.ref')} ELSE m.ref END AS lr,
        CASE WHEN c.strand = '-' THEN {comp('m.alt')} ELSE m.alt END AS la
      FROM m JOIN build USING (study_ord) JOIN fx_chain c ON m.chr = c.chr AND m.pos - 1 >= c.src_start AND m.pos - 1 < c.src_end
      WHERE is37 AND m.pos - 1 + greatest(length(m.ref), length(m.alt)) <= c.src_end AND NOT (c.strand = '-' AND length(m.ref) + length(m.alt) > 2)),
    l AS (SELECT j.* EXCLUDE (chr, pos, ref, alt, beta, af_alt), dst_chr AS chr, lp AS pos, CASE WHEN ok THEN lr ELSE la END AS ref, CASE WHEN ok THEN la ELSE lr END AS alt,
        CASE WHEN ok THEN beta ELSE 0 - beta END AS beta, CASE WHEN ok THEN af_alt ELSE 1 - af_alt END AS af_alt
      FROM (SELECT j.*, substring(lr, 1, 1) = b.base AS ok, b.base FROM j JOIN {_BASES} b ON b.chr = j.dst_chr AND b.pos = j.lp) j
      WHERE (ok OR (length(lr) = 1 AND length(la) = 1 AND la = base)) AND dst_chr BETWEEN 1 AND 24),
    c AS (SELECT m.* FROM m JOIN build USING (study_ord) WHERE NOT is37 AND chr BETWEEN 1 AND 24),
    {_harmonized('hl', 'l', True)}, {_harmonized('hc', 'c', False)}, both_ AS (SELECT * FROM hl UNION ALL BY NAME SELECT * FROM hc), {_aligned('both_')},
    top AS (SELECT chr, pos, ref, alt, occ, arg_min(study_ord, (pval, study_ord)) AS o FROM al GROUP BY ALL),
    fam AS (SELECT *, 'all' AS family FROM al UNION ALL SELECT al.*, 'lmso' FROM al JOIN top USING (chr, pos, ref, alt, occ) WHERE study_ord <> o),
    s AS (SELECT chr, pos, ref, alt, occ, family, count(*) AS k, sum(n)::BIGINT AS n, sum(1/(se*se)) AS w, sum(beta/(se*se)) AS wb,
        any_value(beta) AS b1, any_value(se) AS se1, any_value(pval) AS p1 FROM fam GROUP BY ALL),
    e AS (SELECT chr, pos, ref, alt, occ, family, k, n, CASE WHEN k > 1 THEN wb/w ELSE b1 END AS b, CASE WHEN k > 1 THEN sqrt(1/w) ELSE se1 END AS se,
        CASE WHEN k > 1 THEN {sql_p('z')} ELSE p1 END AS p FROM (SELECT *, wb/sqrt(w) AS z FROM s)),
    sites AS (SELECT chr, pos, ref, unnest(string_split(alt_list, ',')) AS alt, id, seq FROM fx_rsid),
    ids AS (SELECT chr, pos, ref, alt, arg_min(id, seq) AS id FROM sites GROUP BY ALL)
    SELECT x.chr AS "#CHR", x.pos AS "POS", x.ref AS "REF", x.alt AS "ALT", coalesce(id, 'NA') AS "RSID", x.k AS all_meta_Nstudies, x.n AS all_meta_Nsamples,
      {sql_rnd('x.b')} AS beta, {sql_rnd('x.se')} AS se, {sql_mlog10('x.p')} AS mlog10p,
      list_extract(['S0_EUR', 'S1_FIN', 'S2_AFR'], top.o + 1) AS lmso_meta_removed_study_name, {sql_rnd('y.b')} AS lmso_beta
    FROM (SELECT * FROM e WHERE family = 'all' AND k > 1) x JOIN (SELECT * FROM e WHERE family = 'lmso') y USING (chr, pos, ref, alt, occ)
    JOIN top USING (chr, pos, ref, alt, occ) LEFT JOIN ids ON ids.chr = x.chr AND ids.pos = x.pos AND ids.ref = x.ref AND ids.alt = x.alt""",
       ("fx_sumstats", "fx_build", "fx_chain", "fx_reference", "fx_rsid"))
def end_to_end(spark, sf):
    """Manifest, format, gates, munge, alignment, meta-analysis, rsIDs and the final filter, from written files."""
    listed = scratch_path(spark, "manifest")
    entries = [(o, _raw(spark, sf, o, names), dialect, pop) for o, (dialect, pop, names) in DIALECTS.items()]
    spark.createDataFrame([("\t".join(map(str, e)),) for e in entries], "value string").coalesce(1).write.text(listed)
    manifest = delimited.scan_manifest(spark, listed, ["study_ord", "path", "dialect", "pop"])
    formatted = format_studies(spark, [Entry(int(r["study_ord"]), r["path"], r["dialect"], r["pop"]) for r in manifest.orderBy("study_ord").collect()])
    stored = scratch_path(spark, "cleaned")
    clean(formatted, gated=True).write.parquet(stored)
    rows = munge(spark.read.parquet(stored), fx.build_map(spark, sf), fx.chain(spark, sf), fx.reference(spark, sf), bases(spark, sf))
    columns = ["study_ord", "chr", "pos", "ref", "alt", "af_alt", "info", "beta", "se", "pval", "n", "file_order"]
    results = meta(align_groups(with_sizes(rows.select(*columns), fx.study(spark, sf)), dedup=False), leave_most_sig_out=True, keep=["members"])
    out = finish(to_wide(results, list(enumerate(NAMES)), ["inv_var"], leave_most_sig_out=True), fx.rsid(spark, sf))
    return out.select("#CHR", "POS", "REF", "ALT", "RSID", "all_meta_Nstudies", "all_meta_Nsamples", rnd("all_inv_var_meta_beta").alias("beta"),
                      rnd("all_inv_var_meta_sebeta").alias("se"), mlog10("all_inv_var_meta_p").alias("mlog10p"),
                      "lmso_meta_removed_study_name", rnd("lmso_inv_var_meta_beta").alias("lmso_beta"))
