"""Format, quality-filter, lift and harmonise queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumweave.functions.alleles import is_placeholder
from sumweave.operators import align, build, dialects, harmonize as hz, liftover as lo, qc
from sumweave.operators.qcdata import af_density as density
from sumweave.operators.sequence import windows_of
from sumweave.queries import fixtures as fx
from sumweave.session import scratch_path
from sumweave.sources import delimited, sinks
from sumweave.queries.base import alt_sql, comp, key_sql, query, ref_sql, rnd, sql_rnd

TEXT = "string"


def raw(spark, sf, names: dict[str, str], extra: dict | None = None) -> DataFrame:
    """Study rows under a vendor's column names, as text."""
    df = fx.sumstats(spark, sf)
    source = {"chr": "chr_raw", "pos": "pos", "a1": "ref", "a2": "alt", "af": "af_alt", "info": "info",
              "beta": "beta", "se": "se", "p": "pval_raw", "n": "n"}
    out = [F.col(source[k]).cast(TEXT).alias(name) for k, name in names.items()]
    out += [c.cast(TEXT).alias(name) for name, c in (extra or {}).items()]
    return df.select(*out)


SAIGE = {"chr": "CHR", "pos": "POS", "a1": "Allele1", "a2": "Allele2", "af": "AF_Allele2", "info": "imputationInfo",
         "beta": "BETA", "se": "SE", "p": "p.value", "n": "N"}


def log10p():
    return (F.col("l_orderkey") * 7919 + F.col("l_linenumber")) % 9973 / 100


def case_counts():
    return {"N.Cases": F.col("l_linenumber") * 100, "N.Controls": F.col("n")}


def canonical(df: DataFrame) -> DataFrame:
    """The canonical table as numbers where they are numbers, for comparison."""
    c = dialects.col
    return df.select(
        c("CHR").alias("chr"), c("POS").cast("bigint").alias("pos"), c("Allele1").alias("a1"), c("Allele2").alias("a2"),
        c("AF_Allele2").cast("double").alias("af"), c("imputationInfo").cast("double").alias("info"),
        c("BETA").cast("double").alias("beta"), c("SE").cast("double").alias("se"),
        rnd(-F.log10(c("p.value").try_cast("double")), 4).alias("mlog10p"), c("N").cast("bigint").alias("n"))


def fmt_sql(p: str, n: str = "n", where: str = "true") -> str:
    return f"""SELECT chr_raw AS chr, pos, ref AS a1, alt AS a2, af_alt AS af, info, beta, se,
      {sql_rnd(f'-log10({p})', 4)} AS mlog10p, {n} AS n FROM fx_sumstats WHERE {where}"""


_PLAIN = "CASE WHEN TRY_CAST(pval_raw AS DOUBLE) > 0 THEN TRY_CAST(pval_raw AS DOUBLE) END"
_L10 = "pow(10, -((l_orderkey * 7919 + l_linenumber) % 9973 / 100))"


@query("fmt_saige", fmt_sql(_PLAIN), ("fx_sumstats",))
def fmt_saige(spark, sf):
    return canonical(dialects.normalize(raw(spark, sf, SAIGE, {"other": F.lit("x")}), "SAIGE"))


@query("fmt_exceed", fmt_sql(_PLAIN), ("fx_sumstats",))
def fmt_exceed(spark, sf):
    return canonical(dialects.normalize(raw(spark, sf, {**SAIGE, "pos": "BP", "p": "P"}), "EXCEED"))


_A01 = {"a1": "ALLELE0", "a2": "ALLELE1", "af": "A1FREQ", "info": "INFO", "beta": "BETA", "se": "SE", "n": "N"}


@query("fmt_regenie", fmt_sql(_L10, where="l_linenumber <> 7"), ("fx_sumstats",))
def fmt_regenie(spark, sf):
    extra = {"LOG10P": log10p(), "ID": F.lit("."), "TEST": F.lit("ADD"), "CHISQ": F.lit("1"),
             "EXTRA": F.when(F.col("l_linenumber") == 7, "TEST_FAIL").otherwise("NA")}
    return canonical(dialects.normalize(raw(spark, sf, {"chr": "CHROM", "pos": "GENPOS", **_A01}, extra), "REGENIE"))


@query("fmt_japan", fmt_sql(_PLAIN, "l_linenumber * 100 + n"), ("fx_sumstats",))
def fmt_japan(spark, sf):
    names = {k: v for k, v in SAIGE.items() if k != "n"}
    return canonical(dialects.normalize(raw(spark, sf, names, case_counts()), "JAPAN"))


@query("fmt_pmbb", fmt_sql(_L10), ("fx_sumstats",))
def fmt_pmbb(spark, sf):
    return canonical(dialects.normalize(raw(spark, sf, {"chr": "#CHROM", "pos": "POS", **_A01}, {"LOG10P": log10p()}), "PMBB"))


@query("fmt_us", fmt_sql(_PLAIN), ("fx_sumstats",))
def fmt_us(spark, sf):
    return canonical(dialects.normalize(raw(spark, sf, {**SAIGE, "beta": "Beta"}), "US"))


@query("fmt_helix", fmt_sql(_PLAIN, "l_linenumber * 100 + n", "pval_raw <> 'NA' AND l_linenumber <> 5"), ("fx_sumstats",))
def fmt_helix(spark, sf):
    se = F.when(F.col("l_linenumber") == 5, "NA").otherwise(F.col("se").cast(TEXT))
    packed = F.concat(F.lit("BETA="), F.col("beta").cast(TEXT), F.lit(";SE="), se, F.lit(";INFO="), F.col("info").cast(TEXT))
    names = {"chr": "Chr", "pos": "Pos", "a1": "Ref", "a2": "Alt", "af": "AAF", "p": "Pval"}
    filler = {f"x{i}": F.lit("0") for i in range(9, 22)}
    extra = {"Num_Cases": F.col("l_linenumber") * 100, "Num_Controls": F.col("n"), **filler, "Info": packed}
    return canonical(dialects.normalize(raw(spark, sf, names, extra), "HELIX"))


@query("fmt_genotek", fmt_sql(_PLAIN, "l_linenumber * 100 + n"), ("fx_sumstats",))
def fmt_genotek(spark, sf):
    names = {k: v for k, v in {**SAIGE, "beta": "Beta"}.items() if k != "n"}
    return canonical(dialects.normalize(raw(spark, sf, names, case_counts()), "GENOTEK"))


@query("rename_cols", """SELECT chr_raw AS "#CHR", pos AS "POS", ref AS "REF", alt AS "ALT", beta, se AS sebeta FROM fx_sumstats""", ("fx_sumstats",))
def rename_cols(spark, sf):
    df = fx.sumstats(spark, sf).select("chr_raw", "pos", "ref", "alt", "beta", "se")
    return qc.rename_cols(df, {"chr_raw": "#CHR", "pos": "POS", "ref": "REF", "alt": "ALT", "se": "sebeta"})


@query("qc_filter", "SELECT study_ord, chr, pos, ref, alt, af_alt, info, beta, se, pval, n FROM munged", ("munged",))
def qc_filter(spark, sf):
    return fx.munged(spark, sf).drop("file_order")


@query("sort_variants", "SELECT study_ord, chr, pos, ref, alt, n FROM munged ORDER BY chr, pos, study_ord, ref, alt, n", ("munged",))
def sort_variants(spark, sf):
    return qc.sort_variants(fx.munged(spark, sf), "study_ord", "ref", "alt", "n").select(
        "study_ord", "chr", "pos", "ref", "alt", "n")


def _marked(spark, sf) -> DataFrame:
    """Rows with some alleles replaced by placeholder marks."""
    mark = F.when(F.col("l_linenumber") == 1, "I").when(F.col("l_linenumber") == 2, "*").when(
        F.col("l_linenumber") == 4, "N").when(F.col("l_linenumber") == 6, F.lower("ref")).otherwise(F.col("ref"))
    other = F.when(F.col("l_linenumber") == 1, "D").otherwise(F.col("alt"))
    return fx.sumstats(spark, sf).select("l_orderkey", "l_linenumber", "chr_raw", "pos", mark.alias("ref"), other.alias("alt"))


_MARKED = """(SELECT l_orderkey, l_linenumber, chr_raw, pos, CASE l_linenumber WHEN 1 THEN 'I' WHEN 2 THEN '*' WHEN 4 THEN 'N'
    WHEN 6 THEN lower(ref) ELSE ref END AS ref, CASE WHEN l_linenumber = 1 THEN 'D' ELSE alt END AS alt FROM fx_sumstats)"""


@query("placeholder_alleles", f"SELECT * FROM {_MARKED} WHERE ref NOT IN ('I', '*', 'N')", ("fx_sumstats",))
def placeholder_alleles(spark, sf):
    return qc.drop_placeholder_alleles(_marked(spark, sf))


@query("acgt_only", f"SELECT * FROM {_MARKED} WHERE upper(ref) ~ '^[ACGT]+$' AND upper(alt) ~ '^[ACGT]+$'", ("fx_sumstats",))
def acgt_only(spark, sf):
    return qc.acgt_only(_marked(spark, sf))


@query("export_sites", f"""
    SELECT 'chr' || CASE c WHEN '23' THEN 'X' WHEN '24' THEN 'Y' ELSE c END AS "CHROM", pos AS "POS",
      'chr' || CASE c WHEN '23' THEN 'X' WHEN '24' THEN 'Y' ELSE c END || ':' || pos || ':' || ref || ':' || alt AS "ID",
      ref AS "REF", alt AS "ALT", '.' AS "QUAL", '.' AS "FILTER", '.' AS "INFO" FROM (SELECT *, chr::VARCHAR AS c FROM munged)""", ("munged",))
def export_sites(spark, sf):
    return lo.export_sites(fx.munged(spark, sf))


@query("qc_report", """
    SELECT study_ord, count(*) AS n_before, count(ok) AS n_after, count(DISTINCT chr) AS n_chrom, count(DISTINCT nf) AS n_field_counts,
      count(DISTINCT chr) >= 22 AS enough_chroms, count(DISTINCT nf) = 1 AS is_square
    FROM (SELECT r.study_ord, m.chr, m.chr AS ok, 10 AS nf FROM
      (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, n, beta, se) AS i FROM fx_sumstats) r
      LEFT JOIN munged m ON m.l_orderkey = r.l_orderkey AND m.l_linenumber = r.l_linenumber AND m.l_partkey = r.l_partkey
        AND m.l_suppkey = r.l_suppkey AND m.n = r.n AND m.beta = r.beta AND m.se = r.se) GROUP BY study_ord""", ("fx_sumstats", "munged"))
def qc_report(spark, sf):
    fields = ["chr_raw", "pos", "ref", "alt", "af_alt", "info", "beta", "se", "pval_raw", "n"]
    line = F.concat_ws("\t", *[F.col(c).cast(TEXT) for c in fields])
    df = fx.sumstats(spark, sf).select("study_ord", *fields, line.alias("line"))
    return qc.qc_report(df, {"chr_raw": "chr", "pval_raw": "pval"}, F.size(F.split("line", "\t")), skip=["line"])


@query("qc_scanned", """
    SELECT study_ord, count(*) AS n_before, count(*) FILTER (WHERE NOT short AND TRY_CAST(pval_raw AS DOUBLE) > 0 AND info >= 0.6
        AND beta > -1e6 AND beta < 1e6 AND af_alt >= 0.001 AND 1 - af_alt >= 0.001 AND chr_raw NOT LIKE '%MT' AND NOT concat_ws(' ', chr_raw, ref, alt, pval_raw) LIKE '%NA%') AS n_after,
      CASE WHEN bool_or(short) THEN 2 ELSE 1 END AS n_field_counts, NOT bool_or(short) AS is_square
    FROM (SELECT *, study_ord % 2 = 0 AND l_linenumber = 7 AS short FROM fx_sumstats) GROUP BY study_ord""", ("fx_sumstats",))
def qc_scanned(spark, sf):
    # Text lines, of which studies with an even number have some that end before the last field.
    fields = [F.col("study_ord").cast(TEXT), *[F.col(c).cast(TEXT) for c in ("chr_raw", "pos", "ref", "alt", "af_alt", "info", "beta", "se", "pval_raw")]]
    short = (F.col("study_ord") % 2 == 0) & (F.col("l_linenumber") == 7)
    line = F.concat(F.concat_ws("\t", *fields), F.when(short, "").otherwise(F.concat(F.lit("\t"), F.col("n").cast(TEXT))))
    header = "study_ord\tchr_raw\tpos\tref\talt\taf_alt\tinfo\tbeta\tse\tpval_raw\tn"
    path = scratch_path(spark, "lines")
    sinks.with_header(fx.sumstats(spark, sf).select(line.alias("value")), header).write.text(path)
    rows = delimited.scan_study(spark, path, count_fields=True).withColumn("study_ord", F.col("study_ord").cast("int"))
    out = qc.qc_report(rows, {"chr_raw": "chr", "pval_raw": "pval"}, F.col("n_fields"), skip=["file_order", "study_ord", "n_fields"])
    return out.select("study_ord", "n_before", "n_after", "n_field_counts", "is_square")


@query("detect_build", """
    WITH c AS (SELECT m.study_ord, count(*) FILTER (build = 'b37') AS n_b37, count(*) FILTER (build = 'b38') AS n_b38
      FROM (SELECT * FROM munged WHERE NOT (study_ord = 3 AND chr = 21)) m
      LEFT JOIN fx_build b ON m.chr = b.chr AND m.pos = b.pos AND m.chr = 21 GROUP BY 1)
    SELECT *, CASE WHEN n_b37 = 0 AND n_b38 = 0 THEN NULL WHEN n_b37 > n_b38 THEN 'b37' ELSE 'b38' END AS build FROM c""",
       ("munged", "fx_build"))
def detect_build(spark, sf):
    # One study has no chromosome 21.
    return build.detect_build(fx.munged(spark, sf).filter("NOT (study_ord = 3 AND chr = 21)"), fx.build_map(spark, sf))


@query("order_by_ranges", """
    SELECT study_ord, count(*) AS n_rows, count(*) FILTER (chr < pc OR (chr = pc AND pos < pp)) AS n_violations FROM (
      SELECT *, lag(chr) OVER w AS pc, lag(pos) OVER w AS pp FROM munged WINDOW w AS (PARTITION BY study_ord ORDER BY ford))
    GROUP BY study_ord""", ("munged",))
def order_by_ranges(spark, sf):
    return align.order_violations(fx.munged(spark, sf))


@query("bed_intervals", """SELECT 'chr' || CASE chr WHEN 23 THEN 'X' WHEN 24 THEN 'Y' WHEN 25 THEN 'M' ELSE chr::VARCHAR END AS chrom, pos - 1 AS "start",
    pos + greatest(length(ref), length(alt)) - 1 AS "end", ref, alt, n FROM munged""", ("munged",))
def bed_intervals(spark, sf):
    return lo.bed_interval(fx.munged(spark, sf)).select("chrom", "start", "end", "ref", "alt", "n")


@query("order_violations", """
    SELECT study_ord, count(*) AS n_rows, count(*) FILTER (chr < pc OR (chr = pc AND pos < pp)) AS n_violations FROM (
      SELECT *, lag(chr) OVER w AS pc, lag(pos) OVER w AS pp FROM munged WINDOW w AS (PARTITION BY study_ord ORDER BY ford))
    GROUP BY study_ord""", ("munged",))
def order_violations(spark, sf):
    df = fx.munged(spark, sf).withColumn("block", F.expr("file_order.l_orderkey div 1000"))
    return align.order_violations(df, block="block")


# Lifting. Bases of the target build are derived from the parts: agreeing, swapped or neither.

def bases(spark, sf) -> DataFrame:
    v = F.col("p_partkey")
    ref, alt = fx.base_alleles(v)
    minus = v % 13 == 0
    at = v * 100 - 40 + 137 * (v % 7) + F.when(minus, 80 - 1 - 39).otherwise(39) + 1
    base = F.when(v % 3 == 0, ref).when(v % 3 == 1, F.substring(alt, 1, 1)).otherwise("N")
    return fx.table(spark, sf, "part").filter(v % 19 != 0).select(
        (v % 25 + 1).cast("int").alias("chr"), at.alias("pos"),
        F.when(minus, F.translate(base, "ACGT", "TGCA")).otherwise(base).alias("base"))


_BASES = f"""(SELECT (p_partkey % 25 + 1)::INTEGER AS chr, p_partkey * 100 - 40 + 137 * (p_partkey % 7) + CASE WHEN p_partkey % 13 = 0 THEN 41 ELSE 40 END AS pos,
    CASE WHEN p_partkey % 13 = 0 THEN translate(b, 'ACGT', 'TGCA') ELSE b END AS base FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN
      {ref_sql('p_partkey')} WHEN 1 THEN substring({alt_sql('p_partkey')}, 1, 1) ELSE 'N' END AS b FROM part WHERE p_partkey % 19 <> 0))"""
_LIFT = f"""
    j AS (SELECT m.*, c.dst_chr, c.strand, CASE WHEN c.strand = '-' THEN c.dst_start + (c.src_end - c.src_start) - 1 - (m.pos - 1 - c.src_start)
        ELSE c.dst_start + (m.pos - 1 - c.src_start) END + 1 AS lp, c.src_end,
        CASE WHEN c.strand = '-' THEN {comp('m.ref')} ELSE m.ref END AS lr, CASE WHEN c.strand = '-' THEN {comp('m.alt')} ELSE m.alt END AS la
      FROM munged m LEFT JOIN fx_chain c ON m.chr = c.chr AND m.pos - 1 >= c.src_start AND m.pos - 1 < c.src_end),
    k AS (SELECT j.*, base, CASE WHEN dst_chr IS NULL THEN 'NoTarget' WHEN j.pos - 1 + greatest(length(j.ref), length(j.alt)) > src_end THEN 'CrossesBlock'
        WHEN strand = '-' AND (length(j.ref) > 1 OR length(j.alt) > 1) THEN 'ReverseStrandIndel'
        WHEN substring(lr, 1, 1) = base THEN 'OK' WHEN length(lr) = 1 AND length(la) = 1 AND la = base THEN 'SWAP' ELSE 'MismatchedRefAllele' END AS st
      FROM j LEFT JOIN {_BASES} b ON b.chr = j.dst_chr AND b.pos = j.lp),
    lifted AS (SELECT *, CASE st WHEN 'SWAP' THEN 'OK' ELSE st END AS lift_status, st = 'SWAP' AS swapped,
        CASE WHEN st IN ('OK', 'SWAP') THEN dst_chr END AS new_chr, CASE WHEN st IN ('OK', 'SWAP') THEN lp END AS new_pos,
        CASE st WHEN 'OK' THEN lr WHEN 'SWAP' THEN la END AS new_ref, CASE st WHEN 'OK' THEN la WHEN 'SWAP' THEN lr END AS new_alt FROM k)"""
_LIFT_CTES = ("munged", "fx_chain")


def lifted(spark, sf) -> DataFrame:
    return lo.liftover(fx.munged(spark, sf), fx.chain(spark, sf), bases(spark, sf))


LIFT_COLUMNS = ["study_ord", "chr", "pos", "ref", "alt", "n", "new_chr", "new_pos", "new_ref", "new_alt", "swapped", "lift_status"]


@query("liftover", f"WITH {_LIFT} SELECT {', '.join(LIFT_COLUMNS)} FROM lifted", _LIFT_CTES)
def liftover(spark, sf):
    return lifted(spark, sf).select(*LIFT_COLUMNS)


@query("scan_chain", f"WITH {_LIFT} SELECT {', '.join(LIFT_COLUMNS)} FROM lifted", _LIFT_CTES)
def scan_chain(spark, sf):
    """The lift by way of a chain file: one chain for the forward blocks of a chromosome, one for each reverse block."""
    blocks, size, q_size = fx.chain(spark, sf), 80, 1_000_000_000
    names = lambda strand, s0, s1, q0, q1: F.concat_ws(
        " ", F.lit("chain 1"), F.concat(F.lit("chr"), F.col("chr").cast(TEXT)), F.lit(f"{q_size} +"), s0.cast(TEXT), s1.cast(TEXT),
        F.concat(F.lit("chr"), F.col("dst_chr").cast(TEXT)), F.lit(f"{q_size} {strand}"), q0.cast(TEXT), q1.cast(TEXT), F.lit("7"))
    listed = blocks.filter("strand = '+'").groupBy("chr", "dst_chr").agg(
        F.array_sort(F.collect_list(F.struct(F.col("src_start").alias("s"), F.col("dst_start").alias("q")))).alias("b"))
    following = lambda i, c: F.get(F.col("b"), i + 1)[c]
    lines = F.transform("b", lambda x, i: F.when(i == F.size("b") - 1, F.lit(f"{size}")).otherwise(F.concat_ws(
        "\t", F.lit(f"{size}"), (following(i, "s") - x["s"] - size).cast(TEXT), (following(i, "q") - x["q"] - size).cast(TEXT))))
    last = F.element_at("b", -1)
    forward = listed.select(F.concat(names("+", F.col("b")[0]["s"], last["s"] + size, F.col("b")[0]["q"], last["q"] + size),
                                     F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("value"))
    start = q_size - F.col("dst_start") - size
    reverse = blocks.filter("strand = '-'").select(F.concat(
        names("-", F.col("src_start"), F.col("src_end"), start, start + size), F.lit(f"\n{size}\n")).alias("value"))
    path = scratch_path(spark, "chain")
    forward.unionByName(reverse).write.text(path)
    return lo.liftover(fx.munged(spark, sf), delimited.scan_chain(spark, path), bases(spark, sf)).select(*LIFT_COLUMNS)


# A target sequence for indels on reverse blocks: runs of up to three equal bases.

def sequence(spark, sf) -> DataFrame:
    """The 280 bases up to the end of each reverse block."""
    base = lambda p: F.substring(F.lit("ACGT"), ((F.floor(p / 3) * 7 + F.floor(p / 11) + F.col("chr")) % 4 + 1).cast("int"), F.lit(1))
    start = F.col("dst_start") - 199
    pieces = fx.chain(spark, sf).filter("strand = '-'").select(F.col("dst_chr").alias("chr"), start.alias("start"))
    return windows_of(pieces.select("chr", "start", F.array_join(F.transform(F.sequence("start", F.col("start") + 279), base), "").alias("bases")))


def _t(p: str) -> str:
    return f"substr('ACGT', (({p}) // 3 * 7 + ({p}) // 11 + dst_chr) % 4 + 1, 1)"


@query("lift_indels", f"""
    WITH j AS (SELECT m.*, c.dst_chr, c.dst_start + 79 - (m.pos - 1 - c.src_start) + 1 AS e, length(m.ref) AS len,
        {comp('substr(m.ref || m.alt, CASE WHEN length(m.ref) = 2 THEN 2 ELSE 3 END, 1)')} AS unit FROM munged m JOIN fx_chain c
        ON m.chr = c.chr AND m.pos - 1 >= c.src_start AND m.pos - 1 < c.src_end WHERE c.strand = '-' AND length(m.ref) + length(m.alt) > 2),
    k AS (SELECT *, {_t('e')} = {comp('substr(ref, 1, 1)')} AND (len = 1 OR {_t('e - 1')} = {comp('substr(ref, 2, 1)')}) AS ok,
        list_filter(range(0, 60), lambda i: {_t('e - len - i')} <> unit)[1] AS s FROM
        (SELECT * REPLACE (CASE WHEN len = 2 THEN {comp('substr(ref, 2, 1)')} ELSE {comp('substr(alt, 2, 1)')} END AS unit) FROM j))
    SELECT study_ord, chr, pos, ref, alt, n, CASE WHEN ok THEN dst_chr END AS new_chr, CASE WHEN ok THEN e - len - s END AS new_pos,
      CASE WHEN ok THEN {_t('e - len - s')} || CASE WHEN len = 2 THEN unit ELSE '' END END AS new_ref,
      CASE WHEN ok THEN {_t('e - len - s')} || CASE WHEN len = 1 THEN unit ELSE '' END END AS new_alt,
      CASE WHEN ok THEN 'OK' ELSE 'MismatchedRefAllele' END AS lift_status FROM k""", _LIFT_CTES)
def lift_indels(spark, sf):
    out = lo.liftover(fx.munged(spark, sf), fx.chain(spark, sf), windows=sequence(spark, sf))
    v = F.expr("pos div 100")
    turned = (v % 13 == 0) & (v % 19 != 0) & (F.length("ref") + F.length("alt") > 2)
    return out.filter(turned).select("study_ord", "chr", "pos", "ref", "alt", "n", "new_chr", "new_pos", "new_ref", "new_alt", "lift_status")


@query("lift_rejects", f"WITH {_LIFT} SELECT study_ord, chr, pos, ref, alt, n, lift_status FROM lifted WHERE lift_status <> 'OK'", _LIFT_CTES)
def lift_rejects(spark, sf):
    return lo.lift_rejects(lifted(spark, sf)).select("study_ord", "chr", "pos", "ref", "alt", "n", "lift_status")


_APPLIED = f"""SELECT study_ord, new_chr AS chr, new_pos AS pos, new_ref AS ref, new_alt AS alt, n,
      {sql_rnd('CASE WHEN swapped THEN 0 - beta ELSE beta END')} AS beta, {sql_rnd('CASE WHEN swapped THEN 1 - af_alt ELSE af_alt END')} AS af_alt,
      chr AS b37_chr, pos AS b37_pos, ref AS b37_ref, alt AS b37_alt, CASE WHEN swapped THEN 'SwappedAlleles' ELSE 'Lifted' END AS liftover_info
    FROM lifted WHERE lift_status = 'OK' AND new_chr BETWEEN 1 AND 24"""
APPLIED = ["study_ord", "chr", "pos", "ref", "alt", "n", "beta", "af_alt", "b37_chr", "b37_pos", "b37_ref", "b37_alt", "liftover_info"]


@query("lift_apply", f"WITH {_LIFT} {_APPLIED}", _LIFT_CTES)
def lift_apply(spark, sf):
    rows = fx.munged(spark, sf)
    sites = lo.liftover(rows.select("chr", "pos", "ref", "alt").distinct(), fx.chain(spark, sf), bases(spark, sf))
    out = lo.lift_apply(rows, sites.filter("lift_status = 'OK'"))
    return out.select(*[rnd(c).alias(c) if c in ("beta", "af_alt") else c for c in APPLIED])


@query("lift_back", """
    WITH j AS (SELECT m.*, CASE WHEN c.strand = '-' THEN c.dst_start + (c.src_end - c.src_start) - 1 - (m.pos - 1 - c.src_start)
        ELSE c.dst_start + (m.pos - 1 - c.src_start) END + 1 AS lp FROM munged m JOIN fx_chain c
        ON m.chr = c.chr AND m.pos - 1 >= c.src_start AND m.pos - 1 < c.src_end
        WHERE m.pos - 1 + greatest(length(m.ref), length(m.alt)) <= c.src_end AND NOT (c.strand = '-' AND (length(m.ref) > 1 OR length(m.alt) > 1)))
    SELECT chr, lp AS pos, ref, alt, chr||':'||lp||':'||ref||':'||alt AS snp, n, chr AS anew_chr, pos AS anew_pos FROM j""", _LIFT_CTES)
def lift_back(spark, sf):
    from sumweave.operators.annotate import with_snp
    df = with_snp(fx.munged(spark, sf).select("chr", "pos", "ref", "alt", "n"))
    return lo.lift_back(df, fx.chain(spark, sf))


# Harmonisation. Studies take the reference population of their ancestry.

def with_pop(spark, sf) -> DataFrame:
    pop = fx.pick(F.col("study_ord") % 3, ["nfe", "fin", "afr"])
    return fx.munged(spark, sf).withColumn("pop", pop)


_PAL = "(ref||alt IN ('AT','TA','CG','GC'))"


def harmonize_sql(pre_aligned: bool = False, ref_where: str = "true") -> str:
    """All rows with their best candidate: `hz` has one row per study row."""
    key = "ref||'|'||alt" if pre_aligned else f"CASE WHEN {_PAL} THEN ref||'|'||alt ELSE {key_sql()} END"
    turn = "false" if pre_aligned else _turn("s.ref", "s.alt", "r.rref", "r.ralt")
    return f"""
    s AS (SELECT *, list_extract(['nfe','fin','afr'], study_ord % 3 + 1) AS pop, {key} AS hk FROM munged),
    r AS (SELECT pop, chr, pos, ref AS rref, alt AS ralt, af, filter_, {key} AS hk FROM fx_reference WHERE {ref_where}),
    c AS (SELECT s.*, r.rref, r.ralt, r.af, r.filter_, {turn} AS turn FROM s LEFT JOIN r
          ON s.pop = r.pop AND s.chr = r.chr AND s.pos = r.pos AND s.hk = r.hk),
    b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY ford ORDER BY
          coalesce(abs(CASE WHEN turn THEN 1 - af_alt ELSE af_alt END - af), 1), rref, ralt) = 1),
    hz AS (SELECT study_ord, pop, chr, pos, n, ford, filter_, af,
          {'ref' if pre_aligned else 'coalesce(rref, ref)'} AS ref, {'alt' if pre_aligned else 'coalesce(ralt, alt)'} AS alt,
          CASE WHEN turn AND rref IS NOT NULL THEN 0 - beta ELSE beta END AS beta,
          CASE WHEN turn AND rref IS NOT NULL THEN 1 - af_alt ELSE af_alt END AS af_alt FROM b),
    hd AS (SELECT *, coalesce(abs(af_alt - af), -1) AS af_abs_diff,
          CASE WHEN af = 0 THEN 1e9 ELSE af_alt / af END AS af_fc FROM hz),
    uq AS (SELECT * FROM hd QUALIFY count(*) OVER (PARTITION BY study_ord, chr, pos, ref, alt) = 1)"""


def _turn(ref, alt, rref, ralt):
    from sumweave.queries.base import reversed_sql
    return reversed_sql(ref, alt, rref, ralt)


HZ_SELECT = f"""SELECT study_ord, chr, pos, ref, alt, n, {sql_rnd('beta')} AS beta, {sql_rnd('af_alt')} AS af_alt, {sql_rnd('af')} AS af_gnomad,
    {sql_rnd('af_fc', 4)} AS af_fc, coalesce(filter_, 'NA') AS filt_gnomad, n AS "Ntotal" """
HZ_CTES = ("munged", "fx_reference")


def hz_shown(df: DataFrame) -> DataFrame:
    return df.select("study_ord", "chr", "pos", "ref", "alt", "n", rnd("beta").alias("beta"), rnd("af_alt").alias("af_alt"),
                     rnd("af_gnomad").alias("af_gnomad"), rnd("af_fc", 4).alias("af_fc"), "filt_gnomad", "Ntotal")


@query("harmonize", f"WITH {harmonize_sql()} {HZ_SELECT} FROM uq", HZ_CTES)
def harmonize(spark, sf):
    return hz_shown(hz.harmonize(with_pop(spark, sf), fx.reference(spark, sf)))


def _stored(spark, sf, buckets: int = 8, both: bool = True) -> tuple[DataFrame, DataFrame]:
    """The studies and the panel as tables bucketed alike."""
    name = scratch_path(spark, "panel")
    table = "panel_" + name[-32:]
    panel = hz.store_panel(fx.reference(spark, sf), table, name, buckets)
    rows = with_pop(spark, sf)
    return (hz.store_studies(rows, f"{table}_studies", f"{name}-studies", buckets) if both else rows), panel


@query("harmonize_stored", f"WITH {harmonize_sql()} {HZ_SELECT} FROM uq", HZ_CTES)
def harmonize_stored(spark, sf):
    rows, panel = _stored(spark, sf)
    return hz_shown(hz.harmonize(rows, None, stored=panel))


@query("dedup_discard", f"WITH {harmonize_sql(pre_aligned=True)} {HZ_SELECT} FROM uq", HZ_CTES)
def dedup_discard(spark, sf):
    return hz_shown(hz.harmonize(with_pop(spark, sf), fx.reference(spark, sf), pre_aligned=True))


_BEST = """bst AS (SELECT * FROM hd QUALIFY row_number() OVER (PARTITION BY study_ord, chr, pos, ref, alt
    ORDER BY af_abs_diff < 0, af_abs_diff, ford) = 1)"""


@query("dedup_best", f"WITH {harmonize_sql()}, {_BEST} {HZ_SELECT} FROM bst", HZ_CTES)
def dedup_best(spark, sf):
    return hz_shown(hz.harmonize(with_pop(spark, sf), fx.reference(spark, sf), keep_best_duplicate=True))


@query("require_ref", f"WITH {harmonize_sql()}, {_BEST} {HZ_SELECT} FROM bst WHERE af IS NOT NULL", HZ_CTES)
def require_ref(spark, sf):
    return hz_shown(hz.harmonize(with_pop(spark, sf), fx.reference(spark, sf), keep_best_duplicate=True, require_ref=True))


@query("max_af_diff", f"WITH {harmonize_sql()}, {_BEST} {HZ_SELECT} FROM bst WHERE af_abs_diff <= 0.2", HZ_CTES)
def max_af_diff(spark, sf):
    return hz_shown(hz.harmonize(with_pop(spark, sf), fx.reference(spark, sf), keep_best_duplicate=True, max_abs_diff=0.2))


@query("ref_filter", f"WITH {harmonize_sql(ref_where='''filter_ = 'PASS' AND an >= 20000''')}, {_BEST} {HZ_SELECT} FROM bst", HZ_CTES)
def ref_filter(spark, sf):
    return hz_shown(hz.harmonize(with_pop(spark, sf), fx.reference(spark, sf), keep_best_duplicate=True,
                                 passing_only=True, min_an=20000))


@query("af_compare", f"WITH {harmonize_sql()} SELECT study_ord, chr, pos, ref, alt, n, {sql_rnd('af_fc', 4)} AS af_fc, "
       f"{sql_rnd('af_abs_diff')} AS af_abs_diff FROM hd", HZ_CTES)
def af_compare(spark, sf):
    matched = hz.match_reference(with_pop(spark, sf), fx.reference(spark, sf))
    out = hz.af_compare(F.col("af_alt"), F.col("af_gnomad"))
    return matched.select("study_ord", "chr", "pos", "ref", "alt", "n", rnd(out["af_fc"], 4).alias("af_fc"),
                          rnd(out["af_abs_diff"]).alias("af_abs_diff"))


@query("af_density", f"""WITH {harmonize_sql()}, {_BEST} SELECT floor(af_alt * 100)::BIGINT AS af_bin, floor(af * 100)::BIGINT AS ref_bin,
    count(*) AS n FROM bst WHERE af IS NOT NULL GROUP BY 1, 2""", HZ_CTES)
def af_density(spark, sf):
    return density(hz.harmonize(with_pop(spark, sf), fx.reference(spark, sf), keep_best_duplicate=True))


@query("ntotal", """SELECT study_ord, chr, pos, n AS with_column, 4711::BIGINT AS with_constant FROM munged""", ("munged",))
def ntotal(spark, sf):
    df = fx.munged(spark, sf)
    return df.select("study_ord", "chr", "pos", hz.total_n(df, None).alias("with_column"),
                     hz.total_n(df.drop("n"), 4711).alias("with_constant"))
