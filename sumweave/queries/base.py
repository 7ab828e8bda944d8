"""Registry of queries and the pieces their oracle SQL is made of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query with its oracle: named CTEs in front of a final SELECT."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(ctes, sql)
        return fn
    return register


TIE_SHIFT = 1.7e-9


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison between engines.

    The small shift keeps decimal ties, frequent in these data, off the rounding boundary, where
    the last bit of a sum would decide. Adding zero turns a negative zero into zero.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + TIE_SHIFT, digits) + F.lit(0.0)


def sql_rnd(text: str, digits: int = 6) -> str:
    return f"(round(({text}) + {TIE_SHIFT}, {digits}) + 0.0)"


def mlog10(p: Column | str) -> Column:
    return rnd(-F.log10(p), 4)


def sql_mlog10(text: str) -> str:
    return sql_rnd(f"-log10({text})", 4)


# Oracle numerics, by other methods than the expressions they test, whose coefficients they do not read.

def sql_erfc(x: str) -> str:
    """The complementary error function for x >= 0, from the trapezoid rule for its integral, whose error is known."""
    total = f"(1e0/(2e0*{x}*{x})+list_sum([exp(-0.25e0*k*k)/(0.25e0*k*k+{x}*{x}) for k in range(1, 14)]))"
    rest = f"(CASE WHEN {x} < 2e0*pi() THEN 2e0/(exp(4e0*pi()*{x})-1e0) ELSE 0e0 END)"
    return (f"(CASE WHEN {x} = 0 THEN 1e0 WHEN {x} < 1e-6 THEN 1e0-2e0*{x}/sqrt(pi()) "
            f"WHEN {x} <= 27.5 THEN {x}/pi()*exp(-{x}*{x})*{total}-{rest} WHEN {x} IS NOT NULL THEN 0e0 END)")


def sql_p(z: str) -> str:
    return f"greatest({sql_erfc(f'(abs({z})/sqrt(2e0))')}, 5e-324)"


def sql_z(p: str) -> str:
    """z of a two-sided p, by Newton's method on the logarithm of the tail."""
    tail = sql_erfc("(z/sqrt(2e0))")
    step = f"z+(ln({tail})-ln({p}))*{tail}*sqrt(pi()/2e0)*exp(z*z/2e0)"
    return (f"(CASE WHEN {p} < 0 OR {p} > 1 THEN NULL WHEN {p} = 0 THEN 'Infinity'::DOUBLE WHEN {p} = 1 THEN 0e0 "
            f"ELSE list_reduce([sqrt(-2e0*ln({p}))*0.9e0, 1, 2, 3, 4, 5, 6, 7, 8, 9], lambda z, i: {step}) END)")


def sql_chi2(x: str, df: str) -> str:
    """Upper chi-square tail through log-gamma terms."""
    m = f"({df}//2)"
    even = f"list_sum([exp(j*ln({x}/2)-lgamma(j+1)-{x}/2) for j in range(0, {m})])"
    odd = (f"({sql_erfc(f'sqrt({x}/2)')} + coalesce(list_sum([exp((j-0.5)*ln({x}/2)-lgamma(j+0.5)-{x}/2) "
           f"for j in range(1, {m}+1)]), 0))")
    return f"(CASE WHEN {df} < 1 THEN NULL WHEN {x} <= 0 THEN 1e0 WHEN {df} % 2 = 0 THEN {even} ELSE {odd} END)"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_V = "l_partkey"
_REF = "list_extract(['A','A','C','A','A'], (V % 5 + 1)::INTEGER)"
_ALT = "list_extract(['C','G','T','T','AT'], (V % 5 + 1)::INTEGER)"


def ref_sql(v: str) -> str:
    return _REF.replace("V", v)


def alt_sql(v: str) -> str:
    return _ALT.replace("V", v)


def comp(a: str) -> str:
    return f"translate({a}, 'ACGT', 'TGCA')"


def key_sql(ref: str = "ref", alt: str = "alt") -> str:
    return (f"least({ref}||'|'||{alt}, {alt}||'|'||{ref}, {comp(ref)}||'|'||{comp(alt)}, "
            f"{comp(alt)}||'|'||{comp(ref)})")


def reversed_sql(ref: str, alt: str, to_ref: str, to_alt: str) -> str:
    return (f"(CASE WHEN {ref}={to_ref} AND {alt}={to_alt} THEN false WHEN {ref}={to_alt} AND {alt}={to_ref} THEN true "
            f"WHEN {comp(ref)}={to_ref} AND {comp(alt)}={to_alt} THEN false ELSE true END)")


NORM_SQL = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(chr_raw, '^0', ''), '^chr', ''), "
            "'^X', '23'), '^Y', '24')")
FILE_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, n, beta, se"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_study": ((), """
        SELECT DISTINCT (s_suppkey % 6)::INTEGER AS study_ord,
          'S' || (s_suppkey % 6) || '_' || list_extract(['EUR','FIN','AFR','EAS','AMR','SAS'], (s_suppkey % 6 + 1)::INTEGER) AS study,
          200 * (s_suppkey % 6 + 1) AS n_cases, 2000 * (s_suppkey % 6 + 1) + 17 AS n_controls
        FROM supplier"""),
    "fx_raw": ((), f"""
        SELECT (l_suppkey % 6)::INTEGER AS study_ord,
          CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN '0' ELSE 'chr' END ||
          CASE l_partkey % 25 + 1 WHEN 23 THEN 'X' WHEN 24 THEN 'Y' WHEN 25 THEN 'MT'
            ELSE (l_partkey % 25 + 1)::VARCHAR END AS chr_raw,
          l_partkey * 100 AS pos, {ref_sql(_V)} AS bref, {alt_sql(_V)} AS balt, l_orderkey % 4 AS turn,
          l_linenumber / 10 AS af_alt, 5 * l_discount + 0.5 AS info, l_discount - 0.05 AS beta, l_tax + 0.01 AS se,
          CASE WHEN l_orderkey % 97 = 0 THEN 'NA' ELSE ((l_orderkey * 7919 + l_linenumber) % 9973)::VARCHAR END AS pval_raw,
          (100 * l_quantity)::BIGINT AS n, l_orderkey, l_linenumber, l_partkey, l_suppkey
        FROM lineitem"""),
    "fx_sumstats": (("fx_raw",), f"""
        SELECT * EXCLUDE (bref, balt, turn),
          CASE turn WHEN 0 THEN bref WHEN 1 THEN balt WHEN 2 THEN {comp('bref')} ELSE {comp('balt')} END AS ref,
          CASE turn WHEN 0 THEN balt WHEN 1 THEN bref WHEN 2 THEN {comp('balt')} ELSE {comp('bref')} END AS alt
        FROM fx_raw"""),
    "munged": (("fx_sumstats",), f"""
        SELECT * EXCLUDE (chr_raw, pval_raw, chr_text), chr_text::INTEGER AS chr,
          TRY_CAST(pval_raw AS DOUBLE) / 9973 AS pval,
          row_number() OVER (ORDER BY {FILE_ORDER}) AS ford
        FROM (SELECT *, {NORM_SQL} AS chr_text FROM fx_sumstats)
        WHERE regexp_matches(chr_text, '^[0-9]+$') AND concat_ws(' ', chr_raw, ref, alt, pval_raw) NOT LIKE '%NA%'
          AND TRY_CAST(pval_raw AS DOUBLE) > 0 AND beta > -1e6 AND beta < 1e6
          AND af_alt >= 0.001 AND 1 - af_alt >= 0.001 AND info >= 0.6"""),
    "dedup": (("munged",), """
        SELECT * FROM munged QUALIFY row_number() OVER (PARTITION BY study_ord, chr, pos, ref, alt ORDER BY ford) = 1"""),
    "keyed": (("dedup",), f"SELECT *, {key_sql()} AS k FROM dedup"),
}
# Alignment, round by round: the anchor is the first remaining row of the lowest study, and each
# study gives the row spelled like it, or else its first remaining row.
for _r in range(4):
    _src = "keyed" if _r == 0 else f"left{_r}"
    CTES[f"pick{_r}"] = ((_src,), f"""
        SELECT p.*, {_r} AS occ FROM (
          SELECT r.*, a.aref, a.aalt, row_number() OVER (PARTITION BY r.chr, r.pos, r.k, r.study_ord
            ORDER BY (CASE WHEN r.ref = a.aref AND r.alt = a.aalt THEN 0 ELSE 1 END), r.ford) AS rn
          FROM {_src} r JOIN (
            SELECT chr, pos, k, arg_min(ref, (study_ord, ford)) AS aref, arg_min(alt, (study_ord, ford)) AS aalt
            FROM {_src} GROUP BY chr, pos, k) a
          ON r.chr = a.chr AND r.pos = a.pos AND r.k = a.k) p WHERE rn = 1""")
    CTES[f"left{_r + 1}"] = ((_src, f"pick{_r}"),
                             f"SELECT * FROM {_src} s WHERE NOT EXISTS (SELECT 1 FROM pick{_r} p WHERE p.ford = s.ford)")
_FLIP = reversed_sql("ref", "alt", "aref", "aalt")
CTES["aligned"] = (("pick0", "pick1", "pick2", "pick3", "fx_study"), f"""
        SELECT p.chr, p.pos, p.aref AS ref, p.aalt AS alt, p.occ, p.study_ord,
          CASE WHEN flip THEN 0 - p.beta ELSE p.beta END AS beta,
          CASE WHEN flip THEN 1 - p.af_alt ELSE p.af_alt END AS af_alt,
          p.se, p.pval, p.info, p.n, s.n_cases, s.n_controls, s.study
        FROM (SELECT *, {_FLIP} AS flip FROM (SELECT * FROM pick0 UNION ALL SELECT * FROM pick1
              UNION ALL SELECT * FROM pick2 UNION ALL SELECT * FROM pick3)) p JOIN fx_study s USING (study_ord)""")
CTES["fx_reference"] = ((), f"""
        SELECT pop, (p_partkey % 25 + 1)::INTEGER AS chr, p_partkey * 100 AS pos, {ref_sql('p_partkey')} AS ref, alt,
          CASE WHEN p_size % 17 = 0 THEN NULL ELSE (p_size % 50) / 50 END AS af,
          CASE WHEN p_partkey % 11 = 0 THEN 'AC0' ELSE 'PASS' END AS filter_, (1000 * p_size)::BIGINT AS an
        FROM (SELECT *, unnest(CASE WHEN p_partkey % 5 = 0 THEN [{alt_sql('p_partkey')}, 'G'] ELSE [{alt_sql('p_partkey')}] END) AS alt
              FROM (SELECT *, unnest(['nfe', 'fin', 'afr']) AS pop FROM part))""")
CTES["fx_rsid"] = ((), f"""
        SELECT (p_partkey % 25 + 1)::INTEGER AS chr, p_partkey * 100 AS pos, 'rs' || p_partkey AS id,
          {ref_sql('p_partkey')} AS ref, {alt_sql('p_partkey')} || CASE WHEN p_partkey % 4 = 0 THEN ',GG' ELSE '' END AS alt_list,
          p_partkey AS seq FROM part WHERE p_partkey % 3 <> 0""")
CTES["fx_chain"] = ((), """
        SELECT (p_partkey % 25 + 1)::INTEGER AS chr, p_partkey * 100 - 40 AS src_start, p_partkey * 100 + 40 AS src_end,
          (p_partkey % 25 + 1)::INTEGER AS dst_chr, p_partkey * 100 - 40 + 137 * (p_partkey % 7) AS dst_start,
          CASE WHEN p_partkey % 13 = 0 THEN '-' ELSE '+' END AS strand FROM part WHERE p_partkey % 19 <> 0""")
CTES["fx_build"] = ((), """
        SELECT CASE WHEN p_partkey % 2 = 0 THEN 'b37' ELSE 'b38' END AS build, 21 AS chr, p_partkey * 100 AS pos
        FROM part WHERE p_partkey % 25 = 20 AND p_partkey % 3 = 0""")
CTES["fx_files"] = ((), """
        SELECT s_suppkey AS seq, 'gs://bucket' || s_nationkey || '/COH' || (s_suppkey % 9) || '_Sur_' ||
          list_extract(['WE','WQ','NE','NQ'], (s_suppkey % 4 + 1)::INTEGER) || CASE WHEN s_suppkey % 8 < 4 THEN '1.3' ELSE '2.3' END ||
          '_F' || (s_suppkey % 3 + 1) || '_ALL_ALL_' || list_extract(['EUR','FIN','SAS','AFR','ARB'], (s_suppkey % 5 + 1)::INTEGER) ||
          '_' || (100 + s_suppkey) || '_' || (1000 + s_suppkey) || CASE WHEN s_suppkey % 2 = 0 THEN '_REGENIE_2022' ELSE '_SAIGE_2022' END ||
          CASE WHEN s_suppkey % 10 = 9 THEN 'XX' ELSE '04' END || '11.txt.gz' AS uri FROM supplier""")
CTES["fx_named"] = (("fx_files",), """
        SELECT seq, uri, split_part(uri, '/', 3) AS bucket, split_part(name, '_', 1) AS dataset, split_part(name, '_', 2) AS surname,
          split_part(name, '_', 3) AS pheno, split_part(name, '_', 4) AS "freeze", split_part(name, '_', 5) AS age,
          split_part(name, '_', 6) AS sex, split_part(name, '_', 7) AS ancestry, split_part(name, '_', 8)::BIGINT AS cases,
          split_part(name, '_', 9)::BIGINT AS controls, split_part(name, '_', 10) AS software,
          replace(split_part(name, '_', 11), '.txt.gz', '') AS date, name
        FROM (SELECT *, split_part(uri, '/', 4) AS name FROM fx_files)""")
CTES["fx_dotted"] = ((), """
        SELECT s_suppkey AS seq, 'gs://up' || (s_suppkey % 4) || '/' || list_extract(['UKBB','23andMe','FinnGen','HOSTAGE',
          'Italy_HOSTAGE','CCHC','GENOMICC','CHULA','Egypt_hgCOVID','BQC19','MVP'], (s_suppkey % 11 + 1)::INTEGER) || '.Sur.ANA_' ||
          list_extract(['A1','A2','B1','B2','C1','C2','Z9'], (s_suppkey % 7 + 1)::INTEGER) || '_V2.' ||
          CASE WHEN s_suppkey % 23 = 5 THEN 'five' ELSE '5' END || '.' ||
          CASE WHEN s_suppkey % 13 = 0 THEN 'gt_60' WHEN s_suppkey % 13 = 1 THEN 'LT_60' ELSE 'ALL' END || '.' ||
          CASE WHEN s_suppkey % 6 = 0 THEN 'F' WHEN s_suppkey % 6 = 1 THEN 'Male' WHEN s_suppkey % 29 = 3 THEN 'x' ELSE 'ALL' END || '.' ||
          list_extract(['EUR','FIN','AFR','EAS','AMR','HIS','MID','XXX'], (s_suppkey % 8 + 1)::INTEGER) || '.' ||
          (100 + s_suppkey) || '.' || (1000 + s_suppkey) || '.SAIGE.20220411' ||
          CASE WHEN s_suppkey % 17 = 4 THEN '.extra' ELSE '' END || '.txt.gz' AS uri FROM supplier""")
CTES["dotted_fields"] = (("fx_dotted",), """
        SELECT *, string_split(replace(split_part(uri, '/', 4), '.txt.gz', ''), '.') AS f FROM fx_dotted""")
CTES["dotted_checked"] = (("dotted_fields",), """
        SELECT seq, uri, f, array_to_string([x for x in [
            CASE WHEN NOT (f[4] ~ '^[0-9]+$') THEN 'number' END,
            CASE WHEN upper(f[7]) NOT IN ('EUR','AFR','FIN','EAS','AMR','HIS','MID') THEN 'pop' END,
            CASE WHEN NOT (f[3] ~ '(A1|A2|A3|B1|B2|B3|C1|C2|D1)') THEN 'analysis' END,
            CASE WHEN upper(f[5]) NOT IN ('ALL','GT_60','LE_60') THEN 'age' END,
            CASE WHEN NOT (upper(f[6]) ~ '^(F|M|ALL$)') THEN 'sex' END] if x IS NOT NULL], ',') AS bad FROM dotted_fields
        WHERE len(f) = 11""")
CTES["dotted_valid"] = (("dotted_checked",), """
        SELECT seq, uri, f[1] AS cohort, regexp_extract(f[3], '(A1|A2|B1|B2|C1|C2)') AS ana, upper(f[5]) AS age,
          CASE WHEN upper(f[6]) LIKE 'F%' THEN 'FEMALE' WHEN upper(f[6]) LIKE 'M%' THEN 'MALE' ELSE 'ALL' END AS sex,
          upper(f[7]) AS pop, f[8]::BIGINT AS n_cases, f[9]::BIGINT AS n_controls FROM dotted_checked WHERE bad = ''""")
CTES["conf"] = (("dotted_valid",), """
        SELECT *, ana || '_' || stratum AS analysis, cohort || '_' || pop AS name FROM (
          SELECT *, CASE WHEN sex = 'ALL' THEN age ELSE sex END AS stratum FROM dotted_valid WHERE NOT (sex <> 'ALL' AND age <> 'ALL'))""")
CTES["fx_runs"] = ((), """
        SELECT user_id % 30 AS run_id, event_type AS call_name, user_id AS shard,
          row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)::INTEGER AS attempt,
          CASE WHEN event_id % 7 = 0 THEN 'Failed' WHEN event_id % 11 = 0 THEN 'Aborted'
            WHEN event_id % 13 = 0 THEN 'RetryableFailure' ELSE 'Done' END AS status, ts AS start_ts, value AS dur_min, event_id FROM events""")
CTES["fx_shortlist"] = ((), f"""
        SELECT (p_partkey % 25 + 1) || ':' || (p_partkey * 100) || ':' || {ref_sql('p_partkey')} || ':' || {alt_sql('p_partkey')} AS snp
        FROM part WHERE p_partkey % 10 = 0""")


def with_ctes(names: tuple[str, ...], body: str) -> str:
    done: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0]:
            add(needed)
        if name not in done:
            done.append(name)

    for name in names:
        add(name)
    if not done:
        return body.strip()
    inner = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1].strip()})" for name in done)
    body = body.strip()
    # A query with CTEs of its own continues the list.
    return f"WITH {inner},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {inner}\n{body}"
