"""Manifest, cohort and run-log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sumweave.operators import cohorts, manifest, runlog
from sumweave.queries import fixtures as fx
from sumweave.queries.base import query, rnd, sql_rnd
from sumweave.session import scratch_path
from sumweave.sources import config, runs

# The fallback rules written out, not taken from the code they test.
_RULES = """('WQ1.3', 'WQ1.3', 0), ('WQ1.3', 'NQ1.3', 1), ('WQ2.3', 'WQ2.3', 0), ('WQ2.3', 'NQ2.3', 1), ('N1.3', 'NE1.3', 0), ('N1.3', 'NQ1.3', 1),
        ('N2.3', 'NE2.3', 0), ('N2.3', 'NQ2.3', 1), ('W1.3', 'WE1.3', 0), ('W1.3', 'WQ1.3', 1), ('W1.3', 'NE1.3', 2), ('W1.3', 'NQ1.3', 3),
        ('W2.3', 'WE2.3', 0), ('W2.3', 'WQ2.3', 1), ('W2.3', 'NE2.3', 2), ('W2.3', 'NQ2.3', 3)"""
VALID = "date ~ '^202[1-9][0-1][0-9][0-3][0-9]$'"


def results(spark, sf) -> DataFrame:
    return manifest.parse_name(manifest.classify_files(fx.files(spark, sf)).filter("kind = 'results'")).drop("kind")


@query("classify_files", f"SELECT seq, uri, CASE WHEN {VALID} THEN 'results' ELSE 'unrecognised' END AS kind FROM fx_named", ("fx_named",))
def classify_files(spark, sf):
    return manifest.classify_files(fx.files(spark, sf))


@query("parse_name", """SELECT seq, uri, dataset, surname, pheno, "freeze", age, sex, ancestry, cases, controls, software, date FROM fx_named""", ("fx_named",))
def parse_name(spark, sf):
    return manifest.parse_name(fx.files(spark, sf))


@query("manifest_shape", """SELECT seq, line, CASE WHEN seq % 7 = 0 THEN 'fields:2' ELSE 'prefix' END AS problem FROM (
    SELECT seq, CASE WHEN seq % 7 = 0 THEN uri || ' extra' WHEN seq % 11 = 0 THEN replace(uri, 'gs://', 's3://') ELSE uri END AS line FROM fx_files)
    WHERE seq % 7 = 0 OR seq % 11 = 0""", ("fx_files",))
def manifest_shape(spark, sf):
    line = (F.when(F.col("seq") % 7 == 0, F.concat(F.col("uri"), F.lit(" extra")))
            .when(F.col("seq") % 11 == 0, F.regexp_replace("uri", "gs://", "s3://")).otherwise(F.col("uri")))
    return manifest.manifest_shape(fx.files(spark, sf).select("seq", line.alias("line")), "line", 1)


@query("latest_file", """SELECT split_part(uri, '/', 4) AS name, arg_max(uri, seq) AS uri FROM fx_files GROUP BY 1""", ("fx_files",))
def latest_file(spark, sf):
    return manifest.latest_file(fx.files(spark, sf))


@query("pick_latest", f"""SELECT dataset, "freeze", pheno, uri, cases, controls FROM fx_named WHERE {VALID}
    QUALIFY row_number() OVER (PARTITION BY dataset, "freeze", pheno ORDER BY date DESC, seq DESC) = 1""", ("fx_named",))
def pick_latest(spark, sf):
    return manifest.pick_latest(results(spark, sf)).select("dataset", "freeze", "pheno", "uri", "cases", "controls")


@query("pick_newest", f"""SELECT dataset, "freeze", pheno, uri FROM fx_named WHERE {VALID}
    QUALIFY row_number() OVER (PARTITION BY dataset, "freeze", pheno ORDER BY seq * 7919 % 1009 DESC, date DESC, seq DESC) = 1""", ("fx_named",))
def pick_newest(spark, sf):
    # Uploads in an order that is neither that of the names' dates nor that of the listing.
    listed = fx.files(spark, sf).select("uri", F.timestamp_seconds(1_600_000_000 + F.col("seq") * 7919 % 1009).alias("modified"))
    return manifest.pick_latest(manifest.with_modified(results(spark, sf), listed)).select("dataset", "freeze", "pheno", "uri")


@query("meta_documents", f"""SELECT analysis AS pheno, study AS name, uri AS file, cases AS n_cases, controls AS n_controls, 'beta' AS effect_type,
    row_number() OVER (PARTITION BY analysis ORDER BY study) - 1 AS study_ord FROM (SELECT * FROM (
      SELECT r.target AS analysis, dataset || '_' || ancestry AS study, uri, cases, controls, r.rank, seq FROM fx_named JOIN (VALUES {_RULES}) r(target, source, rank) ON pheno = r.source WHERE {VALID})
      QUALIFY row_number() OVER (PARTITION BY analysis, study ORDER BY rank, seq DESC) = 1)""", ("fx_named",))
def meta_documents(spark, sf):
    rows = manifest.study_config(manifest.pheno_fallback(results(spark, sf))).filter(~F.col("pheno").rlike("^N[EQ]"))
    path = scratch_path(spark, "documents")
    manifest.meta_configs(rows).select("pheno", F.col("document").alias("value")).write.partitionBy("pheno").text(path)
    back = config.scan_config(spark, f"{path}/*", by_folder=True)
    return back.select("pheno", "name", "file", "n_cases", "n_controls", "effect_type", F.col("study_ord").cast("bigint").alias("study_ord"))


_CELLS = ", ".join(f"max(CASE WHEN \"freeze\" = '{f}' AND pheno = '{p}' THEN cases || '/' || controls END) AS \"{f}_{p}\""
                   for f in ("F1", "F2", "F3") for p in manifest.PHENOS)


@query("contribution_table", f"""
    WITH v AS (SELECT * FROM fx_named WHERE {VALID}),
    l AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY dataset, "freeze", pheno ORDER BY date DESC, seq DESC) = 1),
    t AS (SELECT dataset, {_CELLS} FROM l GROUP BY dataset),
    i AS (SELECT dataset, max(CASE WHEN seq % 5 = 0 AND "freeze" = 'F1' THEN 'YES' END) AS "F1_sampleinfo",
      max(CASE WHEN seq % 5 = 0 AND "freeze" = 'F2' THEN 'YES' END) AS "F2_sampleinfo",
      max(CASE WHEN seq % 5 = 0 AND "freeze" = 'F3' THEN 'YES' END) AS "F3_sampleinfo" FROM v GROUP BY dataset)
    SELECT DISTINCT v.bucket, t.*, i.* EXCLUDE (dataset) FROM v JOIN t USING (dataset) JOIN i USING (dataset)
    UNION ALL BY NAME SELECT 'up9' AS bucket, 'Lonely' AS dataset, 'YES' AS "F2_sampleinfo" WHERE EXISTS (SELECT 1 FROM fx_named WHERE seq = 0)""", ("fx_named",))
def contribution_table(spark, sf):
    parsed = results(spark, sf)
    # Every fifth file's study gives sample information; so does one study without results.
    info = parsed.filter("seq % 5 = 0").select("uri", "dataset", "freeze")
    lone = fx.files(spark, sf).filter("seq = 0").select(F.lit("gs://up9/Lonely_Smith_F2.zip").alias("uri"))
    info = info.union(manifest.parse_sample_name(lone).select("uri", "dataset", "freeze"))
    return manifest.contribution_table(parsed, ["F1", "F2", "F3"], sampleinfo=info)


@query("availability", f"""
    WITH s AS (SELECT pheno, dataset, array_to_string(list_sort(list(DISTINCT "freeze")), ',') AS fr FROM fx_named WHERE {VALID} GROUP BY 1, 2)
    SELECT pheno, array_to_string(list_sort(list(dataset || ' (' || fr || ')')), ', ') AS studies FROM s GROUP BY 1""", ("fx_named",))
def availability(spark, sf):
    return manifest.availability(results(spark, sf))


@query("non_empty_buckets", "SELECT count(DISTINCT bucket) AS n_buckets FROM fx_named", ("fx_named",))
def non_empty_buckets(spark, sf):
    return manifest.non_empty_buckets(fx.files(spark, sf))


@query("ancestry_map", """SELECT uri, CASE WHEN ancestry IN ('SAS','EAS','AFR','AMR') THEN lower(ancestry)
    WHEN ancestry = 'FIN' OR lower(dataset) LIKE '%finngen%' THEN 'fin' WHEN ancestry IN ('EUR','NFE') THEN 'nfe' ELSE 'oth' END AS pop FROM fx_named""", ("fx_named",))
def ancestry_map(spark, sf):
    return manifest.parse_name(fx.files(spark, sf)).select(
        "uri", manifest.reference_population(F.col("dataset"), F.col("ancestry")).alias("pop"))


_FALLBACK = f"""(SELECT analysis, study, pheno, uri, cases, controls FROM (
      SELECT r.target AS analysis, dataset || '_' || ancestry AS study, pheno, uri, cases, controls, r.rank, seq
      FROM fx_named JOIN (VALUES {_RULES}) r(target, source, rank) ON pheno = r.source WHERE {VALID})
      QUALIFY row_number() OVER (PARTITION BY analysis, study ORDER BY rank, seq DESC) = 1
    UNION ALL SELECT pheno, dataset || '_' || ancestry, pheno, uri, cases, controls FROM fx_named WHERE {VALID} AND pheno LIKE 'N%')"""


@query("pheno_fallback", f"SELECT * FROM {_FALLBACK}", ("fx_named",))
def pheno_fallback(spark, sf):
    return manifest.pheno_fallback(results(spark, sf))


@query("study_config", f"""SELECT analysis AS pheno, study AS name, uri AS file, cases AS n_cases, controls AS n_controls, '#CHR' AS chr, 'POS' AS pos,
    'REF' AS ref, 'ALT' AS alt, 'af_alt' AS af_alt, 'imputationInfo' AS info, 'beta' AS effect, 'beta' AS effect_type, 'pval' AS pval,
    'sebeta' AS se, 'N' AS "Nsamples" FROM {_FALLBACK}""", ("fx_named",))
def study_config(spark, sf):
    return manifest.study_config(manifest.pheno_fallback(results(spark, sf))).drop("config")


@query("study_config_json", f"""SELECT analysis AS pheno, study AS name, '{{"name":"' || study || '","file":"' || uri || '","n_cases":' || cases ||
    ',"n_controls":' || controls || ',"chr":"#CHR","pos":"POS","ref":"REF","alt":"ALT","af_alt":"af_alt","info":"imputationInfo","effect":"beta",' ||
    '"effect_type":"beta","pval":"pval","se":"sebeta","Nsamples":"N"}}' AS config FROM {_FALLBACK}""", ("fx_named",))
def study_config_json(spark, sf):
    return manifest.study_config(manifest.pheno_fallback(results(spark, sf))).select("pheno", "name", "config")


@query("pheno_list", "SELECT pheno, min(seq) AS first_seq FROM fx_named GROUP BY pheno", ("fx_named",))
def pheno_list(spark, sf):
    return manifest.pheno_list(manifest.parse_name(fx.files(spark, sf)))


@query("files_by_pheno", f"""SELECT pheno, string_agg(uri, chr(9) ORDER BY seq) AS files FROM fx_named WHERE {VALID} GROUP BY pheno""", ("fx_named",))
def files_by_pheno(spark, sf):
    return manifest.files_by_pheno(results(spark, sf))


@query("pheno_totals", f"SELECT pheno, sum(cases)::BIGINT AS n_cases, sum(controls)::BIGINT AS n_controls FROM fx_named WHERE {VALID} GROUP BY 1", ("fx_named",))
def pheno_totals(spark, sf):
    return manifest.pheno_totals(results(spark, sf))


# Dot-separated upload names and cohort lists.

@query("validate_name", """
    SELECT seq, uri, bad AS problems FROM dotted_checked UNION ALL SELECT seq, uri, 'fields' FROM dotted_fields WHERE len(f) <> 11""",
       ("dotted_checked", "dotted_fields"))
def validate_name(spark, sf):
    return cohorts.validate_name(fx.dotted(spark, sf)).select("seq", "uri", F.array_join("problems", ",").alias("problems"))


@query("validate_upload", """
    SELECT seq, uri, CASE WHEN len(f) <> 11 THEN 'fields' WHEN bad = '' THEN 'ALLGOOD' ELSE bad END AS verdict FROM (
      SELECT *, array_to_string([x for x in [
        CASE WHEN NOT (f[4] ~ '^[0-9]+$') THEN 'number' END,
        CASE WHEN f[7] NOT IN ('EUR','AFR','FIN','EAS','AMR','HIS') THEN 'pop' END,
        CASE WHEN NOT (f[3] ~ '(A1|A2|B1|B2|B3|C1|C2|D1)') THEN 'analysis' END,
        CASE WHEN upper(f[5]) NOT IN ('ALL','GT_60','LT_60','LE_60') THEN 'age' END,
        CASE WHEN upper(f[6]) NOT IN ('ALL','MALE','FEMALE','M','F') THEN 'sex' END] if x IS NOT NULL], ',') AS bad FROM dotted_fields)""", ("dotted_fields",))
def validate_upload(spark, sf):
    return cohorts.validate_upload(fx.dotted(spark, sf))


@query("parse_meta_name", """
    SELECT seq, split_part(name, '.', 1) || '_' || split_part(name, '.', 6) AS name, 100 + seq AS n_cases, 1000 + seq AS n_controls,
      1100 + 2 * seq AS n_total, true AS is_valid FROM (SELECT seq, 'COH' || seq % 9 || '.S.P.5.ALL.' ||
        list_extract(['EUR','FIN','SAS','AFR','ARB'], (seq % 5 + 1)::INTEGER) AS name FROM fx_files)""", ("fx_files",))
def parse_meta_name(spark, sf):
    s = F.col("seq")
    uri = F.concat(F.lit("gs://b/COH"), (s % 9).cast("string"), F.lit(".S.P.5.ALL."), fx.pick(s % 5, ["EUR", "FIN", "SAS", "AFR", "ARB"]),
                   F.lit("."), (100 + s).cast("string"), F.lit("."), (1000 + s).cast("string"),
                   F.lit(".SAIGE.20220411.formatted.txt.gz.munged.AC.gz"))
    return cohorts.parse_meta_name(fx.files(spark, sf).select("seq", uri.alias("uri"))).drop("uri")


def valid(spark, sf) -> DataFrame:
    return cohorts.validate_name(fx.dotted(spark, sf)).filter(F.size("problems") == 0).drop("problems")


@query("pop_map", """SELECT uri, CASE pop WHEN 'EUR' THEN 'nfe' WHEN 'HIS' THEN 'amr' WHEN 'MID' THEN 'all' ELSE lower(pop) END AS ref_pop,
    n_cases + n_controls AS n_total FROM dotted_valid""", ("dotted_valid",))
def pop_map(spark, sf):
    return cohorts.pop_map(valid(spark, sf))


def conf(spark, sf) -> DataFrame:
    return cohorts.stratum(valid(spark, sf))


@query("stratum", "SELECT seq, uri, ana, stratum, analysis, name, n_cases, n_controls FROM conf", ("conf",))
def stratum(spark, sf):
    return conf(spark, sf).select("seq", "uri", "ana", "stratum", "analysis", "name", "n_cases", "n_controls")


# The roll-up step by step: each step appends what the target lacks by name.
_STEPS = ["WITH c0 AS (SELECT ana, stratum, name, uri, n_cases, n_controls, seq, seq AS arrival FROM conf)"]
for _i, (_a, _b) in enumerate(cohorts.ROLL_UP):
    _STEPS.append(f"""c{_i + 1} AS MATERIALIZED (SELECT * FROM c{_i} UNION ALL
      SELECT '{_b}' AS ana, stratum, name, uri, n_cases, n_controls, seq, arrival + {10_000_000 * (_i + 1)} FROM c{_i} s WHERE ana = '{_a}'
        AND EXISTS (SELECT 1 FROM c{_i} t WHERE t.ana = '{_b}' AND t.stratum = s.stratum)
        AND NOT EXISTS (SELECT 1 FROM c{_i} t WHERE t.ana = '{_b}' AND t.stratum = s.stratum AND t.name = s.name)
      QUALIFY row_number() OVER (PARTITION BY stratum, name ORDER BY arrival) = 1)""")
_ROLLED = ", ".join(_STEPS)


@query("cohort_rollup", f"""{_ROLLED}
    SELECT ana, stratum, ana || '_' || stratum AS analysis, name, uri, n_cases, n_controls, seq FROM c6""", ("conf",))
def cohort_rollup(spark, sf):
    return cohorts.cohort_rollup(conf(spark, sf))


@query("cohort_exclude", f"""{_ROLLED}, r AS (SELECT *, ana || '_' || stratum AS analysis FROM c6),
    sh AS (SELECT DISTINCT x.analysis, x.name FROM r x JOIN r y ON x.ana = 'C2' AND y.ana = 'B1' AND x.name = y.name AND x.uri = y.uri
      AND x.n_cases = y.n_cases AND x.n_controls = y.n_controls)
    SELECT ana, stratum, analysis, name, uri, n_cases, n_controls, seq FROM r
    WHERE NOT EXISTS (SELECT 1 FROM sh WHERE sh.analysis = r.analysis AND sh.name = r.name)
      AND NOT (analysis IN ('B2_ALL', 'C2_ALL') AND (name LIKE 'Italy_HOSTAGE%' OR name LIKE 'Spain_HOSTAGE%'))
      AND NOT (analysis = 'C2_ALL' AND name = 'CCHC_HIS')""", ("conf",))
def cohort_exclude(spark, sf):
    return cohorts.cohort_exclude(cohorts.cohort_rollup(conf(spark, sf)))


@query("analysis_list", """SELECT analysis, name, n_cases, n_controls FROM conf
    WHERE analysis IN ('A2_ALL', 'A3_ALL', 'B1_ALL', 'B2_ALL', 'C2_ALL') ORDER BY analysis, lower(name)""", ("conf",))
def analysis_list(spark, sf):
    chosen = ["A2_ALL", "A3_ALL", "B1_ALL", "B2_ALL", "C2_ALL"]
    return cohorts.analysis_list(conf(spark, sf), chosen).select("analysis", "name", "n_cases", "n_controls")


@query("leave_cohort_out", """
    WITH c AS (SELECT DISTINCT analysis, split_part(name, '_', 1) AS cohort FROM conf)
    SELECT c.analysis || '_leave_' || c.cohort AS subset, f.analysis, name, uri FROM conf f JOIN c ON f.analysis = c.analysis
    WHERE NOT starts_with(name, c.cohort)""", ("conf",))
def leave_cohort_out(spark, sf):
    return cohorts.leave_cohort_out(conf(spark, sf)).select("subset", "analysis", "name", "uri")


# Run logs.

_LAST = """last AS (SELECT * FROM fx_runs QUALIFY row_number() OVER (PARTITION BY run_id, call_name, shard ORDER BY attempt DESC) = 1)"""


@query("workflow_summary", f"""WITH {_LAST}
    SELECT run_id, call_name, count(*) FILTER (status = 'Done') AS n_done, count(*) FILTER (status = 'Failed') AS n_failed,
      count(*) FILTER (status NOT IN ('Done', 'Failed')) AS n_other, count(dur_min) AS n_finished,
      min(dur_min) AS min_min, max(dur_min) AS max_min, {sql_rnd('sum(dur_min)', 4)} AS total_min, {sql_rnd('avg(dur_min)', 4)} AS avg_min,
      arg_min(shard, (dur_min, shard)) AS min_job, arg_max(shard, (dur_min, -shard)) AS max_job FROM last GROUP BY 1, 2""", ("fx_runs",))
def workflow_summary(spark, sf):
    out = runlog.workflow_summary(fx.runs(spark, sf))
    return out.withColumn("total_min", rnd("total_min", 4)).withColumn("avg_min", rnd("avg_min", 4))


@query("workflow_statuses", f"""WITH {_LAST}
    SELECT run_id, call_name, status, count(*) AS n FROM last GROUP BY 1, 2, 3""", ("fx_runs",))
def workflow_statuses(spark, sf):
    return runlog.status_counts(fx.runs(spark, sf))


def parents(spark, sf) -> DataFrame:
    """Runs in two chains, one of twenty levels: each run's parent is the one before it; 0 and 20 are roots."""
    run = F.col("run_id")
    return fx.runs(spark, sf).select("run_id").distinct().select("run_id", F.when(run % 20 > 0, run - 1).alias("parent_id"))


@query("workflow_totals", f"""WITH {_LAST}
    SELECT CASE WHEN run_id < 20 THEN 0::BIGINT ELSE 20::BIGINT END AS root, call_name, status, count(*) AS n FROM last GROUP BY 1, 2, 3""", ("fx_runs",))
def workflow_totals(spark, sf):
    out = runlog.workflow_totals(fx.runs(spark, sf), parents(spark, sf))
    return out.select("root", "call_name", "status", "n")


@query("workflow_failures", f"""WITH {_LAST}
    SELECT run_id, call_name, shard, attempt, 'root cause ' || event_id AS message FROM last WHERE status = 'Failed'""", ("fx_runs",))
def workflow_failures(spark, sf):
    # Up to fourteen causes below each other.
    depth = (F.col("event_id") % 15).cast("int")
    leaf = F.concat(F.lit('{"message":"root cause '), F.col("event_id").cast("string"), F.lit('","causedBy":[]}'))
    nested = F.concat(F.repeat(F.lit('{"message":"above","causedBy":['), depth), leaf, F.repeat(F.lit("]}"), depth))
    return runlog.workflow_failures(fx.runs(spark, sf).withColumn("failures", F.array(nested)))


@query("scan_runs", f"""WITH {_LAST}
    SELECT run_id, call_name, shard, attempt, status, {sql_rnd('dur_min', 2)} AS dur_min, CASE WHEN status = 'Failed' THEN 'root cause ' || event_id END AS message
    FROM last""", ("fx_runs",))
def scan_runs(spark, sf):
    # Documents of runs with their jobs by call; failures have up to fourteen causes below each other.
    depth = (F.col("event_id") % 15).cast("int")
    cause = F.concat(F.repeat(F.lit('{"message":"above","causedBy":['), depth), F.lit('{"message":"root cause '), F.col("event_id").cast("string"),
                     F.lit('","causedBy":[]}'), F.repeat(F.lit("]}"), depth))
    second = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    start = F.date_trunc("second", "start_ts")
    end = F.timestamp_seconds(F.unix_seconds(start) + F.round(F.col("dur_min") * 60, 3))
    job = F.concat(F.lit('{"shardIndex":'), F.col("shard").cast("string"), F.lit(',"attempt":'), F.col("attempt").cast("string"),
                   F.lit(',"executionStatus":"'), F.col("status"), F.lit('","start":"'), second(start), F.lit('","end":"'), second(end), F.lit('"'),
                   F.when(F.col("status") == "Failed", F.concat(F.lit(',"failures":['), cause, F.lit("]"))).otherwise(""), F.lit("}"))
    calls = fx.runs(spark, sf).groupBy("run_id", "call_name").agg(F.array_join(F.collect_list(job), ",").alias("jobs"))
    call = F.concat(F.lit('"'), F.col("call_name"), F.lit('":['), F.col("jobs"), F.lit("]"))
    docs = calls.groupBy("run_id").agg(F.concat(F.lit('{"id":"'), F.col("run_id").cast("string"), F.lit('","status":"Done","calls":{'),
                                                F.array_join(F.collect_list(call), ","), F.lit("}}")).alias("value"))
    path = scratch_path(spark, "runs")
    docs.select("run_id", "value").repartition("run_id").write.partitionBy("run_id").text(path)
    jobs = runlog.latest_attempts(runs.scan_runs(spark, f"{path}/*"))
    causes = runlog.workflow_failures(jobs).select("run_id", "call_name", "shard", "message")
    return jobs.join(causes, ["run_id", "call_name", "shard"], "left").select(
        F.col("run_id").cast("bigint").alias("run_id"), "call_name", "shard", "attempt", "status", rnd("dur_min", 2).alias("dur_min"), "message")


@query("recent_runs", "SELECT event_id, run_id, call_name, status FROM fx_runs ORDER BY start_ts DESC, event_id DESC LIMIT 10", ("fx_runs",))
def recent_runs(spark, sf):
    return runlog.recent_runs(fx.runs(spark, sf)).select("event_id", "run_id", "call_name", "status")
