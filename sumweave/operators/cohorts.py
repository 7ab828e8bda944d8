"""Dot-separated upload names, and which cohorts an analysis is made of."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sumweave.operators.manifest import base_name

# What upload names may hold, for configuration and for the narrower upload check.
POPULATIONS = ["EUR", "AFR", "FIN", "ARAB", "SAS", "EAS", "OTH", "CSA", "AMR", "NON-EUR", "HIS", "AMR_HIS", "MID", "ALL"]
ANALYSES = ["A1", "A2", "A3", "B1", "B2", "B3", "C1", "C2", "D1"]
AGES = ["ALL", "GT_60", "LE_60"]
UPLOAD_POPULATIONS = ["EUR", "AFR", "FIN", "ARAB", "SAS", "EAS", "OTH", "CSA", "AMR", "NON-EUR", "HIS", "ALL"]
UPLOAD_ANALYSES = ["A1", "A2", "B1", "B2", "B3", "C1", "C2", "D1"]
UPLOAD_AGES = ["ALL", "GT_60", "LT_60", "LE_60"]
UPLOAD_SEXES = ["ALL", "MALE", "FEMALE", "M", "F"]

# Reference populations, and the names replaced by one of them.
REFERENCE_POPULATIONS = ["afr", "ami", "amr", "asj", "eas", "fin", "nfe", "sas", "all"]
POPULATION_REPLACEMENTS = {"non-eur": "all", "arab": "all", "mid": "all", "eur": "nfe", "csa": "sas",
                           "his": "amr", "amr_his": "amr"}

# Cohorts flow from a narrower analysis to a wider one, in this order.
ROLL_UP = [("A1", "A2"), ("B1", "B2"), ("C1", "C2"), ("A1", "B1"), ("A2", "B2"), ("B2", "C2")]
STRATA = ["ALL", "MALE", "FEMALE", "GT_60", "LE_60"]

# Cohorts left out of an analysis, by name prefix or by whole name.
EXCLUDED = [("C2_ALL", "Italy_HOSTAGE", "prefix"), ("C2_ALL", "Spain_HOSTAGE", "prefix"),
            ("B2_ALL", "Italy_HOSTAGE", "prefix"), ("B2_ALL", "Spain_HOSTAGE", "prefix"),
            ("C2_ALL", "CCHC_HIS", "name")]


def dotted_fields(uri: Column) -> Column:
    return F.split(F.regexp_replace(base_name(uri), r"([.]txt|[.]gz|[.]bgz)+$", ""), "[.]")


def _first_contained(value: Column, options: list[str]) -> Column:
    return F.coalesce(*[F.when(value.contains(o), F.lit(o)) for o in options])


def _is_int(value: Column) -> Column:
    return F.coalesce(F.trim(value).rlike("^[+-]?[0-9]+$"), F.lit(False))


def _failed(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
                                     for name, ok in rules.items()]))


def validate_name(df: DataFrame) -> DataFrame:
    """Parse and check configuration names: ``problems`` lists the failed rules, empty if valid.

    A name with the wrong number of fields is only reported as such.
    """
    f = lambda i: F.get(F.col("_f"), i)
    df = df.withColumn("_f", dotted_fields(F.col("uri")))
    shaped = F.size("_f").isin(11, 19, 20)
    sex = F.upper(f(5))
    sex_name = F.when(sex.startswith("F"), "FEMALE").when(sex.startswith("M"), "MALE").when(sex == "ALL", "ALL")
    rules = {
        "number": _is_int(f(3)) & _is_int(f(7)) & _is_int(f(8)) & _is_int(f(10)),
        "pop": F.upper(f(6)).isin(POPULATIONS),
        "analysis": _first_contained(f(2), ANALYSES).isNotNull(),
        "age": F.upper(f(4)).isin(AGES),
        "sex": sex_name.isNotNull(),
    }
    return df.select(
        *[c for c in df.columns if c != "_f"],
        F.when(shaped, _failed(rules)).otherwise(F.array(F.lit("fields"))).alias("problems"),
        f(0).alias("cohort"), _first_contained(f(2), ANALYSES).alias("ana"), F.upper(f(4)).alias("age"),
        sex_name.alias("sex"), F.upper(f(6)).alias("pop"),
        f(7).try_cast("bigint").alias("n_cases"), f(8).try_cast("bigint").alias("n_controls"))


def validate_upload(df: DataFrame) -> DataFrame:
    """The stricter upload check: exactly eleven fields, and ``ALLGOOD`` or the failed rules."""
    f = lambda i: F.get(F.col("_f"), i)
    df = df.withColumn("_f", dotted_fields(F.col("uri")))
    rules = {
        "number": _is_int(f(3)) & _is_int(f(7)) & _is_int(f(8)) & _is_int(f(10)),
        "pop": f(6).isin(UPLOAD_POPULATIONS),
        "analysis": _first_contained(f(2), UPLOAD_ANALYSES).isNotNull(),
        "age": F.upper(f(4)).isin(UPLOAD_AGES),
        "sex": F.upper(f(5)).isin(UPLOAD_SEXES),
    }
    failed = F.array_join(_failed(rules), ",")
    verdict = F.when(F.size("_f") != 11, "fields").when(failed == "", "ALLGOOD").otherwise(failed)
    return df.withColumn("verdict", verdict).drop("_f")


def parse_meta_name(df: DataFrame) -> DataFrame:
    """The ten-field form of munged files: cohort name and case and control numbers."""
    name = F.regexp_replace(base_name(F.col("uri")), r"[.]munged.*$", "")
    name = F.regexp_replace(name, r"([.]formatted|[.]txt|[.]gz|[.]bgz)+$", "")
    df = df.withColumn("_f", F.split(name, "[.]"))
    shaped = F.size("_f") == 10
    part = lambda i: F.when(shaped, F.get(F.col("_f"), i))
    cases, controls = part(6).try_cast("bigint"), part(7).try_cast("bigint")
    return df.select(
        *[c for c in df.columns if c != "_f"],
        F.when(shaped, F.concat(part(0), F.lit("_"), part(5))).alias("name"), cases.alias("n_cases"),
        controls.alias("n_controls"), (cases + controls).alias("n_total"),
        (shaped & cases.isNotNull() & controls.isNotNull()).alias("is_valid"))


def reference_pop(pop: Column) -> Column:
    """Reference population of an upload's population; NULL where none is allowed."""
    table = F.create_map(*[F.lit(x) for pair in POPULATION_REPLACEMENTS.items() for x in pair])
    replaced = F.coalesce(F.try_element_at(table, F.lower(pop)), F.lower(pop))
    return F.when(replaced.isin(REFERENCE_POPULATIONS), replaced)


def pop_map(valid: DataFrame) -> DataFrame:
    """Munge input rows: file, reference population and total N, with unknown populations marked."""
    return valid.select("uri", reference_pop(F.col("pop")).alias("ref_pop"),
                        (F.col("n_cases") + F.col("n_controls")).alias("n_total"))


def stratum(valid: DataFrame) -> DataFrame:
    """Analysis and stratum of each file; files stratified by both sex and age are left out."""
    both = (F.col("sex") != "ALL") & (F.col("age") != "ALL")
    name = F.when(F.col("sex") == "ALL", F.col("age")).otherwise(F.col("sex"))
    return valid.filter(~both).withColumn("stratum", name).withColumn(
        "analysis", F.concat_ws("_", "ana", "stratum")).withColumn("name", F.concat_ws("_", "cohort", "pop"))


def _routes() -> list[tuple[str, str, list[str], int]]:
    """(target, source, analyses that must exist on the way, priority) for every roll-up path.

    Follows the steps in order: what an analysis holds at that point moves on as a whole.
    """
    holds: dict[str, list[tuple[str, list[str]]]] = {}
    for source, target in ROLL_UP:
        moved = [(source, [])] + holds.get(source, [])
        holds.setdefault(target, [])
        holds[target] += [(origin, [*via, source]) for origin, via in moved]
    return [(target, origin, via, rank) for target, arrivals in holds.items()
            for rank, (origin, via) in enumerate(arrivals, start=1)]


def cohort_rollup(conf: DataFrame, seq: str = "seq") -> DataFrame:
    """Add to each analysis the cohorts of narrower ones whose name it does not have yet.

    Per stratum. The steps are followed once on the driver, over analysis names only, which gives
    every source of every target in order of arrival; the data then needs one join and one
    ranking. A step applies only where both analyses exist.
    """
    rows = conf.select("ana", "stratum", "name", "uri", "n_cases", "n_controls", seq)
    own = rows.withColumn("_rank", F.lit(0)).withColumn("_target", F.col("ana"))
    present = rows.groupBy("stratum").agg(F.collect_set("ana").alias("_present"))
    table = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(s).alias("source"),
                               F.array(*[F.lit(v) for v in [t, *via]]).alias("via"), F.lit(r).alias("rank"))
                      for t, s, via, r in _routes()])
    moved = (rows.join(present, "stratum").withColumn("_r", F.explode(table))
             .filter((F.col("_r.source") == F.col("ana"))
                     & (F.size(F.array_except("_r.via", "_present")) == 0))
             .select(*rows.columns, F.col("_r.rank").alias("_rank"), F.col("_r.target").alias("_target")))
    everything = own.unionByName(moved)
    w = Window.partitionBy("_target", "stratum", "name").orderBy("_rank", seq, "uri")
    first = everything.withColumn("_rn", F.row_number().over(w)).withColumn("_best", F.min("_rank").over(
        Window.partitionBy("_target", "stratum", "name")))
    # All own rows stay, also of one name twice; of the arrivals the first of each name.
    kept = first.filter((F.col("_rank") == 0) | ((F.col("_best") > 0) & (F.col("_rn") == 1)))
    return kept.select(F.col("_target").alias("ana"), "stratum", F.concat_ws("_", "_target", "stratum").alias("analysis"),
                       "name", "uri", "n_cases", "n_controls", seq)


def cohort_exclude(conf: DataFrame) -> DataFrame:
    """Take out of C2 the cohorts that B1 has as well, and the fixed exclusions.

    A cohort counts as shared when its whole record is in B1, in whatever stratum; all rows of its
    name then leave that C2 analysis.
    """
    # Records and names repeat at most once per analysis of a manifest, so these groups are small.
    record = Window.partitionBy("name", "uri", "n_cases", "n_controls")
    in_b1 = F.max(F.col("ana") == "B1").over(record)
    marked = conf.withColumn("_shared", (F.col("ana") == "C2") & in_b1)
    leaves = F.max("_shared").over(Window.partitionBy("analysis", "name"))
    kept = marked.withColumn("_leaves", leaves).filter(~F.col("_leaves"))
    rules = [(F.col("analysis") == a) & (F.col("name").startswith(n) if kind == "prefix" else F.col("name") == n)
             for a, n, kind in EXCLUDED]
    return kept.filter(~reduce(lambda x, y: x | y, rules)).select(*conf.columns)


def analysis_list(conf: DataFrame, analyses: list[str] | None = None) -> DataFrame:
    """Cohorts of the configured analyses (none configured: all) in case-insensitive name order."""
    if analyses:
        conf = conf.filter(F.col("analysis").isin(analyses))
    return conf.orderBy("analysis", F.lower("name"), "name", "uri")


def leave_cohort_out(conf: DataFrame) -> DataFrame:
    """Study rows of every leave-one-cohort-out subset: ``subset`` and the rows it keeps.

    The cohort is the first token of the name, and all names that start with it are left out.
    Pairs are made within an analysis over its cohort list, which is a configuration of one row per
    study.
    """
    cohorts = conf.groupBy("analysis").agg(
        F.collect_set(F.get(F.split("name", "_"), 0)).alias("_cohorts"))
    pairs = conf.join(cohorts, "analysis").withColumn("_left", F.explode("_cohorts"))
    return pairs.filter(~F.col("name").startswith(F.col("_left"))).select(
        F.concat(F.col("analysis"), F.lit("_leave_"), F.col("_left")).alias("subset"), *conf.columns)
