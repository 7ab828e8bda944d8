"""File-name manifests: what a name says, whether it is valid, and which file feeds what."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Segments of a results file name, in order.
NAME_PARTS = {
    "dataset": "[A-Za-z0-9.-]+", "surname": "[A-Za-z.-]+", "pheno": "[NW][QE][12][.][369]", "freeze": "F[1-9][0-9]*",
    "age": "(ALL|LE_60|GT_60)", "sex": "(ALL|FEMALE|MALE)", "ancestry": "[A-Za-z]{3}", "cases": "[0-9]+",
    "controls": "[0-9]+", "software": "(REGENIE|SAIGE)", "date": "202[1-9][0-1][0-9][0-3][0-9]",
}
RESULT_NAME = "^" + "_".join(NAME_PARTS.values()) + "[.]txt([.]gz)?$"
SAMPLE_NAME = f"^{NAME_PARTS['dataset']}_{NAME_PARTS['surname']}_F[1-9][0-9]*[.]zip$"

# Phenotypes in report order.
PHENOS = ["WQ1.3", "WQ2.3", "NQ1.3", "NQ2.3", "WE1.3", "WE2.3", "NE1.3", "NE2.3"]

# For each analysed phenotype, the reported ones that may feed it, best first.
FALLBACK = {
    "WQ1.3": ["WQ1.3", "NQ1.3"], "WQ2.3": ["WQ2.3", "NQ2.3"],
    "N1.3": ["NE1.3", "NQ1.3"], "N2.3": ["NE2.3", "NQ2.3"],
    "W1.3": ["WE1.3", "WQ1.3", "NE1.3", "NQ1.3"], "W2.3": ["WE2.3", "WQ2.3", "NE2.3", "NQ2.3"],
}


def base_name(uri: Column) -> Column:
    return F.element_at(F.split(uri, "/"), -1)


def bucket(uri: Column) -> Column:
    return F.get(F.split(uri, "/"), 2)


def classify_files(df: DataFrame) -> DataFrame:
    """Each name as ``results``, ``sampleinfo`` or ``unrecognised``."""
    name = base_name(F.col("uri"))
    return df.withColumn("kind", F.when(name.rlike(RESULT_NAME), "results")
                         .when(name.rlike(SAMPLE_NAME), "sampleinfo").otherwise("unrecognised"))


def parse_name(df: DataFrame) -> DataFrame:
    """The eleven underscore tokens of a results file name; counts as numbers where they are."""
    tokens = F.split(base_name(F.col("uri")), "_")
    out = []
    for i, part in enumerate(NAME_PARTS):
        value = F.get(tokens, i)
        if part in ("cases", "controls"):
            value = value.try_cast("bigint")
        elif part == "date":
            value = F.regexp_replace(value, "[.]txt([.]gz)?$", "")
        out.append(value.alias(part))
    return df.select("*", *out)


def parse_sample_name(df: DataFrame) -> DataFrame:
    """The three underscore tokens of a sample-information file name."""
    tokens = F.split(F.regexp_replace(base_name(F.col("uri")), "[.]zip$", ""), "_")
    return df.select("*", *[F.get(tokens, i).alias(part) for i, part in enumerate(("dataset", "surname", "freeze"))])


def manifest_shape(df: DataFrame, line: str, n_fields: int, prefix: str = "gs://") -> DataFrame:
    """Lines with the wrong number of blank-separated fields or without the prefix."""
    value = F.col(line)
    fields = F.size(F.filter(F.split(F.trim(value), r"\s+"), lambda t: t != ""))
    reason = (F.when(fields != n_fields, F.concat(F.lit("fields:"), fields.cast("string")))
              .when(~value.startswith(prefix), "prefix"))
    return df.withColumn("problem", reason).filter(F.col("problem").isNotNull())


def latest_file(df: DataFrame, seq: str = "seq") -> DataFrame:
    """The last listed location of every base name."""
    return df.groupBy(base_name(F.col("uri")).alias("name")).agg(F.max_by("uri", seq).alias("uri"))


def with_modified(parsed: DataFrame, listed: DataFrame) -> DataFrame:
    """The modification time of every file, from an :func:`inventory`; of several entries for one file the last counts."""
    times = listed.groupBy("uri").agg(F.max("modified").alias("modified"))
    return parsed.join(times, "uri", "left")


def pick_latest(parsed: DataFrame, when: Sequence[str] | None = None) -> DataFrame:
    """One results file per study, freeze and phenotype: the one modified last.

    Equal times, and tables without a ``modified`` column, go by the name's date, then the listing
    order; a file without a known time comes before all that have one.
    """
    if when is None:
        when = [c for c in ("modified", "date", "seq") if c in parsed.columns]
    columns = ["dataset", "freeze", "pheno"]
    rest = F.struct(*[c for c in parsed.columns if c not in columns])
    newest = parsed.groupBy(*columns).agg(F.max_by(rest, F.struct(*when)).alias("_row"))
    return newest.select(*columns, "_row.*")


def contribution_table(parsed: DataFrame, freezes: Sequence[str], phenos: Sequence[str] = PHENOS,
                       sampleinfo: DataFrame | None = None) -> DataFrame:
    """Studies and buckets by freeze and phenotype: ``cases/controls`` of the latest file.

    Studies with sample information only are listed, too. ``sampleinfo`` has (uri, dataset, freeze).
    """
    columns = [f"{f}_{p}" for f in freezes for p in phenos]
    latest = pick_latest(parsed)
    cells = (latest.withColumn("_cell", F.concat_ws("_", "freeze", "pheno"))
             .groupBy("dataset").pivot("_cell", columns)
             .agg(F.first(F.concat_ws("/", F.col("cases").cast("string"), F.col("controls").cast("string")))))
    places = [x.select("dataset", bucket(F.col("uri")).alias("bucket")) for x in (parsed, sampleinfo) if x is not None]
    studies = (places[0] if len(places) == 1 else places[0].union(places[1])).distinct()
    table = studies.join(cells, "dataset", "left")
    if sampleinfo is not None:
        flags = (sampleinfo.groupBy("dataset").pivot("freeze", list(freezes)).agg(F.first(F.lit("YES")))
                 .withColumnsRenamed({f: f"{f}_sampleinfo" for f in freezes}))
        table = table.join(flags, "dataset", "left")
    return table


def availability(parsed: DataFrame) -> DataFrame:
    """Per phenotype, the studies with the freezes they provide: ``study (F1,F2), ...``."""
    per_study = (parsed.groupBy("pheno", "dataset")
                 .agg(F.array_join(F.array_sort(F.collect_set("freeze")), ",").alias("freezes")))
    entry = F.concat(F.col("dataset"), F.lit(" ("), F.col("freezes"), F.lit(")"))
    return per_study.groupBy("pheno").agg(F.array_join(F.array_sort(F.collect_list(entry)), ", ").alias("studies"))


def inventory(spark, path: str) -> DataFrame:
    """Files below a path with time and size; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select(F.col("path").alias("uri"), F.col("modificationTime").alias("modified"), F.col("length").alias("size")))


def non_empty_buckets(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct(bucket(F.col("uri"))).alias("n_buckets"))


def reference_population(dataset: Column, ancestry: Column) -> Column:
    """Population of the reference panel for a study; ``oth`` where there is none."""
    return (F.when(ancestry.isin("SAS", "EAS", "AFR", "AMR"), F.lower(ancestry))
            .when(F.lower(dataset).contains("finngen") | (ancestry == "FIN"), "fin")
            .when(ancestry.isin("EUR", "NFE"), "nfe").otherwise("oth"))


def pheno_fallback(parsed: DataFrame, seq: str = "seq") -> DataFrame:
    """For each analysed phenotype and study_ancestry, the best reported phenotype's last file.

    Phenotypes that start with N are also analysed as they are.
    """
    named = parsed.withColumn("study", F.concat_ws("_", "dataset", "ancestry"))
    rules = [(target, source, rank) for target, sources in FALLBACK.items() for rank, source in enumerate(sources)]
    table = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(s).alias("source"), F.lit(r).alias("rank"))
                      for t, s, r in rules])
    # The rules are a constant array: no join, and each row becomes at most a few.
    fed = (named.withColumn("_rule", F.explode(table)).filter(F.col("_rule.source") == F.col("pheno"))
           .groupBy(F.col("_rule.target").alias("analysis"), "study")
           .agg(F.max_by(F.struct("pheno", "uri", "cases", "controls"),
                         F.struct(-F.col("_rule.rank"), F.col(seq))).alias("_row"))
           .select("analysis", "study", "_row.*"))
    as_is = named.filter(F.col("pheno").startswith("N")).select(
        F.col("pheno").alias("analysis"), "study", "pheno", "uri", "cases", "controls")
    return as_is.unionByName(fed)


# Column names of munged study files, as a study configuration lists them.
CONFIG_COLUMNS = {"chr": "#CHR", "pos": "POS", "ref": "REF", "alt": "ALT", "af_alt": "af_alt",
                  "info": "imputationInfo", "effect": "beta", "effect_type": "beta", "pval": "pval",
                  "se": "sebeta", "Nsamples": "N"}


def study_config(fallback: DataFrame) -> DataFrame:
    """Study configuration rows, and the same row as JSON for the meta configuration file."""
    rows = fallback.select(F.col("analysis").alias("pheno"), F.col("study").alias("name"), F.col("uri").alias("file"),
                           F.col("cases").alias("n_cases"), F.col("controls").alias("n_controls"),
                           *[F.lit(v).alias(k) for k, v in CONFIG_COLUMNS.items()])
    return rows.withColumn("config", F.to_json(F.struct(*rows.columns[1:])))


def meta_configs(rows: DataFrame) -> DataFrame:
    """One JSON document ``{"meta": [...]}`` per phenotype, studies by name."""
    entry = F.struct(*[c for c in rows.columns if c not in ("pheno", "config")])
    listed = F.array_sort(F.collect_list(entry))
    return rows.groupBy("pheno").agg(F.to_json(F.struct(listed.alias("meta"))).alias("document"))


def pheno_list(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Distinct phenotypes in order of first appearance, as their first position."""
    return rows.groupBy("pheno").agg(F.min(seq).alias("first_seq"))


def files_by_pheno(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Tab-joined files of every phenotype, in order. A phenotype has one file per study."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("seq"), F.col("uri").alias("uri"))))
    return rows.groupBy("pheno").agg(F.array_join(listed["uri"], "\t").alias("files"))


def pheno_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("pheno").agg(F.sum("cases").alias("n_cases"), F.sum("controls").alias("n_controls"))
