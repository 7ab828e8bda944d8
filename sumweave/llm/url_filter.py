"""URL rules by expression lookup.

A url is expanded into every pair of host suffix and path prefix that a rule could be. The pairs
meet the rules in an equi-join on the first bytes of their digest; the whole digest then confirms,
and the longest fitting rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of the digest that the join uses.
SHORT = 8
#: The verdict where no rule fits.
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for text without ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(raw, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, action) rows as a literal table, whose size Spark knows."""
    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    rows = ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rules)
    if not rows:
        return spark.createDataFrame([], "host string, path string, action string")
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(host, path, action)")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\0"), path), 256)


def _suffixes(host: Column, most: int) -> Column:
    """The host and its parent domains, of at most so many labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), F.least(n, F.lit(most))), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))


def _prefixes(path: Column, most: int) -> Column:
    """The path up to each of its first slashes, that slash included."""
    parts = F.split(path, "/")
    slashes = F.least(F.size(parts) - 1, F.lit(most))
    return F.when(slashes < 1, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(slashes, F.lit(1))),
                    lambda k: F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/"))))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages.

    Rule paths must end with a slash (an error otherwise), so that prefixes at slashes are all a
    rule can be. The longest rule (host and path together) wins, then the longer host, then the
    smaller text; of two actions for one rule, block. Repeated rows give as many rows; a null id
    is kept; a null url has empty host and path, and no rule. No more labels or slashes are
    expanded than some rule has.
    """
    rules = rules.select("host", "path", "action").where("host is not null and path is not null")
    deepest = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"),
                        F.max(F.size(F.split("path", "/")) - 1).alias("slashes"),
                        F.sum(F.expr("if(endswith(path, '/'), 0, 1)")).alias("odd")).first()
    if deepest["odd"]:
        raise ValueError("a rule's path must end with /")
    host, path = host_and_path(F.col(url_col))
    keys = ["page_id", "host", "path"]
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    # Equal rows are judged once and given back as often as they came.
    once = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
    # Urls are short and expand to many expressions: a number of tasks of its own, as their bytes would give one.
    once = once.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    pairs = once.select("*", F.explode_outer(_suffixes(F.col("host"), deepest["labels"] or 1)).alias("e_host"))
    pairs = pairs.select("*", F.explode_outer(_prefixes(F.col("path"), deepest["slashes"] or 1)).alias("e_path"))
    pairs = pairs.withColumn("digest", _digest(F.col("e_host"), F.col("e_path")))
    pairs = pairs.withColumn("short", F.substring("digest", 1, SHORT))
    known = rules.groupBy("host", "path").agg(F.max("action").alias("r_action")).select(
        F.concat("host", "path").alias("r_rule"), F.length("host").alias("r_host"),
        _digest(F.col("host"), F.col("path")).alias("r_digest"), "r_action")
    known = known.withColumn("short", F.substring("r_digest", 1, SHORT))
    fits = F.col("r_digest") == F.col("digest")
    # Greatest first: longer rule, longer host, then the smaller text by way of min over the rest.
    best = F.struct(-F.length("r_rule"), -F.col("r_host"), F.col("r_rule").alias("rule"), F.col("r_action").alias("action"))
    judged = pairs.join(known, "short", "left").groupBy(*keys).agg(
        F.max("times").alias("times"), F.min(F.when(fits, best)).alias("best"))
    return judged.select(*keys, F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"),
                         F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("copy")).drop("copy")
