"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every WINNOW consecutive k-gram hashes of a text the least one is kept, so two texts that share
WINDOW = WINNOW + k - 1 words share a kept hash. Fingerprints of documents meet those of the
benchmark in a join; around each meeting place the windows are then compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sumweave.llm.exchange import saved

#: Words of a window; words of a k-gram.
WINDOW, GRAM = 13, 6
#: A document is contaminated if so many hundredths of its words are hit.
SHARE = 5
#: The fingerprints of the benchmark are sent to every task if they are at most so many, else joined by a shuffle.
BROADCAST_ROWS = 1 << 19

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Other letters than A-Z that lower() would change are among these.
_OTHER_CASE = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^A-Z]]"


def words(text: Column) -> Column:
    """Runs of a-z, 0-9 and characters above U+007F, A-Z lower-cased; none for null."""
    text = F.coalesce(text, F.lit(""))
    # lower() is faster than translate(), and the same where no other letter has case.
    low = F.when(text.rlike(_OTHER_CASE), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(low, _BETWEEN), "")


def _grams(w: str, k: int) -> Column:
    """The hash of each k consecutive words of the array column w."""
    none = F.array().cast("array<bigint>")
    return F.when(F.size(w) < k, none).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))


def _least_of_two(c: str, apart: int) -> Column:
    """The least of each element and the one so far behind it."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(c) - 1 - apart, F.lit(0))),
                       lambda i: F.least(F.get(c, i), F.get(c, i + apart)))


def winnowed(df: DataFrame, keys: list[str], window: int, gram: int) -> DataFrame:
    """keys and one row per distinct kept hash, for the array column w; texts below a window have none."""
    span = window - gram + 1
    out = df.where(F.size("w") >= window).select(*keys, _grams("w", gram).alias("g"))
    # Minima of 2, 4, 8, ... neighbours, then of two overlapping runs that make up the span.
    width = 1
    while width * 2 <= span:
        out = out.select(*keys, _least_of_two("g", width).alias("g"))
        width *= 2
    if width < span:
        out = out.select(*keys, _least_of_two("g", span - width).alias("g"))
    return out.select(*keys, F.explode(F.array_distinct("g")).alias("mark"))


def hit_counts(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, items) for every row of docs: words inside any occurrence of a benchmark window, and the
    sorted items whose windows occur. An item of fewer words than a window is one window; without words it has none.

    Null texts have no words; a null id is kept; repeated rows give as many rows; an empty benchmark hits nothing; other
    columns are not read. The windows of an item without an id hit words, but name no item.
    """
    if not 1 <= gram <= window:
        raise ValueError("a k-gram has at least one word and at most a window's")
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    items = saved(spark, items, "items")
    lengths = sorted(r[0] for r in items.select(F.least(F.size("w"), F.lit(window))).distinct().collect())  # at most `window` rows
    keys = ["doc_id", "h"]
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    split = texts.select(*keys, words(F.col("text")).alias("w"))

    # Marks of a window of each length: winnowed hashes of full windows, all hashes of shorter ones.
    def marks(df: DataFrame, own: list[str], length: int) -> DataFrame:
        if length == window:
            found = winnowed(df, own, window, gram)
        else:
            found = df.where(F.size("w") >= length).select(*own, F.explode(F.array_distinct(_grams("w", length))).alias("mark"))
        return found.select(*own, F.lit(length).alias("length"), "mark")

    meetings = []
    for length in lengths:
        whole = items if length == window else items.where(F.size("w") == length)
        known = saved(spark, marks(whole, [], length).select("length", "mark").distinct(), "marks")
        side = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
        meetings.append(marks(split, keys, length).join(side, ["length", "mark"]))
    if not meetings:
        return split.select("doc_id", F.size("w").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                            F.array().cast("array<string>").alias("items"))
    met = meetings[0]
    for other in meetings[1:]:
        met = met.unionByName(other)
    met = saved(spark, met.groupBy(*keys).agg(F.collect_set(F.struct("length", "mark")).alias("met")), "met")

    # Windows around each meeting place, of the documents that have one.
    same = (F.col("t.doc_id").eqNullSafe(F.col("m.doc_id"))) & (F.col("t.h") == F.col("m.h"))
    near = texts.alias("t").join(met.alias("m"), same).select("t.doc_id", "t.h", "m.met", "t.text").dropDuplicates(keys)
    near = near.select(*keys, "met", words(F.col("text")).alias("w"))
    places = []
    for length in lengths:
        k = gram if length == window else length
        own = F.transform(F.filter("met", lambda m: m["length"] == length), lambda m: m["mark"])
        df = near.select(*keys, "w", own.alias("own"), _grams("w", k).alias("g")).where(F.size("own") > 0)
        at = F.filter(F.transform("g", lambda x, i: F.when(F.array_contains("own", x), i)), lambda i: i.isNotNull())
        starts = F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(
            F.greatest(p - (length - k), F.lit(0)), F.least(p, F.size("w") - length)))))
        places.append(df.select(*keys, "w", F.explode(starts).alias("s"), F.lit(length).alias("length")).select(
            *keys, "s", "length", F.array_join(F.slice("w", F.col("s") + 1, length), " ").alias("words")))
    at = places[0]
    for other in places[1:]:
        at = at.unionByName(other)
    known = items.select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("s"))
    known = known.select(F.array_join(F.slice("w", F.col("s") + 1, window), " ").alias("words"), F.col("item_id").cast("string").alias("item"))
    known = known.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    # Union of the windows of a document: words of each beyond the end of those before it.
    covered = F.aggregate(
        F.sort_array("spans"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, x: F.struct(F.greatest(acc["end"], x["s"] + x["length"]).alias("end"),
                                (acc["n"] + F.greatest(F.lit(0), x["s"] + x["length"] - F.greatest(acc["end"], x["s"]))).alias("n")),
        lambda acc: acc["n"])
    hit = at.join(known, "words").groupBy(*keys).agg(
        F.collect_set(F.struct("s", "length")).alias("spans"), F.collect_set("items").alias("lists"))
    hit = hit.select(*keys, covered.cast("long").alias("n_hit"), F.sort_array(F.array_distinct(F.flatten("lists"))).alias("items"))
    counts = split.select(*keys, F.size("w").cast("long").alias("n_words"))
    same = (F.col("c.doc_id").eqNullSafe(F.col("x.doc_id"))) & (F.col("c.h").eqNullSafe(F.col("x.h")))
    return counts.alias("c").join(hit.alias("x"), same, "left").select(
        "c.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", share: int = SHARE) -> Column:
    return (F.col(n_hit) > 0) & (100 * F.col(n_hit) >= share * F.col(n_words))


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return hit_counts(spark, docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that are not contaminated, with their columns. Rows of one id fall together: one of them
    contaminated takes the others along; rows with a null id stay."""
    bad = saved(spark, hit_counts(spark, docs, benchmark).where(contaminated()).select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
