"""Sequence of the target build in fixed windows, and indels written anew on the other strand.

A window holds WIDTH bases and the MARGIN bases before them, so whatever lies up to MARGIN before a
position is found in the one window of that position: one equi-join, and no window function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sumweave.functions.alleles import strand_flip
from sumweave.functions.values import plot_chrom

#: Bases of a window, and bases before it that it repeats. A margin holds a roll and the allele that is rolled.
WIDTH, MARGIN = 8192, 4096
#: An indel is rolled by less than this many bases (all steps of the doubling below).
ROLL = 2048


def windows_of(pieces: DataFrame, width: int = WIDTH, margin: int = MARGIN) -> DataFrame:
    """(chr, window, seq) from (chr, start, bases): pieces of sequence at 1-based positions that do not overlap.

    Window w covers positions w * width - margin to (w + 1) * width - 1; a base that no piece gives is N.
    """
    end = F.col("start") + F.length("bases") - 1
    first, last = F.floor(F.col("start") / width), F.floor((end + margin) / width)
    parts = pieces.where("length(bases) > 0").select("*", F.explode(F.sequence(first, last)).alias("window"))
    low = F.col("window") * width - margin
    skip = F.greatest(low - F.col("start"), F.lit(0)).cast("int")
    part = F.substring("bases", skip + 1, F.least(F.length("bases") - skip, low + width + margin - F.col("start") - skip).cast("int"))
    parts = parts.select("chr", "window", (F.col("start") + skip - low).cast("int").alias("at"), F.upper(part).alias("part"))
    # At most width + margin bases a window.
    listed = F.array_sort(F.collect_list(F.struct("at", "part")))
    put = F.aggregate(listed, F.lit(""), lambda text, p: F.concat(F.rpad(text, p["at"], "N"), p["part"]))
    return parts.groupBy("chr", "window").agg(F.rpad(put, F.lit(width + margin), "N").alias("seq"))


def scan_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(chr, start, bases): one row per line of a FASTA file, at its 1-based position in its sequence.

    Positions are running sums of line lengths: inside a split first, then over the splits of a file,
    of which each gives one row per sequence that begins or goes on in it.
    """
    lines = spark.read.text(path).select(
        F.trim("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).where("line <> ''")
    head = F.col("line").startswith(">")
    along = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    name = F.regexp_extract("line", r"^>(\S+)", 1)
    marked = lines.select("*", F.sum(head.cast("int")).over(along).alias("number"),
                          F.last(F.when(head, name), ignorenulls=True).over(along).alias("name"))
    bases = marked.where(~head)
    inner = Window.partitionBy("file", "block", "number").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    bases = bases.withColumn("before", F.coalesce(F.sum(F.length("line")).over(inner), F.lit(0)))
    # What a split adds to the sequence that goes on from the split before (number 0), and the last name it gives.
    splits = marked.groupBy("file", "block").agg(
        F.max("number").alias("last"), F.max_by("name", "row").alias("last_name"),
        F.sum(F.when((F.col("number") == 0) & ~head, F.length("line"))).alias("carried"))
    tails = marked.where(~head).groupBy("file", "block", "number").agg(F.sum(F.length("line")).alias("size"))
    splits = splits.join(tails.withColumnRenamed("number", "last"), ["file", "block", "last"], "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    began = F.sum(F.when(F.col("last") > 0, 1).otherwise(0)).over(before)
    splits = splits.select("file", "block", F.last(F.when(F.col("last") > 0, F.col("last_name")), ignorenulls=True).over(before).alias("open_name"),
                           F.coalesce(began, F.lit(0)).alias("run"), "last", F.coalesce("size", F.lit(0)).alias("size"))
    run = Window.partitionBy("file", F.col("run") + F.when(F.col("last") > 0, 1).otherwise(0)).orderBy("block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # Bases of the sequence that is open at the end of each split; the next split goes on from there.
    splits = splits.withColumn("so_far", F.sum("size").over(run)).withColumn(
        "offset", F.coalesce(F.lag("so_far").over(Window.partitionBy("file").orderBy("block")), F.lit(0)))
    placed = bases.join(splits.select("file", "block", "open_name", "offset"), ["file", "block"])
    goes_on = F.col("number") == 0
    return placed.select(plot_chrom(F.when(goes_on, F.col("open_name")).otherwise(F.col("name"))).alias("chr"),
                         (F.col("before") + F.when(goes_on, F.col("offset")).otherwise(0) + 1).alias("start"), F.col("line").alias("bases"))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix, up to 2 * ROLL - 1 characters: halves are taken while they agree."""
    steps = F.array(*[F.lit(ROLL >> i) for i in range(ROLL.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda s, w: F.when(
        (F.length(F.substring(a, s + 1, w)) == w) & (F.substring(a, s + 1, w) == F.substring(b, s + 1, w)), s + w).otherwise(s))


def reverse_strand(df: DataFrame, windows: DataFrame, needed: Column, width: int = WIDTH, margin: int = MARGIN) -> DataFrame:
    """Adds ``rs_known, rs_match, rs_pos, rs_ref, rs_alt`` for rows that ``needed`` marks; the other rows have nulls.

    ``new_chr, new_pos`` is where the first base of ``ref`` lies in the target, in which the alleles run
    backwards. They are reversed and complemented, what both have in common is taken off, and an
    insertion or deletion gets the base before it as its anchor and moves left as far as the sequence
    repeats it. ``rs_match``: the target has the reference allele; ``rs_known``: its sequence is there,
    and the roll ends inside of it.
    """
    chr_, window = F.col("new_chr"), F.floor(F.col("new_pos") / width)
    # Other rows get keys that no window has, many of them, so that they do not gather in one partition.
    keyed = df.withColumn("_needed", needed).withColumns({
        "_wchr": F.when(F.col("_needed"), chr_).otherwise(F.lit(-1)),
        "_window": F.when(F.col("_needed"), window).otherwise(-1 - F.pmod(F.hash("chr", "pos", "ref", "alt"), F.lit(1 << 20)))})
    # A window has thousands of bases, which Spark's estimate of a computed column doesn't know: never broadcast.
    texts = windows.select(F.col("chr").alias("_wchr"), F.col("window").cast("bigint").alias("_window"), F.col("seq").alias("_seq"))
    joined = keyed.join(texts.hint("merge"), ["_wchr", "_window"], "left")
    # Backwards from the first base: position new_pos - i is character i + 1.
    back = F.reverse(F.substring("_seq", F.lit(1), (F.col("new_pos") - window * width + margin + 1).cast("int")))
    step = joined.withColumn("_back", F.when(F.col("_needed"), back)).withColumn(
        "_c0", F.when(F.col("_needed"), common_prefix(F.col("ref"), F.col("alt"))))
    rest = lambda a: F.substring(a, F.col("_c0") + 1, F.length(a))
    step = step.withColumns({"_r": rest("ref"), "_a": rest("alt")}).withColumn(
        "_cs", F.when(F.col("_needed"), common_prefix(F.reverse("_r"), F.reverse("_a"))))
    cut = lambda a: strand_flip(F.substring(a, F.lit(1), F.length(a) - F.col("_cs")))
    step = step.withColumns({"_r": cut("_r"), "_a": cut("_a"), "_span": F.length("ref") - F.col("_cs")})
    moves = (F.length("_r") == 0) | (F.length("_a") == 0)
    unit = F.concat("_r", "_a")  # one of them is empty
    step = step.withColumn("_unit", F.when(moves, unit))
    behind = F.substring("_back", F.col("_span") + 1, F.lit(2 * ROLL))
    repeats = F.expr(f"repeat(_unit, cast(ceil({2 * ROLL} / greatest(length(_unit), 1)) as int))")
    step = step.withColumn("_s", F.when(F.col("_unit").isNotNull(), common_prefix(behind, repeats)))
    turn = F.col("_s") % F.greatest(F.length("_unit"), F.lit(1))
    rolled = F.reverse(F.concat(F.substring("_unit", turn + 1, F.length("_unit")), F.substring("_unit", F.lit(1), turn)))
    anchor = F.substring("_back", F.col("_span") + F.col("_s") + 1, F.lit(1))
    allele = lambda own: F.when(moves, F.concat(anchor, F.when(F.length(own) > 0, rolled).otherwise(""))).otherwise(F.reverse(own))
    pos = F.when(moves, F.col("new_pos") - F.col("_span") - F.col("_s")).otherwise(F.col("new_pos") - F.col("_span") + 1)
    have = F.substring("_back", F.lit(1), F.length("ref"))
    inside = F.when(moves, (anchor != "") & (anchor != "N")).otherwise(F.lit(True))
    known = F.col("_back").isNotNull() & (F.length(have) == F.length("ref")) & ~have.contains("N") & inside
    only = lambda c: F.when(F.col("_needed"), c)
    return step.select(*df.columns, only(F.coalesce(known, F.lit(False))).alias("rs_known"), only(have == strand_flip(F.col("ref"))).alias("rs_match"),
                       only(pos).alias("rs_pos"), only(allele("_r")).alias("rs_ref"), only(allele("_a")).alias("rs_alt"))
