"""Scan and sink queries: a table is written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sumweave.operators import manifest
from sumweave.operators.build import detect_build
from sumweave.operators.liftover import export_sites
from sumweave.queries import fixtures as fx
from sumweave.queries.base import query
from sumweave.session import scratch_path
from sumweave.sources import blockgzip, config, delimited, regions, sinks

RAW = {"chr_raw": "CHR", "pos": "POS", "ref": "REF", "alt": "ALT", "beta": "BETA", "se": "SE", "pval_raw": "p.value", "n": "N"}
_TYPED = "SELECT chr_raw AS chr, pos, ref, alt, beta, se, pval_raw AS pval, n FROM fx_sumstats"


def _write_raw(spark, sf, sep: str, compression: str) -> str:
    path = scratch_path(spark, "study")
    rows = fx.sumstats(spark, sf).select(*[F.col(c).alias(name) for c, name in RAW.items()])
    rows.write.csv(path, sep=sep, header=True, compression=compression)
    return path


def _typed(df):
    c = lambda name: F.col(f"`{name}`")
    return df.select(c("CHR").alias("chr"), c("POS").cast("bigint").alias("pos"), c("REF").alias("ref"), c("ALT").alias("alt"),
                     c("BETA").cast("double").alias("beta"), c("SE").cast("double").alias("se"),
                     c("p.value").alias("pval"), c("N").cast("bigint").alias("n"))


@query("scan_study", _TYPED, ("fx_sumstats",))
def scan_study(spark, sf):
    return _typed(delimited.scan_study(spark, _write_raw(spark, sf, "\t", "gzip")))


@query("scan_mapped", "SELECT chr_raw AS chr, pos, beta AS effect FROM fx_sumstats", ("fx_sumstats",))
def scan_mapped(spark, sf):
    path = _write_raw(spark, sf, " ", "none")
    df = delimited.scan_study(spark, path, {"CHR": "chr", "POS": "pos", "BETA": "effect"}, tab_only=False)
    return df.select("chr", F.col("pos").cast("bigint").alias("pos"), F.col("effect").cast("double").alias("effect"))


@query("scan_reference", "SELECT pop, chr, pos, ref, alt, af, filter_, an FROM fx_reference", ("fx_reference",))
def scan_reference(spark, sf):
    path = scratch_path(spark, "reference")
    fx.reference(spark, sf).write.partitionBy("pop").parquet(path)
    return delimited.scan_reference(spark, path).select(
        "pop", "chr", "pos", "ref", "alt", "af", "filter_", "an")


@query("scan_sites", "SELECT chr::VARCHAR AS chrom, CASE WHEN chr <= 24 THEN chr END AS chr, pos, id, ref, alt_list FROM fx_rsid", ("fx_rsid",))
def scan_sites(spark, sf):
    path = scratch_path(spark, "sites")
    sites = fx.rsid(spark, sf).select(
        F.concat_ws("\t", F.col("chr").cast("string"), F.col("pos").cast("string"), "id", "ref", "alt_list",
                    F.lit("."), F.lit("."), F.lit(".")).alias("value"))
    header = spark.createDataFrame([("##fileformat=VCFv4.0\n" + "\t".join(delimited.SITES_HEADER),)], "value string")
    header.coalesce(1).write.text(f"{path}/0-header")
    sites.write.text(f"{path}/1-body")
    return delimited.scan_sites(spark, f"{path}/*").drop("seq")


@query("scan_manifest", "SELECT uri, 'SAIGE' AS dialect FROM fx_files WHERE seq % 10 <> 0", ("fx_files",))
def scan_manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    mark = F.when(F.col("seq") % 10 == 0, "#").otherwise("")
    fx.files(spark, sf).select(F.concat(mark, F.col("uri"), F.lit("\tSAIGE")).alias("value")).write.text(path)
    return delimited.scan_manifest(spark, path, ["uri", "dialect"])


@query("scan_config", """
    SELECT 'P' || (seq % 4) AS pheno, 'COH' || (seq % 9) AS name, uri AS file, 100 + seq AS n_cases, 1000 + seq AS n_controls,
      CASE WHEN seq % 3 = 0 THEN 'or' ELSE 'beta' END AS effect_type FROM fx_files""", ("fx_files",))
def scan_config(spark, sf):
    path = scratch_path(spark, "config")
    s = F.col("seq")
    entry = F.struct(F.concat(F.lit("COH"), (s % 9).cast("string")).alias("name"), F.col("uri").alias("file"),
                     (100 + s).alias("n_cases"), (1000 + s).alias("n_controls"),
                     *[F.lit(v).alias(k) for k, v in manifest.CONFIG_COLUMNS.items() if k != "effect_type"],
                     F.when(s % 3 == 0, "OR").otherwise("beta").alias("effect_type"))
    docs = fx.files(spark, sf).groupBy((s % 4).alias("p")).agg(
        F.to_json(F.struct(F.collect_list(entry).alias("meta"))).alias("value"))
    # One document per phenotype, in a folder named after it.
    docs.select(F.concat(F.lit("P"), F.col("p").cast("string")).alias("pheno"), "value").write.partitionBy("pheno").text(path)
    rows = config.scan_config(spark, f"{path}/*", by_folder=True)
    return rows.select("pheno", "name", "file", "n_cases", "n_controls", "effect_type")


@query("inventory", "SELECT count(*) AS n FROM (SELECT DISTINCT seq % 4 FROM fx_files)", ("fx_files",))
def inventory(spark, sf):
    path = scratch_path(spark, "inventory")
    (fx.files(spark, sf).select((F.col("seq") % 4).alias("part"), F.col("uri").alias("value"))
     .repartition("part").write.partitionBy("part").text(path))
    listed = manifest.inventory(spark, path).filter((F.col("size") > 0) & F.col("uri").contains("/part="))
    folder = F.regexp_extract("uri", "/(part=[0-9]+)/", 1)
    return listed.agg(F.count_distinct(folder).alias("n"))


@query("inventory_files", """
    SELECT 'part=' || (seq % 4) || '/*.txt' AS uri, sum(strlen(uri) + 1)::BIGINT AS size, true AS timed FROM fx_files GROUP BY seq % 4""", ("fx_files",))
def inventory_files(spark, sf):
    path = scratch_path(spark, "inventory")
    (fx.files(spark, sf).select((F.col("seq") % 4).alias("part"), F.col("uri").alias("value"))
     .repartition("part").write.partitionBy("part").text(path))
    # One row per file. Spark puts a random id into file names, which is shown as a star.
    relative = F.regexp_replace(F.regexp_extract("uri", "/(part=[0-9]+/[^/]*)$", 1), "/part-.*[.]txt$", "/*.txt")
    return manifest.inventory(spark, path).filter(F.col("uri").contains("/part=") & (F.col("size") > 0)).select(
        relative.alias("uri"), "size", (F.col("modified") > F.lit("2000-01-01").cast("timestamp")).alias("timed"))


@query("write_indexed", "SELECT chr, pos, ref, alt, n FROM munged", ("munged",))
def write_indexed(spark, sf):
    path = scratch_path(spark, "indexed")
    sinks.write_indexed(fx.munged(spark, sf).select("chr", "pos", "ref", "alt", "n"), path)
    return delimited.scan_result(spark, path, ["chr", "pos", "ref", "alt", "n"])


@query("scan_shortlist", "SELECT snp FROM fx_shortlist", ("fx_shortlist",))
def scan_shortlist(spark, sf):
    path = scratch_path(spark, "shortlist")
    fx.shortlist(spark, sf).select(F.concat(F.lit("x "), F.translate("snp", ":", " ")).alias("value")).write.text(path)
    return delimited.scan_shortlist(spark, path)


@query("scan_bgz", _TYPED, ("fx_sumstats",))
def scan_bgz(spark, sf):
    # Parts of several members each, read back by as many tasks.
    path = scratch_path(spark, "bgz")
    rows = fx.sumstats(spark, sf).select(*[F.col(c).cast("string").alias(name) for c, name in RAW.items()])
    sinks.write_bgz(rows.repartition(4), path)
    return _typed(delimited.scan_study(spark, f"{path}/*.bgz"))


@query("write_single", """
    SELECT '#CHR' || chr(9) || 'POS' || chr(9) || 'REF' || chr(9) || 'ALT' || chr(9) || 'N' AS line, true AS is_first UNION ALL
    SELECT chr || chr(9) || pos || chr(9) || ref || chr(9) || alt || chr(9) || n, false FROM munged""", ("munged",))
def write_single(spark, sf):
    # One file under one header, written by all tasks in the order of the variants; every line of it is read back.
    path = f"{scratch_path(spark, 'single')}.bgz"
    rows = fx.munged(spark, sf).select(F.col("chr").alias("#CHR"), F.col("pos").alias("POS"), F.col("ref").alias("REF"), F.col("alt").alias("ALT"), F.col("n").alias("N"))
    sinks.write_single(rows.repartitionByRange(6, "#CHR", "POS").sortWithinPartitions("#CHR", "POS"), path)
    lines = blockgzip.scan_lines(spark, path).filter(F.col("value") != "")
    return lines.select(F.col("value").alias("line"), (F.struct("block", "row") == F.struct(F.lit(-1).cast("long"), F.lit((1 << 63) - 1))).alias("is_first"))


@query("scan_build_map", """
    WITH c AS (SELECT m.study_ord, count(*) FILTER (build = 'b37') AS n_b37, count(*) FILTER (build = 'b38') AS n_b38
      FROM (SELECT * FROM munged WHERE NOT (study_ord = 3 AND chr = 21)) m
      LEFT JOIN fx_build b ON m.chr = b.chr AND m.pos = b.pos AND m.chr = 21 GROUP BY 1)
    SELECT *, CASE WHEN n_b37 = 0 AND n_b38 = 0 THEN NULL WHEN n_b37 > n_b38 THEN 'b37' ELSE 'b38' END AS build FROM c""", ("munged", "fx_build"))
def scan_build_map(spark, sf):
    # Position lists as text, and of the stored studies only the files that hold such positions.
    lists = {name: scratch_path(spark, name) for name in ("b37", "b38")}
    for name, path in lists.items():
        fx.build_map(spark, sf).filter(F.col("build") == name).select(
            F.concat_ws("\t", F.col("chr").cast("string"), F.col("pos").cast("string")).alias("value")).write.text(path)
    maps = delimited.scan_build_map(spark, lists)
    stored = scratch_path(spark, "studies")
    rows = fx.munged(spark, sf).filter("NOT (study_ord = 3 AND chr = 21)").select("study_ord", "chr", "pos")
    sinks.write_indexed(rows, stored)
    found = regions.scan_regions(spark, stored, regions.as_points(maps))
    return detect_build(found, maps, studies=spark.read.parquet(stored).select("study_ord").distinct())


@query("write_sites", """
    SELECT c AS chrom, chr, pos, c||':'||pos||':'||ref||':'||alt AS id, ref, alt AS alt_list FROM (
      SELECT *, 'chr' || CASE chr WHEN 23 THEN 'X' WHEN 24 THEN 'Y' ELSE chr::VARCHAR END AS c FROM munged WHERE chr <= 23)""", ("munged",))
def write_sites(spark, sf):
    path = scratch_path(spark, "sites")
    sinks.write_sites(export_sites(fx.munged(spark, sf).filter("chr <= 23")), path)
    return delimited.scan_sites(spark, f"{path}/*").drop("seq")
