import gzip
import json

import pytest
from pyspark.sql import functions as F

from sumweave.operators.annotate import add_rsids
from sumweave.operators.liftover import liftover
from sumweave.operators.runlog import status_counts, tree_roots, workflow_failures, workflow_summary, workflow_totals
from sumweave.plans.format import Entry, format_studies
from sumweave.plans.meta import finish, run_meta
from sumweave.plans.munge import clean, munge
from sumweave.sources import config, delimited, runs, sinks

HEADER = "#CHR POS REF ALT af_alt info beta sebeta pval N extra".split()


def write_study(path, rows, sep="\t", opener=gzip.open):
    with opener(path, "wt") as f:
        f.write(sep.join(HEADER) + "\n")
        for r in rows:
            f.write(sep.join(map(str, r)) + "\n")


def entry(name, path, **more):
    return {"name": name, "file": str(path), "n_cases": 100, "n_controls": "1000", "chr": "#CHR", "pos": "POS", "ref": "REF",
            "alt": "ALT", "af_alt": "af_alt", "info": "info", "effect": "beta", "effect_type": "beta", "pval": "pval",
            "se": "sebeta", "Nsamples": "N", **more}


def test_meta_from_files(spark, tmp_path):
    write_study(tmp_path / "a.txt.gz", [("1", 10, "A", "C", .2, .9, .1, .05, .0455, 1000, "e1"),
                                       ("chrX", "2e3", "A", "G", .2, .9, "NA", .05, .5, 1000, "e2"),
                                       ("HLA", 5, "A", "G", .2, .9, .1, .05, .5, 1000, "e3")])
    write_study(tmp_path / "b.txt.gz", [(1, 10, "G", "T", .7, .9, -.3, .1, .0027, 2000, "x")])
    studies = config.parse_config(json.dumps({"meta": [entry("A", tmp_path / "a.txt.gz", extra_cols=["extra"]),
                                                       entry("B", tmp_path / "b.txt.gz")]}))
    wide = run_meta(spark, studies, het=True, leave_one_out=True, leave_most_sig_out=True)
    rows = {r["SNP"]: r for r in wide.collect()}
    assert set(rows) == {"1:10:A:C", "23:2000:A:G"}
    r = rows["1:10:A:C"]
    assert r["A_extra"] == "e1" and r["B_extra"] is None and r["B_beta"] == pytest.approx(.3)
    assert r["B_af_alt"] == pytest.approx(.3) and r["all_meta_Nstudies"] == 2
    w = (1 / .05**2, 1 / .1**2)
    assert r["all_inv_var_meta_beta"] == pytest.approx((w[0] * .1 + w[1] * .3) / sum(w))
    assert r["lmso_meta_removed_study_name"] == "B" and r["lmso_inv_var_meta_beta"] == .1
    # One bad field among af, info, p and effect voids all four.
    assert rows["23:2000:A:G"]["A_beta"] is None and rows["23:2000:A:G"]["A_pval"] is None
    assert run_meta(spark, studies, chrom=23).count() == 1
    sites = spark.createDataFrame([(1, 10, "A", "T,C", "rs7", 0), (1, 10, "A", "C", "rs9", 1)],
                                  "chr int, pos bigint, ref string, alt_list string, id string, seq int")
    (f,) = finish(wide, sites).collect()
    assert f["RSID"] == "rs7" and "A_beta" not in f.asDict() and "lmso_inv_var_het_p" in f.asDict()


def test_method_needs_configured_columns(spark, tmp_path):
    write_study(tmp_path / "a.txt.gz", [])
    conf = entry("A", tmp_path / "a.txt.gz")
    del conf["se"]
    with pytest.raises(ValueError, match="se"):
        run_meta(spark, config.parse_config(json.dumps({"meta": [conf]})))


@pytest.mark.parametrize("change", [{"effect_type": "hazard"}, {"n_cases": "many"}, {"pval": None}])
def test_bad_configuration(change):
    conf = {**entry("A", "x"), **change}
    conf = {k: v for k, v in conf.items() if v is not None}
    with pytest.raises(ValueError):
        config.parse_config(json.dumps({"meta": [conf]}))


def test_config_table_checks_types(spark, tmp_path):
    (tmp_path / "P1.json").write_text(json.dumps({"meta": [entry("A", "a"), entry("B", "b", effect_type="OR", extra_cols=["x"])]}))
    rows = config.scan_config(spark, str(tmp_path)).orderBy("study_ord").collect()
    assert [(r.pheno, r.name, r.n_controls, r.effect_type) for r in rows] == [("P1", "A", 1000, "beta"), ("P1", "B", 1000, "or")]
    (tmp_path / "P1.json").write_text(json.dumps({"meta": [entry("A", "a", effect_type="hr")]}))
    with pytest.raises(Exception, match="no kind of effect"):
        config.scan_config(spark, str(tmp_path)).collect()


def test_blank_separated_scan_and_missing_column(spark, tmp_path):
    write_study(tmp_path / "b.txt", [(1, 10, "G", "T", .7, .9, -.3, .1, .0027, 2000, "x")] * 3, sep="  ", opener=open)
    df = delimited.scan_study(spark, str(tmp_path / "b.txt"), {"POS": "pos", "beta": "b"}, tab_only=False)
    assert [(r.pos, r.b) for r in df.collect()] == [("10", "-0.3")] * 3
    with pytest.raises(ValueError, match="nope"):
        delimited.scan_study(spark, str(tmp_path / "b.txt"), {"nope": "x"}, tab_only=False)


def test_file_order_follows_the_file_across_splits(spark, tmp_path):
    path = tmp_path / "long.txt"
    with open(path, "w") as f:
        f.write("CHR\tPOS\n")
        for i in range(50_000):
            f.write(f"1\t{i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = delimited.scan_study(spark, str(path))
        assert df.rdd.getNumPartitions() > 1
        got = [int(r.POS) for r in df.orderBy("file_order").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(50_000))


def test_chain_file(spark, tmp_path):
    (tmp_path / "x.chain").write_text("chain 100 chr1 1000 + 10 100 chr2 500 - 20 105 1\n50\t10\t5\n30\n\n"
                                      "chain 90 chrX 1000 + 0 7 chrX 900 + 3 10 2\n7\n")
    got = {(r.chr, r.src_start, r.src_end, r.dst_chr, r.dst_start, r.strand) for r in delimited.scan_chain(spark, str(tmp_path / "x.chain")).collect()}
    assert got == {(1, 10, 60, 2, 500 - 20 - 50, "-"), (1, 70, 100, 2, 500 - 75 - 30, "-"), (23, 0, 7, 23, 3, "+")}


def test_sites_header_is_required(spark, tmp_path):
    (tmp_path / "s.vcf").write_text("##x\n#CHROM\tPOS\tID\n1\t2\trs1\n")
    with pytest.raises(ValueError, match="header"):
        delimited.scan_sites(spark, str(tmp_path / "s.vcf"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 20, 0.05), (2, 10, None), (1, 5, 0.5)], "chr int, pos bigint, p double")
    sinks.write_indexed(df, str(tmp_path / "t"))
    plan = delimited.scan_result(spark, str(tmp_path / "t"), ["pos"]).filter("chr = 1")
    assert sorted(r.pos for r in plan.collect()) == [5, 20]
    sinks.write_hits(df, str(tmp_path / "h"), "p", 0.1)
    assert spark.read.csv(str(tmp_path / "h"), sep="\t", header=True).collect()[0].p == "5.e-02"


def test_munge_pipeline(spark):
    names = "`CHR` string, `POS` string, `Allele1` string, `Allele2` string, `AF_Allele2` string, `imputationInfo` string, " \
            "`BETA` string, `SE` string, `p.value` string, `N` string, study_ord int, pop string, file_order bigint"
    row = lambda s, pos, r, a, i: ("chr21", str(pos), r, a, "0.3", "0.9", "0.1", "0.05", "0.5", "100", s, "nfe", i)
    raw = spark.createDataFrame([row(0, 10, "A", "C", 0), row(0, 11, "G", "A", 1), row(1, 110, "C", "A", 2), row(1, 300, "A", "G", 3)], names)
    maps = spark.createDataFrame([("b37", 21, 10), ("b38", 21, 110)], "build string, chr int, pos bigint")
    chain = spark.createDataFrame([(21, 0, 50, 21, 100, "+")], "chr int, src_start bigint, src_end bigint, dst_chr int, dst_start bigint, strand string")
    ref = spark.createDataFrame([("nfe", 21, 110, "A", "C", 0.25, "PASS", 9)],
                                "pop string, chr int, pos bigint, ref string, alt string, af double, filter_ string, an bigint")
    out = {(r.study_ord, r.pos): r for r in munge(clean(raw), maps, chain, ref).collect()}
    assert set(out) == {(0, 110), (0, 111), (1, 110), (1, 300)}
    assert out[(0, 110)].b37_pos == 10 and out[(0, 110)].af_gnomad == 0.25
    swapped = out[(1, 110)]
    assert (swapped.ref, swapped.alt, swapped.beta, swapped.b37_pos, swapped.liftover_info) == ("A", "C", -0.1, None, "AlreadyB38")


def test_workflow_metadata(spark, tmp_path):
    deep = {"message": "root", "causedBy": []}
    for level in range(12):
        deep = {"message": f"m{level}", "causedBy": [deep, {"message": "other", "causedBy": []}]}
    job = lambda shard, attempt, status, **m: {"shardIndex": shard, "attempt": attempt, "executionStatus": status, **m}
    times = {"start": "2022-04-11T10:00:00.000Z", "end": "2022-04-11T10:30:00.000Z", "stdout": "gs://b/w/call-a/shard-0/attempt-2/stdout"}
    doc = {"id": "w1", "workflowName": "w", "status": "Failed", "calls": {"w.a": [
        job(0, 1, "Failed", failures=[{"message": "superseded", "causedBy": []}]), job(0, 2, "Done", **times),
        job(1, 1, "Failed", failures=[deep, {"message": "flat"}]), job(2, 1, "Aborted", backendStatus="Stopped")]}}
    (tmp_path / "w1.json").write_text(json.dumps(doc))
    jobs = runs.scan_runs(spark, str(tmp_path))
    (s,) = workflow_summary(jobs).collect()
    assert (s.n_done, s.n_failed, s.n_other, s.n_finished, s.max_min) == (1, 1, 1, 1, 30.0)
    assert (s.min_job, s.max_job, s.base_path) == (times["stdout"], times["stdout"], "gs://b/w/call-a/")
    assert sorted(r.message for r in workflow_failures(jobs).collect()) == ["flat", "root"]
    assert {(r.status, r.n) for r in status_counts(jobs).collect()} == {("Done", 1), ("Failed", 1), ("Aborted_Stopped", 1)}
    parents = spark.createDataFrame([("w1", "w0"), ("w0", None)], "run_id string, parent_id string")
    assert {(r.root, r.status, r.n) for r in workflow_totals(jobs, parents).collect()} == {
        ("w0", "Done", 1), ("w0", "Failed", 1), ("w0", "Aborted_Stopped", 1)}


def test_roots_of_deep_trees(spark):
    chain = [(i, i - 1 if i else None) for i in range(50)] + [(60, 55)]
    roots = tree_roots(spark.createDataFrame(chain, "run_id long, parent_id long"))
    assert {tuple(r) for r in roots.collect()} == {(i, 0) for i in range(50)} | {(60, 55)}

def _vendor_line(sep, *fields):
    return sep.join(str(f) for f in fields)


def vendor_files(tmp_path, chroms=range(1, 24), ragged=False):
    """The same rows in three dialects: plain, REGENIE with thirteen columns, and blank-separated."""
    rows = [(c, 100 + i, "A", "G", 0.25, 0.9, 0.5 if i else -0.25, 0.125, 0.01, 1000) for c in chroms for i in range(2)]
    names = "CHR POS Allele1 Allele2 AF_Allele2 imputationInfo BETA SE p.value N".split()
    body = [_vendor_line("\t", *names)] + [_vendor_line("\t", *r) for r in rows]
    if ragged:
        body[5] += '\t"more'
    (tmp_path / "saige.txt").write_text("\n".join(body) + "\n")
    regenie = "CHROM GENPOS ID ALLELE0 ALLELE1 A1FREQ INFO N TEST BETA SE CHISQ LOG10P".split()
    lines = [_vendor_line("\t", c, p, f'"{c}', a, b, f, i, n, "ADD", be, se, 1, 2) for c, p, a, b, f, i, be, se, _, n in rows]
    (tmp_path / "regenie.txt").write_text("\n".join([_vendor_line("\t", *regenie), *lines]) + "\n")
    exceed = [{"POS": "BP", "p.value": "P"}.get(n, n) for n in names]
    (tmp_path / "exceed.txt").write_text("\n".join([_vendor_line("  ", *exceed)] + [_vendor_line(" ", *r) for r in rows]) + "\n")
    return [Entry(0, str(tmp_path / "saige.txt"), "SAIGE", "nfe"), Entry(1, str(tmp_path / "regenie.txt"), "REGENIE", "fin"),
            Entry(2, str(tmp_path / "exceed.txt"), "EXCEED", "afr", tab_only=False)], rows


def test_vendor_files_to_clean_rows(spark, tmp_path):
    entries, rows = vendor_files(tmp_path)
    cleaned = clean(format_studies(spark, entries), gated=True).collect()
    expected = {(o, pop, c, p, a, b, be, n) for o, pop in enumerate(["nfe", "fin", "afr"]) for c, p, a, b, _, _, be, _, _, n in rows}
    assert {(r.study_ord, r["pop"], r.chr, r.pos, r.ref, r.alt, r.beta, r.n) for r in cleaned} == expected
    assert len(cleaned) == 3 * len(rows) and all(abs(r.pval - 0.01) < 1e-9 for r in cleaned)


def test_gates_fail_the_job(spark, tmp_path):
    entries, _ = vendor_files(tmp_path, ragged=True)
    with pytest.raises(Exception, match="number of fields"):
        clean(format_studies(spark, entries), gated=True).count()
    entries, _ = vendor_files(tmp_path, chroms=range(1, 5))
    with pytest.raises(Exception, match="fewer than 22"):
        clean(format_studies(spark, entries), gated=True).count()


def test_quotes_are_ordinary_and_fields_are_counted(spark, tmp_path):
    (tmp_path / "q.txt").write_text('a\tb\tc\n"x\t1\t\n"y"\t2\n')
    got = {(r.a, r.b, r.c, r.n_fields) for r in delimited.scan_study(spark, str(tmp_path / "q.txt"), count_fields=True).collect()}
    assert got == {('"x', "1", None, 3), ('"y"', "2", None, 2)}


def test_one_header_in_two_roles(spark, tmp_path):
    studies = [("A", 10), ("B", 11)]
    for name, pos in studies:
        line = ["1", str(pos), "A", "G", "0.2", "0.9", "0.5", "0.1", "0.01", "77", "e"]
        (tmp_path / f"{name}.txt").write_text("\t".join(HEADER) + "\n" + "\t".join(line) + "\n")
    configs = config.parse_config(json.dumps({"meta": [entry(n, tmp_path / f"{n}.txt", extra_cols=["N", "extra"], Nsamples="N") for n, _ in studies]}))
    out = {r.POS: r for r in run_meta(spark, configs).collect()}
    assert (out[10]["A_N"], out[10]["A_Nsamples"], out[10]["A_extra"], out[10]["B_N"]) == ("77", 77, "e", None)


def test_overlapping_blocks_fail_the_job(spark):
    chain = spark.createDataFrame([(1, 0, 100, 1, 0, "+"), (1, 50, 150, 1, 500, "+")],
                                  "chr int, src_start bigint, src_end bigint, dst_chr int, dst_start bigint, strand string")
    df = spark.createDataFrame([(1, 60, "A", "G")], "chr int, pos bigint, ref string, alt string")
    with pytest.raises(Exception, match="overlap"):
        liftover(df, chain).collect()


def test_sites_file_gives_rsids(spark, tmp_path):
    (tmp_path / "s.vcf").write_text("##x\n" + "\t".join(delimited.SITES_HEADER) + "\nX\t5\trs1\tA\tC,G\t.\t.\t.\n")
    df = spark.createDataFrame([(23, 5, "A", "G"), (23, 5, "A", "T")], "chr int, pos bigint, ref string, alt string")
    named = add_rsids(df, delimited.scan_sites(spark, str(tmp_path / "s.vcf"))).collect()
    assert {(r.alt, r.rsid) for r in named} == {("G", "rs1"), ("T", "NA")}


def test_queries_list_files_and_show_the_configuration(spark):
    from sumweave.queries import ORACLE, QUERIES

    files = QUERIES["inventory_files"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r["uri"] for r in files) == [f"part={i}/*.txt" for i in range(4)] and all(r["size"] > 0 and r["timed"] for r in files)
    config = QUERIES["study_config_json"](spark, "/root/testdata/sf0.001").first()["config"]
    assert config.startswith('{"name":"') and {"inventory_files", "study_config_json"} <= set(ORACLE)


def test_text_tables_quote_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a"b', 0.5), (2, None, None)], "`#CHR` int, x string, p double")
    sinks.write_tsv(df, str(tmp_path / "t"), compression="none")
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).distinct().collect())
    assert lines == ["#CHR\tx\tp", '1\ta"b\t5.e-01', "2\tNA\tNA"]


def test_phenotypes_share_a_scan(spark, tmp_path):
    from sumweave.plans.meta import run_metas

    for name, beta in (("a", .1), ("b", -.2), ("c", .4)):
        write_study(tmp_path / f"{name}.txt.gz", [(1, 10, "A", "C", .2, .9, beta, .1, .01, 1000, "e")])
    a, b, c = (entry(n.upper() + "_EUR", tmp_path / f"{n}.txt.gz") for n in "abc")
    configs = {"P": config.parse_config(json.dumps({"meta": [a, b]})), "Q": config.parse_config(json.dumps({"meta": [c, {**a, "n_cases": 7}]}))}
    rules = lambda name: {"only_a": name.startswith("A"), "none": F.lit(False)}
    out = run_metas(spark, configs, rules=rules, leave_one_out=True)
    got = {(r.pheno, r.family): r for r in out.collect()}
    assert set(got) == {(p, f) for p in "PQ" for f in ("all", "subset_only_a", "leave_0", "leave_1")}
    assert got["P", "all"].beta == pytest.approx(-.05) and got["Q", "all"].beta == pytest.approx(.25)
    assert got["P", "subset_only_a"].beta == pytest.approx(.1) and got["P", "subset_only_a"].n_cases == 100
    assert got["Q", "subset_only_a"].n_cases == 7
    assert got["Q", "leave_0"].left_study == "C_EUR" and got["Q", "leave_0"].beta == pytest.approx(.1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 0 and plan.count("Relation [file_id") == 3  # stored rows, headers and places


def test_two_hundred_headers_one_scan(spark, tmp_path):
    import gzip as gz

    from sumweave.sources import blockgzip
    from sumweave.sources.staged import Source, _lines, scan_files

    sources, want = [], []
    for i in range(200):
        names = ["#CHR", "POS", f"BETA{i % 3}", "junk"]
        names = names[i % 4:] + names[:i % 4]
        rows = [{"#CHR": str(i % 22 + 1), "POS": str(k), f"BETA{i % 3}": "" if k == 1 else f"{k}.{i}", "junk": "j"} for k in range(i % 5)]
        sep = " " if i % 7 == 0 else "\t"
        if sep == " ":
            rows = [r for r in rows if "" not in r.values()]
        text = "##made up\n" * (i % 2) + sep.join(names) + "\n" + "".join(sep.join(r[n] for n in names) + "\n" for r in rows)
        path = tmp_path / (f"s +{i}.txt" if i % 3 == 0 else f"s{i}.txt.gz" if i % 3 == 1 else f"s{i}.bgz")
        path.write_bytes(text.encode() if i % 3 == 0 else gz.compress(text.encode()) if i % 3 == 1 else
                         b"".join(blockgzip.members(iter(text.encode().split(b"\n")[:-1]))) + blockgzip.END)
        sources.append(Source(i, str(path), {"chr": "#CHR", "pos": "POS", "effect": f"BETA{i % 3}", **({"more": "nope"} if i == 4 else {})}, sep == "\t"))
        want += [(i, r["#CHR"], r[f"BETA{i % 3}"] or None, r["POS"]) for r in rows]
    df = scan_files(spark, sources, optional=["more"])
    got = [(r["file_id"], r["chr"], r["effect"], r["pos"]) for r in df.orderBy("file_id", "file_order").collect()]
    assert got == want
    plan = _lines(spark, [s.path for s in sources if not s.path.endswith(".bgz")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 1
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 4
    with pytest.raises(Exception, match="lacks column nope"):
        scan_files(spark, sources).collect()


def test_newest_by_time_before_name(spark):
    from datetime import datetime

    from sumweave.operators.manifest import pick_latest, with_modified

    parsed = spark.createDataFrame([("s", "F1", "P", "old-date", "20210101", 0), ("s", "F1", "P", "new-date", "20220101", 1),
                                    ("s", "F2", "P", "x", "20210101", 2), ("s", "F2", "P", "unknown", "20230101", 3)],
                                   "dataset string, freeze string, pheno string, uri string, date string, seq int")
    listed = spark.createDataFrame([("old-date", datetime(2024, 5, 1)), ("new-date", datetime(2023, 5, 1)), ("x", datetime(2020, 1, 1)),
                                    ("x", datetime(2020, 2, 1))], "uri string, modified timestamp")
    assert {(r.freeze, r.uri) for r in pick_latest(with_modified(parsed, listed)).collect()} == {("F1", "old-date"), ("F2", "x")}
    assert {(r.freeze, r.uri) for r in pick_latest(parsed).collect()} == {("F1", "new-date"), ("F2", "unknown")}


def test_thinned_qq_is_bounded(spark):
    from sumweave.operators.qcdata import qq_thinned

    long = spark.range(200_000).select(F.lit("p").alias("p_col"), ((F.col("id") + .5) / 200_000).alias("pval"), F.lit(1).alias("chr"), F.col("id").alias("pos"))
    df = qq_thinned(long, bins=20, tail=50)
    got = sorted(df.collect(), key=lambda r: r["rank"])
    assert len(got) < 50 + 20 * 6 and [r["rank"] for r in got[:30]] == list(range(1, 31)) and got[-1]["rank"] == 200_000
    assert all(r["expected"] == pytest.approx(r["observed"]) for r in got)
    assert "Checkpoint" not in df._jdf.queryExecution().optimizedPlan().toString()
