"""What the larger tables need of the plans: nothing computed is broadcast on an estimate, no task has a whole file."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from sumweave.operators.annotate import add_rsids
from sumweave.plans.format import Entry, format_studies
from sumweave.plans.munge import clean
from sumweave.queries import QUERIES
from sumweave.sources import delimited, staged

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
MERGED = ["dedup_best", "harmonize", "lift_indels", "af_compare", "max_af_diff", "require_ref", "af_density", "dedup_discard"]


@needs_tables
@pytest.mark.parametrize("name", MERGED)
def test_computed_tables_are_merged(spark, name):
    # The estimates are below the threshold here, as they are on larger tables.
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) >= 10 << 20
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def _parts(folder, sizes, header="CHR\tPOS"):
    """Gzip parts with a header each; positions count up over the parts in the order of their names."""
    folder.mkdir()
    at = 0
    for i, n in enumerate(sizes):
        with gzip.open(folder / f"part-{i:05d}.txt.gz", "wt") as f:
            f.write("\n".join([header, *(f"1\t{p}" for p in range(at, at + n))]) + "\n")
        at += n
    return str(folder), at


def test_rows_follow_the_names_of_part_files(spark, tmp_path):
    # The largest part is the last: scans take up large files first.
    path, total = _parts(tmp_path / "study", [3, 50, 4000])
    rows = delimited.scan_study(spark, path).orderBy("file_order").collect()
    assert [int(r["POS"]) for r in rows] == list(range(total))


def test_conditions_on_fields_do_not_cut_lines(spark, tmp_path):
    columns = ["CHROM", "GENPOS", "ALLELE0", "ALLELE1", "A1FREQ", "INFO", "BETA", "SE", "N", "LOG10P"]
    (tmp_path / "s.txt").write_text("\t".join(columns) + "\n" + "\t".join(["1", "5", "A", "C", "0.2", "0.9", "0.1", "0.2", "70", "3"]) + "\n")
    df = clean(format_studies(spark, [Entry(0, str(tmp_path / "s.txt"), "REGENIE", "nfe")]))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    # Once, to tell the header from the rows.
    assert filters and sum(line.count("split(") for line in filters) <= 1 and not any("POWER(" in line.upper() for line in filters)
    row = df.first()
    assert (row["chr"], row["pos"], row["n"]) == (1, 5, 70) and abs(row["pval"] - 1e-3) < 1e-12


def test_ids_of_sites_are_merged(spark):
    df = spark.createDataFrame([(1, 5, "A", "C")], "chr int, pos bigint, ref string, alt string")
    sites = spark.createDataFrame([(1, 5, "A", "C,G", "rs1", 0)], "chr int, pos bigint, ref string, alt_list string, id string, seq int")
    out = add_rsids(df, sites)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first()["rsid"] == "rs1"


def test_staged_rows_follow_the_names_of_part_files(spark, tmp_path):
    path, total = _parts(tmp_path / "study", [3, 50, 4000])
    rows = staged.scan_files(spark, [staged.Source(0, path, {"pos": "POS"})]).orderBy("file_id", "file_order").collect()
    assert [int(r["pos"]) for r in rows] == list(range(total))
