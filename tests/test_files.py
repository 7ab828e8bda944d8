"""Block-gzip files, zone maps, chain files and sequences against plain Python."""

import gzip
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sumweave.operators.build import detect_build
from sumweave.operators.liftover import liftover
from sumweave.operators.sequence import common_prefix, scan_fasta, windows_of
from sumweave.sources import blockgzip, delimited, regions, sinks


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=400).map(lambda b: b.replace(b"\n", b"")), max_size=30))
def test_members_are_gzip(lines):
    data = b"".join(blockgzip.members(iter(lines))) + blockgzip.END
    assert gzip.decompress(data) == b"".join(x + b"\n" for x in lines)


CASES = {
    "many": [b"l%d\t" % i + bytes([97 + i % 26]) * (i * 7919 % 300) for i in range(20_000)],
    "long line": [b"h", bytes(random.Random(1).choices(range(97, 123), k=700_000)), b"z", b"", b""],
    "one line without end": None,
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_block_gzip_lines_across_members_and_splits(small_splits, tmp_path, name):
    lines = CASES[name]
    path = tmp_path / "x.bgz"
    body = blockgzip.deflate(b"") + blockgzip.deflate(b"no end") if lines is None else b"".join(blockgzip.members(iter(lines)))
    path.write_bytes(body + blockgzip.END)
    df = blockgzip.scan_lines(small_splits, str(path))
    want = gzip.decompress(path.read_bytes()).decode().split("\n")
    assert [r["value"] for r in df.orderBy("block", "row").collect()] == want
    if name == "many":
        assert df.rdd.getNumPartitions() > 4


def test_block_gzip_study(small_splits, tmp_path):
    rows = [f"{i % 22 + 1}\t{i}\t{'A' * (i % 9 + 1)}\t{i / 7}" for i in range(30_000)]
    path = tmp_path / "s.bgz"
    path.write_bytes(b"".join(blockgzip.members(x.encode() for x in ["##comment", "CHR\tPOS\tREF\tBETA", *rows])) + blockgzip.END)
    assert delimited.read_header(small_splits, str(path), "\t") == ["CHR", "POS", "REF", "BETA"]
    df = delimited.scan_study(small_splits, str(path), {"POS": "pos", "BETA": "b"}, count_fields=True)
    got = df.filter("pos is not null").orderBy("file_order").collect()
    assert [(r["pos"], r["b"], r["n_fields"]) for r in got] == [(str(i), str(i / 7), 4) for i in range(30_000)]


def test_damaged_block_gzip_fails(spark, tmp_path):
    data = bytearray(b"".join(blockgzip.members(iter([b"abc" * 50, b"d" * 999]))) + blockgzip.END)
    data[-40] ^= 1
    (tmp_path / "bad.bgz").write_bytes(bytes(data))
    with pytest.raises(Exception, match="block-gzip|decompress|invalid"):
        blockgzip.scan_lines(spark, str(tmp_path / "bad.bgz")).collect()


def test_one_file_under_one_header(spark, tmp_path):
    df = spark.range(0, 50_000, 1, 7).select(F.col("id").alias("#CHR"), (F.col("id") / 3).alias("x"), F.when(F.col("id") % 2 == 0, "a").alias("y"))
    path = str(tmp_path / "all.bgz")
    size = sinks.write_single(df, path)
    data = open(path, "rb").read()
    lines = gzip.decompress(data).decode().split("\n")
    assert len(data) == size and lines[0] == "#CHR\tx\ty" and lines[-1] == "" and len(lines) == 50_002
    text, _ = sinks.text_lines(df)
    assert lines[1:-1] == [r["value"] for r in text.collect()]
    back = delimited.scan_study(spark, path)
    assert back.count() == 50_000 and back.columns[:3] == ["#CHR", "x", "y"]
    (tmp_path / "all.bgz.parts" / "part-00003.bgz").write_bytes(b"x")
    with pytest.raises(Exception, match="not what was written"):
        blockgzip.join_parts(spark, f"{path}.parts", str(tmp_path / "again.bgz"))


def test_block_gzip_folder(spark, tmp_path):
    df = spark.range(0, 1000, 1, 5).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    sinks.write_bgz(df, str(tmp_path / "out"))
    got = delimited.scan_study(spark, f"{tmp_path}/out/*.bgz")
    assert sorted(int(r["a"]) for r in got.collect()) == list(range(1000))
    with pytest.raises(ValueError, match="exists"):
        sinks.write_bgz(df, str(tmp_path / "out"))


def test_regions_open_only_the_files_they_need(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randint(1, 4), rng.randint(1, 400_000), i) for i in range(5000)]
    path = str(tmp_path / "t able")  # a blank in the path
    sinks.write_indexed(spark.createDataFrame(rows, "chr int, pos bigint, i int").repartition(8), path)
    spans = [(2, 1000, 90_000), (2, 80_000, 100_000), (3, 399_000, 399_999), (9, 1, 5)]
    wanted = spark.createDataFrame(spans, "chr int, start bigint, end bigint")
    got = regions.scan_regions(spark, path, wanted)
    assert sorted(r["i"] for r in got.collect()) == sorted(i for c, p, i in rows if any(c == k and a <= p <= b for k, a, b in spans))
    named, every = regions.named_files(spark, path, wanted), spark.read.parquet(path).inputFiles()
    assert 0 < len(named) <= len(every) / 2 and len(got.inputFiles()) == len(named)
    scan = [line for line in got._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line]
    assert scan and f"InMemoryFileIndex({len(named)} paths)" in scan[0]
    assert regions.scan_regions(spark, path, wanted.filter("chr = 9")).count() == 0


def test_build_from_position_lists(spark, tmp_path):
    (tmp_path / "b37.txt").write_text("# chr 21\n21 100\n21\t200\n")
    (tmp_path / "b38.txt").write_text("chr21:300\n21:1e3\n")
    maps = delimited.scan_build_map(spark, {"b37": str(tmp_path / "b37.txt"), "b38": str(tmp_path / "b38.txt")})
    assert sorted(tuple(r) for r in maps.collect()) == [("b37", 21, 100), ("b37", 21, 200), ("b38", 21, 300), ("b38", 21, 1000)]
    rows = [(0, 21, 100), (0, 21, 300), (0, 21, 200), (1, 21, 1000), (1, 5, 100), (2, 1, 100)]
    path = str(tmp_path / "t")
    sinks.write_indexed(spark.createDataFrame(rows, "study_ord int, chr int, pos bigint"), path)
    found = regions.scan_regions(spark, path, regions.as_points(maps))
    studies = spark.createDataFrame([(0,), (1,), (2,)], "study_ord int")
    got = {r["study_ord"]: (r["n_b37"], r["n_b38"], r["build"]) for r in detect_build(found, maps, studies=studies).collect()}
    assert got == {0: (2, 1, "b37"), 1: (0, 1, "b38"), 2: (0, 0, None)}


def brute_chain(text):
    out, head = [], None
    for line in text.split("\n"):
        f = line.split()
        if not f or line.startswith("#"):
            continue
        if f[0] == "chain":
            head, t, q = f, int(f[5]), int(f[10])
            continue
        size = int(f[0])
        out.append((int(head[2].replace("chr", "")), t, t + size, int(head[7].replace("chr", "")),
                    int(head[8]) - q - size if head[9] == "-" else q, head[9]))
        if len(f) > 1:
            t, q = t + size + int(f[1]), q + size + int(f[2])
    return sorted(out)


def test_chain_records(small_splits, tmp_path):
    rng = random.Random(4)
    records = []
    for i in range(400):
        lines = [f"chain {i} chr{i % 22 + 1} 900000000 + {rng.randint(0, 999)} 9 chr{rng.randint(1, 22)} 900000000 {rng.choice('+-')} {rng.randint(0, 999)} 9 {i}"]
        lines += [f"{rng.randint(1, 50)}\t{rng.randint(0, 9)}\t{rng.randint(0, 9)}" for _ in range(rng.randint(0, 40))]
        records.append("\n".join([*lines, str(rng.randint(1, 50))]))
    text = "# made up\n" + "\n\n".join(records[:200]) + "\n" + "\n\n\n".join(records[200:]) + "\n\n"
    (tmp_path / "x.chain").write_text(text)
    df = delimited.scan_chain(small_splits, str(tmp_path / "x.chain"))
    assert sorted(tuple(r) for r in df.collect()) == brute_chain(text)
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "windowspecdefinition(file#" not in plan and "windowspecdefinition(record#" in plan
    (tmp_path / "y.chain").write_text("5\t1\t1\n7\n")
    with pytest.raises(Exception, match="no header"):
        delimited.scan_chain(small_splits, str(tmp_path / "y.chain")).collect()


def test_fasta_positions_and_windows(small_splits, tmp_path):
    rng = random.Random(5)
    whole = {c: "".join(rng.choice("ACGTacgt") for _ in range(n)) for c, n in ((1, 30_001), (2, 60), (3, 45_000), (23, 1))}
    with open(tmp_path / "g.fa", "w") as f:
        for c, seq in whole.items():
            f.write(f">chr{'X' if c == 23 else c} text\n" + "".join(seq[i:i + 60] + "\n" for i in range(0, len(seq), 60)))
    lines = scan_fasta(small_splits, str(tmp_path / "g.fa"))
    got = {c: "" for c in whole}
    for r in lines.orderBy("chr", "start").collect():
        assert r["start"] == len(got[r["chr"]]) + 1
        got[r["chr"]] += r["bases"]
    assert got == whole
    width, margin = 700, 333
    seen = {(r["chr"], r["window"]): r["seq"] for r in windows_of(lines, width, margin).collect()}
    for c, seq in whole.items():
        for w in range(len(seq) // width + 1):
            low = w * width - margin
            want = "".join(seq[p - 1].upper() if 1 <= p <= len(seq) else "N" for p in range(low, low + width + margin))
            assert seen[c, w] == want


def test_common_prefix(spark):
    rng = random.Random(6)
    pairs = [("", ""), ("a", ""), ("", "b"), ("ab", "ab"), ("abc", "abd"), ("x" * 5000, "x" * 5000)]
    for _ in range(200):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 50)))
        pairs.append((a, a[:rng.randint(0, len(a))] + rng.choice(["", "a", "b", "ab"])))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", common_prefix(F.col("a"), F.col("b")).alias("n"))
    for r in df.collect():
        n = next((i for i, (x, y) in enumerate(zip(r["a"], r["b"])) if x != y), min(len(r["a"]), len(r["b"])))
        assert r["n"] == min(n, 4095)


def turned(seq, e, ref, alt):
    """The reverse-strand alleles of a variant whose first base lies at target position e (1-based), left-aligned one base at a time."""
    comp = str.maketrans("ACGT", "TGCA")
    pos = e - len(ref) + 1
    r, a = ref.translate(comp)[::-1], alt.translate(comp)[::-1]
    if seq[pos - 1:pos - 1 + len(r)] != r:
        return "MismatchedRefAllele"
    while r and a and r[-1] == a[-1] or not (r and a):
        if r and a and r[-1] == a[-1]:
            r, a = r[:-1], a[:-1]
        if not (r and a):
            pos -= 1
            if pos < 1:
                return "ReverseStrandIndel"
            r, a = seq[pos - 1] + r, seq[pos - 1] + a
            if r[-1] != a[-1]:
                break
    while len(r) > 1 and len(a) > 1 and r[0] == a[0]:
        pos, r, a = pos + 1, r[1:], a[1:]
    return pos, r, a


def test_reverse_strand_alleles_against_brute_force(spark):
    rng = random.Random(7)
    # Repeats of one to four bases, so that indels roll far.
    seq = "".join(rng.choice(["A", "C", "AC", "GTT", "ACGT"]) * rng.randint(1, 30) for _ in range(200))
    n = len(seq)
    comp = str.maketrans("ACGT", "TGCA")
    source = seq.translate(comp)[::-1]  # the source build is the target read backwards
    rows = []
    for i in range(1500):
        at = rng.randint(1, n - 12)
        ref = source[at - 1:at - 1 + rng.randint(1, 8)]
        kind = rng.random()
        alt = ref[0] if kind < 0.35 else ref + source[at - 1 + len(ref):at + 5] if kind < 0.6 else ref[0] + "".join(
            rng.choice("ACGT") for _ in range(rng.randint(0, 5)))
        if kind > 0.95:
            ref = ref[::-1]
        if len(ref) == len(alt) == 1 or ref == alt:
            continue
        rows.append((i, 1, at, ref, alt))
    df = spark.createDataFrame(rows, "i int, chr int, pos bigint, ref string, alt string")
    chain = spark.createDataFrame([(1, 0, n, 2, 0, "-")], "chr int, src_start bigint, src_end bigint, dst_chr int, dst_start bigint, strand string")
    pieces = spark.createDataFrame([(2, p + 1, seq[p:p + 61]) for p in range(0, n, 61)], "chr int, start bigint, bases string")
    got = {r["i"]: r for r in liftover(df, chain, windows=windows_of(pieces)).collect()}
    statuses = set()
    for i, _, at, ref, alt in rows:
        want = turned(seq, n - at + 1, ref, alt)
        r = got[i]
        statuses.add(r["lift_status"])
        if isinstance(want, str):
            assert r["lift_status"] == want, (at, ref, alt)
        else:
            assert (r["lift_status"], r["new_pos"], r["new_ref"], r["new_alt"]) == ("OK", *want), (at, ref, alt)
    assert {"OK", "MismatchedRefAllele"} <= statuses
    # Without sequence nothing is known.
    assert {r["lift_status"] for r in liftover(df, chain, windows=windows_of(pieces.filter("start > 1e9"))).collect()} == {"ReverseStrandIndel"}
