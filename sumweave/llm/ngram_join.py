"""Similarity self-join of documents on word n-grams, by T-occurrence search with DivideSkip.

Texts with equal n-gram sets are one class, searched once. N-grams get a global order, rare ones
first (document frequencies are counted over all classes); two sets of the wanted similarity share
one of their first few n-grams in that order. Classes that share such a one, directly or over
others, fall into one search group. Within a group an inverted index answers each set's query: the
short lists are merged and counted, the long ones only probed by binary search for what the short
ones left over, and what reaches the required overlap is checked exactly.

A query looks only for sets that are not yet reached, so copies of one text cost one query each
over a shrinking index, not one per pair; every link between sets not otherwise joined is found. A
group above GROUP_GRAMS is split over tasks: blocks are searched alone, then what lies outside the
group's largest class is searched against every block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sumweave.llm import exchange as X
from sumweave.llm.components import connected
from sumweave.llm.words import hashed_words, mix, run_hashes, second

#: Words of an n-gram; the least similarity, in hundredths.
GRAM, PERCENT = 5, 80
#: Weight of a probe against a merged entry in the choice of long lists.
MU = 0.01
#: N-grams of the sets that one search task holds.
GROUP_GRAMS = 2 << 20


def gram_sets(texts: list[bytes | None], gram: int) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """The sorted distinct n-gram hashes of each text (A-Z as a-z), and 128 bits that stand for the set.

    A text of fewer words has all of them as one n-gram; one without words has none. The second half of
    the bits comes from another hash of every word.
    """
    words, _, _, first, others = hashed_words(texts, lower=True, both=True)
    hashes, more = run_hashes(words, gram), run_hashes(others, gram)
    sets, marks = [], []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= gram:
            own, at = np.unique(hashes[low:high - gram + 1], return_index=True)
            other = more[low + at]
        elif high > low:
            own, other = run_hashes(words[low:high], high - low), run_hashes(others[low:high], high - low)
        else:
            own = other = np.zeros(0, np.uint64)
        sets.append(own)
        marks.append(tuple(int(x) for x in np.array([mix(own).sum(dtype=np.uint64), second(other).sum(dtype=np.uint64)]).view(np.int64)))
    return sets, marks


def needed(a: int, b, percent: int):
    """The least overlap o of sets of a and b with 100 * o >= percent * (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    """So many first n-grams that a similar set shares one of them."""
    return n - -(-percent * n // 100) + 1


class Index:
    """Inverted lists of sets that are not reached yet."""

    def __init__(self, sizes: np.ndarray, grams: list[np.ndarray], percent: int):
        self.sizes, self.grams, self.percent = sizes, grams, percent
        self.alive = np.ones(len(sizes), dtype=bool)
        self._build()

    def _build(self) -> None:
        rows = np.flatnonzero(self.alive)
        self.built = self.left = len(rows)
        flat = np.concatenate([self.grams[i] for i in rows]) if len(rows) else np.zeros(0, np.uint64)
        owner = np.repeat(rows, [len(self.grams[i]) for i in rows]) if len(rows) else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.owner, flat = owner[order].astype(np.int64), flat[order]
        self.gram, start = np.unique(flat, return_index=True)
        self.start = np.append(start, len(flat))

    def remove(self, rows: np.ndarray) -> None:
        self.alive[rows] = False
        self.left -= len(rows)
        if self.left < self.built // 2:
            self._build()

    def search(self, grams: np.ndarray, size: int) -> np.ndarray:
        """The sets left that are similar to one of so many n-grams, of which grams are those others have."""
        if not self.left:
            return np.zeros(0, np.int64)
        at = np.searchsorted(self.gram, grams)
        at = at[at < len(self.gram)][self.gram[at[at < len(self.gram)]] == grams[at < len(self.gram)]]
        low, length = self.start[at], self.start[at + 1] - self.start[at]
        least = -(-self.percent * size // 100)  # whatever the partner's size
        if len(at) < least:
            return np.zeros(0, np.int64)
        order = np.argsort(length, kind="stable")
        low, length = low[order], length[order]
        # DivideSkip: the longest lists are left out of the merge, and the threshold falls by their number.
        longest = min(least - 1, int(least / (MU * math.log2(max(2, int(length[-1]))) + 1)), len(at) - 1)
        short = len(at) - longest
        total = int(length[:short].sum())
        where = np.repeat(low[:short] - np.concatenate([[0], np.cumsum(length[:short])[:-1]]), length[:short]) + np.arange(total)
        found, count = np.unique(self.owner[where], return_counts=True)
        keep = (count >= least - longest) & self.alive[found]
        found, count = found[keep], count[keep]
        other = self.sizes[found]
        keep = (100 * np.minimum(other, size) >= self.percent * np.maximum(other, size))
        found, count, want = found[keep], count[keep], needed(size, other[keep], self.percent)
        for k in range(short, len(at)):
            if not len(found):
                break
            part = self.owner[low[k]:low[k] + length[k]]
            spot = np.searchsorted(part, found)
            count = count + ((spot < len(part)) & (part[np.minimum(spot, len(part) - 1)] == found))
            keep = count + (len(at) - 1 - k) >= want
            found, count, want = found[keep], count[keep], want[keep]
        return found[count >= want]


def components(ids: np.ndarray, sizes: np.ndarray, grams: list[np.ndarray], percent: int) -> np.ndarray:
    """The least id reachable by links, for each set: queries spread from set to set over those not reached."""
    index = Index(sizes, grams, percent)
    label = ids.copy()
    for seed in np.argsort(ids, kind="stable"):
        if not index.alive[seed]:
            continue
        index.remove(np.array([seed]))
        waiting = [seed]
        while waiting and index.left:
            row = waiting.pop()
            found = index.search(grams[row], int(sizes[row]))
            if len(found):
                index.remove(found)
                label[found] = ids[seed]
                waiting.extend(found.tolist())
    return label


def _grams(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.sort(np.frombuffer(x, "<u8")) for x in column.to_pylist()]


def classes_of(measured: DataFrame) -> DataFrame:
    """(mark_a, mark_b, n_shingles, doc_id, node) of every class of equal sets, doc_id being the least in it.

    The node is that id, too; where one id is the least of several classes, as it stands for several texts, all but
    one of them get a node below zero from their marks.
    """
    classes = measured.where("n_shingles > 0 and doc_id is not null").groupBy("mark_a", "mark_b", "n_shingles").agg(F.min("doc_id").alias("doc_id"))
    firsts = classes.groupBy("doc_id").agg(F.min(F.struct("mark_a", "mark_b", "n_shingles")).alias("first"), F.count(F.lit(1)).alias("n"))
    several = firsts.where("n > 1").select("doc_id", "first")
    own = F.col("first").isNull() | (F.struct("mark_a", "mark_b", "n_shingles") == F.col("first"))
    made = -1 - F.pmod(F.xxhash64("mark_a", "mark_b", "n_shingles"), F.lit(1 << 62))
    return classes.join(several, "doc_id", "left").select(
        "mark_a", "mark_b", "n_shingles", "doc_id", F.when(own, F.col("doc_id")).otherwise(made).alias("node"))


def search_sets(docs: DataFrame, classes: DataFrame, gram: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, prefix, grams) of every class whose first n-grams some other class has, too."""
    chunks, buckets = X.sizes(docs, text_col)
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk")
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).where("doc_id is not null")
    parted = plain.select(chunk, "*").groupBy("chunk")
    firsts = classes.select(chunk, "doc_id", "mark_a", "mark_b", "node").groupBy("chunk")

    def chosen(table: pa.Table, nodes: dict) -> tuple[list[int], list[np.ndarray]]:
        """The sets of the classes whose document is in this chunk, by their node, in order."""
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        wanted = {d for d, _, _ in nodes}
        rows = [i for i, d in enumerate(ids) if d in wanted]
        taken = {}
        for i, grams, marks in zip(rows, *gram_sets([texts[i] for i in rows], gram)):
            if len(grams) and (node := nodes.get((ids[i], *marks))) is not None:
                taken[node] = grams
        return sorted(taken), [taken[d] for d in sorted(taken)]

    def ask(key: tuple, left: pa.Table, firsts: pa.Table) -> pa.Table:
        names = ("bucket", "chunk", "bits", "counts")
        empty = pa.table({n: pa.array([], k) for n, k in zip(names, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))})
        if not firsts.num_rows or not left.num_rows:
            return empty
        nodes = {(d, a, b): n for d, a, b, n in zip(*(firsts.column(n).to_pylist() for n in ("doc_id", "mark_a", "mark_b", "node")))}
        _, sets = chosen(left, nodes)
        if not sets:
            return empty
        who = firsts.column("chunk")[0].as_py()
        keys, counts = np.unique(X.keys_of(np.concatenate(sets), buckets), return_counts=True)
        rows = [(b, who, X.pack(X.low_bits(keys[s])), X.pack(counts[s].astype(np.uint32))) for b, s in X.slices(keys)]
        # Which documents stand for a class travels on to the step that reads the answers.
        state = np.array([[*key, nodes[key]] for key in sorted(nodes)], dtype=np.int64)
        rows.append((rows[0][0], who, None, X.pack(state.ravel())))
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))})

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        """Twice the binary logarithm of each n-gram's document frequency, at least; 0 for 1."""
        rows, who, bits, counts = [], [], [], []
        for w, b, c in zip(*(table.column(n).to_pylist() for n in ("chunk", "bits", "counts"))):
            if b is None:
                rows.append((w, -1, c))
            else:
                who.append(w)
                bits.append(X.unpack(b, np.uint32))
                counts.append(X.unpack(c, np.uint32))
        if who:
            _, number = np.unique(np.concatenate(bits), return_inverse=True)
            often = np.floor(2 * np.log2(np.bincount(number, weights=np.concatenate(counts)))).astype(np.uint8)[number]
            low = 0
            for w, part in zip(who, bits):
                rows.append((w, key[0].as_py(), X.pack(often[low:low + len(part)])))
                low += len(part)
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("chunk", "bucket", "answer"), zip(*rows), (pa.int64(), pa.int64(), pa.binary()))})

    def choose(key: tuple, left: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        told = sorted(zip(told.column("bucket").to_pylist(), told.column("answer").to_pylist()))
        if told and left.num_rows:
            state = X.unpack(told[0][1], np.int64).reshape(-1, 4)
            ids, sets = chosen(left, {(d, a, b): n for d, a, b, n in state.tolist()})
            often = np.concatenate([X.unpack(a, np.uint8) for b, a in told if b >= 0])
            all_keys = X.keys_of(np.concatenate(sets), buckets)
            level, low = often[np.searchsorted(np.unique(all_keys), all_keys)], 0
            for d, grams in zip(ids, sets):
                own = level[low:low + len(grams)]
                low += len(grams)
                order = np.lexsort((grams, own))
                first = order[:prefix_size(len(grams), percent)]
                first = first[own[first] > 0]
                if len(first):
                    rows.append((d, len(grams), grams[first].view(np.int64).tolist(), grams[own > 0].astype("<u8").tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        columns = list(zip(*rows)) if rows else [()] * 4
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("doc_id", "n", "prefix", "grams"), columns, kinds)})

    asked = parted.cogroup(firsts).applyInArrow(ask, "bucket long, chunk long, bits binary, counts binary")
    told = asked.groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, answer binary")
    return parted.cogroup(told.groupBy("chunk")).applyInArrow(choose, "doc_id long, n long, prefix array<long>, grams binary")


def _labels(parts, percent: int) -> DataFrame:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        label = components(ids, table.column("n").to_numpy(), _grams(table.column("grams")), percent)
        return pa.table({"doc_id": ids, "label": label})
    return parts.applyInArrow(run, "doc_id long, label long")


def link_groups(spark: SparkSession, sets: DataFrame, percent: int, group_grams: int = GROUP_GRAMS) -> DataFrame:
    """(doc_id, component) of the classes in sets that have a link."""
    tokens = sets.select("doc_id", F.explode("prefix").alias("gram"))
    # A star for each first n-gram: its classes hang on the least one.
    least = tokens.groupBy("gram").agg(F.min("doc_id").alias("v"), F.max("doc_id").alias("top")).where("v <> top").select("gram", "v")
    stars = tokens.join(least, "gram").select(F.col("doc_id").alias("u"), "v").where("u <> v")
    groups = connected(spark, stars).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "group")
    grouped = X.saved(spark, sets.drop("prefix").join(groups, "doc_id"), "sets")
    weights = X.saved(spark, grouped.groupBy("group").agg(F.sum(F.octet_length("grams") / 8 + 1).cast("long").alias("weight")), "weights")
    large = weights.where(F.col("weight") > group_grams).select(
        "group", F.ceil(F.col("weight") / group_grams).cast("long").alias("blocks"))
    if large.isEmpty():
        return _labels(grouped.groupBy("group"), percent).select("doc_id", F.col("label").alias("component"))
    whole = _labels(grouped.join(large, "group", "left_anti").groupBy("group"), percent)
    # Large groups: every block alone.
    blocks = X.saved(spark, grouped.join(large, "group").withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks")), "blocks")
    alone = X.saved(spark, _labels(blocks.groupBy("group", "block"), percent), "labels")
    links = alone.select(F.col("doc_id").alias("u"), F.col("label").alias("v"))
    # The sets that stand for the classes of the blocks, searched together block-wise by another hash.
    heads = blocks.join(alone.select(F.col("label").alias("doc_id")).distinct(), "doc_id").withColumn(
        "block", F.pmod(F.xxhash64("block", F.lit(1)), F.greatest(F.lit(1), F.ceil(F.sqrt("blocks"))).cast("long")))
    between = _labels(heads.groupBy("group", "block"), percent)
    links = X.saved(spark, links.union(between.select("doc_id", "label")).where("u <> v"), "links")
    marked = _with_class(spark, blocks, links)
    # Outside the largest class of its group: against every block, where the class differs.
    biggest = marked.groupBy("group", "class").count().groupBy("group").agg(F.max(F.struct("count", "class"))["class"].alias("big"))
    # Written, so that both sides of the join below are tables of their own.
    outer = X.saved(spark, marked.join(biggest, "group").where("class <> big").drop("big"), "outer")
    spread = outer.select("group", "doc_id", "n", "grams", "class", F.col("block").alias("from_block"),
                          F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def across(key: tuple, here: pa.Table, there: pa.Table) -> pa.Table:
        pairs = []
        if here.num_rows and there.num_rows:
            ids, kinds = there.column("doc_id").to_numpy(), there.column("class").to_numpy()
            index = Index(there.column("n").to_numpy(), _grams(there.column("grams")), percent)
            seen = set()
            for d, n, grams, kind in zip(here.column("doc_id").to_pylist(), here.column("n").to_pylist(),
                                         _grams(here.column("grams")), here.column("class").to_pylist()):
                for row in index.search(grams, n):
                    if kinds[row] != kind and (kind, int(kinds[row])) not in seen:
                        seen.add((kind, int(kinds[row])))  # one link joins two classes
                        pairs.append((d, int(ids[row])))
        return pa.table({"u": pa.array([p[0] for p in pairs], pa.int64()), "v": pa.array([p[1] for p in pairs], pa.int64())})

    # A task holds one block and the outer sets of one block.
    froms = marked.select("group", "block", "doc_id", "n", "grams", "class", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("from_block"))
    froms = froms.join(outer.select("group", F.col("block").alias("from_block")).distinct(), ["group", "from_block"], "left_semi")
    froms = X.saved(spark, froms, "froms")
    keys = ["group", "block", "from_block"]
    crossing = froms.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(across, "u long, v long")
    final = connected(spark, links.union(crossing))
    return whole.select("doc_id", F.col("label").alias("component")).union(final.select(F.col("node").alias("doc_id"), "component"))


def _with_class(spark: SparkSession, blocks: DataFrame, links: DataFrame) -> DataFrame:
    known = connected(spark, links).select(F.col("node").alias("doc_id"), F.col("component").alias("class"))
    return X.saved(spark, blocks.join(known, "doc_id", "left").withColumn("class", F.coalesce("class", "doc_id")), "classes")


def similar_documents(spark: SparkSession, docs: DataFrame, gram: int = GRAM, percent: int = PERCENT,
                      id_col: str = "doc_id", text_col: str = "text", group_grams: int = GROUP_GRAMS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs.

    component_id is the least doc_id reachable by links of at least the similarity; documents
    without words link with nothing and are their own component. A null doc_id has a null component
    and links with nothing; repeated rows give as many rows, and of an id that stands for several texts
    each text is a document; other columns are not read.
    """
    def measure(batches):
        for batch in batches:
            sets, marks = gram_sets(batch.column(1).to_pylist(), gram)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in marks], pa.int64()),
                 pa.array([m[1] for m in marks], pa.int64())], ["doc_id", "n_shingles", "mark_a", "mark_b"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    measured = X.saved(spark, source.mapInArrow(measure, "doc_id long, n_shingles long, mark_a long, mark_b long"), "measured")
    known = X.saved(spark, classes_of(measured), "known")
    sets = X.saved(spark, search_sets(docs, known, gram, percent, id_col, text_col), "sets")
    found = link_groups(spark, sets, percent, group_grams)
    classes = known.join(found.select(F.col("doc_id").alias("node"), F.col("component").alias("label")), "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    # A label is the least node of its component, which need not be an id.
    odd = classes.where("node <> doc_id").select("label").distinct()
    least = classes.join(odd, "label", "left_semi").groupBy("label").agg(F.min("doc_id").alias("least"))
    classes = classes.join(least, "label", "left").select("mark_a", "mark_b", "n_shingles", F.coalesce("least", "label").alias("component"))
    return measured.join(classes, ["mark_a", "mark_b", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
