"""N-gram Jaccard self-join by a MinHash LSH forest, then exact comparison.

Texts are sets of hashed ``k``-word shingles (a text of 1 to k - 1 words is one shingle).  Equal sets
are first reduced to one with a count.  A set's signature has ``depth`` values in each of ``trees``
prefix tries.  The forest works on the sorted tries:

1. Each tree's labels are sorted over all tasks, so a prefix is a run of neighbours.  The runs' lengths
   are what it would cost a set to look at its neighbours at each prefix length.
2. A set starts with its full labels and shortens the prefix of one tree after another, the one that
   adds the fewest candidates for its gain first, until a pair at the threshold is met in some tree
   with a chance of the target recall.  A prefix that no other set has is shortened for nothing.
3. A set asks in the trie nodes that it ended at, and stands in those above, where sets with a shorter
   prefix ask.  Nodes in which none asks are skipped.

Sets that meet in a trie node are first linked where their signatures agree by ``near`` or more (0.58
is over 4 standard deviations of a 64-value signature below a pair at the threshold); the
components of these links are clusters.  A node of over ``per_node`` sets is split into hash blocks
whose pairs are read by different tasks, so no task holds a whole hot node and no pair is lost.
Clusters are split in the same way, and each pair of their blocks is compared exactly as a product
of 0/1 matrices; only counts and spanning stars leave a task, never all pairs.

Null and empty texts have no shingles and link with nothing, not even each other.  Repeated rows are
texts of their own, and so are rows that share a doc_id.  A null doc_id stays null; a class is named
by its least doc_id that is not null (null if it has none), and doc_ids only name rows and classes:
each distinct set has a number of its own, by which blocks, links and classes are kept.  Extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Cut, Words, bitmap, block_pairs, components, grams, marked, mix, paired, partitions, prepare, runs, slices, stars, utf8

BROADCAST_NODES = 200_000
NAME_BITS = 26  # 8 MB
ROW = ["nul", "doc", "t"]  # what names a row: no doc_id, doc_id (0 if null), digest of its text


def prefix_depth(trees: int, depth: int, threshold: float, recall: float) -> int:
    """The longest prefix at which, used in every tree, a pair at the threshold meets often enough: no set needs a shorter one."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(ws: Words, k: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles, sorted."""
    g = grams(ws.hash, k)
    for s, e in zip(ws.first[:-1].tolist(), ws.first[1:].tolist(), strict=True):
        if e - s >= k:
            yield np.unique(g[s : e - k + 1])
        elif e > s:
            yield grams(ws.hash[s:e], e - s)
        else:
            yield np.zeros(0, np.uint64)


def digest(s: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64).tolist())


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """n MinHash values of each set; sets must not be empty."""
    x = np.concatenate(sets)
    low = (x & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (x >> np.uint64(32)).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), n), np.uint32)
    salts = mix(np.arange(1, 2 * n + 1, dtype=np.uint64))
    for j in range(n):
        y = low * np.uint32(salts[2 * j] & np.uint64(0xFFFFFFFE) | np.uint64(1)) + high * np.uint32(salts[2 * j + 1] & np.uint64(0xFFFFFFFE) | np.uint64(1))
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        out[:, j] = np.minimum.reduceat(y, at)
    return out


def _measure(k: int, trees: int, depth: int):
    """Of each text with words: digest and size of its set, and its signature, tree by tree, most significant byte first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = utf8(b.column("text"))
            for lo, hi in slices(offs):
                sets = list(shingle_sets(Words(data, offs[lo : hi + 1]), k))
                full = [i for i, s in enumerate(sets) if len(s)]
                if not full:
                    continue
                sig = signatures([sets[i] for i in full], trees * depth)
                own = b.slice(lo, hi - lo).take(pa.array(full))
                d = [digest(sets[i]) for i in full]
                sketch = (sig >> np.uint32(7)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    *(own.column(c) for c in ROW), pa.array([x[0] for x in d], pa.int64()), pa.array([x[1] for x in d], pa.int64()), pa.array([len(sets[i]) for i in full], pa.int64()),
                    pa.array([x.tobytes() for x in sig.astype(">u4")], pa.binary()), pa.array([x.tobytes() for x in sketch], pa.binary()),
                ], [*ROW, "d1", "d2", "size", "sig", "sketch"])

    return run


# ---------------------------------------------------------------- the forest
def run_lengths(same: np.ndarray) -> np.ndarray:
    """For each of the sorted rows, how many stand in its run; ``same`` says whether a row continues the one before."""
    at = np.cumsum(~same) - 1
    return np.bincount(at, minlength=1)[at] if len(at) else at


def _tries(low: int, depth: int):
    """Of a task's share of the sorted labels: id, tree, label and run lengths at each prefix length from ``low`` on, where some other set may have the prefix.

    A run at the share's border may go on in another task, so it counts as one longer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).combine_chunks()
        tree, label = t["tree"].to_numpy(), utf8(t["label"])[0].reshape(-1, 4 * depth)
        n = len(tree)
        counts = np.empty((n, depth - low + 1), np.int64)
        for d in range(low, depth + 1):
            same = np.zeros(n, bool)
            same[1:] = (tree[1:] == tree[:-1]) & (label[1:, : 4 * d] == label[:-1, : 4 * d]).all(1)
            counts[:, d - low] = run_lengths(same)
            border = np.cumsum(~same)
            counts[(border == 1) | (border == border[-1]), d - low] += 1
        met = np.flatnonzero(counts[:, 0] > 1)
        for lo in range(0, len(met), 10_000):
            m = met[lo : lo + 10_000]
            own = t.select(["id", "tree", "label"]).take(pa.array(m)).combine_chunks()
            yield pa.RecordBatch.from_arrays([*(own[c].chunk(0) for c in own.column_names), pa.array(counts[m].tolist(), pa.list_(pa.int64()))], [*own.column_names, "counts"])

    return run


def shorten(counts: np.ndarray, low: int, threshold: float, recall: float) -> np.ndarray:
    """The prefix length of each set (row) in each tree (column); ``counts`` has the run lengths at low, low + 1, ... (1: no other set).

    The cheapest gain is taken first: candidates added over what the chance of not meeting falls by.
    """
    n, trees, levels = counts.shape
    gain = np.array([-math.log1p(-(threshold**d)) for d in range(low, low + levels)])
    at = np.full((n, trees), levels - 1)
    need = -math.log1p(-recall)
    todo = np.arange(n)
    while len(todo):
        here = at[todo]
        todo = todo[(gain[here].sum(1) < need - 1e-12) & (here > 0).any(1)]
        here = at[todo]
        up = np.maximum(here - 1, 0)
        pick = lambda x, of=counts[todo]: np.take_along_axis(of, x[:, :, None], 2)[:, :, 0]
        cost = np.where(here > 0, (pick(up) - pick(here)) / np.maximum(gain[up] - gain[here], 1e-12), np.inf)
        if len(todo):
            at[todo, cost.argmin(1)] -= 1
    return at + low


def node_keys(tree: np.ndarray, label: np.ndarray) -> np.ndarray:
    """A number for the trie node of each prefix (columns) of labels (rows of values)."""
    keys = np.empty(label.shape, np.uint64)
    at = mix(tree.astype(np.uint64) + np.uint64(1))
    for d in range(label.shape[1]):
        at = mix(at * np.uint64(0x9E3779B97F4A7C15) + label[:, d].astype(np.uint64) + np.uint64(d + 1))
        keys[:, d] = at
    return keys


def _shortened(trees: int, low: int, depth: int, threshold: float, recall: float):
    """Each set's nodes: the one in each tree that its prefix ended at, where it asks, and those above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = depth - low + 1
        for b in batches:
            met = b.column("met")
            row = np.repeat(np.arange(b.num_rows), met.value_lengths().to_numpy(zero_copy_only=False))
            flat = met.flatten()
            tree, own = flat.field("tree").to_numpy(zero_copy_only=False), flat.field("counts").flatten().to_numpy(zero_copy_only=False).reshape(-1, levels)
            counts = np.ones((b.num_rows, trees, levels), np.int64)
            counts[row, tree] = own
            ends = shorten(counts, low, threshold, recall)[row, tree]
            keys = node_keys(tree, utf8(flat.field("label"))[0].view(">u4").reshape(-1, depth)) if len(tree) else np.zeros((0, depth), np.uint64)
            for d in range(low, depth + 1):
                here = np.flatnonzero((ends >= d) & (own[:, d - low] > 1))  # no other set has the prefix: none to meet
                yield pa.RecordBatch.from_arrays([pa.array(keys[here, d - 1].view(np.int64)), b.column("id").take(pa.array(row[here])), pa.array(ends[here] == d)], ["key", "id", "asks"])

    return run


def forest(one: DataFrame, trees: int, depth: int, threshold: float, recall: float) -> DataFrame:
    """key, id, sketch, asks: the sets of each trie node, at the prefix they ended at (``asks``) and at those above it."""
    low = prefix_depth(trees, depth, threshold, recall)
    leaves = one.select("id", F.posexplode(F.array(*[F.substring("sig", 4 * depth * t + 1, 4 * depth) for t in range(trees)])).alias("tree", "label"))
    ordered = ["tree", "label", "id"]
    laid = leaves.repartitionByRange(partitions(one.sparkSession), *ordered).sortWithinPartitions(*ordered)
    met = laid.mapInArrow(_tries(low, depth), "id long, tree int, label binary, counts array<long>")
    met = met.groupBy("id").agg(F.collect_list(F.struct("tree", "label", "counts")).alias("met"))  # at most one row for each tree
    return met.mapInArrow(_shortened(trees, low, depth, threshold, recall), "key long, id long, asks boolean").join(one.select("id", "sketch"), "id")


def linked(sketch: np.ndarray, least: float) -> np.ndarray:
    """Each text's component, over pairs whose signatures agree by ``least`` or more.

    A pass of leaders links most of a group at once; then only texts outside the largest component
    are compared with those of other components, so a hot group costs its outliers times its size.
    """
    n, width = sketch.shape
    label = np.arange(n)
    need = int(np.ceil(least * width))

    def join(i: int, hits: np.ndarray) -> None:
        found = np.unique(np.r_[label[i], label[hits]])
        if len(found) > 1:
            label[np.isin(label, found[1:])] = found[0]

    rest = np.arange(n)
    while len(rest):
        near = (sketch == sketch[rest[0]]).sum(1) >= need
        join(rest[0], np.flatnonzero(near))
        rest = rest[1:][~near[rest[1:]]]
    names, sizes = np.unique(label, return_counts=True)
    if len(names) > 1:
        for i in np.flatnonzero(label != names[sizes.argmax()]):
            other = np.flatnonzero(label != label[i])
            join(i, other[(sketch[other] == sketch[i]).sum(1) >= need])
    return label


def _nodes(least: float):
    """Links of the texts of each trie node, a star for each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            x = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *out], 1), axis=1)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in x], ["a", "b"])

        for group in runs(batches, ["key", "bi", "bj"]):
            if group.num_rows < 2 or not any(group["asks"].to_pylist()):
                continue
            ids = group["id"].to_numpy()
            sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(len(ids), -1)
            star = linked(sketch, least)
            moved = np.flatnonzero(star != np.arange(len(ids)))
            if len(moved):
                out.append(np.stack([ids[moved], ids[star[moved]]]))
                held += len(moved)
            if len(out) > 20_000 or held > 200_000:  # by groups and by links, so that memory is bounded
                held = 0
                yield flush()
        yield flush()

    return run


def node_blocks(nodes: DataFrame, per_node: int, cut: Cut) -> DataFrame:
    """The texts of each trie node, once per block pair; a node of up to ``per_node`` texts is one block."""
    hot = nodes.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > per_node)
    hot = cut(hot.select("key", F.ceil(F.col("n") / per_node).alias("_nb")))
    if hot.count() <= BROADCAST_NODES:  # a checked size; else Spark chooses
        hot = F.broadcast(hot)
    return paired(nodes.join(hot, "key", "left").withColumn("_nb", F.coalesce("_nb", F.lit(1).cast("long"))), "id")


def _sets(k: int, bits: int, wanted):
    """The shingles of the rows whose name is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(marked(wanted.value, b.column("name").to_numpy().view(np.uint64), bits)))
            data, offs = utf8(b.column("text"))
            for lo, hi in slices(offs):
                sets = list(shingle_sets(Words(data, offs[lo : hi + 1]), k))
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(lo, hi - lo) for c in ROW), pa.array([s.tobytes() for s in sets], pa.binary())], [*ROW, "shingles"])

    return run


def overlap(sets: list[np.ndarray], budget: int = 2 << 20) -> np.ndarray:
    """Sizes of all intersections: a product of 0/1 matrices over the shared shingles."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    kept = count[at] > 1
    owner, at = owner[kept], column[at[kept]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((n, n), np.float32)
    width = max(64, budget // n)
    for c in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        s, e = np.searchsorted(at, [c, c + width])
        m = np.zeros((n, min(width, int(at[-1]) + 1 - c)), np.float32)
        m[owner[s:e], at[s:e] - c] = 1
        out += m @ m.T
    return out


def compare(group: pa.Table, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, copies, link matrix) of a block pair, by exact Jaccard >= num / den."""
    ids, first = np.unique(group["id"].to_numpy(), return_index=True)
    group = group.take(pa.array(first))
    copies, blk = group["copies"].to_numpy(), group["blk"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group["shingles"].to_pylist()]
    both = overlap(sets)
    size = np.array([len(s) for s in sets], np.float64)
    link = np.empty(both.shape, bool)
    for i in range(0, len(sets), 128):  # in double precision, a few rows at a time
        link[i : i + 128] = (den + num) * both[i : i + 128].astype(np.float64) >= num * (size[i : i + 128, None] + size[None, :])
    np.fill_diagonal(link, False)
    if group["bi"][0].as_py() != group["bj"][0].as_py():
        link &= blk[:, None] != blk[None, :]
    return ids, copies, link


def _within(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["cluster", "bi", "bj"]):
            if group.num_rows < 2:
                continue
            ids, copies, link = compare(group, num, den)
            added = link @ copies
            own = np.flatnonzero(added)
            if len(own):
                root = ids[stars(link)]
                yield pa.RecordBatch.from_arrays([pa.array(x[own], pa.int64()) for x in (ids, added, root)], ["id", "added", "root"])

    return run


def _known(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (4, 5), trees: int = 16, depth: int = 4, recall: float = 0.9999, near: float = 0.58, per_block: int = 512, block_shingles: int = 150_000, per_node: int = 8192) -> tuple[DataFrame, DataFrame]:
    """Rows with shingles (nul, doc, t, d1, d2), and each distinct set: d1, d2, n_links of its rows and its class's own row (nul, doc, t)."""
    spark = prepare(docs.sparkSession)
    cut = Cut(spark)
    num, den = threshold
    texts = docs.select(*[x.alias(c) for c, x in _names().items()], "text")
    rows = cut(texts.mapInArrow(_measure(k, trees, depth), "nul boolean, doc long, t binary, d1 long, d2 long, size long, sig binary, sketch binary"))
    one = rows.groupBy("d1", "d2").agg(F.min(F.struct(*ROW)).alias("own"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch"))
    one = cut(one.withColumn("id", F.monotonically_increasing_id()))  # written, so the numbers are fixed
    node = ["key", "bi", "bj"]
    nodes = node_blocks(cut(forest(one, trees, depth, num / den, recall)), per_node, cut)
    nodes = nodes.repartition(partitions(spark), *node).sortWithinPartitions(*node, "sketch", "id")
    cluster = components(nodes.mapInArrow(_nodes(near), "a long, b long"))
    members = cut(cluster.select(F.col("root").alias("cluster"), "id").join(one.select("id", "own.*", "copies", "size"), "id"))
    # only the members' own texts are shingled again and moved; a bitmap of their names picks them where they are read
    wanted = spark.sparkContext.broadcast(bitmap(members.select(F.xxhash64(*ROW)), NAME_BITS))
    sets = texts.withColumn("name", F.xxhash64(*ROW)).mapInArrow(_sets(k, NAME_BITS, wanted), "nul boolean, doc long, t binary, shingles binary")
    sets = sets.groupBy(*ROW).agg(F.first("shingles").alias("shingles"))  # a row that repeats
    sets = cut(sets.join(members.select("id", *ROW), ROW).select("id", "shingles"))
    met = block_pairs(members.select("cluster", "id", "copies", "size"), ["cluster"], "id", per_block, "size", block_shingles).drop("size").join(sets, "id")
    keys = ["cluster", "bi", "bj"]
    met = met.repartition(partitions(spark), *keys).sortWithinPartitions(*keys)
    found = cut(met.mapInArrow(_within(num, den), "id long, added long, root long"))
    links = found.groupBy("id").agg(F.sum("added").alias("added"))
    classes = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    first = classes.join(one.select("id", "own"), "id").groupBy("root").agg(F.min("own").alias("first"))
    known = one.select("d1", "d2", "id", "own", "copies").join(links, "id", "left").join(classes, "id", "left").join(first, "root", "left")
    return rows.select(*ROW, "d1", "d2"), known.select("d1", "d2", (F.col("copies") - 1 + F.coalesce("added", F.lit(0))).alias("n_links"), F.coalesce("first", "own").alias("own"))


def _names() -> dict[str, Column]:
    """What names a row; the digest is of its whole text."""
    return dict(zip(ROW, (F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.unhex(F.md5(F.col("text").cast("binary")))), strict=True))


def _bare() -> Column:
    """Whether a text has no words."""
    return ~F.coalesce("text", F.lit("")).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def ngram_join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links, kept: one row for each input row; the options are those of ``_known``.

    ``threshold`` is a fraction; ``class_id`` is the least doc_id reachable by links, itself included;
    ``n_links`` counts the other rows linked directly; ``kept`` marks the rows of the class that have its
    class_id as doc_id (one row, unless doc_ids repeat in a class).
    """
    rows, known = _known(docs, **options)
    id_ = lambda nul, doc: F.when(~F.col(nul), F.col(doc))
    full = rows.join(known, ["d1", "d2"]).select(id_("nul", "doc").alias("doc_id"), id_("own.nul", "own.doc").alias("class_id"), "n_links")
    own = F.col("doc_id").cast("long")
    bare = docs.where(_bare()).select(own.alias("doc_id"), own.alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each class, of the least doc_id in it, and every row without words."""
    names = [f"_{c}" for c in ROW]
    kept = _known(docs, **options)[1].select(*[F.col(f"own.{c}").alias(f"_{c}") for c in ROW]).distinct()
    own = docs.withColumns({f"_{c}": x for c, x in _names().items()}).join(kept, names, "left_semi").dropDuplicates(names)
    return own.select(*docs.columns).unionByName(docs.where(_bare()))
