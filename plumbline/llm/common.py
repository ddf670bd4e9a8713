"""What the operators share: tables, checkpoints, Arrow batches, word hashing, components.

Word rule: A-Z is lowered and words are maximal runs of the bytes 0-9, a-z and >= 0x80,
which on UTF-8 equals ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  All kernels work on whole
texts; a null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Cut, partitions, ready, shared_folder  # noqa: F401  partitions: for the operators

#: Settings of Arrow batches: Spark's default, and what is set instead.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}
#: The largest arrays are mapped and freed one by one, not kept in a worker's heap.
WORKER_MEMORY = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": str(16 << 20), "MALLOC_TRIM_THRESHOLD_": str(32 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}
SLICE_BYTES = 1 << 19  # of text that a kernel holds at once; one longer text is held alone


# ---------------------------------------------------------------- Spark helpers
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Python workers find this package and give memory back; the folder for cut tables is known.

    Arrow batches of 10,000 rows or 64 MB, Spark's defaults, would hold that many whole texts at once, on
    both sides of the pipe; unless the session sets others, 1000 rows or 8 MB (or one longer text) are sent
    at a time.
    """
    ready(spark)
    for name, (default, own) in BATCHES.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, own)
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    shared_folder(spark)
    return spark


def fold(key: str, by: int) -> Column:
    """The remainder that splits labelled rows into learning and held-out ones."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(by)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` learning rows of each label, least hash first: (text, y).

    The bound is a parameter and the order is by a hash of doc_id, so the sample is the same at
    any partitioning.  Labels that are null or disagree for one doc_id are left out.  Repeated rows of
    one doc_id give one row, the least of their texts, so the bound holds whatever repeats.
    """
    clean = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & keep)
        .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("y2")).where("y = y2")
        .select("doc_id", "y", F.xxhash64("doc_id").alias("o"))
    )
    few = None
    for y in (0, 1):
        part = clean.where(F.col("y") == y).orderBy("o", "doc_id").limit(per_class)
        few = part if few is None else few.unionByName(part)
    # 2 * per_class pairs of numbers: a proven bound, so this side is broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(few.select("doc_id", "y")), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")


# ---------------------------------------------------------------- Arrow helpers
def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    binary = pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type)
    col = col.cast(pa.large_binary() if binary else pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, b"" if binary else "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offs


def binaries(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or one row."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that share ``keys``, from batches sorted by them; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.zeros(b.num_rows, bool)
        cut[0] = last is not None and last != tuple(c[0] for c in cols)
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        at = 0
        for p in np.flatnonzero(cut):
            if p > at:
                held.append(b.slice(at, p - at))
            if held:
                yield pa.Table.from_batches(held)
            held, at = [], int(p)
        held.append(b.slice(at))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


# ---------------------------------------------------------------- hashing
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i below n."""
    if len(_POW["up"]) < n:
        m = max(n, SLICE_BYTES + 1)
        for k, b in (("up", BASE), ("down", BASE_INV)):
            x = np.full(m, b, np.uint64)
            x[0] = 1
            _POW[k] = np.cumprod(x, dtype=np.uint64)
    return _POW["up"][:n], _POW["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of several texts: byte ranges, hash and the first word of each text."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data = data = LOWER[data[offs[0] : offs[-1]]]
        self.offs = offs = offs - offs[0]
        n = len(data)
        is_word = WORD[data]
        inner = offs[1:-1]
        before = np.zeros(n, bool)
        before[1:] = is_word[:-1]
        before[inner[inner < n]] = False
        after = np.zeros(n, bool)
        after[:-1] = is_word[1:]
        after[inner[inner > 0] - 1] = False
        self.start = np.flatnonzero(is_word & ~before)
        self.end = np.flatnonzero(is_word & ~after) + 1
        self.first = np.searchsorted(self.start, offs)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n)[0], out=self.sums[1:])
        self.hash = self.spans(self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges; equal bytes have equal hashes wherever they stand."""
        if not len(start):
            return np.zeros(0, np.uint64)
        return mix((self.sums[end] - self.sums[start]) * powers(len(self.data) + 1)[1][start])

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.first))

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def key(self, i: int, n: int) -> bytes:
        return b" ".join(self.text(j) for j in range(i, i + n))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive words, from each word with k - 1 after it (text borders ignored)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= BASE
        out += h[j : j + n]
    return mix(out + np.uint64(k))


# ---------------------------------------------------------------- bitmaps
def _marks(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((1 << bits) // 8, np.uint8)
        for b in batches:
            bit = b.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            np.bitwise_or.at(own, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([own.tobytes()], pa.binary())], ["bits"])

    return run


def bitmap(hashes: DataFrame, bits: int) -> bytes:
    """2 ** bits bits, of which each 64-bit hash (one column) sets one: two tasks make a map each and the driver joins them, whatever their number."""
    whole = np.zeros((1 << bits) // 8, np.uint8)
    for x in hashes.repartition(2).mapInArrow(_marks(bits), "bits binary").toArrow()["bits"].to_pylist():
        whole |= np.frombuffer(x, np.uint8)
    return whole.tobytes()


def marked(raw: bytes, h: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes a bitmap may hold: all that it was made of, and a few more."""
    held = np.frombuffer(raw, np.uint8)
    return (held[(h >> np.uint64(67 - bits)).astype(np.int64)] >> ((h >> np.uint64(64 - bits)) & np.uint64(7)).astype(np.uint8)) & 1 > 0


# ---------------------------------------------------------------- components
def _forest(batches: Iterator[pa.RecordBatch], most: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Each task's links reduced to a star per component that it sees; after ``most`` ids it starts anew."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def flush() -> pa.RecordBatch:
        got = [(x, find(x)) for x in list(parent)]
        got = [(x, r) for x, r in got if x != r]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)], ["a", "b"])

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
        if len(parent) > most:  # memory stays bounded
            yield flush()
    yield flush()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, root) of all ids in links that one task may hold."""
    for b in _forest(batches, 1 << 62):
        a, r = (b.column(i).to_numpy() for i in (0, 1))
        ids = np.concatenate([a, np.unique(r)])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate([r, np.unique(r)]))], ["id", "root"])


def components(edges: DataFrame, few: int = 100_000) -> DataFrame:
    """(id, root): the smallest id reachable over ``edges`` (a, b), for every id in an edge that is no loop.

    Tasks first shrink what they see to stars.  While more than ``few`` links are left, the graph is
    contracted: each id takes the name of the least in its neighbourhood by an order drawn anew each
    round, so the ids fall by a third a round on average whatever their order (a path too), and there
    is no limit of rounds.  Once at most ``few`` links are left, one task settles them.  The names are
    then followed back, and each component gets its least id.

    Least names are aggregated before their shuffle.  Each join stands between two written tables, so
    that Spark can split a hot name's partition and estimates sizes from files.
    """
    cut = Cut(edges.sparkSession)
    e = cut(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(_forest, "a long, b long"))
    names: list[DataFrame] = []
    while e.count() > few:
        drawn = lambda c, k=len(names): F.struct(F.xxhash64(c, F.lit(k)).alias("o"), F.col(c).alias("id"))
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        name = cut(both.groupBy("a").agg(F.min(drawn("b")).alias("m")).select(F.col("a").alias("id"), F.least(drawn("a"), "m")["id"].alias("name")))
        names.append(name)
        for c in ("a", "b"):
            e = cut(e.join(name.withColumnRenamed("id", c), c).drop(c).withColumnRenamed("name", c))
        e = cut(e.select("a", "b").where("a <> b").mapInArrow(_forest, "a long, b long").distinct())
    root = cut(e.coalesce(1).mapInArrow(_settle, "id long, root long"))
    for name in reversed(names):
        known = root.select(F.col("id").alias("name"), "root")
        root = cut(name.join(known, "name", "left").select("id", F.coalesce("root", "name").alias("root")))
    if names:
        least = cut(root.groupBy("root").agg(F.min("id").alias("least")))
        root = cut(root.join(least, "root").select("id", F.col("least").alias("root")))
    cut.drop(keep=1)
    return root


# ---------------------------------------------------------------- blocks of pairs
def block_pairs(members: DataFrame, keys: list[str], id_col: str, per_block: int, weight: str | None = None, per_weight: int = 1) -> DataFrame:
    """Each member once per block pair (bi <= bj) of its group that holds its block ``blk``.

    A group of n members has ceil(n / per_block) hash blocks, or more if they hold over
    ``per_weight`` of ``weight`` each, so every task compares at most two blocks, and a hot group's
    work is spread over its block pairs instead of one task.
    """
    blocks = F.count("*") / per_block
    if weight:
        blocks = F.greatest(blocks, F.least(F.sum(weight) / per_weight, F.count("*").cast("double")))
    counts = members.groupBy(*keys).agg(F.ceil(blocks).alias("_nb"))
    return paired(members.join(counts, keys), id_col)


def paired(members: DataFrame, id_col: str) -> DataFrame:
    """Rows once per block pair (bi <= bj) that holds their block ``blk``, of ``_nb`` blocks by a hash of the id."""
    m = members.withColumn("blk", F.pmod(F.xxhash64(id_col, F.lit("block")), F.col("_nb")))
    m = m.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1)))
    return m.withColumns({"bi": F.least("blk", "_other"), "bj": F.greatest("blk", "_other")}).drop("_nb", "_other")


def stars(link: np.ndarray) -> np.ndarray:
    """The least index reachable from each index over a symmetric boolean matrix."""
    n = len(link)
    label = np.arange(n)
    todo = np.ones(n, bool)
    while todo.any():
        seed = int(np.flatnonzero(todo)[0])
        seen = np.zeros(n, bool)
        front = np.zeros(n, bool)
        front[seed] = True
        while front.any():
            seen |= front
            front = link[front].any(0) & ~seen
        label[seen] = seed
        todo &= ~seen
    return label
