"""Benchmark decontamination by winnowing.

The least hash of ``k`` words in every window of ``window`` words is its fingerprint.  A document
window that equals an item window has the same fingerprint, so joining fingerprints finds every
shared span of ``window`` words; each hit is then extended to the windows around it, which are
compared word by word.  An item of fewer words is one window of its own length and is looked up at
that length.

Items of up to ``block_bytes`` of text are one index, broadcast, and documents need no shuffle.  More
items stay a table: tasks write their fingerprints and windows, and only a bitmap of ``2 ** bits`` bits of
the fingerprints is broadcast (16 MB).  Documents are scanned once with it; the windows around what it lets pass
are joined to the items' windows by hash and digest, and what joins goes back to the rows by doc_id and
digest of the text.  Both ways give the same rows.

A null or empty text has no words and is never contaminated; items without words match nothing;
repeated rows are judged row by row; a null doc_id stays null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Cut, Words, bitmap, grams, marked, mix, prepare, slices, utf8


def least(g: np.ndarray, w: int) -> np.ndarray:
    """The place of the least of each w neighbours (the last of equals)."""
    n = len(g) - w + 1
    place = np.arange(n)
    low = g[:n].copy()
    for j in range(1, w):
        x = g[j : j + n]
        take = x <= low
        low[take] = x[take]
        place[take] = np.flatnonzero(take) + j
    return place


class Index:
    """Fingerprints and distinct windows of some items, as flat arrays: about 40 bytes a window beside the text."""

    def __init__(self, items: list[tuple[str, str]], window: int, k: int):
        self.window, self.k = window, k
        self.names = [item for item, _ in items]
        texts, prints = [], []
        parts: dict[int, list[tuple[np.ndarray, ...]]] = {}  # length -> (hash, start, end, item) of windows
        at = 0
        for number, (_, text) in enumerate(items):
            raw = np.frombuffer((text or "").encode(), np.uint8)
            ws = Words(raw, np.array([0, len(raw)]))
            n = min(len(ws), window)
            if not n:
                continue
            words = ws.key(0, len(ws))
            texts.append(words)
            ends = at + np.cumsum(ws.end - ws.start + 1) - 1  # in the joined words
            starts = ends - (ws.end - ws.start)
            last = len(ws) - n + 1
            parts.setdefault(n, []).append((grams(ws.hash, n), starts[:last], ends[n - 1 :], np.full(last, number)))
            at += len(words) + 1
            if n == window:
                g = grams(ws.hash, k)
                prints.append(g[np.unique(least(g, window - k + 1))])
        self.words = b" ".join(texts)
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
        self.tables = {n: self._table([np.concatenate(x) for x in zip(*p, strict=True)]) for n, p in parts.items()}

    def _table(self, columns: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(hash, start, end) of each distinct window by hash, and its items' range in a last array."""
        h, start, end, item = columns
        order = np.lexsort((item, h))
        h, start, end, item = h[order], start[order], end[order], item[order].astype(np.int32)
        cut = np.ones(len(h) + 1, bool)
        cut[1:-1] = h[1:] != h[:-1]
        bounds = np.flatnonzero(cut)
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if e - s > 1:  # equal hashes are parted by their words, should they differ
                words = [self.words[start[i] : end[i]] for i in range(s, e)]
                if len(set(words)) > 1:
                    own = s + np.array(sorted(range(e - s), key=words.__getitem__))
                    start[s:e], end[s:e], item[s:e] = start[own], end[own], item[own]
                    words.sort()
                    cut[s + 1 : e] = [x != y for x, y in zip(words[1:], words, strict=False)]
        first = np.flatnonzero(cut)
        return h[first[:-1]], start[first[:-1]], end[first[:-1]], first, item

    def items(self, n: int, h: int, words: bytes) -> np.ndarray:
        """The numbers of the items with the window ``words`` of n words and hash ``h``."""
        hashes, start, end, first, item = self.tables[n]
        lo, hi = (int(np.searchsorted(hashes, np.uint64(h), side)) for side in ("left", "right"))
        for j in range(lo, hi):
            if self.words[start[j] : end[j]] == words:
                return item[first[j] : first[j + 1]]
        return item[:0]


def among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered) or not len(x):
        return np.zeros(len(x), bool)
    at = np.searchsorted(ordered, x)
    at[at == len(ordered)] = 0
    return ordered[at] == x


def found(ws: Words, index: Index) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first word, words, numbers of items) of each window that occurs."""
    doc = ws.doc()
    w, k = index.window, index.k
    for n, (hashes, *_) in index.tables.items():
        if len(ws) < n:
            continue
        if n == w:
            g = grams(ws.hash, k)
            chosen = np.unique(least(g, w - k + 1))
            hit = chosen[among(g[chosen], index.prints)]
            at = np.unique((hit[:, None] - np.arange(w - k + 1)).ravel())
            at = at[(at >= 0) & (at <= len(ws) - n)]
            at = at[doc[at] == doc[at + n - 1]]
            h = windows_at(ws, at, n)
        else:
            h = grams(ws.hash, n)
            at = np.flatnonzero(doc[: len(h)] == doc[n - 1 :])
            h = h[at]
        ok = among(h, hashes)
        for i, x in zip(at[ok].tolist(), h[ok].tolist(), strict=True):
            items = index.items(n, x, ws.key(i, n))
            if len(items):
                yield i, n, items


def one_index(items: DataFrame, block_bytes: int) -> bool:
    """Whether the items fit one broadcast index."""
    return (items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) <= block_bytes


def ordered(names: set[str | None]) -> list[str | None]:
    """Item ids as sorted strings, null last."""
    return sorted(names, key=lambda x: (x is None, x or ""))


def mapper(index, carry: bool = False):
    """Adds n_words, n_hit, hits (places of hit words) and items; with ``carry`` under names that start with _, and the text stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = utf8(b.column(b.schema.names.index("text")))
            out = {"n_words": [], "n_hit": [], "hits": [], "items": []}
            for lo, hi in slices(offs):
                ws = Words(data, offs[lo : hi + 1])
                hit = np.zeros(len(ws) + 1, np.int32)
                by: dict[int, set[int]] = {}
                doc = ws.doc()
                for i, n, got in found(ws, index.value):
                    hit[i] += 1
                    hit[i + n] -= 1
                    by.setdefault(int(doc[i]), set()).update(got.tolist())
                on = np.cumsum(hit[:-1]) > 0
                for d in range(hi - lo):
                    s, e = ws.first[d], ws.first[d + 1]
                    out["n_words"].append(int(e - s))
                    out["n_hit"].append(int(on[s:e].sum()) if d in by else 0)
                    out["hits"].append(np.flatnonzero(on[s:e]).astype("<i8").tobytes() if d in by else b"")
                    out["items"].append(ordered({index.value.names[j] for j in by.get(d, ())}))
            types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string())]
            cols = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            names = [c for c in b.schema.names if carry or c != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *cols], [*names, *(f"_{c}" if carry else c for c in out)])
    return run


def _fields(names: list[str]) -> list[T.StructField]:
    kinds = {"n_words": T.LongType(), "n_hit": T.LongType(), "hits": T.BinaryType(), "items": T.ArrayType(T.StringType())}
    return [T.StructField(n, kinds[n.lstrip("_")]) for n in names]


# ---------------------------------------------------------------- more items than one index holds
WINDOW = "n int, h long, w binary"  # words, hash, digest


def digests(ws: Words, at: np.ndarray, n: int) -> list[bytes]:
    return [hashlib.md5(ws.key(i, n), usedforsecurity=False).digest() for i in at.tolist()]


def windows_at(ws: Words, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of n words from the places ``at``."""
    h = ws.hash[at].copy()
    for j in range(1, n):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += ws.hash[at + j]
    return mix(h + np.uint64(n))


def _item_windows(window: int, k: int):
    """item, windows (with the fingerprints of each window's length, as f) of a task's items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = utf8(b.column("text"))
            for row in range(b.num_rows):
                ws = Words(data, offs[row : row + 2])
                n = min(len(ws), window)
                if not n:
                    continue
                at = np.arange(len(ws) - n + 1)
                h = windows_at(ws, at, n)
                prints = grams(ws.hash, k)[least(grams(ws.hash, k), window - k + 1)] if n == window else h
                item = b.column("item_id").slice(row, 1).take(pa.array(np.zeros(len(at), np.int64)))
                yield pa.RecordBatch.from_arrays([item, pa.array(np.full(len(at), n, np.int32)), pa.array(h.view(np.int64)), pa.array(digests(ws, at, n), pa.binary()), pa.array(prints.view(np.int64))], ["item_id", "n", "h", "w", "f"])

    return run


def _candidates(shared, window: int, k: int, bits: int):
    """Adds _n_words and _candidates (at, n, h, w): windows whose fingerprint the bitmap has."""
    kind = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int32()), ("h", pa.int64()), ("w", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, raw = shared.value
        known = lambda h: marked(raw, h, bits)
        for b in batches:
            data, offs = utf8(b.column(b.schema.names.index("text")))
            n_words, out = [], []
            for lo, hi in slices(offs):
                ws = Words(data, offs[lo : hi + 1])
                doc = ws.doc()
                got: list[list[dict]] = [[] for _ in range(hi - lo)]
                for n in lengths:
                    if len(ws) < n:
                        continue
                    if n == window:
                        g = grams(ws.hash, k)
                        chosen = np.unique(least(g, n - k + 1))
                        hit = chosen[known(g[chosen])]
                        at = np.unique((hit[:, None] - np.arange(n - k + 1)).ravel())
                        at = at[(at >= 0) & (at <= len(ws) - n)]
                        at = at[doc[at] == doc[at + n - 1]]
                        h = windows_at(ws, at, n)
                    else:
                        at = np.flatnonzero(doc[: len(ws) - n + 1] == doc[n - 1 :])
                        h = windows_at(ws, at, n)
                        at, h = at[known(h)], h[known(h)]
                    for i, x, w in zip(at.tolist(), h.view(np.int64).tolist(), digests(ws, at, n), strict=True):
                        got[doc[i]].append({"at": i - int(ws.first[doc[i]]), "n": n, "h": x, "w": w})
                n_words += np.diff(ws.first).tolist()
                out += got
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n_words, pa.int64()), pa.array(out, kind)], [*b.schema.names, "_n_words", "_candidates"])

    return run


class Fingerprints:
    """The items as tables, for any number of items."""

    def __init__(self, items: DataFrame, window: int, k: int, bits: int, cut: Cut):
        self.window, self.k, self.bits, self.cut = window, k, bits, cut
        every = cut(items.mapInArrow(_item_windows(window, k), f"item_id string, {WINDOW}, f long"))
        self.windows = every.select("item_id", "n", "h", "w").distinct()
        lengths = sorted(r["n"] for r in every.select("n").distinct().collect())  # at most ``window``
        self.shared = items.sparkSession.sparkContext.broadcast((lengths, bitmap(every.select("f"), bits)))

    def scanned(self, docs: DataFrame) -> DataFrame:
        """``docs`` with _n_words and _candidates."""
        more = [T.StructField("_n_words", T.LongType()), T.StructField("_candidates", T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("h", T.LongType()), T.StructField("w", T.BinaryType())])))]
        return docs.mapInArrow(_candidates(self.shared, self.window, self.k, self.bits), T.StructType([*docs.schema.fields, *more]))

    def hits(self, found: DataFrame) -> DataFrame:
        """_t, at, n, item_id: each text (by its digest, once) and item with a window of it."""
        each = found.select("_t", "_candidates").dropDuplicates(["_t"]).select("_t", F.explode("_candidates").alias("c")).select("_t", "c.*")
        return each.join(self.windows, ["n", "h", "w"])


def _digest() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 5, block_bytes: int = 8 << 20, bits: int = 27) -> DataFrame:
    """The rows of ``docs`` in which no item window occurs."""
    spark = prepare(docs.sparkSession)
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    if one_index(items, block_bytes):
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in items.collect()], window, k))
        fields = _fields(["_n_words", "_n_hit", "_hits", "_items"])
        return docs.mapInArrow(mapper(index, True), T.StructType([*docs.schema.fields, *fields])).where("_n_hit = 0").select(*docs.columns)
    tables = Fingerprints(items, window, k, bits, Cut(spark))
    scanned = tables.scanned(docs)
    some = scanned.where(F.size("_candidates") > 0).withColumn("_t", _digest())
    bad = tables.hits(some).select("_t").distinct()
    return scanned.where(F.size("_candidates") == 0).select(*docs.columns).unionByName(some.join(bad, "_t", "left_anti").select(*docs.columns))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 5, block_bytes: int = 8 << 20, bits: int = 27) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row for each input row.

    ``items_sha256`` is of the item_ids that occur, sorted as strings and joined by commas.  Items with a
    null item_id are searched like any other; together they add 1 to ``n_items`` and nothing to the hashed ids.
    """
    spark = prepare(docs.sparkSession)
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names, n_items = F.array_join("items", ","), F.size("items").cast("long")
    if one_index(items, block_bytes):
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in items.collect()], window, k))
        out = docs.mapInArrow(mapper(index), "doc_id long, n_words long, n_hit long, hits binary, items array<string>")
        return out.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
    cut = Cut(spark)
    tables = Fingerprints(items, window, k, bits, cut)
    scanned = cut(tables.scanned(docs).withColumn("_t", _digest()).drop("text"))
    hits = cut(tables.hits(scanned.where(F.size("_candidates") > 0)))
    places = hits.select("_t", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("place")).distinct().groupBy("_t").agg(F.count("*").alias("n_hit"))
    by = hits.select("_t", "item_id").distinct().groupBy("_t").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("names"))
    known = cut(places.join(by, "_t"))
    out = scanned.select("doc_id", "_t", F.col("_n_words").alias("n_words")).join(known, "_t", "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", count("n_hit").alias("n_hit"), count("n_items").alias("n_items"), F.sha2(F.coalesce("names", F.lit("")).cast("binary"), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
