"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

Every byte covered by a ``span``-byte string that also starts in a document with a smaller doc_id is
removed.  The steps:

1. Chunks of documents find anchors: the least 24-byte hash in each string, so equal strings have
   equal anchors.  Sorted anchor hashes go to hash buckets, which answer each chunk with one bit per
   hash: does another document have it?  Strings without such an anchor cannot repeat.
2. For the others a chunk sends each distinct context of an anchor (the strings that have it, as one
   run of bytes) once, with its least doc_id.  Contexts of one anchor meet in one bucket; an anchor in
   more than ``hot_chunks`` chunks or with more than ``hot_contexts`` contexts sends its strings one by
   one, dealt by their own hash, so that no bucket takes in all contexts of a hot line.
3. A bucket builds BWTs of shards of its distinct contexts, a part of its anchors at a time, and merges
   them by interleave refinement; the intervals with a common prefix of ``span`` bytes are the repeated
   strings, and each one's least doc_id goes back to the chunks, which remove what is covered.

Every chunk sends to every bucket, so both grow with the root of the input: the messages then grow in
proportion to it.  They hold 2 to 32 MB of text (but for one longer document).  Documents are shuffled
once and that exchange is used by all steps.  A null or empty text has no strings; a null doc_id counts as -1; documents with one doc_id
do not remove each other's strings; repeated rows give repeated rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import anchored
from .bwt import gather, merge, ranges, transforms
from .common import mix, powers, prepare, slices, utf8
from .decontaminate import among

CHUNK, MOST, HASHES = 2 << 20, 32 << 20, 24 << 20  # bytes of text for a chunk or a bucket of contexts, at least and at most, and for a bucket of hashes
MESSAGE = 10_000  # bytes of text for each message from a chunk to a bucket of contexts, where MOST allows
PART = 2 << 20  # bytes of contexts that a bucket merges at once
SLICE = 1 << 18  # bytes of text that anchors are found in at once
WIDE = 16  # contexts of an anchor in a chunk from which they are counted
SHARD = 256  # strings of a shard, about


def _batches(docs: pa.Table):
    """(bytes, offsets, ids) of slices of a chunk, in a fixed order."""
    docs = docs.combine_chunks()
    data, offs = utf8(docs["text"])
    ids = docs["id"].to_numpy()
    for lo, hi in slices(offs, SLICE):
        yield np.ascontiguousarray(data[offs[lo] : offs[hi]]), offs[lo : hi + 1] - offs[lo], ids[lo:hi], (lo, hi)


def chunk_size(total: int) -> int:
    """Bytes of text for a chunk, and for a bucket of contexts, of ``total`` bytes."""
    return min(MOST, max(CHUNK, math.isqrt(total * MESSAGE)))


def four_bytes(u: np.ndarray) -> bytes:
    """The high 32 bits of each hash: enough to screen by in a bucket of some million, as a chance match only adds a candidate."""
    return (u >> np.uint64(32)).astype("<u4").tobytes()


def by_bucket(bucket: np.ndarray):
    """(bucket, places) for each bucket."""
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    return zip(names.tolist(), np.split(order, first[1:]) if len(names) else [], strict=True)


def namer(data: np.ndarray):
    """A function from starts and ends to hashes of those bytes of ``data``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=sums[1:])
    back = powers(len(data) + 1)[1]
    return lambda a, z: mix((sums[z] - sums[a]) * back[a])


def contexts_of(found: list, at: np.ndarray, many: np.ndarray, span: int) -> np.ndarray:
    """The number of distinct contexts of each anchor that is one of ``many``; 1 for the others."""
    out = np.ones(len(many), np.int64)
    which, names, seen = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    for data, s, n in found:
        own = at[seen : seen + len(s)]
        seen += len(s)
        ok = many[own]
        if ok.any():
            which.append(own[ok])
            names.append(namer(data)(s[ok], (s + n)[ok] + span - 1))
    which, names = np.concatenate(which), np.concatenate(names)
    order = np.lexsort((names, which))
    which, names = which[order], names[order]
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (names[1:] != names[:-1])
    out[many] = np.bincount(which[new], minlength=len(many))[many]
    return out


def _hash_lists(span: int, buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        chunk = docs["chunk"][0].as_py()
        hashes, owners, found = [], [], []
        for data, offs, ids, _ in _batches(docs):
            h, text, s, n = anchored(data, offs, span)
            hashes.append(h)
            owners.append(ids[text])
            found.append((data, s, n))
        ids = np.concatenate(owners)
        u, at, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        low, high = np.full(len(u), 1 << 62), np.full(len(u), -(1 << 62))
        np.minimum.at(low, at, ids)
        np.maximum.at(high, at, ids)
        contexts = contexts_of(found, at, times >= WIDE, span)
        names, cuts = [], []
        for name, places in by_bucket((u % np.uint64(buckets)).astype(np.int64)):
            names.append(name)
            cuts.append(places)
        wide = [np.flatnonzero(contexts[c] > 1) for c in cuts]
        return pa.table({
            "bucket": pa.array(names, pa.int64()), "chunk": pa.array([chunk] * len(names), pa.int64()),
            "hashes": pa.array([four_bytes(u[c]) for c in cuts], pa.binary()), "several": pa.array([np.packbits(low[c] < high[c]).tobytes() for c in cuts], pa.binary()),
            "wide": pa.array([w.astype("<u4").tobytes() for w in wide], pa.binary()), "contexts": pa.array([contexts[c[w]].astype("<u4").tobytes() for c, w in zip(cuts, wide, strict=True)], pa.binary()),
        })

    return run


def _answers(hot_chunks: int, hot_contexts: int):
    """For each list, a bit for each hash that another document has, and one for each hot hash."""

    def run(lists: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, "<u4") for x in lists["hashes"].to_pylist()]
        several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8))[: len(h)] for x, h in zip(lists["several"].to_pylist(), hashes, strict=True)])
        contexts = np.ones(len(several), np.int64)
        ends = np.cumsum([len(h) for h in hashes])
        for x, y, h, end in zip(lists["wide"].to_pylist(), lists["contexts"].to_pylist(), hashes, ends.tolist(), strict=True):
            contexts[end - len(h) + np.frombuffer(x, "<u4").astype(np.int64)] = np.frombuffer(y, "<u4")
        u, at, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        again = np.zeros(len(u), bool)
        again[at[several > 0]] = True
        again, hot = (again | (n > 1))[at], ((n > hot_chunks) | (np.bincount(at, contexts, len(u)) > hot_contexts))[at]
        pack = lambda x: pa.array([np.packbits(p).tobytes() for p in np.split(x, ends[:-1])], pa.binary())
        return pa.table({"chunk": lists["chunk"].cast(pa.int64()), "bucket": lists["bucket"].cast(pa.int64()), "again": pack(again), "hot": pack(hot)})

    return run


class Contexts:
    """The distinct contexts of a chunk's repeated anchors, in a fixed order, and where they occur."""

    def __init__(self, docs: pa.Table, answers: pa.Table, span: int, hash_buckets: int, buckets: int):
        found = []
        self.slices = []
        for data, offs, ids, rows in _batches(docs):
            found.append([*anchored(data, offs, span)])
            self.slices.append((data, offs, ids, rows))
        u = np.sort(np.concatenate([f[0] for f in found]))
        u = u[np.r_[True, u[1:] != u[:-1]]] if len(u) else u
        of = (u % np.uint64(hash_buckets)).astype(np.int64)
        again, hot = [], []
        places = dict(by_bucket(of))
        for b, x, y in zip(answers["bucket"].to_pylist(), answers["again"].to_pylist(), answers["hot"].to_pylist(), strict=True):
            own = u[places[b]]
            bit = lambda z, own=own: np.unpackbits(np.frombuffer(z, np.uint8))[: len(own)].astype(bool)
            again.append(own[bit(x)])
            hot.append(own[bit(y)])
        again, hot = (np.sort(np.concatenate(x)) if x else np.zeros(0, np.uint64) for x in (again, hot))
        family, name, low, place, size = [], [], [], [], []
        self.runs = []
        for (data, _, ids, _), (h, text, s, n) in zip(self.slices, found, strict=True):
            ok = among(h, again)
            h, text, s, n = h[ok], text[ok], s[ok], n[ok]
            hit = among(h, hot)
            named = namer(data)
            if hit.any():  # each string of a hot anchor is a context of its own
                one = np.repeat(s[hit] - (np.cumsum(n[hit]) - n[hit]), n[hit]) + np.arange(int(n[hit].sum()))
                own = named(one, one + span)
                h, text = np.r_[h[~hit], own], np.r_[text[~hit], np.repeat(text[hit], n[hit])]
                s, n = np.r_[s[~hit], one], np.r_[n[~hit], np.ones(len(one), np.int64)]
            family.append(h)
            name.append(named(s, s + n + span - 1))
            low.append(ids[text])
            place.append(s)
            size.append(n + span - 1)
            self.runs.append((text, s, n))
        f, c, d = (np.concatenate(x) for x in (family, name, low))
        order = np.lexsort((d, c, f, (f >> np.uint64(20)) % np.uint64(buckets)))
        new = np.ones(len(order), bool)
        new[1:] = (f[order][1:] != f[order][:-1]) | (c[order][1:] != c[order][:-1])
        self.first = order[new]  # the occurrence with the least doc_id stands for the context
        self.of = np.empty(len(order), np.int64)  # the context of each occurrence
        self.of[order] = np.cumsum(new) - 1
        self.family, self.low = f[self.first], d[self.first]
        self.size, self.place = (np.concatenate(x)[self.first] for x in (size, place))
        self.slice = np.repeat(np.arange(len(place)), [len(x) for x in place])[self.first]
        self.bucket = ((self.family >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)

    def bytes(self, lo: int, hi: int) -> np.ndarray:
        """The bytes of contexts lo to hi, one after another."""
        starts = np.cumsum([0, *[len(s[0]) for s in self.slices]])
        if not hasattr(self, "whole"):
            self.whole = np.concatenate([s[0] for s in self.slices])
        return gather(self.whole, (self.place + starts[self.slice])[lo:hi], self.size[lo:hi])

    def parts(self):
        """(bucket, lo, hi) of contexts."""
        names, first = np.unique(self.bucket, return_index=True)
        return zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(self.bucket)], strict=True)


def _contexts(span: int, hash_buckets: int, buckets: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = {k: [] for k in ("bucket", "chunk", "family", "low", "size", "bytes")}
        if docs.num_rows and answers.num_rows:
            chunk = docs["chunk"][0].as_py()
            c = Contexts(docs, answers, span, hash_buckets, buckets)
            for b, lo, hi in c.parts():
                for k, v in zip(out, (b, chunk, c.family[lo:hi].tobytes(), c.low[lo:hi].astype("<i8").tobytes(), c.size[lo:hi].astype("<u2").tobytes(), c.bytes(lo, hi).tobytes()), strict=True):
                    out[k].append(v)
        return pa.table({k: pa.array(v, pa.int64() if k in ("bucket", "chunk") else pa.binary()) for k, v in out.items()})

    return run


def least_ids(family: np.ndarray, low: np.ndarray, size: np.ndarray, data: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The least doc_id of each string of each context, and the number of strings of each context."""
    first = np.cumsum(size) - size
    name = namer(data)(first, first + size)
    order = np.lexsort((low, name, family))
    new = np.ones(len(order), bool)
    new[1:] = (family[order][1:] != family[order][:-1]) | (name[order][1:] != name[order][:-1])
    distinct = order[new]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    _, at, n = np.unique(family[distinct], return_inverse=True, return_counts=True)
    starts = size[distinct] - span + 1
    base = np.cumsum(starts) - starts
    least = np.repeat(low[distinct], starts)
    several = np.flatnonzero(n[at] > 1)  # a context alone in its family shares no string
    if len(several):
        # a family's contexts are dealt over shards, so that strings within a shard differ early
        shard = (np.arange(len(several)) % min(65_536, -(-len(several) // SHARD))).astype(np.uint16)
        d = distinct[several]
        string, offset, block = merge(transforms(gather(data, first[d], size[d]), size[d], shard), size[d], span)
        if len(block):
            where = base[several[string]] + offset
            low_of = np.full(int(block.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(low_of, block, least[where])
            least[where] = low_of[block]
    own = starts[of]
    return gather(least, base[of], own), own


def least_in_parts(family: np.ndarray, low: np.ndarray, size: np.ndarray, data: np.ndarray, span: int, buckets: int, part_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """``least_ids``, of some of a bucket's families at a time."""
    parts = max(1, -(-len(data) // part_bytes))
    if parts == 1:
        return least_ids(family, low, size, data, span)
    n, first = size - span + 1, np.cumsum(size) - size
    starts = np.cumsum(n) - n
    least = np.empty(int(n.sum()), np.int64)
    for _, own in by_bucket(((family >> np.uint64(20)) // np.uint64(buckets) % np.uint64(parts)).astype(np.int64)):
        least[ranges(starts[own], n[own])] = least_ids(family[own], low[own], size[own], gather(data, first[own], size[own]), span)[0]
    return least, n


def _intervals(span: int, buckets: int, part_bytes: int):
    def run(contexts: pa.Table) -> pa.Table:
        join = lambda k, t: np.concatenate([np.frombuffer(x, t) for x in contexts[k].to_pylist()])
        family, low, size, data = join("family", np.uint64), join("low", "<i8"), join("size", "<u2").astype(np.int64), join("bytes", np.uint8)
        least, n = least_in_parts(family, low, size, data, span, buckets, part_bytes)
        starts = np.cumsum(n) - n
        flat = np.minimum.reduceat(least, starts) == np.maximum.reduceat(least, starts)
        counts = np.array([len(x) // 8 for x in contexts["family"].to_pylist()])
        ends = np.cumsum(counts)
        kept = np.where(flat, 1, n)
        values, at = gather(least, starts, kept), np.r_[0, np.cumsum(kept)]
        return pa.table({
            "chunk": contexts["chunk"].cast(pa.int64()), "bucket": contexts["bucket"].cast(pa.int64()),
            "flat": pa.array([np.packbits(flat[e - c : e]).tobytes() for c, e in zip(counts, ends, strict=True)], pa.binary()),
            "least": pa.array([values[at[e - c] : at[e]].tobytes() for c, e in zip(counts, ends, strict=True)], pa.binary()),
        })

    return run


def covered(c: Contexts, told: pa.Table, span: int) -> list[np.ndarray]:
    """A mask over the bytes of each slice of a chunk."""
    n = c.size - span + 1
    at = np.zeros(len(n), np.int64)  # where each context's values start
    flat = np.ones(len(n), bool)
    values = [np.zeros(0, np.int64)]
    held = 0
    rows = {b: x for b, *x in zip(*(told[k].to_pylist() for k in ("bucket", "flat", "least")), strict=True)}
    for b, lo, hi in c.parts():
        bits, low = rows[b]
        flat[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8))[: hi - lo].astype(bool)
        x = np.frombuffer(low, np.int64)
        k = np.where(flat[lo:hi], 1, n[lo:hi])
        at[lo:hi] = held + np.cumsum(k) - k
        values.append(x)
        held += len(x)
    values = np.concatenate(values)
    out, seen = [], 0
    for (data, _, ids, _), (text, s, m) in zip(c.slices, c.runs, strict=True):
        of = c.of[seen : seen + len(s)]
        seen += len(s)
        edge = np.zeros(len(data) + 1, np.int32)
        one = flat[of] & (values[at[of]] < ids[text]) if len(of) else np.zeros(0, bool)
        np.add.at(edge, s[one], 1)
        np.add.at(edge, s[one] + m[one] + span - 1, -1)
        many = np.flatnonzero(~flat[of])
        if len(many):
            start = gather(np.arange(len(data)), s[many], m[many])
            low = gather(values, at[of[many]], m[many])
            start = start[low < np.repeat(ids[text[many]], m[many])]
            np.add.at(edge, start, 1)
            np.add.at(edge, start + span, -1)
        out.append(np.cumsum(edge[:-1]) > 0)
    return out


def _results(span: int, hash_buckets: int, buckets: int):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "starts", "ends", "kept")}
        if docs.num_rows:
            docs = docs.combine_chunks()
            given = docs["doc_id"].to_pylist()
            answers = pa.table({"bucket": told["hash_bucket"], "again": told["again"], "hot": told["hot"]}).filter(pa.compute.is_valid(told["again"]))
            told = told.filter(pa.compute.is_valid(told["flat"]))
            if told.num_rows:
                c = Contexts(docs, answers, span, hash_buckets, buckets)
                pieces = zip(c.slices, covered(c, told, span), strict=True)
            else:
                pieces = ((s, np.zeros(len(s[0]), bool)) for s in _batches(docs))
            for (data, offs, _, (lo, _)), gone in pieces:
                for i, (s, e) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
                    g = gone[s:e]
                    turn = np.flatnonzero(np.diff(np.r_[False, g, False]))
                    for k, v in zip(out, (given[lo + i], e - s, int(g.sum()), turn[::2].tolist(), turn[1::2].tolist(), data[s:e][~g].tobytes()), strict=True):
                        out[k].append(v)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types, strict=True)})

    return run


def remove_repeats(docs: DataFrame, span: int = 50, hot_chunks: int = 4096, chunk_bytes: int | None = None, hot_contexts: int = 1 << 16, part_bytes: int = PART) -> DataFrame:
    """doc_id, n_bytes, n_removed, starts and ends of the removed runs, kept (bytes): a row for each input row."""
    spark = prepare(docs.sparkSession)
    total = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    size = chunk_size(total)
    chunks, hash_buckets, buckets = (max(1, -(-total // x)) for x in (chunk_bytes or size, HASHES, size))
    d = F.col("doc_id").cast("long")
    id_ = F.coalesce(d, F.lit(-1))
    # by text and partition too: a doc_id or a row that repeats very often is shared by many chunks
    chunk = F.pmod(F.xxhash64(id_, F.col("text"), F.spark_partition_id()), F.lit(chunks))
    rows = docs.select(chunk.alias("chunk"), d.alias("doc_id"), id_.alias("id"), "text")
    by = lambda df, *k: df.groupBy(*k)
    lists = by(rows, "chunk").applyInArrow(_hash_lists(span, hash_buckets), "bucket long, chunk long, hashes binary, several binary, wide binary, contexts binary")
    answers = by(lists, "bucket").applyInArrow(_answers(hot_chunks, hot_contexts), "chunk long, bucket long, again binary, hot binary")
    contexts = by(rows, "chunk").cogroup(by(answers, "chunk")).applyInArrow(_contexts(span, hash_buckets, buckets), "bucket long, chunk long, family binary, low binary, size binary, bytes binary")
    told = by(contexts, "bucket").applyInArrow(_intervals(span, buckets, part_bytes), "chunk long, bucket long, flat binary, least binary")
    none = lambda *names: [F.lit(None).cast("binary").alias(n) for n in names]
    told = told.select("chunk", "bucket", F.lit(None).cast("long").alias("hash_bucket"), "flat", "least", *none("again", "hot"))
    told = told.unionByName(answers.select("chunk", F.lit(None).cast("long").alias("bucket"), F.col("bucket").alias("hash_bucket"), *none("flat", "least"), "again", "hot"))
    schema = "doc_id long, n_bytes long, n_removed long, starts array<long>, ends array<long>, kept binary"
    return by(rows, "chunk").cogroup(by(told, "chunk")).applyInArrow(_results(span, hash_buckets, buckets), schema)

