"""Token counts of whole texts by a map-side two-tier lookup, with no shuffle of pre-tokens.

Tier 1 is a broadcast table of frequent pre-tokens and their token counts, of at most
``table_size`` entries; tier 2 encodes a miss with the tokenizer and keeps it in a bounded cache of
the worker.  The table comes from a sample of about ``sample_rows`` rows of all partitions, tallied where
they are read; it can change the speed but never a count.  A tokenizer whose pre-tokens are not those of
``PIECES`` (byte-level, with its standard pattern, no normaliser) is refused.  Null and empty texts have 0 tokens; repeated rows are counted row by row; extra
columns are ignored; strings of added tokens, special or not, inside a text count as the library takes
them by default (one token each, the longest first; a text with one goes to the tokenizer whole where
some added token takes in the space around it or needs word borders).
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, utf8

PIECES = regex.compile(r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Outside these ranges the Unicode versions of two libraries could differ: such texts go to the tokenizer whole.
UNSURE = regex.compile("[^\t-\r -\x7e\xa1-ͷ΄-ӿḀ-ỿ‐-‧‰-⁞₠-₵ぁ-ゖァ-ヺ一-龥가-힣]")
LONGEST_KEPT, MOST_KEPT = 48, 400_000
_STATE: dict = {}


def _tokenizer(path: str):
    if ("tokenizer", path) not in _STATE:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer") or spec["model"].get("type") != "BPE":
            raise ValueError(f"{path}: only byte-level BPE with the standard pre-token pattern can be counted by pre-tokens")
        t.no_truncation()
        t.no_padding()
        added = sorted(t.get_added_tokens_decoder().values(), key=lambda a: (-len(a.content), a.content))
        plain = not any(a.lstrip or a.rstrip or a.single_word for a in added) and len({a.normalized for a in added}) < 2
        _STATE["tokenizer", path] = t, [a.content for a in added], plain
    return _STATE["tokenizer", path]


def resolve(tokenizer: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


class Counts:
    """Counts texts with a fixed table and a cache for what it lacks."""

    def __init__(self, tokenizer: str, frequent: dict[str, int]):
        self.tok, added, self.split = _tokenizer(resolve(tokenizer))
        self.cut = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.frequent, self.cache = frequent, {}

    def whole(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False))

    def text(self, text: str) -> int:
        n = 0
        if self.cut is not None and self.cut.search(text):
            if not self.split:
                return self.whole(text)
            n = len(self.cut.findall(text))
            parts = self.cut.split(text)
        else:
            parts = (text,)
        return n + sum(self.plain(p) for p in parts if p)

    def plain(self, text: str) -> int:
        if UNSURE.search(text):
            return self.whole(text)
        pieces = PIECES.findall(text)
        got = list(map(self.frequent.get, pieces))
        if None not in got:
            return sum(got)
        n, missed, cache = 0, [], self.cache
        for p, k in zip(pieces, got, strict=True):
            if k is None and (k := cache.get(p)) is None:
                missed.append(p)
            else:
                n += k
        if missed:
            if len(cache) > MOST_KEPT:
                cache.clear()
            for p, e in zip(missed, self.tok.encode_batch_fast(missed, add_special_tokens=False), strict=True):
                n += (k := len(e))
                if len(p) <= LONGEST_KEPT:
                    cache[p] = k
        return n


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for b in batches:
        for t in b.column(0).to_pylist():
            seen.update(p for p in PIECES.findall(t or "") if len(p) <= LONGEST_KEPT)
    yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["p", "n"])


def frequent_pieces(docs: DataFrame, tokenizer: str, table_size: int, sample_rows: int) -> bytes:
    """The table as one block: token counts, then the pre-tokens, each ended by a zero byte."""
    n = docs.count()
    some = docs.select("text").sample(min(1.0, sample_rows / n), seed=1) if n else docs.select("text")
    top = some.mapInArrow(_tally, "p string, n long").groupBy("p").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "p").limit(table_size).collect()
    pieces = [r["p"] for r in top if "\0" not in r["p"]]
    tok, added, _ = _tokenizer(resolve(tokenizer))
    pieces = [p for p in pieces if not any(s in p for s in added)]
    ns = [len(e) for e in tok.encode_batch(pieces, add_special_tokens=False)]
    return len(ns).to_bytes(8, "little") + np.array(ns, np.uint8).tobytes() + "\0".join(pieces).encode()


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, table_size: int = 65_536, sample_rows: int = 2_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row for each input row."""
    spark = prepare(docs.sparkSession)
    block = spark.sparkContext.broadcast(frequent_pieces(docs, tokenizer, table_size, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _STATE.get("counts")
        if state is None or state[0] != (tokenizer, block.value):
            raw = block.value
            n = int.from_bytes(raw[:8], "little")
            ns = np.frombuffer(raw, np.uint8, n, 8).tolist()
            pieces = raw[8 + n :].decode().split("\0") if n else []
            state = _STATE["counts"] = (tokenizer, raw), Counts(tokenizer, dict(zip(pieces, ns, strict=True)))
        counts = state[1]
        for b in batches:
            _, offs = utf8(b.column(1))
            n = np.fromiter((counts.text(t) if t else 0 for t in (x.as_py() for x in b.column(1))), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offs)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
