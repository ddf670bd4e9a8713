"""Each operator against a plain version, and over hostile tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import chat_format, decontaminate, embedding_dedup, mixing, ngram_join, quality, secret_scan, suffix_dedup, token_counts, toxicity
from plumbline.llm.bwt import Transforms, merge, transforms
from plumbline.llm.common import Cut, components, labelled_sample, prepare
from plumbline.llm.transducers import KINDS, Compiled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = "the quick brown fox jumps over a lazy dog while seven more wolves sleep near cold rivers of northern plains and dream about summer fields"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, chunk long"


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def nasty(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing names, NUL, special strings."""
    texts = [None, "", " ", "one", "two words", BASE, BASE, BASE.upper(), BASE + " end", "start " + BASE, "é" * 60, "<|endoftext|>x<|endoftext|>", "a\x00b" * 40, "aaaa" * 40, "ab" * 100, " \x85\x1c tail", "x" * 300_000, (BASE + " ") * 400, "日本語 текст ελληνικά 𝒳😀 " * 8]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 else "s", None, 0.5, True, 7) for i, t in enumerate(texts)]
    rows += [(3, "one", "en", "s", 3, 0.5, True, 7), (None, None, None, None, None, None, None, None), (None, BASE, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(19)] + [(1, 0, None), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")


def test_counts_equal_the_library(spark, nasty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_counts.resolve("byte_bpe_50k.json"))
    got = token_counts.count_tokens(nasty).collect()
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), len(tok.encode(r["text"] or "", add_special_tokens=False))) for r in nasty.collect())
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


def brute_hits(text, items, window=10):
    w, hit, found = WORD.findall(low(text)), set(), set()
    for i, t in items:
        v = WORD.findall(low(t))
        n = min(len(v), window)
        for a in range(len(v) - n + 1 if n else 0):
            for b in range(len(w) - n + 1):
                if w[b : b + n] == v[a : a + n]:
                    hit.update(range(b, b + n))
                    found.add(str(i))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination(spark, block_bytes):
    items = [(1, BASE), (2, "Lazy DOG while"), (3, None), (10, ""), (4, "one"), (5, "unseen words only here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = BASE.split()
    texts = [None, "", "One", BASE[10:150], "x " + " ".join(words[3:14]) + " y " + " ".join(words[0:9]), "a lazy dog while", " ".join(words * 3), "one"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(7, "one")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in decontaminate.decontaminate(docs, bench, block_bytes=block_bytes).collect())
    assert got == sorted((r["doc_id"], *brute_hits(r["text"], items)) for r in docs.collect())
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench, block_bytes=block_bytes).collect()}
    assert kept == {g[0] for g in got if not g[2]}


@pytest.mark.parametrize("block_bytes", [1 << 20, 80])
def test_decontamination_by_items_without_id(spark, block_bytes):
    bench = spark.createDataFrame([(None, BASE), (None, "unseen words"), (5, "lazy dog"), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, BASE), (2, "unseen words"), (3, "a lazy dog"), (4, "clean"), (4, "clean"), (6, "unseen words " + BASE)], "doc_id long, text string")
    sha = lambda x: hashlib.sha256(x).hexdigest()
    got = sorted((r["doc_id"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontaminate.decontaminate(docs, bench, block_bytes=block_bytes).collect())
    n = len(BASE.split())
    assert got == [(1, n, 2, sha(b"5"), True), (2, 2, 1, sha(b""), True), (3, 2, 1, sha(b"5"), True), (4, 0, 0, sha(b""), False), (4, 0, 0, sha(b""), False), (6, n + 2, 2, sha(b"5"), True)]
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench, block_bytes=block_bytes).collect()] == [4, 4]


def classes(ids, links):
    root = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("per_block,per_node", [(512, 8192), (3, 2)])
def test_ngram_join(spark, per_block, per_node):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(12):
        base = list(rng.choice(vocabulary, 120))
        for k in range(8):
            t = list(base)
            for p in rng.integers(0, 120, k // 2):
                t[p] = str(rng.choice(vocabulary))
            texts.append(" ".join(t))
    texts += [texts[0], texts[0].upper() + "!", "", "a b", "A, b", None, "solo"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def shingles(t):
        w = WORD.findall(low(t))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [shingles(t) for t in texts]
    links = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root = classes(range(len(texts)), links)
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["kept"]) for r in ngram_join.ngram_join(docs, per_block=per_block, per_node=per_node).collect()}
    assert got == {i: (root[i], n[i], root[i] == i) for i in range(len(texts))}
    assert {r["doc_id"] for r in ngram_join.keep_one(docs).collect()} == {i for i in range(len(texts)) if root[i] == i}


def least_id(ids):
    return min((i for i in ids if i is not None), default=None)


def nulls_last(rows):
    return sorted(rows, key=lambda r: [(x is None, 0 if x is None else x) for x in r])


def test_ngram_join_with_repeated_ids(spark):
    rng = np.random.default_rng(2)
    words = [[f"w{x}" for x in rng.integers(0, 10**6, 60)] for _ in range(10)]
    plain = [" ".join(w) for w in words]
    near = [" ".join([*w[:-1], "other"]) for w in words]
    rows = [(None, t) for t in plain[:4]] + [(None, near[0]), (None, plain[1]), (7, near[1]), (7, plain[4]), (7, plain[5]), (8, near[4]), (9, near[5]), (9, plain[6]), (9, plain[6]), (3, plain[7]), (None, plain[7]), (5, near[8]), (4, plain[8]), (-1, plain[9]), (0, plain[2]), (None, ""), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    group = [plain.index(t) if t in plain else near.index(t) if t in near else -i - 1 for i, (_, t) in enumerate(rows)]
    least = {g: least_id(i for (i, _), h in zip(rows, group, strict=True) if h == g) for g in group}
    want = nulls_last((i, least[g], group.count(g) - 1, i == least[g]) for (i, _), g in zip(rows, group, strict=True))
    for options in ({}, {"per_block": 3, "per_node": 2}):
        assert nulls_last(tuple(r) for r in ngram_join.ngram_join(docs, **options).select("doc_id", "class_id", "n_links", "kept").collect()) == want
        kept = [(r["doc_id"], r["text"]) for r in ngram_join.keep_one(docs, **options).collect()]
        names = sorted((plain.index(t) if t in plain else near.index(t), i is None, i) for i, t in kept if t)
        assert names == sorted((g, i is None, i) for g, i in least.items() if g >= 0)
        assert len([t for _, t in kept if not t]) == 3


def test_prefixes_are_shortened_to_the_target():
    rng = np.random.default_rng(6)
    counts = np.sort(rng.integers(1, 50, (200, 16, 3)), axis=2)[:, :, ::-1]
    counts[:, :4] = 1
    got = ngram_join.shorten(counts, 2, 0.8, 0.9999)
    miss = np.prod(1 - 0.8 ** got.astype(float), axis=1)
    assert (miss <= 1.0001e-4).all() and got.min() >= 2 and got.max() == 4 and (got[:, :4] <= 3).any()
    deep = ngram_join.shorten(np.ones((1, 16, 3), int), 2, 0.8, 0.5)
    assert deep.max() == 4  # a low target is met by full labels


def test_recall_against_the_exact_join(spark):
    """All pairs of the sf0.01 texts at 0.8 or more, by an inverted index."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {}
    for r in docs.collect():
        w = WORD.findall(low(r["text"]))
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    where, shared = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for ids in where.values():
        for pair in itertools.combinations(sorted(ids), 2):
            shared[pair] += 1
    n = defaultdict(int)
    for (a, b), k in shared.items():
        if 9 * k >= 4 * (len(sets[a]) + len(sets[b])):
            n[a] += 1
            n[b] += 1
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.ngram_join(docs).collect()}
    assert sum(n.values()) > 50 and got == {i: n[i] for i in sets}


def test_linked_signatures_hot_node():
    rng = np.random.default_rng(0)
    sketch = np.repeat(rng.integers(0, 255, (1, 64), dtype=np.uint8), 300, 0)
    sketch[:, 0] = rng.integers(0, 255, 300)
    other = rng.integers(0, 255, (5, 64), dtype=np.uint8)
    label = ngram_join.linked(np.concatenate([sketch, other]), 0.58)
    assert len(set(label[:300])) == 1 and len(set(label[300:])) == 5


@pytest.mark.parametrize("per_block,per_cell", [(1024, 4096), (4, 10)])
def test_embedding_links(spark, per_block, per_cell):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(8):
        centre = rng.normal(size=16)
        rows += [(len(rows) + k, [float(x) for x in centre + rng.normal(size=16) * 0.06], c % 2) for k in range(20)]
    n = len(rows)
    rows += [(n, rows[0][1], 0), (n + 1, [0.0] * 16, 0), (n + 2, None, 0), (n + 3, [float("nan")] * 16, 0), (n + 4, rows[0][1], None), (n + 5, [1.0], 0), (n + 6, [], 1), (n + 7, [None, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    good = [(i, np.array(np.float32(v), float), y) for i, v, y in rows if v and y is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(a[0], b[0]) for a, b in itertools.combinations(good, 2) if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / math.sqrt(a[1] @ a[1]) / math.sqrt(b[1] @ b[1]) >= 0.98]
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    root = classes([r[0] for r in rows], links)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.link_vectors(df, per_block=per_block, per_cell=per_cell).collect()}
    assert got == {r[0]: (count[r[0]], root[r[0]], root[r[0]] == r[0]) for r in rows}


def test_embedding_links_of_repeated_ids(spark):
    rng = np.random.default_rng(8)
    x, y, z, w = (rng.normal(size=8) for _ in range(4))
    close = lambda v: v + rng.normal(size=8) * 0.01
    rows = [(1, x, 0), (1, y, 0), (2, close(y), 0), (3, close(y), 0), (None, z, 0), (None, close(z), 0), (None, w, 1), (4, close(w), 1), (4, close(w), 1), (-1, x, 1), (None, x, 1), (None, None, 0), (5, None, 0)]
    rows = [(i, None if v is None else [float(e) for e in v], k) for i, v, k in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    units = [None if v is None else np.array(np.float32(v), float) / np.linalg.norm(np.array(np.float32(v), float)) for _, v, _ in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if rows[i][2] == rows[j][2] and units[i] is not None and units[j] is not None and units[i] @ units[j] >= 0.98]
    root = classes(range(len(rows)), links)
    names = {r: least_id(rows[i][0] for i in root if root[i] == r) for r in set(root.values())}
    want = nulls_last((rows[i][0], sum(i in p for p in links), names[root[i]], rows[i][0] == names[root[i]]) for i in range(len(rows)))
    for options in ({}, {"per_block": 2, "per_cell": 2}):
        assert nulls_last(tuple(r) for r in embedding_dedup.link_vectors(df, **options).select("vec_id", "n_links", "component_id", "kept").collect()) == want


def brute_repeats(rows, span=50):
    first = {}
    for i, b in rows:
        for p in range(len(b) - span + 1):
            k = b[p : p + span]
            first[k] = min(first.get(k, i), i)
    out = []
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - span + 1):
            if first[b[p : p + span]] < i:
                gone[p : p + span] = True
        runs = int((np.diff(np.r_[False, gone, False].astype(int)) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot_chunks,chunk_bytes", [(4096, 2 << 20), (0, 900), (1, 400)])
def test_repeats(spark, hot_chunks, chunk_bytes):
    rng = np.random.default_rng(5)
    pieces = ["".join(rng.choice(list("abcdé \x00"), 80)) for _ in range(6)]
    texts = [None, "", "short", "ab" * 60, "ab" * 60, "z" * 200, "z" * 49, "z" * 50, BASE, BASE, "(" + BASE[5:80] + ")"]
    texts += ["".join(rng.choice(pieces, 3)) + "".join(rng.choice(list("xyz"), int(rng.integers(0, 90)))) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(8, BASE), (None, BASE)], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, hot_chunks=hot_chunks, chunk_bytes=chunk_bytes).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], len(r["starts"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got)
    assert got == brute_repeats([(-1 if r["doc_id"] is None else r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()])


@pytest.mark.parametrize("hot_contexts,part_bytes", [(2, 2 << 20), (1 << 16, 300), (2, 100)])
def test_repeats_with_hot_contexts_and_parts(spark, hot_contexts, part_bytes):
    rng = np.random.default_rng(6)
    piece = "".join(rng.choice(list("abcdé"), 90))
    texts = ["".join(rng.choice(list("xyz"), 40)) + piece + "".join(rng.choice(list("xyz"), 40)) for _ in range(40)] + [(piece + "-") * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, chunk_bytes=2000, hot_contexts=hot_contexts, part_bytes=part_bytes).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["starts"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got)
    assert got == brute_repeats([(i, t.encode()) for i, t in enumerate(texts)])


def test_messages_of_chunks_grow_with_the_input():
    small, large = (-(-total // suffix_dedup.chunk_size(total)) for total in (1_000_000_000, 10_000_000_000))
    assert large**2 < 11 * small**2  # chunks times buckets, over ten times the text
    assert suffix_dedup.chunk_size(0) == suffix_dedup.CHUNK and suffix_dedup.chunk_size(10**15) == suffix_dedup.MOST


def test_an_anchor_is_hot_by_its_contexts():
    rng = np.random.default_rng(7)
    line = "".join(rng.choice(list("abcd"), 60))
    texts = ["".join(rng.choice(list("wxyz"), 60)) + line + "".join(rng.choice(list("wxyz"), 60)) for _ in range(2 * suffix_dedup.WIDE)]
    docs = pa.table({"chunk": [0] * len(texts), "id": list(range(len(texts))), "text": texts})
    lists = suffix_dedup._hash_lists(50, 1)(docs)
    hot = {n: int(np.unpackbits(np.frombuffer(suffix_dedup._answers(4096, n)(lists)["hot"][0].as_py(), np.uint8)).sum()) for n in (1, 2 * suffix_dedup.WIDE)}
    assert hot[1] > 0 and hot[2 * suffix_dedup.WIDE] == 0  # in one chunk, but next to other bytes in each text


STRINGS = [b"banana", b"ananas", b"bandana", b"an\x00an\x00", b"an", b"", b"nab\x00\x00", b"nab\x00"]


def strings_in(shards):
    size = np.array([len(s) for s in STRINGS])
    return transforms(np.frombuffer(b"".join(STRINGS), np.uint8), size, np.array(shards, np.uint16)), size


def test_each_shard_has_its_own_transform():
    for shards in ([0] * 8, [0, 1, 2, 1, 0, 2, 2, 1]):
        t, size = strings_in(shards)
        step = t.steps()
        string, offset = t.places(step, size)
        at = 0
        for k in range(max(shards) + 1):
            own = [i for i, s in enumerate(shards) if s == k]
            want = sorted((tuple(c + 1 for c in STRINGS[i][o:]), i, o) for i in own for o in range(len(STRINGS[i]) + 1))  # 0: the terminator
            got = list(zip(string[at : at + len(want)].tolist(), offset[at : at + len(want)].tolist(), strict=True))
            assert got == [w[1:] for w in want]
            for r, (_, i, o) in enumerate(want):
                assert t.whole[at + r] == (o == 0) and (o == 0 or t.symbol[at + r] == STRINGS[i][o - 1])
            at += len(want)


def test_merged_transforms_find_repeated_intervals():
    for shards in ([0] * 8, [0, 1, 2, 1, 0, 2, 2, 1], list(range(8))):
        t, size = strings_in(shards)
        string, offset, block = merge(t, size, 3)
        found = defaultdict(set)
        for s, o, b in zip(string.tolist(), offset.tolist(), block.tolist(), strict=True):
            found[b].add((s, o))
        want = defaultdict(set)
        for i, s in enumerate(STRINGS):
            for o in range(len(s) - 2):
                want[s[o : o + 3]].add((i, o))
        assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)
        order = [STRINGS[s][o : o + 3] for s, o in zip(string.tolist(), offset.tolist(), strict=True)]
        assert order == sorted(order)  # the merge has the suffixes in their order


def test_a_scrambled_transform_gives_another_result():
    t, size = strings_in([0, 1, 2, 1, 0, 2, 2, 1])
    right = {(s, o) for s, o, _ in zip(*(x.tolist() for x in merge(t, size, 3)), strict=True)}
    rng = np.random.default_rng(0)
    wrong = 0
    for _ in range(20):
        symbol = t.symbol.copy()
        for k in range(3):
            inner = np.flatnonzero((t.owner == k) & ~t.whole)
            symbol[inner] = symbol[rng.permutation(inner)]
        wrong += {(s, o) for s, o, _ in zip(*(x.tolist() for x in merge(Transforms(symbol, t.whole, t.owner, t.strings), size, 3)), strict=True)} != right
    assert wrong >= 18


def plain_links(t, kinds, reach=200):
    """All spans of ``t``, by comparing every pair."""
    base = [(m.start(), n, m.end()) for n, (_, p, ok) in enumerate(kinds) for m in p.finditer(t) if ok(m)]
    weak = [(m.start(), 4, m.end()) for m in kinds[0][1].finditer(t) if len(m[2]) < 6]
    weak += [(m.start(), 4, m.end()) for m in re.finditer(secret_scan.HEX, t) if len(m[0]) < 24]
    weak += [(m.start(), r, m.end()) for r, p in ((3, secret_scan.IDENT), (5, secret_scan.ENDPOINT)) for m in re.finditer(p, t)]
    weak = [w for w in weak if not any(b[0] < w[2] and w[0] < b[2] for b in base)]
    parts = base + weak
    linked = [w for w in weak if any(p[0] < w[2] + reach and w[0] < p[2] + reach and (p[1] in (0, 2, 4)) != (w[1] in (0, 2, 4)) for p in parts)]
    return ",".join(f"{secret_scan.KINDS[n]}:{s}:{e}" for s, n, e in sorted(base + linked))


def test_secrets_against_plain_search(spark):
    texts = [
        None, "", 'password = "abcdef" é secret: tok', "PassWord:abcdef,token=12345 token = 𝒳 api_key='k.-_/+=9'", "AKIA" + "B" * 16 + " AKIA" + "B" * 15, "x" + "0123456789abcdef" * 2 + "g " + "ab" * 8,
        "client_id=ab12 and token=xyz then https://host.example/a?b=1", "token=xyz alone", "password: token: abcdef1", "0a" * 12 + " 0a" * 3, "😀 secret=aaaaaa😀 token='bbbbbb'",
        "é token=abc x " * 700 + "client_id=ab1 " * 3 + "0a" * 12 + " y" + " token=abcdefg" * 300,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = (("assign", re.compile(secret_scan.ASSIGN), lambda m: len(m[2]) >= 6), ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24))
    for r in secret_scan.scan(docs).collect():
        t = texts[r["doc_id"]] or ""
        base = sorted((m.start(), n, m.end()) for n, (_, p, ok) in enumerate(kinds) for m in p.finditer(t) if ok(m))
        want = ",".join(f"{kinds[n][0]}:{s}:{e}" for s, n, e in base)
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), t
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == n for x in base) for n in range(3)]
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs).collect()}
    assert spans[11] == plain_links(texts[11], kinds)
    assert [x.split(":")[0] for x in spans[6].split(",")] == ["id", "weak", "endpoint"] and spans[7] == ""
    red = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    cut, at = "", 0
    for s, e in sorted(tuple(map(int, x.split(":")[1:])) for x in spans[11].split(",")):
        cut, at = cut + (texts[11][at:s] + "[SECRET]" if s >= at else ""), max(at, e)
    assert red[11] == cut + texts[11][at:]
    assert red[10] == "😀 [SECRET]😀 [SECRET]'" and red[0] is None and red[7] == texts[7]


def test_endpoints_of_any_scheme(spark):
    schemes = "https mongodb+srv rediss s3 ldaps mssql postgresql+psycopg2 kafka ftps x".split()
    rng = np.random.default_rng(4)
    texts = [f"token=ab12 {x}://u:p@host/a" for x in schemes] + ["".join(rng.choice(list("ab1+.-:/ X😀\""), 40, p=[0.1, 0.1, 0.06, 0.04, 0.04, 0.04, 0.2, 0.3, 0.04, 0.03, 0.03, 0.02])) for _ in range(600)]
    texts += ["1https://a", "..+s3://b x-://c ://d a:// e://\x00f", "see ...http://g://h\"i://j", "a" * 300_000, "1" * 300_000 + "a://k", "a.b-" * 100_000 + ":/ m://n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in docs.select("text", secret_scan._endpoints(F.col("text")).alias("found")).collect():
        old = re.finditer(r"""[a-z][a-z0-9+.-]*://[^\x00-\x20"'<>]+""", r["text"]) if len(r["text"]) < 1000 else re.finditer(r"""(?:(?<=111)a|m)://[kn]""", r["text"])
        assert [(x["start"], x["end"]) for x in r["found"]] == [m.span() for m in old], r["text"][:100]
    weak = docs.where(F.col("doc_id") < len(schemes))
    assert {r["spans"] for r in secret_scan.scan(weak).collect()} == {f"weak:0:10,endpoint:11:{len(t)}" for t in texts[: len(schemes)]}
    assert {r["text"] for r in secret_scan.redact(weak).collect()} == {"[SECRET] [SECRET]"}


def test_mixing_meets_targets(spark):
    rows = [(i, "word " * (5 + i % 7), ("a", "b", "c")[min(2, i % 5)], ("en", "de")[i % 2]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = mixing.mix_to_targets(docs, keep=0.2, targets={"source": {"a": 1.0, "b": 1.0, "c": 2.0}, "lang": 1.0, "topic": 1.0}).toPandas()
    expected = (out.n_tokens * out.probability).groupby(out.source).sum()
    assert np.allclose(expected / expected.sum(), [0.25, 0.25, 0.5], atol=1e-6)
    assert abs((out.n_tokens * out.probability).sum() / out.n_tokens.sum() - 0.2) < 1e-6
    assert abs(out[out.kept].n_tokens.sum() / out.n_tokens.sum() - 0.2) < 0.03


def plain_raking(cells, targets, keep):
    """Probabilities of cells {(source, lang, topic): tokens} by loops, to the last bit of raking and by bisection of the level."""
    w = dict(cells)
    shares = []
    for i, t in enumerate(targets):
        own = defaultdict(float)
        for k, x in cells.items():
            own[k[i]] += x
        want = {v: t.get(v, 0.0) if isinstance(t, dict) else x**t for v, x in own.items()}
        shares.append({v: x / sum(want.values()) for v, x in want.items()})
    for _ in range(3000):
        for i, share in enumerate(shares):
            got = defaultdict(float)
            for k, x in w.items():
                got[k[i]] += x
            w = {k: x * share[k[i]] / got[k[i]] if got[k[i]] else 0.0 for k, x in w.items()}
    low, high = 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(cells[k], mid * x) for k, x in w.items()) < keep * sum(cells.values()) else (low, mid)
    return {k: min(1.0, high * x / cells[k]) if x else 0.0 for k, x in w.items()}


@pytest.mark.parametrize("few_cells", [1000, 0])
def test_mixing_against_plain_loops(spark, few_cells):
    """Null and unknown values, cells that hold less than they should give, and a source that is not wanted."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        source = (None, "a", "b", "c", "junk")[int(rng.choice(5, p=[0.1, 0.5, 0.05, 0.3, 0.05]))]
        rows.append((None if i % 50 == 0 else i, None if i % 40 == 0 else "w " * int(rng.integers(0, 30)), source, (None, "en", "de")[int(rng.choice(3, p=[0.1, 0.8, 0.1]))], ("x", "y", None)[i % 3]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    targets = {"source": {"": 1.0, "a": 1.0, "b": 4.0, "c": 2.0}, "lang": 0.0, "topic": 1.0}
    cells = defaultdict(float)
    for _, t, *k in rows:
        cells[tuple(x or "" for x in k)] += len((t or "").split())
    want = plain_raking({k: x for k, x in cells.items() if x}, [targets[m] for m in mixing.MARGINS], 0.6)
    assert any(p == 1 for p in want.values()) and any(p == 0 for p in want.values())
    out = mixing.mix_to_targets(docs, keep=0.6, targets=targets, few_cells=few_cells).collect()
    assert len(out) == len(rows)
    for r in out:
        assert abs(r["probability"] - want.get((r["source"], r["lang"], r["topic"]), 0.0)) < 2e-6
        u = int(hashlib.md5(str("" if r["doc_id"] is None else r["doc_id"]).encode()).hexdigest()[:12], 16) / 2**48
        assert r["kept"] == (u < r["probability"])
    assert abs(sum(r["n_tokens"] * r["probability"] for r in out) / sum(r["n_tokens"] for r in out) - 0.6) < 1e-5


def test_mixing_alike_at_any_number_of_cells(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source", "lang")
    few, many = (sorted((r["doc_id"], r["probability"], r["kept"]) for r in mixing.mix_to_targets(docs, few_cells=n).collect()) for n in (1000, 0))
    assert [(i, k) for i, _, k in few] == [(i, k) for i, _, k in many]
    assert np.allclose([p for _, p, _ in few], [p for _, p, _ in many], atol=1e-8)
    empty = mixing.mix_to_targets(docs.where("false"), few_cells=-1)
    assert not empty.collect()


def test_raking_reports_what_it_reaches(spark):
    prepare(spark)
    schema = "source string, lang string, topic string, tokens long"
    reach = lambda rows: mixing.raked(spark.createDataFrame(rows, schema), {"source": 0.0, "lang": 0.0, "topic": 1.0}, 1e-12, mixing.Cells(True, Cut(spark)))
    df, off = reach([("a", "en", "", 5), ("a", "de", "", 9), ("b", "en", "", 1), ("b", "de", "", 7)])
    assert off <= 1e-12 and {(r["margin"], r["value"]): round(r["share"], 9) for r in mixing.margins(df).collect()}["source", "a"] == 0.5
    _, off = reach([("a", "en", "", 5), ("b", "en", "", 3), ("b", "de", "", 2), ("c", "en", "", 2)])  # a and c alone are two thirds English, the target is half
    assert off > 0.05


def test_index_parts_windows_of_one_hash(spark):
    index = decontaminate.Index([("x", "one two"), ("y", "three four"), ("z", "one two"), ("w", None)], 10, 5)
    (h, start, end, first, item) = index.tables[2]
    assert len(h) == 2 and sorted(sorted(index.names[j] for j in item[s:e]) for s, e in zip(first, first[1:], strict=False)) == [["x", "z"], ["y"]]
    same = np.zeros(3, np.uint64)
    h, start, end, first, item = index._table([same, np.array([0, 8, 19]), np.array([7, 18, 26]), np.arange(3)])
    assert len(h) == 2 and sorted(sorted(item[s:e].tolist()) for s, e in zip(first, first[1:], strict=False)) == [[0, 2], [1]]


def plain_dialogues(turns):
    """Each conversation by each speaker, by loops."""
    clean = lambda r: re.sub(r"[\x00-\x1f\x7f]", " ", ("unknown" if r is None else r).replace("<|", "< |").replace("|>", "| >"))
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append(((turn is not None, turn or 0), clean(role), (text or "").replace("<|", "< |")))
    out = {}
    for conv, rows in by.items():
        rows.sort()
        for p in {r for _, r, _ in rows if r != "system"}:
            text, masks = "", []
            for _, role, said in rows:
                text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == p else f"<|user name={role}|>\n"
                if role == p:
                    masks.append(f"{len(text)}:{len(text + said) + 7}")
                text += said + "<|end|>\n"
            out[conv, p] = (len(rows), text, ",".join(masks))
    return out


def test_rotation(spark):
    turns = [(1, 0, "system", "rules"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (2, 0, "system", "alone"), (None, None, None, "?"), (None, 3, "x", "null conversation"), (None, 1, "y", "é😀")]
    turns += [(3, i, ("u", "v")[i % 2], f"t{i}") for i in range(150)] + [(4, 1_700_000_000 + 97 * i, ("u", "v")[i % 2], "x" * i) for i in range(6)]
    turns += [(5, 0, "bob|>\n<|assistant", "forged"), (5, 1, "ann", "real"), (5, 2, "bob|>\n<|assistant", "z" * 200_000), (6, 1, "a", "same")] + [(6, 2, "b", "same")] * 40
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("?") for c in ("n", "perspective", "start", "mask", "end", "own")})
    rows = chat_format.rotate(df)
    got = {(r["conv_id"], r["perspective"]): (r["n_turns"], r["text"], r["mask"]) for r in chat_format.dialogues(rows).collect()}
    want = plain_dialogues(turns)
    assert got == want and "<|assistant|>" not in want[5, "ann"][1].split("real")[0].split("forged")[0]
    for r in rows.collect():
        whole = want[r["conv_id"], r["perspective"]][1]
        assert whole[r["start"] : r["start"] + len(r["text"])] == r["text"]
        if r["mask"]:
            a, b = map(int, r["mask"].split(":"))
            assert b - a == r["n_masked"] > 0 and whole[a:b].endswith("<|end|>") and r["text"].startswith("<|assistant|>")
        else:
            assert r["n_masked"] == 0


@pytest.mark.parametrize("few", [100_000, 0])
def test_components(spark, few):
    prepare(spark)
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (5, 5)] + [(300, int(x)) for x in rng.integers(301, 400, 300)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7), few).collect()}
    assert got == {i: r for i, r in classes({x for e in edges if e[0] != e[1] for x in e}, edges).items()}


def test_components_of_an_adverse_path(spark):
    """A path whose ids jump about, its links dealt over many tasks: rounds grow with the logarithm of its length."""
    prepare(spark)
    n = 2000
    path = [x for i in range(n // 2) for x in (i, n - 1 - i)]
    edges = spark.createDataFrame(list(zip(path, path[1:], strict=False)), "a long, b long").repartition(64)
    got = components(edges, 20).collect()
    assert sorted((r["id"], r["root"]) for r in got) == [(i, 0) for i in range(n)]
    assert not components(edges.where("false"), 0).collect()


def test_hostile_tables(spark, nasty, labels):
    empty = nasty.where("false")
    bench = spark.createDataFrame([(1, BASE), (None, "x"), (2, None)], "item_id long, text string")
    no_labels = labels.where("false")
    n = nasty.count()
    for docs, size in ((nasty, n), (empty, 0)):
        for given in (labels, no_labels):
            for f in (quality.score_quality, toxicity.score_toxicity):
                out = f(docs, given).collect()
                assert len(out) == size and all(0 <= r["score"] <= 1 for r in out)
            assert set(quality.keep_good(docs, given).columns) == set(docs.columns)
        for out in (token_counts.count_tokens(docs), decontaminate.decontaminate(docs, bench), decontaminate.decontaminate(docs, bench.where("false")), ngram_join.ngram_join(docs), suffix_dedup.remove_repeats(docs), secret_scan.scan(docs), secret_scan.redact(docs), mixing.mix_to_targets(docs)):
            assert len(out.collect()) == size
        ngram_join.keep_one(docs).collect()
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert not embedding_dedup.link_vectors(vectors).collect()
    assert not chat_format.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect()


def test_hostile_values(spark, nasty):
    """The whole result over the hostile table, not its size alone."""
    rows = [(r["doc_id"], r["text"]) for r in nasty.collect()]
    items = [(1, BASE), (None, "x"), (2, None), (3, "aaaa"), (4, "two words")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def hits(text):
        n, hit, _, _ = brute_hits(text, [(i, t) for i, t in items])
        of = [i for i, t in items if brute_hits(text, [(i, t)])[1]]
        return n, hit, len(of), hashlib.sha256(",".join(sorted(str(i) for i in of if i is not None)).encode()).hexdigest()

    short = [(i, t) for i, t in rows if len(t or "") < 20_000]  # brute force is slow on the longest
    few = spark.createDataFrame(short, "doc_id long, text string")
    for block_bytes in (1 << 20, 20):
        got = decontaminate.decontaminate(few, bench, block_bytes=block_bytes)
        assert nulls_last((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in got.collect()) == nulls_last((i, *hits(t)) for i, t in short)
    got = suffix_dedup.remove_repeats(nasty).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], len(r["starts"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got)
    assert got == brute_repeats([(-1 if i is None else i, (t or "").encode()) for i, t in rows])
    sets = []
    for _, t in rows:
        w = WORD.findall(low(t))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    root = classes(range(len(rows)), links)
    names = {r: least_id(rows[i][0] for i in root if root[i] == r) for r in set(root.values())}
    want = nulls_last((rows[i][0], names[root[i]], sum(i in p for p in links), rows[i][0] == names[root[i]]) for i in range(len(rows)))
    assert nulls_last(tuple(r) for r in ngram_join.ngram_join(nasty).select("doc_id", "class_id", "n_links", "kept").collect()) == want
    kept = sorted(t or "" for _, t in ((r["doc_id"], r["text"]) for r in ngram_join.keep_one(nasty).collect()))
    assert len(kept) == len(set(root.values())) and [t for t in kept if not WORD.findall(low(t))] == sorted(t or "" for _, t in rows if not WORD.findall(low(t)))
    mixed = {(r["doc_id"], r["n_tokens"]) for r in mixing.mix_to_targets(nasty).collect()}
    assert mixed == {(i, len(re.findall(r"[^ \t\r\n]+", t or ""))) for i, t in rows}


def test_clashing_names(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name in "probability topic n_tokens tokens weight kept class_id n_links root y held_out predicted n_hit item_id blk bi bj part starts".split():
        docs = docs.withColumn(name, F.lit("?"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert 0 < out.count() <= docs.count(), name
        assert out.columns == docs.columns or name == corpus_pipeline.STAGES[-1][0], name


def test_learning_sample_is_bounded_by_ids(spark, labels):
    hot = spark.createDataFrame([(1, f"t{i}") for i in range(500)] + [(1, None), (2, None)], "doc_id long, text string")
    given = labels.where("doc_id in (1, 2) and quality is not null").where("doc_id <> 1 or quality = 1")
    got = labelled_sample(hot, given, "quality", F.lit(True), 10).collect()
    assert sorted((r["doc_id"], r["text"], r["y"]) for r in got) == [(1, "t0", 1), (2, None, 0)]


def words_of(text):
    """(word, clause) pairs; a clause ends at a mark or a new line."""
    return [(w, i) for i, part in enumerate(re.split(r"[\n!.:;?]", low(text))) for w in WORD.findall(part)]


def plain_toxicity(text, weight_of):
    """The features of a text by one loop over its words."""
    kind_of = {w: k for k, ws in toxicity.WORDS.items() for w in ws.split()}
    clauses = defaultdict(list)
    words = words_of(text)
    for w, c in words:
        clauses[c].append(w)
    total = most = 0.0
    insults = strong = negated = told = 0
    for ws in clauses.values():
        aimed, own, since, reported, meant, threat = any(kind_of.get(w) == "target" for w in ws), 0.0, 9, False, False, False
        for w in ws:
            k, x = kind_of.get(w), weight_of(w)
            since = 0 if k == "negation" else since + 1
            reported |= k == "reported"
            threat |= k == "harm" and meant
            meant |= k == "modal"
            if x:
                insults, strong, negated, told = insults + 1, strong + (x >= 5), negated + (since <= 3), told + reported
                own += x * (0.5 if since <= 3 else 1) * (0.7 if reported else 1) * (1.25 if aimed else 1)
        own += 4 * (0.7 if reported else 1) if threat and aimed else 0
        total, most = total + own, max(most, own)
    return np.log1p([total, most, insults, 100 * insults / max(1, len(words)), strong, negated, told])


def plain_logistic(model, x):
    if model.w is None:
        return model.prior
    e = [*x, *(x[i] * x[j] for i in range(len(x)) for j in range(i, len(x)))]
    z = sum(w * (v - m) / s for w, v, m, s in zip(model.w, e, model.mean, model.std, strict=False)) + model.w[-1]
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def held_out(i, by, rest):
    return i is not None and zlib.crc32(str(i).encode()) % by == rest


@pytest.fixture(scope="module")
def sample(spark):
    sf = "/root/testdata/sf0.01"
    extra = [(10**6 + i, t) for i, t in enumerate([None, "", "You will not die. He said they will kill you", "x" * 100_000, "word " * 40_000, "!!!", "no " * 50 + "idiot you"])]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    return docs, spark.read.parquet(f"{sf}/labels.parquet")


def test_toxicity_equals_plain_clause_scoring(spark, sample):
    docs, given = sample
    grammar, model = toxicity.learn(docs, given, toxicity.fold("doc_id", 3) != 1, 3000, 5000)
    assert len(grammar.hashes) > 5
    known = dict(zip(grammar.hashes.tolist(), grammar.weights.tolist(), strict=True))

    def weight_of(w):
        """The heaviest of the word and its prefixes, by the hashes of single words."""
        raw = w.encode()
        one = lambda b: int(toxicity.Words(np.frombuffer(b, np.uint8), np.array([0, len(b)])).spans(np.array([0]), np.array([len(b)]))[0])
        keys = [one(raw), *((one(raw[:n]) + n) % 2**64 for n in range(3, 9) if len(raw) > n)]
        return max(known.get(k, 0.0) for k in keys)

    cache = {}
    weight = lambda w: cache[w] if w in cache else cache.setdefault(w, weight_of(w))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = toxicity.score_toxicity(docs, given).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain_logistic(model, plain_toxicity(texts[r["doc_id"]], weight))
        assert abs(r["score"] - want) < 1e-9 and r["predicted"] == (r["score"] >= 0.7) and r["held_out"] == held_out(r["doc_id"], 3, 1)


def test_composed_transducers_against_each_alone():
    """The composition's weight and marks are those of the machines run one after another by hand."""
    rng = np.random.default_rng(0)
    parts = (toxicity.NEGATED, toxicity.TOLD, toxicity.AIMED, toxicity.THREAT)
    machine = Compiled(toxicity.GRAMMAR)
    kinds, weights, clause, want = [], [], [], []
    for c in range(400):
        k = rng.choice(len(KINDS), int(rng.integers(1, 20)), p=[0.6, 0.08, 0.08, 0.08, 0.08, 0.08]).tolist()
        w = [float(rng.random()) * 6 if rng.random() < 0.3 else 0.0 for _ in k]
        total = 0.0
        for starts in itertools.product(*(m.start for m in parts)):
            states, own = list(starts), 0.0
            for x, y in zip(k, w, strict=True):
                states = [None if s is None else m.step(s, KINDS[x]) for m, s in zip(parts, states, strict=True)]
                own += y * math.prod(m.marks.get(s, ("", 1.0))[1] for m, s in zip(parts, states, strict=True))
            if all(s in m.final for m, s in zip(parts, states, strict=True)):
                total += own + math.prod(m.final[s] for m, s in zip(parts, states, strict=True))
        want.append(total)
        kinds, weights, clause = kinds + k, weights + w, clause + [c] * len(k)
    got, _ = machine(np.array(kinds, np.int8), np.array(weights), np.array(clause))
    assert np.allclose(got, want)


def test_quality_equals_plain_size_differences(spark, sample):
    import zstandard

    docs, given = sample
    sizes, model = quality.learn(docs, given, quality.fold("doc_id", 5) != 0, 1500, 112 << 10, 2048, 3)
    packers = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False) for d in sizes.raw]
    both = lambda x: [len(p.compress(x)) for p in packers]

    def plain(text):
        raw = (text or "").encode()
        if not raw:
            return [0.0] * 7
        pieces = [raw[i : i + 2048] for i in range(0, len(raw), 2048)]
        if len(pieces) > 1 and len(pieces[-1]) < 512:
            pieces[-1] = raw[-2048:]
        d = [(g - b) / max(g, b) for g, b in map(both, pieces)]
        r = [min(both(x)) / len(x) for x in pieces]
        g, b = both(raw)
        return [(g - b) / max(g, b), max(d), min(d), sum(d) / len(d), min(g, b) / len(raw), min(r), sum(r) / len(r)]

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = quality.score_quality(docs, given).collect()
    assert len(got) == len(texts)
    for r in got:
        assert abs(r["score"] - plain_logistic(model, plain(texts[r["doc_id"]]))) < 1e-9 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == held_out(r["doc_id"], 5, 0)
    kept = {r["doc_id"] for r in quality.keep_good(docs, given).collect()}
    assert kept == {r["doc_id"] for r in got if r["predicted"]}


def test_other_tokenizers_are_refused(spark, tmp_path, monkeypatch):
    import json

    with open(token_counts.resolve("byte_bpe_50k.json")) as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(spec))
    monkeypatch.setattr(token_counts, "resolve", lambda name: str(tmp_path / name))
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.count_tokens(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "other.json")


@pytest.mark.parametrize("name,label", [("op9_quality", "quality"), ("op4_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    from plumbline.llm.queries import queries

    sf = "/root/testdata/sf0.1"
    out = queries()[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").where(F.col(label).isNotNull())
    right = out.where(F.col("predicted") == F.col(label)).count() / out.count()
    assert right > 0.97


def test_pipeline_stages_keep_their_columns(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert set(docs.columns) <= set(out.columns) and 0 < out.count() <= docs.count(), name
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_quality_learns_from_bounded_bytes(spark):
    rows = [(i, ("good text " if i % 2 else "bad <x> ") * (40 if i % 7 else 4000), i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    given = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    sample = labelled_sample(docs, given, "quality", F.lit(True), 100)
    size = {i: len(t) for i, t, _ in rows}
    assert sorted(quality.fitting(sample, 1 << 20)) == list(range(60))
    few = quality.fitting(sample, 5000)
    assert few == quality.fitting(sample.repartition(5), 5000)
    assert all(sum(size[i] for i in few if i % 2 == y) <= 5000 for y in (0, 1)) and {i % 2 for i in few} == {0, 1}
    assert quality.fitting(sample, 10) == []
    for most in (5000, 10):  # every row gets a score, of the share alone if nothing fits
        got = quality.score_rows(docs, given, folds=1000, held=999, most_bytes=most).collect()
        assert len(got) == 60 and all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize("odd", [{}, {"lstrip": True}, {"single_word": True}])
def test_added_tokens_count_as_the_library_takes_them(tmp_path, monkeypatch, odd):
    import json

    from tokenizers import Tokenizer

    with open(token_counts.resolve("byte_bpe_50k.json")) as f:
        spec = json.load(f)
    plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
    spec["added_tokens"] += [{"id": 50257, "content": "<|end|>", "special": True, **plain}, {"id": 50258, "content": "<|end|>more", "special": False, **plain}, {"id": 50259, "content": "foo", "special": False, **plain, **odd}]
    path = tmp_path / "added.json"
    path.write_text(json.dumps(spec))
    monkeypatch.setattr(token_counts, "resolve", lambda name: str(path))
    counts, tok = token_counts.Counts("added.json", {}), Tokenizer.from_file(str(path))
    for text in ("a <|end|>more b", "x  foo y food  foo", "<|endoftext|><|end|>foo<|end|>more", "no marks at all", "foo", " <|end|> \n foo! "):
        assert counts.text(text) == len(tok.encode(text, add_special_tokens=False)), text
