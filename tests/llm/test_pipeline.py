"""The pipeline against a plain version of its five stages, one after another."""

import hashlib
import itertools
import math
import re
from collections import defaultdict

from pyspark.sql import functions as F
from test_operators import WORD, classes, low, plain_links, plain_logistic, plain_raking

from plumbline.llm import mixing, quality, secret_scan


def plain_quality(sizes, model, text):
    import zstandard

    packers = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False) for d in sizes.raw]
    both = lambda x: [len(p.compress(x)) for p in packers]
    raw = (text or "").encode()
    if not raw:
        return plain_logistic(model, [0.0] * 7)
    pieces = [raw[i : i + 2048] for i in range(0, len(raw), 2048)]
    if len(pieces) > 1 and len(pieces[-1]) < 512:
        pieces[-1] = raw[-2048:]
    d = [(g - b) / max(g, b) for g, b in map(both, pieces)]
    r = [min(both(x)) / len(x) for x in pieces]
    g, b = both(raw)
    return plain_logistic(model, [(g - b) / max(g, b), max(d), min(d), sum(d) / len(d), min(g, b) / len(raw), min(r), sum(r) / len(r)])


def without_copies(rows):
    sets = []
    for r in rows:
        w = WORD.findall(low(r["text"]))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    where, shared = defaultdict(list), defaultdict(int)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    for ids in where.values():
        for pair in itertools.combinations(ids, 2):
            shared[pair] += 1
    links = [(a, b) for (a, b), n in shared.items() if 9 * n >= 4 * (len(sets[a]) + len(sets[b]))]
    root = classes(range(len(rows)), links)
    return [min((rows[i] for i in root if root[i] == r), key=lambda r: r["doc_id"]) for r in sorted(set(root.values()))]


def windows(words, n):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def without_secrets(text):
    if text is None:
        return None
    kinds = (("assign", re.compile(secret_scan.ASSIGN), lambda m: len(m[2]) >= 6), ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24))
    spans = sorted(tuple(map(int, x.split(":")[1:])) for x in plain_links(text, kinds).split(",") if x)
    cut, at = "", 0
    for s, e in spans:
        cut, at = cut + (text[at:s] + "[SECRET]" if s >= at else ""), max(at, e)
    return cut + text[at:]


def form(text, n):
    if n == 0:
        return "empty"
    if len(re.findall(mixing.DATA, text)) * 33 >= len(text):
        return "data"
    return "short" if n < 100 else "long" if n > 600 else "prose"


def test_pipeline_against_plain_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    table = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    docs, labels = table("documents"), table("labels")
    rows = [r.asDict() for r in docs.collect()]
    assert len({r["doc_id"] for r in rows}) == len(rows)
    sizes, model = quality.learn(docs, labels, quality.fold("doc_id", 5) != 0, 1500, 112 << 10, 2048, 3)
    rows = [r for r in rows if plain_quality(sizes, model, r["text"]) >= 0.3]
    rows = without_copies(rows)
    by = defaultdict(set)
    for r in table("benchmark").collect():
        w = WORD.findall(low(r["text"]))
        by[min(len(w), 10)] |= windows(w, min(len(w), 10)) if w else set()
    rows = [r for r in rows if not any(windows(WORD.findall(low(r["text"])), n) & known for n, known in by.items() if n)]
    for r in rows:
        clean = without_secrets(r["text"])
        if clean != r["text"]:
            r["text"], r["n_chars"] = clean, len(clean)
        r["n"] = len(re.findall(r"[^ \t\r\n]+", r["text"] or ""))
        r["cell"] = (r["source"] or "", r["lang"] or "", form(r["text"] or "", r["n"]))
    cells = defaultdict(float)
    for r in rows:
        cells[r["cell"]] += r["n"]
    p = plain_raking({k: x for k, x in cells.items() if x}, [mixing.TARGETS[m] for m in mixing.MARGINS], 0.5)
    u = lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:12], 16) / 2**48
    want = sorted((r["doc_id"], r["text"], r["n_chars"], r["cell"], r["n"]) for r in rows if u(r["doc_id"]) < round(p.get(r["cell"], 0.0), 9))
    out = corpus_pipeline.run(spark, sf).collect()
    got = sorted((r["doc_id"], r["text"], r["n_chars"], (r["source"], r["lang"], r["topic"]), r["n_tokens"]) for r in out)
    assert len(want) > 20 and got == want
    assert all(math.isclose(r["probability"], p[r["source"], r["lang"], r["topic"]], abs_tol=1e-6) for r in out)


def test_pipeline_keeps_unrelated_rows_without_ids(spark):
    """Clean rows with null or repeated ids all pass the stages that filter."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, sf)
    alike = kept.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, 7).otherwise(F.col("doc_id")))
    for stage in (corpus_pipeline.STAGES[1][1], corpus_pipeline.STAGES[2][1]):
        want = sorted(r["text"] for r in stage(spark, kept, sf).select("text").collect())
        got = [r["text"] for r in stage(spark, alike, sf).select("text").collect()]
        if stage is corpus_pipeline.STAGES[2][1]:
            assert sorted(got) == want
        else:  # which row of a class stays is by id; the number of classes is not
            assert len(got) == len(want)


def test_pipeline_leaves_one_table(spark):
    """What the stages cut on their way, and the rows of all stages but the last, are deleted."""
    import os

    import corpus_pipeline
    from plumbline.session import shared_folder

    home = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(home)) if os.path.exists(home) else set()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert len(set(os.listdir(home)) - before) == 1 and out.count() > 0
