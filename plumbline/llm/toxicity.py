"""Toxicity by a weighted finite-state pattern grammar.

Words are read as kinds: target, negation, reported speech, modal, harm or other, and as insults by
stems with learned weights.  Four weighted transducers read a clause (``NEGATED``, ``TOLD``, ``AIMED``,
``THREAT``, below, as data) and are composed into one machine, whose run gives the clause's weight: an
insult counts half within three words after a negation, 0.7 of it in reported speech, and a quarter
more where the clause has a target, before or after it (the machine follows both readings, and only
the true one is accepted); a modal and then a verb of harm, with a target, add a threat.  A text's
clause weights, and the number of its strongest insults, become a score by logistic regression.

Insult stems are learned: words and their prefixes of 3 to 8 bytes whose document frequency differs
between toxic and other labelled rows.  Learning takes at most ``per_class`` rows of each class,
chosen by a hash of doc_id; one half gives the stems and the other the calibration.  Null and empty
texts have no clauses and get the score of a text without matches; texts are read whole; repeated
rows are scored row by row; with no labels, or of one class, every score is that class's share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, Words, fold, labelled_sample, prepare, slices, utf8
from .decontaminate import among
from .logistic import Logistic
from .transducers import ANY, KINDS, Compiled, Transducer, compose

#: Words of each kind.
WORDS = {
    "target": "you your yours he she they them him her people everyone ihr du dich sie vous tu toi usted ustedes",
    "negation": "not no never isn aren don doesn nicht kein keine pas jamais nunca",
    "reported": "said says wrote claimed quoted reported called sagte schrieb dit écrit dijo escribió",
    "modal": "will gonna shall should hope werde voy vais",
    "harm": "kill hurt die destroy punish beat töten tuer matar",
}
#: A negation reaches the three words after it.
NEGATED = Transducer(
    ("free",),
    {("free", ANY): "free", ("n0", ANY): "n1", ("n1", ANY): "n2", ("n2", ANY): "n3", ("n3", ANY): "free", **{(s, "negation"): "n0" for s in ("free", "n0", "n1", "n2", "n3")}},
    {s: ("n", 0.5) for s in ("n0", "n1", "n2", "n3")},
    dict.fromkeys(("free", "n0", "n1", "n2", "n3"), 1.0),
)
#: Reported speech lasts to the end of the clause; a threat in it counts less too.
TOLD = Transducer(("own",), {("own", "reported"): "told", ("own", ANY): "own", ("told", ANY): "told"}, {"told": ("r", 0.7)}, {"own": 1.0, "told": 0.7})
#: Two readings: a target comes (or came), or there is none; a threat needs one.
AIMED = Transducer(
    ("awaited", "none"),
    {("awaited", "target"): "aimed", ("awaited", ANY): "awaited", ("aimed", ANY): "aimed", **{("none", k): "none" for k in KINDS if k != "target"}},
    {"awaited": ("t", 1.25), "aimed": ("t", 1.25)},
    {"aimed": 1.0, "none": 0.0},
)
THREAT = Transducer(("calm",), {("calm", "modal"): "meant", ("calm", ANY): "calm", ("meant", "harm"): "threat", ("meant", ANY): "meant", ("threat", ANY): "threat"}, {}, {"calm": 0.0, "meant": 0.0, "threat": 4.0})
GRAMMAR = compose(compose(NEGATED, TOLD), compose(AIMED, THREAT))
STRONG = 5.0  # of an insult's weight
LENGTHS = range(3, 9)
CLAUSE = np.zeros(256, np.int64)
CLAUSE[[10, 33, 46, 58, 59, 63]] = 1
FEATURES = 7


def word_hashes(words: str) -> np.ndarray:
    raw = np.frombuffer(words.encode(), np.uint8)
    return np.sort(Words(raw, np.array([0, len(raw)])).hash)


def stems(ws: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(salt, word places, hashes) of whole words (salt 0) and of each prefix length."""
    every = np.arange(len(ws))
    yield 0, every, ws.hash
    size = ws.end - ws.start
    for n in LENGTHS:
        long = np.flatnonzero(size > n)
        yield n, long, ws.spans(ws.start[long], ws.start[long] + n) + np.uint64(n)


class Grammar:
    def __init__(self, weights: dict[int, float]):
        self.hashes = np.sort(np.fromiter(weights, np.uint64, len(weights)))
        self.weights = np.array([weights[int(h)] for h in self.hashes])
        self.fixed = {KINDS.index(k): word_hashes(w) for k, w in WORDS.items()}
        self.machine = Compiled(GRAMMAR)

    def insults(self, ws: Words) -> np.ndarray:
        """The weight of each word: that of its heaviest stem, or 0."""
        out = np.zeros(len(ws))
        if len(self.hashes):
            for _, places, h in stems(ws):
                at = np.searchsorted(self.hashes, h)
                at[at == len(self.hashes)] = 0
                ok = self.hashes[at] == h
                np.maximum.at(out, places[ok], self.weights[at[ok]])
        return out

    def __call__(self, ws: Words) -> np.ndarray:
        """The features of each text: weight of its clauses, of the heaviest, insults, insults in 100 words, strong insults, negated, reported (log1p of each)."""
        out = np.zeros((len(ws.offs) - 1, FEATURES))
        if not len(ws):
            return out
        weights = self.insults(ws)
        kinds = np.zeros(len(ws), np.int8)
        for c, h in self.fixed.items():
            kinds[among(ws.hash, h)] = c
        seed = (weights > 0) | (kinds == KINDS.index("harm"))
        if not seed.any():
            return out
        doc = ws.doc()
        clause = np.concatenate([[0], np.cumsum(CLAUSE[ws.data])])[ws.start] + doc  # a new text is a new clause
        wanted = among(clause, np.unique(clause[seed]))  # a clause without insult or harm weighs nothing
        kinds, weights, clause, doc = kinds[wanted], weights[wanted], clause[wanted], doc[wanted]
        total, marks = self.machine(kinds, weights, clause)
        first = np.flatnonzero(np.r_[True, clause[1:] != clause[:-1]])
        of = doc[first]
        add = lambda column, values, where: np.add.at(out[:, column], where, values)
        add(0, total, of)
        np.maximum.at(out[:, 1], of, total)
        add(2, weights > 0, doc)
        add(4, weights >= STRONG, doc)
        add(5, marks["n"], of)
        add(6, marks["r"], of)
        out[:, 3] = 100 * out[:, 2] / np.maximum(1, np.diff(ws.first))
        return np.log1p(out)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, toxic documents, other documents) of each task's texts."""
    for b in batches:
        data, offs = utf8(b.column("text"))
        y = b.column("y").to_numpy(zero_copy_only=False)
        for lo, hi in slices(offs):
            ws = Words(data, offs[lo : hi + 1])
            doc = ws.doc()
            found = []
            for _, places, h in stems(ws):
                order = np.lexsort((doc[places], h))
                h, d = h[order], doc[places][order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                found.append((h[new], y[lo + d[new]]))
            h = np.concatenate([f[0] for f in found])
            toxic = np.concatenate([f[1] for f in found])
            keys, at = np.unique(h, return_inverse=True)
            n1, n = np.bincount(at, toxic, len(keys)).astype(np.int64), np.bincount(at, minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n1), pa.array(n - n1)], ["stem", "n1", "n0"])


def learn(docs: DataFrame, labels: DataFrame, keep, per_class: int, most_stems: int) -> tuple[Grammar, Logistic]:
    cut = Cut(docs.sparkSession)
    sample = cut(labelled_sample(docs, labels, "toxic", keep, per_class)).where("text is not null")  # documents are read for it once
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    first = sample.where(half == 0)
    sizes = {r["y"]: r["n"] for r in first.groupBy("y").agg(F.count("*").alias("n")).collect()}
    t, o = sizes.get(1, 0), sizes.get(0, 0)
    counts = first.select("text", "y").mapInArrow(_count, "stem long, n1 long, n0 long").groupBy("stem").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    ratio = F.log((F.col("n1") + 0.1) / (t + 1.0)) - F.log((F.col("n0") + 0.1) / (o + 1.0))
    chosen = counts.where(F.col("n1") >= max(3, t // 500)).withColumn("w", ratio).where("w > 2.5").orderBy(F.desc(F.col("n1") * F.col("w")), "stem").limit(most_stems).collect() if t and o else []
    grammar = Grammar({r["stem"] % (1 << 64): float(min(r["w"], 6.0)) for r in chosen})
    totals = {r["y"]: r["n"] for r in labels.where(keep & F.col("toxic").isin(0, 1)).groupBy(F.col("toxic").alias("y")).agg(F.count("*").alias("n")).collect()}
    prior = totals.get(1, 0) / max(1, sum(totals.values())) if totals else 0.5
    schema = "y int, f array<double>"
    rest = sample.where(half == 1).select("text", F.col("y").cast("int").alias("y")).mapInArrow(_features(docs.sparkSession.sparkContext.broadcast(grammar)), schema).collect()
    rest = sorted((r["y"], r["f"]) for r in rest)
    cut.drop()
    return grammar, Logistic(np.array([f for _, f in rest]).reshape(-1, FEATURES), np.array([y for y, _ in rest], float), prior)


def _features(grammar, model=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = utf8(b.column("text"))
            x = [grammar.value(Words(data, offs[lo : hi + 1])) for lo, hi in slices(offs)]
            x = np.concatenate(x) if x else np.zeros((0, FEATURES))
            names = [n for n in b.schema.names if n != "text"]
            out = pa.array(model.value(x), pa.float64()) if model else pa.array(x.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), out], [*names, "score" if model else "f"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 3, held: int = 1, per_class: int = 3000, most_stems: int = 5000) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each input row."""
    spark = prepare(docs.sparkSession)
    grammar, model = learn(docs, labels, fold("doc_id", folds) != held, per_class, most_stems)
    share = spark.sparkContext.broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(_features(share(grammar), share(model)), "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
