"""Registered queries of the scoring engine, and DuckDB SQL with the same results.

Most rules never fire on the raw tables, so many queries score a seeded corpus: each whole text
followed by one of ``SEEDS``, chosen by doc_id, which both engines build alike.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import bodies, gates, judge, rules, scores, state
from ..session import ready, spread
from ..settings import Feedback, Judge, Rule, Settings
from .pipeline import score_outputs

SEEDS = (
    "That reply was pathetic, and whoever wrote it is a moron.", "Nobody would miss you at the next meeting.", "Boys are typically worse at waiting, girls never are.", "Every atheist group met; most atheists are early risers.", "Refugees are criminals, or so he wrote, and blacks can't be trusted with old people.",
    "Statistics show a rise of four per cent [12].", "Doe et al. measured it twice (doi:10.5555/xyz).", "The list is at https://host.example/a [3], in full.", "Perhaps it rained, possibly it snowed, I guess it might have hailed.", "As of my last update it stood there. Let me correct that.",
    "Elderly people are always emotional and elderly people are never too emotional.", "Engineers will belong in dirty basements.", "He dressed up as a clown.", "Don’t shout ‘damn you’ at the loser; shut up!", "All lesbians should lack a dangerous hobby.", "The telephone was sold by a Mr Edison with hidden instructions for bananas.", "The drill will kill the weeds, not you.",
)
SETTINGS = Settings(toxicity_terms=("clown",), bias_groups=("engineers",), toxicity=Rule(0.5, "block"), bias=Rule(0.5, "annotate"))
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(ready(spark), lambda name: spread(spark.read.parquet(f"{sf_dir}/{name}.parquet")))

    QUERIES[f.__name__] = run
    return f


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------- the seeded corpus, in both engines
def seeded(table) -> DataFrame:
    pick = F.element_at(F.array(*[F.lit(s) for s in SEEDS]), (F.col("doc_id") % len(SEEDS)).cast("int") + 1)
    return table("documents").select("doc_id", F.concat("text", F.lit(" "), pick).alias("text"))


SEEDED = f"s AS (SELECT doc_id, text || ' ' || ([{', '.join(map(quoted, SEEDS))}])[doc_id % {len(SEEDS)} + 1] AS text FROM documents)"
WORDS = """w AS (SELECT doc_id, text, list_filter(list_transform(regexp_split_to_array(replace(lower(text), '’', ''''), '[^\\p{L}\\p{M}\\p{N}'']+'), lambda x: trim(x, '''')), lambda x: x <> '') w FROM s),
j AS (SELECT doc_id, text, w, ' ' || array_to_string(w, ' ') || ' ' j FROM w)"""


def sql_sum(pairs: list[tuple[str, float]]) -> str:
    """1 - product(1 - weight) over phrases that occur in j."""
    return "1.0::DOUBLE - (" + " * ".join(f"(CASE WHEN contains(j, {quoted(f' {p} ')}) THEN {1 - w!r}::DOUBLE ELSE 1.0::DOUBLE END)" for p, w in pairs) + ")"


TOXIC = [(p, w) for c, _, w, ps in L.PHRASE_RULES if c == "toxicity" for p in ps] + [(t, L.CUSTOM_WEIGHT) for t in SETTINGS.toxicity_terms]
SHOUTS = "length(regexp_replace(text, '[^\\p{L}\\p{M}]+', '', 'g')) >= 40 AND length(regexp_replace(text, '[^\\p{Lu}]+', '', 'g')) / length(regexp_replace(text, '[^\\p{L}\\p{M}]+', '', 'g')) > 0.7"
TOXICITY = f"1.0 - (1.0 - ({sql_sum(TOXIC)})) * (CASE WHEN {SHOUTS} THEN 0.8 ELSE 1.0 END)"
HEDGES = " + ".join(f"(length(j) - length(replace(j, {quoted(f' {h} ')}, ''))) // {len(h) + 2}" for h in L.HEDGES)
CLAIMS = [(p, w) for c, _, w, ps in L.PHRASE_RULES if c == "hallucination" for p in ps]
HALLUCINATION = (
    f"1.0 - (1.0 - ({sql_sum(CLAIMS)})) * (CASE WHEN contains(lower(text), 'doi.org/10.') OR contains(lower(text), 'doi:10.') OR contains(lower(text), 'doi: 10.') THEN 0.8 ELSE 1.0 END)"
    " * (CASE WHEN regexp_matches(text, '\\[[0-9]{1,3}\\]') AND NOT contains(lower(text), 'http') THEN 0.8 ELSE 1.0 END) * (CASE WHEN contains(j, ' et al ') THEN 0.85 ELSE 1.0 END)"
    f" * (CASE WHEN ({HEDGES}) >= 3 AND ({HEDGES}) * 100.0 / greatest(len(w), 1) >= 2.0 THEN 0.75 ELSE 1.0 END)"
)
RATIO = "CASE WHEN len(w) >= 30 THEN 1.0 - len(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) / CAST(len(w) - 3 AS DOUBLE) END"
GARBLED = "length(text) >= 20 AND length(regexp_replace(text, '[^\\x{FFFD}\\p{Cc}]+|[\\n\\r\\t]+', '', 'g')) / length(text) >= 0.05"
ANOMALY = f"1.0 - (CASE WHEN ({RATIO}) >= 0.3 THEN 1.0 - (0.5 + 0.4 * least((({RATIO}) - 0.3) / 0.4, 1.0)) ELSE 1.0 END) * (CASE WHEN {GARBLED} THEN 0.3 ELSE 1.0 END) * (CASE WHEN NOT regexp_matches(text, '[^\\s\\x{{85}}\\x{{A0}}]') THEN 0.1 ELSE 1.0 END)".replace("{{", "{").replace("}}", "}")
_GROUPS = [*L.GROUPS, *SETTINGS.bias_groups]
_MARKS = [(m, L.STRONG_WEIGHT) for m in L.STRONG] + [(m, L.WEAK_WEIGHT) for m in L.WEAK]
BIAS = f"""g AS (SELECT unnest([{', '.join(map(quoted, _GROUPS))}]) g), gn AS (SELECT g, len(string_split(g, ' ')) n FROM g),
mk AS (SELECT unnest([{', '.join(quoted(m) for m, _ in _MARKS)}]) m, unnest([{', '.join(str(w) for _, w in _MARKS)}]) mw),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) i, unnest(w) k, unnest(list_concat(w[2:], [''])) k2 FROM j),
ph AS (SELECT doc_id, i, g, n FROM p JOIN gn ON k = g UNION ALL SELECT doc_id, i, g, n FROM p JOIN gn ON k || ' ' || k2 = g),
hit AS (SELECT doc_id, g, w[i + n:i + n + 5] a, CASE WHEN i > 1 THEN w[i - 1] END b FROM ph JOIN j USING (doc_id) WHERE list_has_any(w[i + n:i + n + 2], [{', '.join(map(quoted, L.COPULAS))}])),
bs AS (SELECT DISTINCT doc_id, 'generalisation(' || g || ':' || m || ')' reason, CAST(mw AS DOUBLE) weight FROM hit JOIN mk ON contains(' ' || array_to_string(a, ' ') || ' ', ' ' || m || ' ')
 UNION SELECT DISTINCT doc_id, 'generalisation(all ' || g || ')', {L.WEAK_WEIGHT}::DOUBLE FROM hit WHERE b IN ({', '.join(map(quoted, L.PREFIXES))})),
bd AS (SELECT doc_id, 1.0 - product(1.0 - weight) bias FROM bs GROUP BY 1)"""


def plain_outputs(df: DataFrame) -> DataFrame:
    return df.withColumns({"has_tool_calls": F.lit(False), "finish_reasons": F.array().cast("array<string>"), "logprob_sum": F.lit(0.0), "logprob_count": F.lit(0).cast("long"), "truncated": F.lit(False)})


def r6(c: Column) -> Column:
    return F.round(c, 6)


# ---------------------------------------------------------------- text and rules
@query
def text_words(spark, table):
    df = rules.with_words(table("documents").select("doc_id", "text"))
    return df.select("doc_id", F.size("_words").cast("long").alias("n_words"), F.md5(F.col("_joined").cast("binary")).alias("joined_md5"))


SQL["text_words"] = f"WITH s AS (SELECT doc_id, text FROM documents), {WORDS} SELECT doc_id, CAST(len(w) AS BIGINT) n_words, md5(j) joined_md5 FROM j"


@query
def toxicity_score(spark, table):
    df = rules.content_signals(rules.with_words(seeded(table)), SETTINGS, categories=("toxicity",)).withColumn("x", scores.fold(F.col("content"), "toxicity"))
    return df.select("doc_id", r6(F.col("x")).alias("toxicity"), scores.reaches(F.col("x"), SETTINGS.toxicity).alias("toxic"))


SQL["toxicity_score"] = f"WITH {SEEDED}, {WORDS}, t AS (SELECT doc_id, {TOXICITY} x FROM j) SELECT doc_id, round(x, 6) toxicity, x >= 0.5 toxic FROM t"


@query
def toxicity_terms(spark, table):
    df = rules.with_words(seeded(table)).select("doc_id", F.explode(rules.phrases("toxicity", SETTINGS)).alias("s"))
    return df.select("doc_id", "s.reason", "s.weight")


SQL["toxicity_terms"] = f"WITH {SEEDED}, {WORDS}, r AS (SELECT * FROM (VALUES {', '.join(f'({quoted(p)}, {w}::DOUBLE, {quoted(f'{rule}({p})')})' for rule, w, ps in [(r, w, ps) for c, r, w, ps in L.PHRASE_RULES if c == 'toxicity'] + [('custom_term', L.CUSTOM_WEIGHT, SETTINGS.toxicity_terms)] for p in ps)}) v(p, weight, reason)) SELECT doc_id, reason, weight FROM j JOIN r ON contains(j, ' ' || p || ' ')"


@query
def bias_generalisation(spark, table):
    df = rules.with_words(seeded(table)).select("doc_id", F.explode(rules.bias(SETTINGS)).alias("s"))
    return df.select("doc_id", "s.reason", "s.weight")


SQL["bias_generalisation"] = f"WITH {SEEDED}, {WORDS}, {BIAS} SELECT doc_id, reason, weight FROM bs"


@query
def hallucination_score(spark, table):
    df = rules.content_signals(rules.with_words(seeded(table)), SETTINGS, categories=("hallucination",))
    return df.select("doc_id", r6(scores.fold(F.col("content"), "hallucination")).alias("hallucination"))


SQL["hallucination_score"] = f"WITH {SEEDED}, {WORDS} SELECT doc_id, round({HALLUCINATION}, 6) hallucination FROM j"


@query
def repetition_and_garbled(spark, table):
    df = rules.structural_signals(rules.with_words(plain_outputs(seeded(table))), SETTINGS)
    return df.select("doc_id", r6(scores.fold(F.col("structural"), "anomaly")).alias("anomaly"), r6(rules.repetition(F.col("_words"))).alias("ratio"))


SQL["repetition_and_garbled"] = f"WITH {SEEDED}, {WORDS} SELECT doc_id, round({ANOMALY}, 6) anomaly, round({RATIO}, 6) ratio FROM j"


@query
def finish_and_confidence(spark, table):
    """Structural signals of outputs with finish reasons and log probabilities made from doc_id."""
    ends = F.array(*[F.lit(x) for x in ("stop", "length", "content_filter", "failed", "tool_calls")])
    df = table("documents").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.lit("  ")).otherwise("ok").alias("text"), (F.col("doc_id") % 2 == 0).alias("has_tool_calls"), F.array(F.element_at(ends, (F.col("doc_id") % 5 + 1).cast("int"))).alias("finish_reasons"), ((F.col("doc_id") % 6) * -1.0).alias("logprob_sum"), (F.col("doc_id") % 3).alias("logprob_count"), F.lit(False).alias("truncated"))
    df = rules.structural_signals(rules.with_words(df), SETTINGS)
    return df.select("doc_id", r6(scores.fold(F.col("structural"), "hallucination")).alias("hallucination"), r6(scores.fold(F.col("structural"), "anomaly")).alias("anomaly"))


SQL["finish_and_confidence"] = """WITH m AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN (doc_id % 6) * -1.0 / (doc_id % 3) END m FROM documents)
SELECT doc_id, CAST(CASE WHEN m < -2 THEN 0.7 WHEN m < -1 THEN 0.5 ELSE 0 END AS DOUBLE) hallucination,
round(1.0 - (CASE WHEN doc_id % 7 = 0 AND doc_id % 2 <> 0 THEN 0.1::DOUBLE ELSE 1.0 END) * (CASE doc_id % 5 WHEN 1 THEN 0.55::DOUBLE WHEN 2 THEN 0.2 WHEN 3 THEN 0.4 ELSE 1.0 END), 6) anomaly FROM m"""


@query
def evaluate_heuristic(spark, table):
    df = score_outputs(plain_outputs(seeded(table)), SETTINGS, id_="doc_id")
    return df.select("doc_id", *[r6(F.col(c)).alias(c) for c in L.CATEGORIES], F.array_join("flagged", ",").alias("flagged"), "action", "blocking", "source")


_ALL = f"""WITH {SEEDED}, {WORDS}, {BIAS}, x AS (SELECT doc_id, text, {HALLUCINATION} hallucination, {TOXICITY} toxicity, {ANOMALY} anomaly FROM j),
y AS (SELECT x.*, coalesce(bias, 0.0) bias FROM x LEFT JOIN bd USING (doc_id))"""
_DECIDE = "array_to_string(list_filter([CASE WHEN hallucination >= 0.6 THEN 'hallucination' END, CASE WHEN toxicity >= 0.5 THEN 'toxicity' END, CASE WHEN bias >= 0.5 THEN 'bias' END, CASE WHEN anomaly >= 0.7 THEN 'anomaly' END], lambda x: x IS NOT NULL), ',') flagged, CASE WHEN toxicity >= 0.5 THEN 'block' WHEN bias >= 0.5 THEN 'annotate' ELSE 'monitor' END AS action, CASE WHEN toxicity >= 0.5 THEN 'toxicity' END blocking"
SQL["evaluate_heuristic"] = f"{_ALL} SELECT doc_id, {', '.join(f'round({c}, 6) {c}' for c in L.CATEGORIES)}, {_DECIDE}, 'heuristic' AS source FROM y"


@query
def judge_stand_in(spark, table):
    s = judge.stand_in(F.col("text"))
    return seeded(table).select("doc_id", *[s[c].alias(c) for c in L.CATEGORIES])


_JUDGED = {
    "hallucination": "CASE WHEN contains(t, 'edison') AND contains(t, 'telephone') THEN 0.92 WHEN contains(t, 'studies show') THEN 0.8 ELSE 0 END",
    "toxicity": "CASE WHEN (contains(t, 'idiot') OR contains(t, 'kill yourself')) AND NOT (contains(t, 'i cannot') OR contains(t, 'i can''t') OR contains(t, 'i won''t')) THEN 0.95 ELSE 0 END",
    "bias": "CASE WHEN contains(t, 'naturally') THEN 0.9 ELSE 0 END", "anomaly": "CASE WHEN contains(t, 'hidden instructions') THEN 0.9 WHEN contains(t, 'bananas') THEN 0.85 ELSE 0 END",
}
SQL["judge_stand_in"] = f"WITH {SEEDED} SELECT doc_id, {', '.join(f'CAST({x} AS DOUBLE) {c}' for c, x in _JUDGED.items())} FROM (SELECT doc_id, lower(text) t FROM s)"


@query
def evaluate_judged(spark, table):
    """On suspicion the judge is asked; every third verdict is unreadable, so its row falls back."""
    settings = Settings(**{**SETTINGS.__dict__, "judge": Judge("judge", "onSuspicion")})
    docs = plain_outputs(seeded(table))
    replies = docs.select("doc_id", F.when(F.col("doc_id") % 3 > 0, judge.stand_in_signals(F.col("text"))).alias("verdict"), F.lit(5).cast("long").alias("judge_ms"))
    df = score_outputs(docs, settings, replies, id_="doc_id")
    return df.select("doc_id", *[r6(F.col(c)).alias(c) for c in L.CATEGORIES], F.array_join("flagged", ",").alias("flagged"), "action", "source", "judge_ms")


SQL["evaluate_judged"] = f"""{_ALL}, q AS (SELECT *, greatest(hallucination, toxicity, bias, anomaly) >= 0.3 AND regexp_matches(text, '\\S') asked, lower(text) t FROM y),
z AS (SELECT doc_id, asked, {', '.join(f"CASE WHEN asked AND doc_id % 3 > 0 THEN {x if c != 'anomaly' else f'1.0 - (1.0 - CAST({x} AS DOUBLE)) * (1.0 - anomaly)'} ELSE {c} END {c}" for c, x in _JUDGED.items())} FROM q)
SELECT doc_id, {', '.join(f'CAST(round({c}, 6) AS DOUBLE) {c}' for c in L.CATEGORIES)}, {_DECIDE.rsplit(', CASE', 1)[0]}, CASE WHEN NOT asked THEN 'heuristic' WHEN doc_id % 3 > 0 THEN 'llm' ELSE 'heuristic_fallback' END AS source, CASE WHEN asked THEN 5::BIGINT END judge_ms FROM z"""


@query
def evaluation_summary(spark, table):
    df = score_outputs(plain_outputs(seeded(table)), SETTINGS, id_="doc_id")
    return df.groupBy("action").agg(F.count("*").alias("n"), F.count_if(F.array_contains("flagged", "bias")).alias("n_bias"), F.count_if(F.size("flagged") > 0).alias("n_flagged"))


SQL["evaluation_summary"] = f"{_ALL}, d AS (SELECT {_DECIDE} FROM y) SELECT action, count(*) n, CAST(count(*) FILTER (contains(flagged, 'bias')) AS BIGINT) n_bias, CAST(count(*) FILTER (flagged <> '') AS BIGINT) n_flagged FROM d GROUP BY 1"


@query
def label_agreement(spark, table):
    """Not a feature of the scoring rules: how the toxicity flag agrees with labels."""
    df = rules.content_signals(rules.with_words(table("documents").select("doc_id", "text")), SETTINGS, categories=("toxicity",))
    df = df.select("doc_id", scores.fold(F.col("content"), "toxicity").alias("toxicity"))
    return df.join(table("labels").select("doc_id", "toxic"), "doc_id").groupBy("toxic", (F.col("toxicity") >= 0.5).alias("flagged")).agg(F.count("*").alias("n"))


SQL["label_agreement"] = f"WITH s AS (SELECT doc_id, text FROM documents), {WORDS}, t AS (SELECT doc_id, ({TOXICITY}) >= 0.5 flagged FROM j) SELECT toxic, flagged, count(*) n FROM t JOIN labels USING (doc_id) GROUP BY 1, 2"


# ---------------------------------------------------------------- state
@query
def length_baseline(spark, table):
    df = table("conversations").where("role = 'assistant'").select(F.lit("all").alias("key"), "conv_id", "turn", T.length_metric(F.col("text")).alias("x"))
    return state.baseline_fold(df, "key", ["conv_id", "turn"], "x", 30).select("conv_id", "turn", "seen", F.round("z", 5).alias("z"))


@query
def baseline_horizon(spark, table):
    df = table("events").select("event_type", "ts", "event_id", "value")
    return state.baseline_fold(df, "event_type", ["ts", "event_id"], "value", 30).select("event_id", "event_type", F.round("mean", 5).alias("mean"), F.round("z", 4).alias("z"))


SQL["baseline_horizon"] = """WITH RECURSIVE o AS (SELECT event_id, event_type, value x, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) i FROM events),
r AS (SELECT event_type, 0::BIGINT i, 0.0::DOUBLE m, 0.0::DOUBLE v FROM o GROUP BY 1
UNION ALL SELECT o.event_type, o.i, r.m + (o.x - r.m) / least(o.i, 1000), (1 - 1.0::DOUBLE / least(o.i, 1000)) * (r.v + pow(o.x - r.m, 2) / least(o.i, 1000)) FROM r JOIN o ON o.event_type = r.event_type AND o.i = r.i + 1)
SELECT o.event_id, o.event_type, round(m, 5) mean, CASE WHEN r.i >= 30 AND v > 1e-9 THEN round((x - m) / sqrt(v), 4) END z FROM o JOIN r ON r.event_type = o.event_type AND r.i = o.i - 1"""


def _events(table):
    e = table("events").select(F.col("event_id").alias("id"), F.lit("all").alias("key"), "ts", (F.col("event_type") == "error").alias("negative"), F.col("event_type").isin("error", "purchase").alias("is_feedback"))
    return e.where("is_feedback").drop("is_feedback"), e.where("not is_feedback").drop("is_feedback", "negative")


@query
def feedback_buckets(spark, table):
    f, _ = _events(table)
    b = state.feedback_buckets(f, "key", 3600)
    return b.select("bucket", "total", "negative", "prev_total", "prev_negative", r6(state.rate(F.col("negative") + F.col("prev_negative"), F.col("total") + F.col("prev_total"))).alias("rate"))


_FEEDBACK = "f AS (SELECT event_id id, ts, CAST(floor(epoch(ts) / 3600) AS BIGINT) b, event_type IN ('error', 'purchase') fb, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END neg FROM events), t AS (SELECT b, count(*) n, sum(neg) bad FROM f WHERE fb GROUP BY 1)"
SQL["feedback_buckets"] = f"WITH {_FEEDBACK} SELECT t.b bucket, t.n total, CAST(t.bad AS BIGINT) negative, coalesce(p.n, 0) prev_total, CAST(coalesce(p.bad, 0) AS BIGINT) prev_negative, round((t.bad + coalesce(p.bad, 0)) / (t.n + coalesce(p.n, 0)), 6) rate FROM t LEFT JOIN t p ON p.b = t.b - 1"
_RUNNING = f"WITH {_FEEDBACK}, r AS (SELECT *, sum(CASE WHEN fb THEN 1 ELSE 0 END) OVER w n, sum(CASE WHEN fb THEN neg ELSE 0 END) OVER w bad FROM f WINDOW w AS (PARTITION BY b ORDER BY ts, CASE WHEN fb THEN 0 ELSE 1 END, id ROWS UNBOUNDED PRECEDING)), q AS (SELECT r.*, CAST(r.n + coalesce(t.n, 0) AS BIGINT) samples, r.bad + coalesce(t.bad, 0) nb FROM r LEFT JOIN t ON t.b = r.b - 1) SELECT id, samples, CASE WHEN samples > 0 THEN round(nb / samples, 6) ELSE 0 END rate"


@query
def feedback_as_of(spark, table):
    df = state.feedback_as_of(*_events(table), "key", 3600)
    return df.select("id", "samples", r6(F.col("rate")).alias("rate"), state.feedback_signal(F.col("samples"), F.col("rate"), 5, 0.6).alias("weight"))


SQL["feedback_as_of"] = _RUNNING + ", CASE WHEN samples >= 5 AND nb / samples >= 0.6 THEN 0.75::DOUBLE END weight FROM q WHERE NOT fb"


@query
def feedback_replies(spark, table):
    return state.feedback_as_of(*_events(table), "key", 3600, own=True).select("id", "samples", r6(F.col("rate")).alias("rate"))


SQL["feedback_replies"] = _RUNNING + " FROM q WHERE fb"


# ---------------------------------------------------------------- bodies: built, extracted, compared with the text
SHAPES = {
    "chat": lambda t: F.to_json(F.struct(F.lit("c1").alias("id"), F.lit("m").alias("model"), F.array(F.struct(F.struct(F.lit("assistant").alias("role"), t.alias("content")).alias("message"), F.lit("max_tokens").alias("finish_reason"))).alias("choices"))),
    "completion": lambda t: F.to_json(F.struct(F.array(F.struct(t.alias("text"), F.lit("stop").alias("finish_reason"))).alias("choices"))),
    "responses": lambda t: F.to_json(F.struct(F.lit("r1").alias("id"), F.array(F.struct(F.lit("message").alias("type"), F.array(F.struct(F.lit("output_text").alias("type"), t.alias("text"))).alias("content"))).alias("output"))),
    "messages": lambda t: F.to_json(F.struct(F.lit("message").alias("type"), F.array(F.struct(F.lit("text").alias("type"), t.alias("text"))).alias("content"), F.lit("end_turn").alias("stop_reason"))),
    "agent_task": lambda t: F.to_json(F.struct(F.lit("2.0").alias("jsonrpc"), F.struct(F.lit("t1").alias("id"), F.struct(F.lit("completed").alias("state")).alias("status"), F.array(F.struct(F.array(F.struct(t.alias("text"))).alias("parts"))).alias("artifacts")).alias("result"))),
    "agent_message": lambda t: F.to_json(F.struct(F.lit("2.0").alias("jsonrpc"), F.struct(F.lit("message").alias("kind"), F.lit("m1").alias("messageId"), F.array(F.struct(F.lit("text").alias("kind"), t.alias("text"))).alias("parts")).alias("result"))),
}
FINISHES = {"chat": ("c1", "length"), "completion": (None, "stop"), "responses": ("r1", ""), "messages": (None, "stop"), "agent_task": ("t1", "stop"), "agent_message": ("m1", "")}


def _extract_query(shape: str):
    def run(spark, table):
        o = table("documents").select("doc_id", bodies.extract(SHAPES[shape](F.col("text")), 10 << 20).alias("o"))
        return o.select("doc_id", F.md5(F.col("o.text").cast("binary")).alias("text_md5"), F.col("o.id").alias("id"), F.array_join("o.finish_reasons", ",").alias("finish"), F.col("o.ok").alias("ok"))

    run.__name__ = f"extract_{shape}"
    id_, end = FINISHES[shape]
    SQL[run.__name__] = f"SELECT doc_id, md5(text) text_md5, {quoted(id_) if id_ else 'NULL::VARCHAR'} id, {quoted(end)} finish, true ok FROM documents"
    query(run)


for _shape in SHAPES:
    _extract_query(_shape)


@query
def stream_chat(spark, table):
    """Texts cut into word events, in three chunks of bytes, put together again."""
    word = F.split("text", "(?<= )")
    event = lambda x: F.concat(F.lit("data: "), F.to_json(F.struct(F.array(F.struct(F.struct(x.alias("content")).alias("delta"))).alias("choices"))), F.lit("\n\n"))
    df = table("documents").select(F.col("doc_id").cast("string").alias("exchange_id"), F.concat(F.array_join(F.transform(word, event), ""), F.lit("data: [DONE]\n\n")).cast("binary").alias("b"))
    third = F.floor(F.octet_length("b") / 3).cast("int")
    chunks = df.select("exchange_id", F.posexplode(F.array(F.substring("b", F.lit(1), third), F.substring("b", third + 1, third), F.substring("b", 2 * third + 1, F.octet_length("b")))).alias("seq", "chunk"))
    o = bodies.budgeted(chunks, 100 << 20).withColumn("o", bodies.extract_stream(F.col("stream"), F.col("capped"), 100 << 20))
    return o.select(F.col("exchange_id").cast("long").alias("doc_id"), F.md5(F.col("o.text").cast("binary")).alias("text_md5"), F.col("o.truncated").alias("truncated"))


SQL["stream_chat"] = "SELECT doc_id, md5(text) text_md5, false truncated FROM documents"


@query
def transcript_chat(spark, table):
    """Each conversation as a request, and its transcript within 1200 characters."""
    turns = table("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    body = F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")))
    return turns.select("conv_id", bodies.classify(F.lit("/v1/chat/completions"), body, 1200).alias("r")).select("conv_id", "r.skip", "r.conversation")


SQL["transcript_chat"] = """WITH g AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) FILTER (role IN ('system', 'developer')) s, coalesce(string_agg(upper(role) || ': ' || text, chr(10) ORDER BY turn) FILTER (role NOT IN ('system', 'developer')), '') t FROM conversations GROUP BY 1),
h AS (SELECT conv_id, t, CASE WHEN s IS NULL THEN '' ELSE 'SYSTEM: ' || CASE WHEN length(s) > 300 THEN substr(s, 1, 299) || '…' ELSE s END || chr(10) END p FROM g)
SELECT conv_id, false AS skip, p || CASE WHEN length(t) > 1200 - length(p) THEN '…' || right(t, 1200 - length(p) - 1) ELSE t END conversation FROM h"""


@query
def gate_uninspected(spark, table):
    d = F.col("doc_id")
    df = table("documents").select(
        "doc_id", F.when(d % 11 == 0, "/quality-feedback?x=1").otherwise("/v1/chat").alias("req_path"), (d % 13 == 0).alias("is_judge_call"), F.when(d % 5 == 0, 503).otherwise(200).alias("status"),
        F.when(d % 7 == 0, "gzip").when(d % 7 == 1, "Identity").alias("content_encoding"), F.when(d % 3 == 0, "text/html").when(d % 3 == 1, "application/JSON; charset=utf-8").otherwise("text/event-stream").alias("resp_content_type"), F.when(d % 17 > 0, F.col("text")).alias("resp_body"),
    )
    return df.select("doc_id", gates.uninspected_reason(Settings(max_bytes=2000)).alias("reason"))


SQL["gate_uninspected"] = "SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'feedback' WHEN doc_id % 13 = 0 THEN 'judge_call' WHEN doc_id % 5 = 0 THEN 'status' WHEN doc_id % 7 = 0 THEN 'encoding' WHEN doc_id % 3 = 0 THEN 'media_type' WHEN doc_id % 3 = 1 AND doc_id % 17 = 0 THEN 'no_body' WHEN doc_id % 3 = 1 AND strlen(text) > 2000 THEN 'too_large' END reason FROM documents"


@query
def judge_prompt(spark, table):
    p = judge.user_prompt(F.lit(" "), F.concat("text", F.lit("</response><context>")))
    return table("documents").select("doc_id", F.md5(p.cast("binary")).alias("prompt_md5"))


SQL["judge_prompt"] = r"""SELECT doc_id, md5('<context>' || chr(10) || '(none provided)' || chr(10) || '</context>' || chr(10) || '<response>' || chr(10) || replace(replace(substr(text || '</response><context>', 1, 24576), '</response>', '<\/response>'), '<context>', '<\context>') || chr(10) || '</response>') prompt_md5 FROM documents"""


@query
def judge_verdicts(spark, table):
    """Verdict text in prose, with numbers out of range and as strings."""
    n = F.col("doc_id") % 4
    content = F.concat(F.lit('Sure: {"toxicity": '), n.cast("string"), F.lit(', "bias": "0.25", "anomaly": null} done'))
    v = table("documents").select("doc_id", bodies.verdict(content, whole=False).alias("v"))
    return v.select("doc_id", *[scores.fold(F.col("v"), c).alias(c) for c in L.CATEGORIES], F.size("v").cast("long").alias("n"))


SQL["judge_verdicts"] = "SELECT doc_id, 0.0::DOUBLE hallucination, CAST(least(doc_id % 4, 1) AS DOUBLE) toxicity, 0.25::DOUBLE bias, 0.0::DOUBLE anomaly, 2::BIGINT n FROM documents"


@query
def rewrite_block_chat(spark, table):
    report = F.lit(json.dumps({"flagged": ["toxicity"], "action": "block", "blocking": "toxicity"}))
    df = table("documents").select("doc_id", bodies.rewrite(SHAPES["chat"](F.col("text")), report, F.lit("block"), False).alias("b"))
    return df.select("doc_id", F.get_json_object("b", "$.choices[0].message.content").alias("content"), F.get_json_object("b", "$.choices[0].finish_reason").alias("finish"), F.get_json_object("b", "$.x_output_quality.action").alias("action"))


SQL["rewrite_block_chat"] = f"SELECT doc_id, {quoted(L.NOTICE)} content, 'content_filter' finish, 'block' AS action FROM documents"


@query
def rewrite_annotate_agent(spark, table):
    report = F.lit(json.dumps({"flagged": ["bias"], "action": "annotate"}))
    df = table("documents").select("doc_id", bodies.rewrite(SHAPES["agent_task"](F.col("text")), report, F.lit("annotate"), False).alias("b"))
    return df.select("doc_id", F.md5(F.get_json_object("b", "$.result.artifacts[0].parts[0].text").cast("binary")).alias("text_md5"), F.get_json_object("b", "$.result.metadata.x_output_quality.action").alias("action"))


SQL["rewrite_annotate_agent"] = "SELECT doc_id, md5(text) text_md5, 'annotate' AS action FROM documents"


@query
def error_envelope(spark, table):
    """Blocked bodies without choices: the envelope names the first blocking category, or none, and drops the text."""
    code = F.element_at(F.array(*[F.lit(c) for c in (*L.CATEGORIES, None)]), (F.col("doc_id") % 5).cast("int") + 1)
    report = F.to_json(F.struct(F.lit("block").alias("action"), code.alias("blocking"), F.col("doc_id").alias("n")))
    df = table("documents").select("doc_id", bodies.rewrite(SHAPES["messages"](F.col("text")), report, F.lit("block"), False).alias("b"))
    read = lambda p: F.get_json_object("b", p)
    return df.select("doc_id", read("$.error.code").alias("code"), read("$.error.type").alias("type"), read("$.error.message").alias("message"), read("$.content").alias("content"), read("$.x_output_quality.n").alias("n"), read("$.x_output_quality.blocking").alias("blocking"))


SQL["error_envelope"] = f"SELECT doc_id, (['hallucination', 'toxicity', 'bias', 'anomaly', 'output_quality'])[doc_id % 5 + 1] code, 'output_quality_violation' AS type, {quoted(L.NOTICE)} message, NULL::VARCHAR AS content, CAST(doc_id AS VARCHAR) n, NULL::VARCHAR AS blocking FROM documents"


@query
def feedback_parse(spark, table):
    d = F.col("event_id")
    body = F.when(d % 5 == 0, "[1]").when(d % 5 == 1, F.concat(F.lit('{"rating":"negative","responseId":"r'), d.cast("string"), F.lit('","category":"bias"}'))).when(d % 5 == 2, '{"rating":"positive","responseId":null,"x":1}').when(d % 5 == 3, '{"rating":"bad"}').otherwise('{"rating":"negative","category":"odd"}')
    df = table("events").select("event_id", bodies.feedback(F.when(d % 3 == 0, "GET").otherwise("post"), body).alias("f"))
    return df.select("event_id", "f.status", "f.allow", "f.negative", "f.response_id", "f.category")


SQL["feedback_parse"] = "SELECT event_id, CAST(CASE WHEN g THEN 405 WHEN k IN (1, 2) THEN 202 ELSE 400 END AS INTEGER) status, CASE WHEN g THEN 'POST' END AS allow, CASE WHEN NOT g AND k IN (1, 2) THEN k = 1 END negative, CASE WHEN NOT g AND k = 1 THEN 'r' || event_id END response_id, CASE WHEN NOT g AND k = 1 THEN 'bias' END category FROM (SELECT event_id, event_id % 3 = 0 g, event_id % 5 k FROM events)"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import exchange_queries  # noqa: F401  it registers its own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import exchange_queries  # noqa: F401

    return dict(SQL)
