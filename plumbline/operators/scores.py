"""Noisy-or scores, decisions and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import CATEGORIES, NOTICE
from ..functions.text import round2
from ..settings import ACTIONS, Rule, Settings


def fold(signals: Column, category: str) -> Column:
    """1 - product(1 - weight) in the signals' order; weights are clamped to 0..1."""
    w = lambda s: F.greatest(F.lit(0.0), F.least(F.lit(1.0), s["weight"]))
    own = F.filter(signals, lambda s: s["category"] == category)
    return F.aggregate(own, F.lit(0.0), lambda a, s: 1.0 - (1.0 - a) * (1.0 - w(s)))


def reasons(signals: Column) -> Column:
    told = F.filter(signals, lambda s: (s["weight"] > 0) & (s["reason"] != ""))
    return F.transform(told, lambda s: F.concat(s["category"], F.lit(":"), s["reason"]))


def combine(a: Column, b: Column) -> Column:
    return 1.0 - (1.0 - a) * (1.0 - b)


def with_scores(df: DataFrame, content: str = "content", structural: str = "structural") -> DataFrame:
    """Adds one score column a category, and the reasons."""
    df = df.withColumns({c: combine(fold(F.col(content), c), fold(F.col(structural), c)) for c in CATEGORIES})
    return df.withColumn("reasons", F.concat(reasons(F.col(content)), reasons(F.col(structural))))


def reaches(score: Column, rule: Rule) -> Column:
    return (score > 0) & (score >= rule.threshold)


def with_decision(df: DataFrame, settings: Settings) -> DataFrame:
    """Adds flagged (in category order), action (the strictest of those flagged) and blocking."""
    rules = [(c, settings.rule(c)) for c in CATEGORIES]
    hit = [(c, r, reaches(F.col(c), r)) for c, r in rules]
    rank = F.greatest(*[F.when(h, F.lit(ACTIONS.index(r.action))).otherwise(0) for _, r, h in hit])
    blocking = F.coalesce(*[F.when(h, F.lit(c)) if r.action == "block" else F.lit(None).cast("string") for c, r, h in hit])
    return df.withColumns({
        "flagged": F.array_compact(F.array(*[F.when(h, F.lit(c)) for c, _, h in hit])),
        "action": F.element_at(F.array(*[F.lit(a) for a in ACTIONS]), rank + 1),
        "blocking": blocking,
    })


def report(judge_ms: Column | None = None, source: Column | None = None) -> Column:
    """The report as JSON, with rounded scores and null judgeMs if no judge was called."""
    fields = F.struct(
        "flagged", "action", (F.col("source") if source is None else source).alias("source"),
        (F.lit(None).cast("long") if judge_ms is None else judge_ms).alias("judgeMs"),
        F.struct(*[round2(F.col(c)).alias(c) for c in CATEGORIES]).alias("scores"), "reasons",
    )
    return F.to_json(fields, {"ignoreNullFields": "false"})


def error_envelope(report_: Column, blocking: Column) -> Column:
    """The body that replaces a withheld response of no known shape."""
    code = F.coalesce(blocking, F.lit("output_quality"))
    error = F.struct(F.lit(NOTICE).alias("message"), F.lit("output_quality_violation").alias("type"), code.alias("code"), F.lit(None).cast("string").alias("param"))
    return F.concat(F.lit('{"error":'), F.to_json(error, {"ignoreNullFields": "false"}), F.lit(',"x_output_quality":'), report_, F.lit("}"))


def rowset(signals: DataFrame, key: str) -> DataFrame:
    """key, category, score of signals that are rows (key, category, weight)."""
    w = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("weight")))
    return signals.groupBy(key, "category").agg((1.0 - F.product(1.0 - w)).alias("score"))


def outcome(report_: Column) -> Column:
    """What a reader is told of an exchange: no report, blocked, flagged or passed."""
    action = F.get_json_object(report_, "$.action")
    some = F.coalesce(F.get_json_object(report_, "$.flagged[0]"), F.lit("")) != ""
    return F.when(report_.isNull(), "not inspected").when(action == "block", "blocked").when(some & (action == "annotate"), "flagged").when(some, "flagged (monitor)").otherwise("passed")


def reason_parts(reason: Column) -> Column:
    """A reason's category, its detail and whether a rule or the judge gave it."""
    at = F.locate(":", reason)
    detail = F.when(at > 0, F.substring(reason, at + 1, F.length(reason))).otherwise(reason)
    told = F.regexp_extract(detail, r"(?s)^llm\((.*)\)$", 1)
    judged = detail.rlike(r"(?s)^llm\(.*\)$")
    return F.struct(F.when(at > 0, F.substring(reason, F.lit(1), at - 1)).otherwise("").alias("category"), F.when(judged, told).otherwise(detail).alias("detail"), F.when(judged, "LLM").otherwise("rule").alias("via"))


def feedback_category(flagged: Column) -> Column:
    """The category that feedback is offered with: the first flagged."""
    return F.coalesce(F.get(flagged, F.lit(0)), F.lit("other"))


def log_line(applied: Column | None = None, id_: Column | None = None, model: Column | None = None) -> Column:
    """One line for an evaluation; it never has the text."""
    or_none = lambda c: F.lit("-") if c is None else F.coalesce(c.cast("string"), F.lit("-"))
    said = F.format_string(" scores=[h=%.2f t=%.2f b=%.2f a=%.2f]", *CATEGORIES)
    quoted = F.transform("reasons", lambda r: F.concat(F.lit('"'), F.replace(F.replace(r, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))
    who = F.concat(F.lit(" response_id="), or_none(id_), F.lit(" model="), or_none(model))
    judged = F.concat(F.lit(" source="), F.col("source"), F.lit(" judge_ms="), or_none(F.col("judge_ms")), said)
    end = F.concat(F.lit(" truncated="), F.coalesce("truncated", F.lit(False)).cast("string"))
    flagged = F.concat(F.lit("flagged"), who, F.lit(" categories="), F.array_join("flagged", ","), F.lit(" action="), F.col("action") if applied is None else applied, judged, F.lit(" reasons=["), F.array_join(quoted, ", "), F.lit("]"), end)
    return F.when(F.size("flagged") > 0, flagged).otherwise(F.concat(F.lit("evaluated"), who, judged, end))
