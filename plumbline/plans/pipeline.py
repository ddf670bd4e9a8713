"""The whole evaluation of a table of exchanges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, length_metric
from ..operators import bodies, gates, judge, rules, scores, state
from ..session import Cut, ready
from ..settings import Settings


def score_outputs(outputs: DataFrame, settings: Settings, judged: DataFrame | None = None, key: str | None = None, order: list[str] | None = None, feedback: DataFrame | None = None, id_: str = "exchange_id", ask: Callable[[str], tuple[int, str]] | None = None) -> DataFrame:
    """Scores, decision and report of normalised outputs (id, text, has_tool_calls, finish_reasons, logprob_sum, logprob_count, truncated).

    ``judged`` has (id, verdict signals or null, judge_ms), or ``ask`` is called for the rows to be judged
    (request JSON to status and body) and its replies are written before use.  ``key`` and ``order`` turn on
    the length baseline; ``feedback`` (id, key, ts, negative) the windowed feedback rate, with ts in ``order``.
    """
    df = rules.structural_signals(rules.content_signals(rules.with_words(outputs), settings), settings)
    df = df.withColumn("source", F.lit("heuristic"))
    if settings.judge and (judged is not None or ask is not None):  # by what the rules alone say, before length and feedback
        df = df.withColumn("_asked", judge.should_call(settings.judge, F.col("text")))
        if judged is None:
            context = F.col("conversation") if "conversation" in df.columns else F.lit(None).cast("string")
            cut = Cut(df.sparkSession)
            asked = df.select(id_, F.when(F.col("_asked"), judge.request(settings.judge, context, F.col("text"))).alias("request"))
            # questions are written first: a filter on what the rules say would be pushed below them and repeat them
            replies = cut(judge.call(cut(asked).where("request is not null"), ask, settings.judge.timeout_ms, id_))
            judged = verdicts(replies, id_)
    if key:
        x = F.when(~F.coalesce("truncated", F.lit(False)) & ~blank(F.col("text")), length_metric(F.col("text")))
        narrow = df.select(*dict.fromkeys([id_, key, *order]), x.alias("_x")).where("_x is not null")  # only these columns are sorted by key
        z = state.baseline_fold(narrow, key, order, "_x", settings.warmup).select(id_, "z")
        weight, reason = state.length_signal(settings.length_z)
        df = df.join(z, id_, "left").withColumn("structural", F.concat("structural", rules.some([(weight.isNotNull(), rules.signal("anomaly", weight, reason))])))
    if feedback is not None and settings.feedback:
        f = settings.feedback
        seen = state.feedback_as_of(feedback, df.select(F.col(id_).alias("id"), key, "ts"), key, f.window_seconds).select(F.col("id").alias(id_), "samples", "rate")
        said = F.concat(F.lit("feedback_negative_rate(rate="), F.format_string("%.2f", "rate"), F.lit(",samples="), F.col("samples").cast("string"), F.lit(")"))
        hit = state.feedback_signal(F.col("samples"), F.col("rate"), f.min_samples, f.negative_rate)
        df = df.join(seen, id_, "left").withColumn("structural", F.concat("structural", rules.some([(hit.isNotNull(), rules.signal("anomaly", hit, said))])))
    if "_asked" in df.columns:
        df = df.join(judged, id_, "left")
        ok = F.col("_asked") & F.col("verdict").isNotNull()
        df = df.withColumn("source", F.when(ok, "llm").when(F.col("_asked"), "heuristic_fallback").otherwise("heuristic"))
        df = df.withColumn("content", F.when(ok, F.col("verdict")).otherwise(F.col("content")).cast(rules.SIGNALS)).withColumn("judge_ms", F.when(F.col("_asked"), F.col("judge_ms")))
    else:
        df = df.withColumn("judge_ms", F.lit(None).cast("long"))
    return scores.with_decision(scores.with_scores(df), settings).withColumn("report", scores.report(F.col("judge_ms")))


def verdicts(replies: DataFrame, id_: str = "exchange_id") -> DataFrame:
    """(id, status, body, judge_ms) of the judge -> id, verdict (null if it failed or cannot be read), judge_ms."""
    return replies.select(id_, bodies.verdict(F.when(F.col("status").between(200, 299), F.col("body"))).alias("verdict"), "judge_ms")


def outputs_of(exchanges: DataFrame, settings: Settings, chunks: DataFrame | None = None) -> DataFrame:
    """Exchanges that pass the gates, with their normalised output and conversation."""
    ready(exchanges.sparkSession)
    limit = settings.max_bytes
    budget = settings.judge.context_chars if settings.judge else 0
    df = exchanges.withColumn("uninspected", gates.uninspected_reason(settings, exchanges.columns)).where("uninspected is null")
    request = F.when(gates.request_parsed(settings), F.col("req_body"))
    df = df.withColumn("_r", bodies.classify(F.col("req_path"), request, budget)).where(~F.col("_r.skip")).withColumn("conversation", F.col("_r.conversation")).withColumn("is_stream", gates.is_stream())
    buffered = df.where("not is_stream").withColumn("_o", bodies.extract(F.col("resp_body"), limit))
    if chunks is not None:
        streams = bodies.budgeted(chunks, limit)
        streamed = df.where("is_stream").join(streams, "exchange_id").withColumn("_o", bodies.extract_stream(F.col("stream"), F.col("capped"), limit)).drop("stream", "capped")
        buffered = buffered.unionByName(streamed)
    return buffered.where("_o.ok").select(*[c for c in df.columns if c != "_r"], *[F.col(f"_o.{c}").alias(f"output_{c}" if c in ("id", "model") else c) for c in ("id", "model", "text", "has_tool_calls", "finish_reasons", "logprob_sum", "logprob_count", "truncated")])


def with_withheld(report: Column, text: Column) -> Column:
    """The report with the text that was withheld."""
    field = F.to_json(F.struct(text.alias("withheldText")))
    return F.concat(F.left(report, F.length(report) - 1), F.lit(","), F.substring(field, F.lit(2), F.length(field)))


def evaluate(exchanges: DataFrame, settings: Settings, chunks: DataFrame | None = None, judge_replies: DataFrame | None = None, feedback: DataFrame | None = None, key: str | None = None, ask: Callable[[str], tuple[int, str]] | None = None) -> DataFrame:
    """One row for each evaluated exchange, with applied action, report, new body and log line.

    Without a key there is one length baseline for all rows; its fold is shared by many tasks all the same.
    """
    out = outputs_of(exchanges, settings, chunks)
    if key is None:
        key = "_all"
        out = out.withColumn("_all", F.lit("all"))
    judged = None if judge_replies is None else verdicts(judge_replies)
    df = score_outputs(out, settings, judged, key, ["ts", "exchange_id"], feedback, ask=ask)
    df = df.withColumn("applied", F.when(F.col("is_stream") & (F.col("action") != "monitor"), "monitor(streaming)").otherwise(F.col("action")))
    if settings.withheld_text:
        df = df.withColumn("report", F.when((F.col("action") == "block") & ~F.col("is_stream"), with_withheld(F.col("report"), F.col("text"))).otherwise(F.col("report")))
    with_code = F.concat(F.left("report", F.length("report") - 1), F.lit(',"blocking":"'), F.col("blocking"), F.lit('"}'))
    asked = ~F.col("is_stream") & ((F.col("action") != "monitor") | F.lit(settings.report_all))
    new = bodies.rewrite(F.when(asked, F.col("resp_body")), F.coalesce(with_code, F.col("report")), F.col("action"), settings.report_all)
    df = df.withColumn("new_body", F.coalesce(new, F.col("resp_body")))
    return df.withColumn("log_line", scores.log_line(F.col("applied"), F.col("output_id"), F.col("output_model")))


def answer_feedback(requests: DataFrame, settings: Settings, key: str | None = None) -> DataFrame:
    """(id, ts, method, body) of the feedback endpoint -> id, status, allow, body, log_line; each signal counts in its own reply."""
    if key is None:
        key = "_all"
        requests = requests.withColumn("_all", F.lit("all"))
    read = Cut(requests.sparkSession)(requests.select("id", key, "ts", bodies.feedback(F.col("method"), F.col("body")).alias("f")))
    good = read.where("f.status = 202").select("id", key, "ts", F.col("f.negative").alias("negative"))
    seen = state.feedback_as_of(good, good.limit(0), key, settings.feedback.window_seconds, own=True).select("id", "samples", "rate")
    out = read.join(seen, "id", "left")
    args = (F.col("f"), F.col("samples"), F.col("rate"))
    return out.select("id", "f.status", "f.allow", bodies.feedback_reply(*args).alias("body"), bodies.feedback_line(*args).alias("log_line"))
