"""Arrow-batched functions over protocol bodies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wire
from ..functions.lexicon import CATEGORIES
from ..functions.text import round2
from ..session import partitions

OUTPUT = "id string, model string, text string, has_tool_calls boolean, finish_reasons array<string>, logprob_sum double, logprob_count long, truncated boolean, ok boolean"
NONE = (None, None, None, None, None, None, None, None, False)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")])


def extract(body: Column, limit: int) -> Column:
    """The output struct of a buffered body; ``ok`` is false if it has no known shape."""

    @F.pandas_udf(OUTPUT)
    def run(b: pd.Series) -> pd.DataFrame:
        return _frame([(*o.row(), True) if (o := wire.extract(x, limit)) else NONE for x in b], OUTPUT)

    return run(body)


def budgeted(chunks: DataFrame, limit: int) -> DataFrame:
    """exchange_id, stream (an array of chunks in order), capped: a chunk is taken if the bytes before it are under the limit."""
    from pyspark.sql import Window

    w = Window.partitionBy("exchange_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.octet_length("chunk")).over(w), F.lit(0))
    laid = chunks.repartition(partitions(chunks.sparkSession), "exchange_id")  # its one shuffle, not merged into fewer tasks: parsing costs more than moving
    taken = laid.withColumn("_in", before < limit)
    part = F.when(F.col("_in"), F.struct("seq", "chunk"))
    return taken.groupBy("exchange_id").agg(F.array_sort(F.collect_list(part)).alias("_parts"), (~F.bool_and("_in")).alias("capped")).select(
        "exchange_id", F.transform("_parts", lambda p: p["chunk"]).alias("stream"), "capped"
    )


def extract_stream(stream: Column, capped: Column, limit: int) -> Column:
    """The output struct of a stream's chunks."""

    @F.pandas_udf(OUTPUT)
    def run(b: pd.Series, c: pd.Series) -> pd.DataFrame:
        return _frame([(*o.row(), True) if (o := wire.extract_stream(b"".join(x), limit, bool(k))) else NONE for x, k in zip(b, c, strict=True)], OUTPUT)

    return run(stream, capped)


def classify(path: Column, body: Column, budget: int) -> Column:
    schema = "skip boolean, conversation string"

    @F.pandas_udf(schema)
    def run(p: pd.Series, b: pd.Series) -> pd.DataFrame:
        return _frame([wire.classify_request(x, y, budget) for x, y in zip(p, b, strict=True)], schema)

    return run(path, body)


def verdict(body: Column, whole: bool = True) -> Column:
    """Signals of a judge's reply (or of its content), null if unreadable."""

    @F.pandas_udf("array<struct<category:string,weight:double,reason:string>>")
    def run(b: pd.Series) -> pd.Series:
        read = wire.judge_reply if whole else wire.judge_verdict
        return pd.Series([[{"category": c, "weight": s, "reason": r} for c, s, r in v] if (v := read(x, CATEGORIES)) else None for x in b], dtype=object)

    return run(body)


def rewrite(body: Column, report: Column, action: Column, report_all: bool) -> Column:
    @F.pandas_udf("string")
    def run(b: pd.Series, r: pd.Series, a: pd.Series) -> pd.Series:
        return pd.Series([wire.rewrite(x, y, z, report_all) for x, y, z in zip(b, r, a, strict=True)], dtype=object)

    return run(body, report, action)


def feedback(method: Column, body: Column) -> Column:
    """status, allow, error, negative, response_id, category of a feedback request."""
    schema = "error string, negative boolean, response_id string, category string"

    @F.pandas_udf(schema)
    def run(b: pd.Series) -> pd.DataFrame:
        return _frame([wire.feedback(x) for x in b], schema)

    read = run(body)
    post = F.upper(method) == "POST"
    return F.struct(
        F.when(~post, 405).when(read["error"].isNotNull(), 400).otherwise(202).alias("status"), F.when(~post, "POST").alias("allow"),
        F.when(~post, "method not allowed").otherwise(read["error"]).alias("error"), *[F.when(post & read["error"].isNull(), read[c]).alias(c) for c in ("negative", "response_id", "category")],
    )


def feedback_reply(parsed: Column, samples: Column, rate: Column) -> Column:
    """The JSON body that answers feedback; null samples: it could not be recorded."""
    recorded = F.to_json(F.struct(F.lit("recorded").alias("status"), round2(rate).alias("windowNegativeRate"), samples.alias("windowSamples")))
    error = F.to_json(F.struct(parsed["error"].alias("error")))
    return F.when(parsed["status"] != 202, error).when(samples.isNull(), F.lit('{"status":"accepted_unrecorded"}')).otherwise(recorded)


def feedback_line(parsed: Column, samples: Column, rate: Column) -> Column:
    """The log line of a recorded signal."""
    window = F.concat(F.lit(" window_samples="), samples.cast("string"), F.format_string(" window_negative_rate=%.2f", rate))
    id_ = F.concat(F.lit(" feedback response_id="), F.coalesce(parsed["response_id"], F.lit("-")))
    bad = F.concat(F.lit("negative"), id_, F.lit(" category="), F.coalesce(parsed["category"], F.lit("-")), window)
    return F.when(parsed["status"] == 202, F.when(parsed["negative"], bad).otherwise(F.concat(F.lit("positive"), id_, window)))
