"""Which exchanges are evaluated: cheap predicates on raw columns, before any body is parsed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import Settings


def _low(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit("")))


def is_stream() -> Column:
    return F.contains(_low("resp_content_type"), F.lit("text/event-stream"))


def request_parsed(settings: Settings) -> Column:
    return F.contains(_low("req_content_type"), F.lit("json")) & (F.upper("req_method") == "POST") & F.col("req_body").isNotNull() & (F.octet_length("req_body") <= settings.max_bytes)


def own_call(settings: Settings, columns: list[str]) -> Column:
    """Whether a request is this engine's own question to the judge: it carries the settings' token (column ``req_guard``), or is marked so."""
    marked = F.coalesce("is_judge_call", F.lit(False)) if "is_judge_call" in columns else F.lit(False)
    return marked | F.coalesce(F.col("req_guard") == settings.guard_token, F.lit(False)) if "req_guard" in columns and settings.guard_token else marked


def uninspected_reason(settings: Settings, columns: list[str] | None = None) -> Column:
    """Why a row is not evaluated (null: it is, if its body has a known shape), in order of precedence."""
    path = F.split_part("req_path", F.lit("?"), F.lit(1))
    out = F.when(path == settings.feedback.path, "feedback") if settings.feedback else F.when(F.lit(False), "feedback")
    out = out.when(own_call(settings, ["is_judge_call"] if columns is None else columns), "judge_call")
    out = out.when(~F.coalesce(F.col("status").between(200, 299), F.lit(False)), "status")
    out = out.when(~_low("content_encoding").isin("", "identity"), "encoding")
    json_ = F.contains(_low("resp_content_type"), F.lit("json"))
    out = out.when(~is_stream() & ~json_, "media_type")
    out = out.when(~is_stream() & F.col("resp_body").isNull(), "no_body")
    return out.when(~is_stream() & (F.octet_length("resp_body") > settings.max_bytes), "too_large")
