"""Tables in and out, as batches or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXCHANGES = "exchange_id string, ts timestamp, req_method string, req_path string, req_content_type string, req_body string, is_judge_call boolean, status int, resp_content_type string, content_encoding string, resp_body string"
CHUNKS = "exchange_id string, seq long, chunk binary"
FEEDBACK = "id string, ts timestamp, method string, body string"
JUDGE_REPLIES = "exchange_id string, status int, body string, judge_ms long"


def read(spark: SparkSession, path: str, kind: str = "parquet", schema: str | None = None, stream: bool = False) -> DataFrame:
    """A table in any format that Spark reads; streams and text formats need the schema."""
    reader = (spark.readStream if stream else spark.read).format(kind)
    return (reader.schema(schema) if schema else reader).load(path)


def write_evaluations(evaluations: DataFrame, path: str, kind: str = "parquet") -> None:
    evaluations.write.mode("append").format(kind).save(path)


def bodies(evaluations: DataFrame) -> DataFrame:
    """What goes back to the caller: the new body of each exchange that was not streamed."""
    return evaluations.where(~F.col("is_stream")).select("exchange_id", F.col("new_body").alias("body"))


def log(evaluations: DataFrame) -> DataFrame:
    """One line for each evaluation, a warning if something is flagged."""
    return evaluations.select("exchange_id", F.when(F.size("flagged") > 0, "warn").otherwise("info").alias("level"), "log_line")


def violations(evaluations: DataFrame) -> DataFrame:
    """Evaluations with some flag."""
    return evaluations.where("size(flagged) > 0")
