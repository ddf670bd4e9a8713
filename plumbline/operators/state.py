"""Running statistics: the length baseline and the feedback window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Cut, partitions, running

HORIZON, FLAT = 1000, 1e-9


def baseline_window(df: DataFrame, key: str, order: list[str], x: str, warmup: int) -> DataFrame:
    """Adds seen, mean, variance and z of each row against the rows before it of its key.

    Exact while a key has at most 1000 earlier rows; one running window, O(1) a row.
    """
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({"seen": F.count(x).over(w), "mean": F.avg(x).over(w), "variance": F.var_pop(x).over(w)})
    return df.withColumn("z", z_score(F.col(x), warmup))


def z_score(x: Column, warmup: int) -> Column:
    return F.when((F.col("seen") >= warmup) & (F.col("variance") > FLAT), (x - F.col("mean")) / F.sqrt("variance"))


def advance(state: tuple[int, float, float], x: float) -> tuple[int, float, float]:
    """Count, mean and variance after x; a row weighs at least 1/1000, so old rows fade."""
    count, mean, variance = state
    n = min(count + 1, HORIZON)
    d = x - mean
    return count + 1, mean + d / n, (1 - 1 / n) * (variance + d * d / n)


BLOCK = 1_000_000  # rows of a key that are folded one after another


def baseline_fold(df: DataFrame, key: str, order: list[str], x: str, warmup: int, block: int = BLOCK) -> DataFrame:
    """As ``baseline_window``, for any number of rows of a key; a null or NaN x leaves the state as it is.

    Rows are numbered by running sums and folded in blocks of ``block`` rows, so that a key of any size is
    shared by many tasks.  Mean and mean square are linear in their start (with n the lesser of a row's
    number and 1000, y becomes (1 - 1/n) y + x/n), so what a block adds is a weighted sum that needs no
    state, and a block's start follows from the blocks before it, one row each.
    """
    cut = Cut(df.sparkSession)
    known = (F.col(x).isNotNull() & ~F.isnan(x)).cast("long")
    rows = running(cut(df), [key], order, {"_i": known}, cut)
    rows = cut(rows.withColumn("_block", F.floor((F.greatest("_i", F.lit(1).cast("long")) - 1) / block)))
    # what a block's rows weigh at its end, and how much of its start is left there
    end = (F.col("_block") + 1) * block
    weight = F.when(end <= HORIZON, 1.0 / end).otherwise(F.pow(F.lit(1 - 1 / HORIZON), (end - F.greatest("_i", F.lit(HORIZON))).cast("double")) / HORIZON)
    sums = rows.where(known == 1).groupBy(key, "_block").agg(F.sum(weight * F.col(x)).alias("m"), F.sum(weight * F.col(x) * F.col(x)).alias("q"))
    later = sums.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_block", "m", "q"))).alias("parts")).where(F.size("parts") > 1)
    begin = lambda b: b["_block"] * block
    stop = lambda b: (b["_block"] + 1) * block
    kept = lambda b: F.least(begin(b), F.lit(HORIZON)) / F.least(stop(b), F.lit(HORIZON)) * F.pow(F.lit(1 - 1 / HORIZON), (F.greatest(stop(b), F.lit(HORIZON)) - F.greatest(begin(b), F.lit(HORIZON))).cast("double"))
    zero = F.struct(F.lit(0.0).alias("m"), F.lit(0.0).alias("q"), F.array().cast("array<struct<b:bigint,m:double,q:double>>").alias("out"))

    def follow(acc: Column, b: Column) -> Column:
        m, q = kept(b) * acc["m"] + b["m"], kept(b) * acc["q"] + b["q"]
        return F.struct(m.alias("m"), q.alias("q"), F.array_append(acc["out"], F.struct((b["_block"] + 1).alias("b"), m.alias("m"), q.alias("q"))).alias("out"))

    starts = later.select(F.col(key).alias("_k"), F.explode(F.aggregate("parts", zero, follow)["out"]).alias("s")).select("_k", F.col("s.b").alias("_b"), F.col("s.m").alias("_m"), F.col("s.q").alias("_q"))
    rows = rows.join(F.broadcast(starts), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_block") == F.col("_b")), "left").drop("_k", "_b")  # at most a row for each ``block`` rows
    laid = rows.repartition(partitions(df.sparkSession), key, "_block").sortWithinPartitions(key, "_block", *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", seen long, mean double, variance double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = None, (0, 0.0, 0.0)
        for f in frames:
            out = []
            for k, n, v, m, q in zip(f[key].tolist(), f["_block"].tolist(), f[x].tolist(), f["_m"].tolist(), f["_q"].tolist(), strict=True):
                if (k, n) != last:
                    last, state = (k, n), (0, 0.0, 0.0) if m is None or m != m else (n * block, m, max(0.0, q - m * m))
                out.append(state)
                if v is not None and v == v:
                    state = advance(state, v)
            f = f.drop(columns=["_i", "_block", "_m", "_q"])
            f[["seen", "mean", "variance"]] = pd.DataFrame(out, index=f.index, columns=["seen", "mean", "variance"])
            yield f

    return laid.mapInPandas(run, schema).withColumn("z", z_score(F.col(x), warmup))


def length_signal(threshold: float) -> tuple[Column, Column]:
    """(weight, reason) of an unusual length, null if none."""
    z = F.abs("z")
    said = lambda name: F.concat(F.lit(f"{name}(z="), F.format_string("%.2f", F.col("z")), F.lit(")"))
    far, off = z >= threshold, z >= 0.66 * threshold
    return F.when(far, 0.80).when(off, 0.40), F.when(far, said("length_outlier")).when(off, said("length_deviation"))


def bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / max(1, seconds)).cast("long")


def feedback_buckets(feedback: DataFrame, key: str, seconds: int) -> DataFrame:
    """key, bucket, total, negative, and those of the bucket just before (0 if there is none)."""
    now = feedback.groupBy(key, bucket(F.col("ts"), seconds).alias("bucket")).agg(F.count("*").alias("total"), F.count_if("negative").alias("negative"))
    before = now.select(key, (F.col("bucket") + 1).alias("bucket"), F.col("total").alias("prev_total"), F.col("negative").alias("prev_negative"))
    out = now.join(before, [key, "bucket"], "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("prev_total", "prev_negative")})


def rate(negative: Column, total: Column) -> Column:
    return F.when(total > 0, negative / total).otherwise(0.0)


def feedback_as_of(feedback: DataFrame, responses: DataFrame, key: str, seconds: int, own: bool = False) -> DataFrame:
    """Each response (id, key, ts) with samples and rate of the feedback before it; at equal times feedback comes first.

    Feedback and responses are one union with running sums within a bucket, plus the bucket before; there
    is no range join, and a bucket of any size is shared by many tasks.  With ``own``, each feedback row is
    returned instead, with its own signal counted.
    """
    cut = Cut(feedback.sparkSession)
    f = feedback.select("id", key, "ts", F.col("negative").cast("int").alias("neg"), F.lit(0).alias("kind"))
    r = responses.select("id", key, "ts", F.lit(0).alias("neg"), F.lit(1).alias("kind"))
    every = cut(f.unionByName(r).withColumn("bucket", bucket(F.col("ts"), seconds)))
    totals = every.where("kind = 0").groupBy(F.col(key).alias("_k"), (F.col("bucket") + 1).alias("_b")).agg(F.count("*").alias("pn"), F.sum("neg").alias("pbad"))
    every = running(every, [key, "bucket"], ["ts", "kind", "id"], {"n": (1 - F.col("kind")).cast("long"), "bad": F.col("neg").cast("long")}, cut)
    out = every.where(F.col("kind") == (0 if own else 1)).join(totals, F.col(key).eqNullSafe(F.col("_k")) & (F.col("bucket") == F.col("_b")), "left")
    samples = (F.col("n") + F.coalesce("pn", F.lit(0))).cast("long")
    return out.select("id", key, "ts", samples.alias("samples"), rate(F.col("bad") + F.coalesce("pbad", F.lit(0)), samples).alias("rate"))


def feedback_signal(samples: Column, rate_: Column, least: int, threshold: float) -> Column:
    return F.when((samples >= least) & (rate_ >= threshold), F.lit(0.75))
