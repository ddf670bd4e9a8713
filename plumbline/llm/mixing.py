"""Mixing to target weights by iterative proportional fitting, by DataFrame functions only.

Documents are counted into cells (source, language, topic) of word tokens.  The cells' weights are
raked in turn to each margin's targets until no margin's shares are off by more than ``tolerance`` (or
no longer come nearer, where empty cells make the targets unreachable); ``margins`` reports what is
reached.  Then a level is found such that cells filled up to it, none beyond what it holds, have ``keep``
of all tokens: it solves the sum exactly, by sums over the cells in the order in which they fill up.
A document is sampled if a hash of its doc_id, as a number below 1, is under its cell's probability,
so the choice does not depend on partitioning.  Up to ``few_cells`` cells are raked in one partition
and broadcast; more are aggregated before each shuffle, their margins' sums joined.

A margin's target is a power (its own shares raised to it) or explicit weights by value; values
without a weight are then not sampled.  The topic is a column ``topic`` where the table has one, else
the form of the text (``form_of``).  A null source, language or topic counts as ''.  Null and empty
texts have no tokens: they are kept out of the margins and sampled with their cell's probability, 0 if
the cell has no tokens.  A null doc_id hashes like ''.  Repeated rows share one fate.  An empty table
gives an empty result.  Columns named n_tokens, probability or kept are replaced, whatever they held.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import running
from .common import Cut, prepare

MARGINS = ("source", "lang", "topic")
TARGETS: dict[str, float | dict[str, float]] = {"source": 0.5, "lang": 0.7, "topic": 0.9}
FEW_CELLS = 200_000
FEW_VALUES = 100_000  # of one margin: sums that are broadcast
ROUNDS = 8  # between two looks at the residual
DATA = r"[0-9{}<>|=;#_\\/\[\]]"


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\r\n]+")), F.lit(0)).cast("long")


def form_of(text: Column, n: Column) -> Column:
    """What a text is made of: data (3 in 100 characters are figures or markup), or prose by its length; for tables without a topic of their own."""
    return F.when(n == 0, "empty").when(F.regexp_count(text, F.lit(DATA)) * 33 >= F.length(text), "data").when(n < 100, "short").when(n > 600, "long").otherwise("prose")


def measured(docs: DataFrame) -> DataFrame:
    df = docs.withColumn("n_tokens", tokens(F.col("text")))
    if "topic" not in docs.columns:
        df = df.withColumn("topic", form_of(F.coalesce("text", F.lit("")), F.col("n_tokens")))
    return df.withColumns({m: F.coalesce(F.col(m).cast("string"), F.lit("")) for m in MARGINS})


def _share(margin: str, target: float | dict[str, float]) -> Column:
    """A margin's target before it is made a share, on a row for each of its values."""
    if isinstance(target, dict):
        pairs = [F.lit(x) for kv in target.items() for x in kv]
        return F.coalesce(F.element_at(F.create_map(*pairs), F.col(margin)).cast("double"), F.lit(0.0))
    return F.pow("_own", F.lit(float(target)))


class Cells:
    """Sums over the cells: in windows of one partition if they are few, else aggregated and joined."""

    def __init__(self, few: bool, cut: Cut):
        self.few, self.cut = few, cut

    def laid(self, df: DataFrame) -> DataFrame:
        """Written and read back; few cells into one partition, which windows by any key then need no shuffle for."""
        df = self.cut(df)
        return df.coalesce(1) if self.few else df

    def with_sum(self, df: DataFrame, value: Column, name: str, key: str | None) -> DataFrame:
        """``df`` with the sum of ``value`` over the rows that share ``key`` (all rows for None)."""
        if self.few:
            return df.withColumn(name, F.sum(value).over(Window.partitionBy(F.col(key) if key else F.lit(0))))
        if not key:
            return df.withColumn(name, F.lit(df.agg(F.sum(value)).first()[0]))
        sums = self.cut(df.groupBy(key).agg(F.sum(value).alias(name)))
        if sums.count() <= FEW_VALUES:  # a checked size; else Spark chooses
            sums = F.broadcast(sums)
        return self.laid(df.join(sums, key))


def targeted(cells: DataFrame, targets: dict, at: Cells) -> DataFrame:
    """The cells with each margin's target share, t_source and so on, and w, their weight so far."""
    df = at.laid(cells.withColumn("w", F.col("tokens").cast("double")))
    for m in MARGINS:
        values = df.groupBy(m).agg(F.sum("w").alias("_own"))
        values = at.cut(values.select(m, _share(m, targets[m]).alias("_t")))
        total = values.agg(F.sum("_t")).first()[0] or 0.0
        values = values.select(m, (F.col("_t") / F.lit(total) if total else F.lit(0.0)).alias(f"t_{m}"))
        df = df.join(F.broadcast(values) if at.few or values.count() <= FEW_VALUES else values, m)
    return at.laid(df)


def margins(df: DataFrame) -> DataFrame:
    """margin, value, target, share: what the weights ``w`` of raked cells have reached."""
    parts = [df.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(F.first(f"t_{m}").alias("target"), F.sum("w").alias("share")) for m in MARGINS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def raked(cells: DataFrame, targets: dict, tolerance: float, at: Cells) -> tuple[DataFrame, float]:
    """The cells with w raked to the targets, as shares, and the residual: the most a margin's share is off."""
    df = targeted(cells, targets, at)
    last = math.inf
    while True:
        for _ in range(ROUNDS):
            for m in MARGINS:
                df = at.with_sum(df, F.col("w"), "_sum", m)
                df = df.withColumn("w", F.when(F.col("_sum") > 0, F.col("w") * F.col(f"t_{m}") / F.col("_sum")).otherwise(0.0)).drop("_sum")
        df = at.with_sum(df, F.col("w"), "_sum", None)
        df = at.laid(df.withColumn("w", F.when(F.col("_sum") > 0, F.col("w") / F.col("_sum")).otherwise(0.0)).drop("_sum"))
        off = margins(df).agg(F.max(F.abs(F.col("share") - F.col("target")))).first()[0] or 0.0
        if off <= tolerance or off > 0.9 * last:
            return df, off
        last = off


def filled(df: DataFrame, keep: float, at: Cells) -> DataFrame:
    """source, lang, topic, tokens, weight, probability: the share of each cell's tokens below the level that gives ``keep`` of all.

    Cells fill up in the order of tokens / w.  With those before it full, a cell's level is what is left of
    the budget over the weight that is left; the first cell that this level does not fill has the true one.
    """
    full_at = F.when(F.col("w") > 0, F.col("tokens") / F.col("w")).otherwise(float("inf"))
    df = at.laid(df.withColumn("_r", full_at))
    everything = df.agg(F.sum("tokens"), F.sum("w")).first()
    budget, weight = keep * (everything[0] or 0), everything[1] or 0.0
    order = ["_r", *MARGINS]
    if at.few:
        upto = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        sums = df.withColumns({"_tokens": F.sum("tokens").over(upto), "_w": F.sum("w").over(upto)})
    else:
        sums = running(df.withColumn("_all", F.lit(0)), ["_all"], order, {"_tokens": F.col("tokens"), "_w": F.col("w")}, at.cut)
    left = F.lit(weight) - (F.col("_w") - F.col("w"))
    level = F.when(left > 0, (F.lit(budget) - (F.col("_tokens") - F.col("tokens"))) / left)
    first = sums.select(level.alias("level"), "_r", "_tokens").where("level <= _r").agg(F.min_by("level", "_tokens")).first()[0]
    p = F.when(F.col("w") > 0, F.least(F.lit(1.0), F.lit(first) * F.col("w") / F.col("tokens")) if first is not None else F.lit(1.0)).otherwise(0.0)
    return df.select(*MARGINS, "tokens", F.round("w", 9).alias("weight"), F.round(p, 9).alias("probability"))


def unit_hash(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mix_to_targets(docs: DataFrame, keep: float = 0.5, tolerance: float = 1e-12, targets: dict | None = None, few_cells: int = FEW_CELLS) -> DataFrame:
    """``docs`` with topic, n_tokens, probability and kept: one row for each input row."""
    cut = Cut(prepare(docs.sparkSession))
    df = measured(docs.drop("probability"))  # a column of that name would clash in the join
    cells = cut(df.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"))
    few = cells.count() <= few_cells  # a checked size
    at = Cells(few, cut)
    known = cut(filled(raked(cells, {**TARGETS, **(targets or {})}, tolerance, at)[0], keep, at)).select(*MARGINS, "probability")
    if few:
        known = F.broadcast(known)
    df = df.join(known, list(MARGINS), "left").withColumn("probability", F.coalesce("probability", F.lit(0.0)))
    df = df.withColumn("kept", unit_hash(F.col("doc_id")) < F.col("probability"))
    return df.select(*docs.columns, *[c for c in ("topic", "n_tokens", "probability", "kept") if c not in docs.columns])
