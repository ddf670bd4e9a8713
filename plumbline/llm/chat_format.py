"""Multi-party perspective rotation, by DataFrame functions only.

For every participant of a conversation (each role but ``system``) the dialogue is rendered with
that speaker as assistant and the others as named users.  There is a row for each turn of each
perspective: its rendered segment, where the segment starts in the dialogue (the segments one after
another, in code points) and the mask, the range of the dialogue whose loss counts there: the
speaker's own text and its end mark.

Turns are numbered 1, 2, ... by turn, role and text, nulls first, whatever their turn values.  Numbers
and places are running sums over blocks of a range partitioning, so a conversation of any length is
shared by many tasks.  ``dialogues`` joins the segments to one text for each perspective, where a
dialogue is known to fit a row.

A null text is empty, a null role is ``unknown``, rows with a null conv_id are one conversation;
repeated rows are repeated turns.  A conversation with only system turns gives no row.  ``<|`` inside
a text becomes ``< |``; in a role ``|>`` becomes ``| >`` too and each control character a space, so
neither can imitate a mark; roles that are alike then are one participant.  Extra columns are ignored
and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Cut, running, shared_folder

SYSTEM, OWN, END = "<|system|>\n", "<|assistant|>\n", "<|end|>"


def safe_role(role: Column) -> Column:
    role = F.replace(F.replace(F.coalesce(role, F.lit("unknown")), F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))
    return F.regexp_replace(role, r"[\x00-\x1F\x7F]", " ")


def user_mark(role: Column) -> Column:
    return F.concat(F.lit("<|user name="), role, F.lit("|>\n"))


def rotate(turns: DataFrame) -> DataFrame:
    """conv_id, perspective, n, text, start, mask ('start:end' or empty), n_masked: a row for each turn of each perspective."""
    spark = turns.sparkSession
    shared_folder(spark)
    cut = Cut(spark)
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select("conv_id", "turn", safe_role(F.col("role")).alias("role"), text.alias("text"))
    mark = F.when(F.col("role") == "system", F.lit(SYSTEM)).otherwise(user_mark(F.col("role")))
    rows = rows.withColumns({"mark": mark, "body": F.concat("text", F.lit(END))})
    size = (F.length("mark") + F.length("body") + 1).cast("long")
    rows = cut(running(rows, ["conv_id"], ["turn", "role", "text"], {"n": F.lit(1).cast("long"), "end": size}, cut))
    speakers = rows.where("role <> 'system'").select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective")).distinct()
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    seen = rows.select("conv_id", "n", (F.col("role")).alias("_role")).join(speakers, same).select("conv_id", "perspective", "n", (F.col("_role") == F.col("perspective")).alias("own"))
    # each own turn has the assistant's mark where the places counted the user's
    less = F.when(F.col("own"), F.length(user_mark(F.col("perspective"))) - len(OWN)).otherwise(0).cast("long")
    seen = running(seen, ["conv_id", "perspective"], ["n"], {"less": less}, cut)
    seen = seen.select(F.col("conv_id").alias("_conv"), F.col("n").alias("_n"), "perspective", "own", "less")
    both = rows.join(seen, same & (F.col("n") == F.col("_n")))
    head = F.when(F.col("own"), F.lit(OWN)).otherwise(F.col("mark"))
    end = F.col("end") - F.col("less") - 1
    masked = F.when(F.col("own"), F.length("body")).otherwise(0).cast("long")
    return both.select(
        "conv_id", "perspective", "n", F.concat(head, "body", F.lit("\n")).alias("text"), (end - F.length("body") - F.length(head)).alias("start"),
        F.when(F.col("own"), F.concat_ws(":", (end - F.length("body")).cast("string"), end.cast("string"))).otherwise("").alias("mask"), masked.alias("n_masked"),
    )


def dialogues(rotated: DataFrame) -> DataFrame:
    """conv_id, perspective, n_turns, text, mask (ranges, comma-joined), n_masked: whole dialogues, each in one row and so in one task."""
    parts = rotated.groupBy("conv_id", "perspective").agg(F.array_sort(F.collect_list(F.struct("n", "text", "mask"))).alias("parts"), F.sum("n_masked").alias("n_masked"))
    masks = F.filter(F.transform("parts", lambda p: p["mask"]), lambda m: m != "")
    return parts.select("conv_id", "perspective", F.size("parts").cast("long").alias("n_turns"), F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), F.array_join(masks, ",").alias("mask"), "n_masked")
