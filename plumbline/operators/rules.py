"""Content and structural rules: column expressions that give arrays of signals."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions.text import blank, has, joined, times, words
from ..settings import Settings

SIGNAL = "struct<category:string,weight:double,reason:string>"
SIGNALS = f"array<{SIGNAL}>"


def signal(category: str, weight, reason) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit(category).alias("category"), as_col(weight).cast("double").alias("weight"), as_col(reason).alias("reason")).cast(SIGNAL)


def some(candidates: list[tuple[Column, Column]]) -> Column:
    """The signals whose condition holds, in order."""
    if not candidates:
        return F.array().cast(SIGNALS)
    return F.array_compact(F.array(*[F.when(c, s) for c, s in candidates])).cast(SIGNALS)


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds _joined and _words once, so that rules share them."""
    return df.withColumn("_joined", joined(F.coalesce(F.col(text), F.lit("")))).withColumn("_words", words(F.col("_joined")))


def phrases(category: str, settings: Settings) -> Column:
    j = F.col("_joined")
    found = [(has(j, p), signal(category, w, f"{rule}({p})")) for c, rule, w, ps in L.PHRASE_RULES if c == category for p in ps]
    if category == "toxicity":
        found += [(has(j, t), signal(category, L.CUSTOM_WEIGHT, f"custom_term({t})")) for t in settings.toxicity_terms]
    return some(found)


def shouting(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, r"[^\p{IsAlphabetic}]+", ""))
    capitals = F.length(F.regexp_replace(text, r"[^\p{IsUppercase}]+", ""))
    return (letters >= 40) & (capitals / letters > 0.7)


def bias(settings: Settings) -> Column:
    """A group, then a copula within three words, then a marker within six; each (group, marker) once.

    Only texts with some group are looked at word by word.
    """
    groups = list(dict.fromkeys([*L.GROUPS, *settings.bias_groups]))
    w, j = F.col("_words"), F.col("_joined")
    known = F.array(*[F.struct(F.lit(g).alias("phrase"), F.lit(len(g.split())).alias("n")) for g in groups])
    copulas = F.array(*[F.lit(c) for c in L.COPULAS])
    marks = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(weight).alias("w")) for ms, weight in ((L.STRONG, L.STRONG_WEIGHT), (L.WEAK, L.WEAK_WEIGHT)) for m in ms])
    heads = sorted({g.split()[0] for g in groups})
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1))), lambda i: F.get(w, i - 1).isin(*heads))

    def at(i: Column) -> Column:
        found = F.filter(known, lambda g: F.array_join(F.slice(w, i, g["n"]), " ") == g["phrase"])
        return F.flatten(F.transform(found, lambda g: of(i, g)))

    def of(i: Column, g: Column) -> Column:
        after = F.slice(w, i + g["n"], 6)
        tail = F.concat(F.lit(" "), F.array_join(after, " "), F.lit(" "))
        hit = F.transform(
            F.filter(marks, lambda m: F.contains(tail, F.concat(F.lit(" "), m["m"], F.lit(" ")))),
            lambda m: signal("bias", m["w"], F.concat(F.lit("generalisation("), g["phrase"], F.lit(":"), m["m"], F.lit(")"))),
        )
        general = F.when((i > 1) & F.get(w, i - 2).isin(*L.PREFIXES), F.array(signal("bias", L.WEAK_WEIGHT, F.concat(F.lit("generalisation(all "), g["phrase"], F.lit(")"))))).otherwise(F.array().cast(SIGNALS))
        return F.when(F.arrays_overlap(F.slice(after, 1, 3), copulas), F.concat(hit, general)).otherwise(F.array().cast(SIGNALS))

    mentioned = j.rlike(" (?:" + "|".join(re.escape(g) for g in groups) + ") ")
    return F.when(mentioned, F.array_distinct(F.flatten(F.transform(places, at)))).otherwise(F.array().cast(SIGNALS)).cast(SIGNALS)


def hedge_count() -> Column:
    """Counted only where some hedge occurs; a column of its own, so that it is counted once."""
    j = F.col("_joined")
    every = sum((times(j, h) for h in L.HEDGES[1:]), times(j, L.HEDGES[0]))
    return F.when(j.rlike(" (?:" + "|".join(re.escape(h) for h in L.HEDGES) + ") "), every).otherwise(0)


def hallucination(text: Column, settings: Settings) -> Column:
    j = F.col("_joined")
    low = F.lower(text)
    n = F.size("_words")
    hedges = F.col("_hedges")
    doi = F.contains(low, F.lit("doi.org/10.")) | F.contains(low, F.lit("doi:10.")) | F.contains(low, F.lit("doi: 10."))
    more = some([
        (doi, signal("hallucination", 0.20, "unverified_doi")),
        (text.rlike(r"\[[0-9]{1,3}\]") & ~F.contains(low, F.lit("http")), signal("hallucination", 0.20, "reference_markers_without_sources")),
        (has(j, "et al"), signal("hallucination", 0.15, "et_al_citation")),
        ((hedges >= 3) & (hedges * 100.0 / F.greatest(n, F.lit(1)) >= 2.0), signal("hallucination", 0.25, F.concat(F.lit("hedging_density("), hedges.cast("string"), F.lit("/"), n.cast("string"), F.lit(")")))),
    ])
    return F.concat(phrases("hallucination", settings), more)


def content_signals(df: DataFrame, settings: Settings, text: str = "text", categories: tuple[str, ...] = L.CATEGORIES) -> DataFrame:
    """Adds ``content``: the signals a judge's verdict replaces, of the categories asked for."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = []
    if "toxicity" in categories:
        found += [phrases("toxicity", settings), some([(shouting(t), signal("toxicity", L.SHOUTING_WEIGHT, "shouting"))])]
    if "bias" in categories:
        found.append(bias(settings))
    if "hallucination" in categories:
        df = df.withColumn("_hedges", hedge_count())
        found.append(hallucination(t, settings))
    return df.withColumn("content", F.concat(*found) if found else F.array().cast(SIGNALS))


def repetition(w: Column) -> Column:
    """1 - distinct / all of the four-word runs (told apart by 64-bit hashes), null under 30 words."""
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - 4), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(4)]))
    return F.when(F.size(w) >= 30, 1.0 - F.size(F.array_distinct(runs)) / (F.size(w) - 3).cast("double"))


def structural_signals(df: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """Adds ``structural`` from text, has_tool_calls, finish_reasons, logprob_sum and logprob_count."""
    t = F.coalesce(F.col(text), F.lit(""))
    mean = F.when(F.col("logprob_count") > 0, F.col("logprob_sum") / F.col("logprob_count"))
    said = lambda name: F.concat(F.lit(f"{name}(mean_logprob="), F.format_string("%.2f", mean), F.lit(")"))
    low = F.when(mean < 2 * settings.low_logprob, F.array(signal("hallucination", 0.70, said("very_low_confidence")))).when(mean < settings.low_logprob, F.array(signal("hallucination", 0.50, said("low_confidence")))).otherwise(F.array().cast(SIGNALS))
    known = F.create_map(*[x for k, w, r in (("length", 0.45, "truncated(finish_reason=length)"), ("content_filter", 0.80, "provider_content_filter"), ("failed", 0.60, "agent_task_failed")) for x in (F.lit(k), signal("anomaly", w, r))])
    ended = F.array_compact(F.transform(F.coalesce("finish_reasons", F.array().cast("array<string>")), lambda r: F.element_at(known, r)))
    df = df.withColumn("_ratio", repetition(F.col("_words")))
    ratio = F.col("_ratio")
    odd = F.length(F.regexp_replace(t, r"[^\x{FFFD}\p{Cc}]+|[\n\r\t]+", ""))
    rest = some([
        (ratio >= 0.3, signal("anomaly", 0.5 + 0.4 * F.least((ratio - 0.3) / 0.4, F.lit(1.0)), F.concat(F.lit("repetition(ratio="), F.format_string("%.2f", ratio), F.lit(")")))),
        ((F.length(t) >= 20) & (odd / F.length(t) >= 0.05), signal("anomaly", 0.70, "garbled_output")),
    ])
    empty = some([(blank(t) & ~F.coalesce("has_tool_calls", F.lit(False)), signal("anomaly", 0.90, "empty_output"))])
    return df.withColumn("structural", F.concat(low, empty, ended, rest).cast(SIGNALS)).drop("_ratio")
