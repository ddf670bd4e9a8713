"""The demonstration's parts as columns: canned and scripted answers, word streams, agent tasks, what a client shows.

Answers and prompts are tables of the caller (key to text, in order); ``ANSWERS``, ``CLEAN`` and ``PROMPTS`` are
examples.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import wire

ANSWERS = {
    "rude": "What a pathetic plan, and you suck at plans.",
    "group": "Migrants are always dangerous.",
    "cite": "Experts agree on this [7]; Doe et al. say so, doi:10.5555/xyz.",
    "loop": "round and round we go and " * 12,
    "empty": "",
}
CLEAN = "Lisbon lies on the Tagus and is the capital of Portugal."
PROMPTS = {"normal": "Answer briefly and politely.", "rude": "Mock whoever asks.", "cite": "Always name a source."}


def texts_of(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def pick(messages: Column, answers: dict[str, str], otherwise: str) -> Column:
    """The answer whose key comes first among those in the last user message (array of role and content)."""
    own = F.filter(messages, lambda m: (m["role"] == "user") & m["content"].isNotNull())
    said = F.lower(F.coalesce(F.get(own, F.size(own) - 1)["content"], F.lit("")))
    return F.coalesce(*[F.when(F.contains(said, F.lit(k)), F.lit(a)) for k, a in answers.items()], F.lit(otherwise))


def is_known(mode: Column, answers: dict[str, str]) -> Column:
    return F.coalesce(mode.isin(*answers), F.lit(False))


def scripted(mode: Column, answers: dict[str, str]) -> Column:
    return F.coalesce(F.element_at(texts_of(answers), mode), F.lit(""))


def prompt_of(mode: Column, prompts: dict[str, str], default: str = "normal") -> Column:
    return F.coalesce(F.element_at(texts_of(prompts), mode), F.lit(prompts[default]))


def model_request(model: str, mode: Column, question: Column, prompts: dict[str, str]) -> Column:
    """The chat request of a real answer, as JSON."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.to_json(F.struct(F.lit(model).alias("model"), F.array(turn("system", prompt_of(mode, prompts)), turn("user", question)).alias("messages"), F.lit(False).alias("stream")))


def listing(answers: dict[str, str]) -> Column:
    """All answers as one JSON object; of no known shape, so it is never scored."""
    return F.to_json(texts_of(answers))


def question_of(parts: Column) -> Column:
    """The text of a message's parts (structs with text), one to a line."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["text"].isNotNull()), lambda p: p["text"]), "\n")


def task_answer(mode: Column, source: Column, answers: dict[str, str], model_answer: Column) -> Column:
    """A task's answer: scripted for a mode other than normal, else the model's (null: there is no key for it)."""
    known = F.when(is_known(mode, answers), scripted(mode, answers)).otherwise(F.concat(F.lit("Unknown demo mode '"), mode, F.lit("'.")))
    no_key = F.lit("Answers of a real model need a key; choose a scripted mode or set one.")
    return F.when((mode != "normal") & (source == "scripted"), known).otherwise(F.coalesce(model_answer, no_key))


def task(task_id: Column, answer: Column, error: Column) -> Column:
    """The finished task as JSON: the answer as its artifact, or a failed status."""
    artifact = F.struct(F.concat(F.lit("answer-"), task_id).alias("artifactId"), F.lit("answer").alias("name"), F.array(F.struct(answer.alias("text"))).alias("parts"))
    status = lambda state, note: F.struct(F.lit(state).alias("state"), F.struct(F.lit("ROLE_AGENT").alias("role"), F.array(F.struct(note.alias("text"))).alias("parts")).alias("message"))
    done = F.to_json(F.struct(F.struct(task_id.alias("id"), status("TASK_STATE_COMPLETED", F.lit("Answer ready.")).alias("status"), F.array(artifact).alias("artifacts")).alias("task")))
    failed = F.to_json(F.struct(F.struct(task_id.alias("id"), status("TASK_STATE_FAILED", F.concat(F.lit("The agent could not answer: "), error)).alias("status")).alias("task")))
    return F.when(error.isNull(), done).otherwise(failed)


def client_text(body: Column) -> Column:
    """What a client shows of a task or message: its artifacts, else its status message, and its own parts, one to a line."""

    @F.pandas_udf("string")
    def run(b: pd.Series) -> pd.Series:
        return pd.Series([shown(wire.parse(x)) for x in b], dtype=object)

    return run(body)


def shown(v) -> str:
    v = wire.unwrap(v, ("task", "message"))
    texts = lambda parts: [t for p in parts if (t := wire.text_at(p, "text")) is not None]
    artifacts = [t for a in wire.items(v, "artifacts") for t in texts(wire.items(a, "parts"))]
    return "\n".join((artifacts or texts(wire.items(v, "status", "message", "parts"))) + texts(wire.items(v, "parts")))


def word_events(text: Column, id_: str = "chat-1", model: str = "demo") -> Column:
    """The text as a stream of word events, a last one with the finish reason, and the end mark."""
    words = F.split(text, " ")
    name = [F.lit(id_).alias("id"), F.lit(model).alias("model")]
    event = lambda delta, end=None: F.concat(F.lit("data: "), F.to_json(F.struct(*name, F.array(F.struct(F.lit(0).alias("index"), delta.alias("delta"), *([F.lit(end).alias("finish_reason")] if end else []))).alias("choices"))), F.lit("\n\n"))
    each = F.transform(words, lambda w, i: event(F.struct(F.concat(w, F.when(i < F.size(words) - 1, " ").otherwise("")).alias("content"))))
    return F.concat(F.array_join(each, ""), event(F.struct(F.lit(None).cast("string").alias("content")), "stop"), F.lit("data: [DONE]\n\n"))
