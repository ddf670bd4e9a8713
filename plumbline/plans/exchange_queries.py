"""Registered queries of protocol bodies, streams, requests, judging and whole exchanges, and DuckDB SQL with the same results."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..operators import bodies, gates, judge, rules, scores, state
from ..settings import Feedback, Judge, Rule, Settings, SettingsError, from_dict, guard_token, normalise
from . import demo
from .pipeline import answer_feedback, evaluate, score_outputs
from .queries import _ALL, _DECIDE, _FEEDBACK, _RUNNING, ANOMALY, HALLUCINATION, SEEDED, SETTINGS, SHAPES, SQL, TOXICITY, WORDS, plain_outputs, query, quoted, r6, seeded

def doc() -> Column:
    return F.col("doc_id")


def literal(text: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.struct(text.alias("t")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def body(form: str, *texts: Column) -> Column:
    """``form`` with each ~ replaced by a text's JSON string."""
    parts = form.split("~")
    return F.concat(*[x for p, t in zip(parts, [*[literal(t) for t in texts], None], strict=True) for x in (F.lit(p), t) if x is not None])


def by_id(n: int, cases: dict[int, Column]) -> Column:
    out = F.when(doc() % n == -1, None)
    for k, v in cases.items():
        out = out.when(doc() % n == k, v)
    return out


def output_columns(o: Column) -> list[Column]:
    """An output's fields; null where the body has no known shape."""
    ok = o["ok"]
    kept = lambda c, name: F.when(ok, c).alias(name)
    return [ok.alias("ok"), kept(F.md5(o["text"].cast("binary")), "text_md5"), kept(o["id"], "id"), kept(o["has_tool_calls"], "tools"), kept(F.array_join(o["finish_reasons"], ","), "finish"), kept(o["logprob_sum"], "lp_sum"), kept(o["logprob_count"], "lp_count"), kept(o["truncated"], "truncated")]


def expected(n: int, cases: dict[int, tuple | None], source: str = "documents") -> str:
    """SQL of ``output_columns``: case -> (text, id, tools, finish, lp_sum, lp_count) or None."""
    pick = lambda i, default: "CASE d " + " ".join(f"WHEN {k} THEN {c[i]}" for k, c in cases.items() if c) + f" ELSE {default} END"
    ok = f"d IN ({', '.join(str(k) for k, c in cases.items() if c)})"
    shown = lambda x, kind: f"CASE WHEN {ok} THEN CAST({x} AS {kind}) END"
    return (
        f"WITH s AS (SELECT doc_id, text t, doc_id % {n} d, substr(text, 1, CAST(length(text) // 2 AS BIGINT)) a, substr(text, CAST(length(text) // 2 AS BIGINT) + 1) b FROM {source})"
        f" SELECT doc_id, {ok} ok, CASE WHEN {ok} THEN md5({pick(0, 'NULL')}) END text_md5, {shown(pick(1, 'NULL'), 'VARCHAR')} id, {shown(pick(2, 'false'), 'BOOLEAN')} tools, {shown(pick(3, 'NULL'), 'VARCHAR')} finish,"
        f" {shown(pick(4, '0'), 'DOUBLE')} lp_sum, {shown(pick(5, '0'), 'BIGINT')} lp_count, {shown('false', 'BOOLEAN')} truncated FROM s"
    )


# ---------------------------------------------------------------- bodies
@query
def extract_edges(spark, table):
    """Bodies that are no JSON, have tool calls, several shapes, several choices, log probabilities, parts."""
    t = F.col("text")
    b = by_id(12, {
        0: F.lit('{"choices":'), 1: F.concat(SHAPES["chat"](t), F.lit(" x")), 2: F.lit('{"id":"c","choices":[{"message":{"content":null,"tool_calls":[{}]},"finish_reason":"tool_use"}]}'),
        3: body('{"choices":[{"message":{"content":~,"tool_calls":[],"function_call":null},"finish_reason":"other"}]}', t), 4: body('{"choices":[{"message":{"content":~,"function_call":{}}}]}', t),
        5: body('{"type":"message","choices":[{"text":~}],"output":[{"type":"message","content":[{"text":"two"}]}],"content":[{"type":"text","text":"three"}]}', t),
        6: body('{"choices":[{"message":{"content":~},"finish_reason":"stop"},{"text":"b","finish_reason":"max_tokens"},{"finish_reason":"end_turn"}]}', t),
        7: body('{"choices":[{"message":{"content":~},"logprobs":{"content":[{"logprob":-1.5},{"logprob":"x"},{"logprob":-0.5},{}]}}]}', t),
        8: body('{"choices":[{"text":~,"logprobs":{"token_logprobs":[null,-1,-2]}}]}', t), 9: body('{"id":7,"choices":[{"message":{"content":[{"text":~},{"text":"z"},{"x":1}]}}]}', t),
        10: body('{"hello":~}', t), 11: F.lit('{"id":"r","output":[{"type":"function_call"}],"incomplete_details":{"reason":"max_output_tokens"}}'),
    })
    return table("documents").select("doc_id", bodies.extract(b, 10 << 20).alias("o")).select("doc_id", *output_columns(F.col("o")))


_N = "NULL"
SQL["extract_edges"] = expected(12, {
    0: None, 1: None, 2: ("''", "'c'", "true", "'tool_calls'", 0, 0), 3: ("t", _N, "false", "'other'", 0, 0), 4: ("t", _N, "true", "''", 0, 0), 5: ("t || 'twothree'", _N, "false", "''", 0, 0),
    6: ("t || chr(10) || chr(10) || 'b' || chr(10) || chr(10)", _N, "false", "'stop,length'", 0, 0), 7: ("t", _N, "false", "''", -2, 2), 8: ("t", _N, "false", "''", -3, 2), 9: ("t || 'z'", _N, "false", "''", 0, 0), 10: None, 11: ("''", "'r'", "true", "'length'", 0, 0),
})


@query
def extract_agent_edges(spark, table):
    """Agent bodies: an error, wrapped tasks, status and artifact updates, part kinds, a message without parts."""
    t = F.col("text")
    b = by_id(9, {
        0: body('{"jsonrpc":"2.0","error":{"message":~}}', t), 1: body('{"jsonrpc":"2.0","result":{"task":{"id":"t1","artifacts":[{"parts":[{"text":~}]}]}}}', t),
        2: body('{"jsonrpc":"2.0","result":{"statusUpdate":{"taskId":"t2","status":{"state":"TASK_STATE_FAILED","message":{"parts":[{"text":~}]}}}}}', t),
        3: body('{"jsonrpc":null,"result":{"artifact_update":{"taskId":"t3","artifact":{"parts":[{"type":"text","text":~}]}}}}', t),
        4: body('{"jsonrpc":"2.0","result":{"parts":[{"kind":"text","text":~},{"kind":"file","text":"no"},{"type":"data","text":"no"},{"kind":5,"type":"data","text":"x"},{"text":6}]}}', t),
        5: body('{"artifacts":[{"parts":[{"text":~}]},{"parts":[{"text":"two"}]}],"status":{"state":"input-required","message":{"parts":[{"text":"note"}]}}}', t),
        6: body('{"message":{"role":~}}', t), 7: body('{"task":{"status":{"state":"working"}},"choices":[{"text":~}]}', t), 8: body('{"jsonrpc":"2.0","result":{"id":"t8","status":{"state":"rejected"}}}'),
    })
    return table("documents").select("doc_id", bodies.extract(b, 10 << 20).alias("o")).select("doc_id", *output_columns(F.col("o")))


SQL["extract_agent_edges"] = expected(9, {
    0: None, 1: ("t", "'t1'", "false", "''", 0, 0), 2: ("t", "'t2'", "false", "'failed'", 0, 0), 3: ("t", "'t3'", "false", "''", 0, 0), 4: ("t || chr(10) || 'x'", _N, "false", "''", 0, 0),
    5: ("t || chr(10) || 'two'", _N, "false", "'stop'", 0, 0), 6: None, 7: ("t", _N, "false", "''", 0, 0), 8: ("''", "'t8'", "false", "'failed'", 0, 0),
})


def streamed(df: DataFrame, events: Column, limit: int = 10 << 20) -> DataFrame:
    """doc_id and the output of a stream given as text, cut into chunks of seven bytes and one of the rest."""
    raw = df.select(F.col("doc_id").cast("string").alias("exchange_id"), events.cast("binary").alias("b"))
    cuts = F.array(*[F.substring("b", F.lit(1 + 7 * i), F.lit(7)) for i in range(4)], F.substring("b", F.lit(29), F.octet_length("b")))
    chunks = raw.select("exchange_id", F.posexplode(cuts).alias("seq", "chunk"))
    return bodies.budgeted(chunks, limit).select(F.col("exchange_id").cast("long").alias("doc_id"), bodies.extract_stream(F.col("stream"), F.col("capped"), limit).alias("o"))


def halves() -> tuple[Column, Column]:
    half = F.floor(F.length("text") / 2).cast("int")
    return F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text"))


@query
def stream_typed(spark, table):
    """Typed events of two protocols, tool calls, an unterminated last event, streams of no known shape."""
    a, b = halves()
    event = lambda form, *t: F.concat(F.lit("event: x\ndata: "), body(form, *t), F.lit("\n\n"))
    delta, block = '{"type":"response.output_text.delta","delta":~}', '{"type":"content_block_delta","delta":{"text":~}}'
    e = by_id(8, {
        0: F.concat(event('{"type":"response.created","response":{"id":"r0","model":"m"}}'), event(delta, a), event(delta, b), event('{"type":"response.incomplete","response":{"incomplete_details":{"reason":"max_output_tokens"}}}')),
        1: F.concat(event('{"type":"message_start","message":{"id":"m1","model":"m"}}'), event(block, a), event(block, b), event('{"type":"message_delta","delta":{"stop_reason":"end_turn"}}')),
        2: F.concat(event('{"type":"content_block_start","content_block":{"type":"tool_use"}}'), event('{"type":"response.function_call_arguments.delta"}')),
        3: event('{"type":"message_delta","delta":{"stop_reason":"end_turn"}}'), 4: F.concat(F.lit(": note\n\ndata: [DONE]\n\ndata: 5\n\n"), event('{"type":"ping"}')),
        5: F.concat(event('{"choices":[{"delta":{"content":~,"tool_calls":[]},"logprobs":{"content":[{"logprob":-2}]}}]}', a), F.lit("data: "), body('{"choices":[{"text":~,"finish_reason":"stop"}]}', b)),
        6: F.concat(F.lit("data: "), F.regexp_replace(body('{"choices":[{"delta":{"content":~}}]}', F.lit("one")), ":", ":\ndata:"), F.lit("\r\n\r\n"), event(delta, a)),
        7: F.concat(event('{"type":"response.output_text.delta","delta":~,"logprobs":[{"logprob":-1},{"logprob":-3}]}', a), event('{"type":"content_block_start","content_block":{"type":"text"}}')),
    })
    return streamed(table("documents"), e).select("doc_id", *output_columns(F.col("o")))


SQL["stream_typed"] = expected(8, {
    0: ("t", "'r0'", "false", "'length'", 0, 0), 1: ("t", "'m1'", "false", "'stop'", 0, 0), 2: ("''", _N, "true", "''", 0, 0), 3: None, 4: None,
    5: ("t", _N, "true", "'stop'", -2, 1), 6: ("'one' || a", _N, "false", "''", 0, 0), 7: ("a", _N, "false", "''", -4, 2),
})


@query
def stream_agent(spark, table):
    """Agent events: artifacts over several events, a status note after them, a failure."""
    a, b = halves()
    event = lambda form, *t: F.concat(F.lit("data: "), body(form, *t), F.lit("\n\n"))
    part, note = '{"jsonrpc":"2.0","result":{"artifactUpdate":{"taskId":"t","artifact":{"parts":[{"text":~}]}}}}', '{"jsonrpc":"2.0","result":{"statusUpdate":{"taskId":"t","status":{"state":"completed","message":{"parts":[{"text":"note"}]}}}}}'
    e = by_id(4, {0: F.concat(event(part, a), event(part, b)), 1: F.concat(event(part, a), event(note)), 2: event('{"jsonrpc":"2.0","error":{}}'), 3: F.concat(event('{"task":{"id":"w","status":{"state":"working"}}}'), event('{"statusUpdate":{"status":{"state":"failed"}}}'))})
    return streamed(table("documents"), e).select("doc_id", *output_columns(F.col("o")))


_LINE = "CASE WHEN {0} <> '' THEN {0} || chr(10) ELSE '' END"
SQL["stream_agent"] = expected(4, {0: (_LINE.format("a") + " || b", "'t'", "false", "''", 0, 0), 1: (_LINE.format("a") + " || 'note'", "'t'", "false", "'stop'", 0, 0), 2: None, 3: ("''", "'w'", "false", "'working,failed'", 0, 0)})


@query
def chunk_budget(spark, table):
    """Three chunks of one event each, under a budget of bytes that some reach."""
    event = lambda n: F.concat(F.lit("data: "), body('{"choices":[{"delta":{"content":~}}]}', F.repeat(F.lit("a"), n.cast("int"))), F.lit("\n\n")).cast("binary")
    df = table("documents").select(F.col("doc_id").cast("string").alias("exchange_id"), F.posexplode(F.array(event(doc() % 90), event(doc() % 70), event(doc() % 50))).alias("seq", "chunk"))
    o = bodies.budgeted(df, 150).withColumn("o", bodies.extract_stream(F.col("stream"), F.col("capped"), 150))
    return o.select(F.col("exchange_id").cast("long").alias("doc_id"), F.length("o.text").cast("long").alias("n"), F.col("o.truncated").alias("truncated"), F.size("stream").cast("long").alias("chunks"))


SQL["chunk_budget"] = """WITH s AS (SELECT doc_id, doc_id % 90 x, doc_id % 70 y, doc_id % 50 z FROM documents), k AS (SELECT *, 46 + x < 150 two, 92 + x + y < 150 three FROM s),
e AS (SELECT *, x + CASE WHEN two THEN y ELSE 0 END + CASE WHEN three THEN z ELSE 0 END n FROM k)
SELECT doc_id, least(n, 150) n, NOT three OR n > 150 truncated, 1 + CAST(two AS BIGINT) + CAST(three AS BIGINT) chunks FROM e"""


@query
def text_cap(spark, table):
    """Text beyond the limit of bytes is cut at a character."""
    text = F.concat(F.repeat(F.lit("é"), (doc() % 7).cast("int")), F.repeat(F.lit("€"), (doc() % 5).cast("int")), F.repeat(F.lit("x"), (doc() % 3).cast("int")))
    o = table("documents").select("doc_id", text.alias("t"), bodies.extract_stream(F.array(F.concat(F.lit("data: "), body('{"choices":[{"text":~}]}', text)).cast("binary")), F.lit(False), 11).alias("o"))
    return o.select("doc_id", F.col("o.text").alias("text"), F.col("o.truncated").alias("truncated"))


SQL["text_cap"] = """WITH s AS (SELECT doc_id, doc_id % 7 e, doc_id % 5 u, doc_id % 3 x FROM documents), m AS (SELECT *, least(e, 5) ke FROM s), n AS (SELECT *, least(u, (11 - 2 * ke) // 3) ku FROM m),
k AS (SELECT *, CASE WHEN ke = e AND ku = u THEN least(x, 11 - 2 * ke - 3 * ku) ELSE 0 END kx FROM n)
SELECT doc_id, repeat('é', ke) || repeat('€', ku) || repeat('x', kx) AS text, 2 * e + 3 * u + x > 11 truncated FROM k"""


# ---------------------------------------------------------------- requests
@query
def request_classify(spark, table):
    """Which requests' answers are skipped, and the conversation of the others, over all request forms."""
    t = F.left("text", F.lit(300))
    b = by_id(12, {
        0: body('{"jsonrpc":"2.0","method":"message/send","params":{"message":{"parts":[{"text":~},{"kind":"file","text":"no"}]}}}', t), 1: body('{"jsonrpc":"2.0","method":"tasks/get","params":{"id":~}}', t),
        2: body('{"method":"message/send","prompt":~}', t), 3: body('{"message":{"parts":[{"text":~}]}}', t), 4: body('{"instructions":"be kind","input":~}', t),
        5: body('{"input":[~,{"role":"developer","content":"rule"},{"content":[{"text":"x"},{"text":"y"}]},{"role":"tool","content":""}]}', t), 6: body('{"system":[{"text":"s1"},{"text":"s2"}],"prompt":[~,"two",3]}', t),
        7: F.lit("not json"), 8: body('{"model":~}', t), 9: body('{"messages":[{"role":"assistant","content":~},{"content":5},{"role":"system","content":"late"}],"input":"in"}', t), 10: body('{"jsonrpc":"2.0","method":"SendStreamingMessage","params":{}}'),
        11: body('{"messages":[{"role":7,"content":~}]}', t),
    })
    path = F.when(doc() % 12 == 3, "/a/message:send?x=1").otherwise("/v1/x")
    return table("documents").select("doc_id", bodies.classify(path, b, 200).alias("r")).select("doc_id", "r.skip", "r.conversation")


_TAIL = "CASE WHEN length({0}) > {1} THEN '…' || right({0}, CAST({1} - 1 AS BIGINT)) ELSE {0} END"
SQL["request_classify"] = f"""WITH s AS (SELECT doc_id, doc_id % 12 d, substr(text, 1, 300) t FROM documents),
p AS (SELECT *, CASE d WHEN 4 THEN 'SYSTEM: be kind' || chr(10) WHEN 5 THEN 'SYSTEM: rule' || chr(10) WHEN 6 THEN 'SYSTEM: s1' || chr(10) || 's2' || chr(10) WHEN 9 THEN 'SYSTEM: late' || chr(10) ELSE '' END p,
CASE WHEN d IN (0, 2, 3, 4) THEN 'USER: ' || t WHEN d = 5 THEN 'USER: ' || t || chr(10) || 'USER: x' || chr(10) || 'y' WHEN d = 6 THEN 'USER: ' || t || chr(10) || 'USER: two' WHEN d = 9 THEN 'ASSISTANT: ' || t || chr(10) || 'USER: in' WHEN d = 11 THEN 'USER: ' || t END c FROM s)
SELECT doc_id, d = 1 skip, p || {_TAIL.format('c', '(200 - length(p))')} conversation FROM p"""


@query
def system_budget(spark, table):
    """The system part takes a quarter of the budget, the last turns the rest."""
    b = body('{"instructions":~,"messages":[{"role":"user","content":"first"},{"role":"Assistant","content":~}]}', F.col("text"), F.col("text"))
    out = [bodies.classify(F.lit("/"), b, n)["conversation"] for n in (400, 7, 0)]
    return table("documents").select("doc_id", *[F.md5(c.cast("binary")).alias(f"c{n}") for n, c in zip((400, 7, 0), out, strict=True)])


SQL["system_budget"] = f"""WITH s AS (SELECT doc_id, 'SYSTEM: ' || CASE WHEN length(text) > 100 THEN substr(text, 1, 99) || '…' ELSE text END || chr(10) p, 'SYSTEM: ' || CASE WHEN length(text) > 1 THEN '…' ELSE text END || chr(10) q,
'USER: first' || chr(10) || 'ASSISTANT: ' || text t FROM documents)
SELECT doc_id, md5(p || {_TAIL.format('t', '(400 - length(p))')}) c400, md5(q || '…') c7, NULL::VARCHAR c0 FROM s"""


@query
def guard_calls(spark, table):
    """The engine's own questions to the judge carry a token made from its configuration."""
    config = '{"judgeService":"http://judge"}'
    settings = Settings.from_json(config)
    df = table("documents").select("doc_id", F.when(doc() % 3 == 0, guard_token(config)).when(doc() % 3 == 1, "0123456789abcdef").alias("req_guard"), (doc() % 7 == 0).alias("is_judge_call"), F.lit("/v1").alias("req_path"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("content_encoding"), F.lit("application/json").alias("resp_content_type"), F.col("text").alias("resp_body"))
    return df.select("doc_id", gates.uninspected_reason(settings, df.columns).alias("reason"), gates.own_call(settings, ["req_guard"]).alias("by_token"))


SQL["guard_calls"] = "SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 7 = 0 THEN 'judge_call' WHEN strlen(text) > 262144 THEN 'too_large' END reason, doc_id % 3 = 0 by_token FROM documents"


# ---------------------------------------------------------------- judging
@query
def judge_gate(spark, table):
    """Who is asked: nobody for blank text; on suspicion, those whose rules reach the score."""
    df = plain_outputs(seeded(table)).withColumn("text", F.when(doc() % 9 == 0, "   ").otherwise(F.col("text")))
    df = rules.structural_signals(rules.content_signals(rules.with_words(df), SETTINGS), SETTINGS)
    return df.select("doc_id", judge.should_call(Judge("j"), F.col("text")).alias("always"), judge.should_call(Judge("j", "onSuspicion", suspicion=0.5), F.col("text")).alias("suspicious"))


SQL["judge_gate"] = f"{_ALL} SELECT doc_id, doc_id % 9 <> 0 AS always, doc_id % 9 <> 0 AND greatest(hallucination, toxicity, bias, anomaly) >= 0.5 suspicious FROM y"


@query
def judge_request(spark, table):
    """The question's fields, with and without JSON mode and operator's rules."""
    one = Judge("j", model="m-1", instructions="Be strict.", json_mode=True)
    two = Judge("j", model="m-2", json_mode=False)
    context = F.when(doc() % 2 == 0, F.concat(F.lit("USER: <context>"), F.col("doc_id").cast("string")))
    read = lambda b, p: F.get_json_object(b, p)
    df = table("documents").select("doc_id", judge.request(one, context, F.col("text")).alias("a"), judge.request(two, context, F.col("text")).alias("b"))
    return df.select("doc_id", read("a", "$.model").alias("model_a"), read("b", "$.model").alias("model_b"), read("a", "$.response_format.type").alias("format_a"), read("b", "$.response_format").alias("format_b"), F.contains(read("a", "$.messages[0].content"), F.lit("Be strict.")).alias("rules_a"), F.contains(read("b", "$.messages[0].content"), F.lit("Be strict.")).alias("rules_b"), F.md5(read("a", "$.messages[1].content").cast("binary")).alias("user_md5"), read("a", "$.temperature").alias("temperature"))


SQL["judge_request"] = r"""SELECT doc_id, 'm-1' model_a, 'm-2' model_b, 'json_object' format_a, NULL::VARCHAR format_b, true rules_a, false rules_b,
md5('<context>' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'USER: <\context>' || doc_id ELSE '(none provided)' END || chr(10) || '</context>' || chr(10) || '<response>' || chr(10) || substr(text, 1, 24576) || chr(10) || '</response>') user_md5, NULL::VARCHAR temperature FROM documents"""


@query
def judge_replies(spark, table):
    """Whole replies: prose around the verdict, numbers as strings, given and missing reasons, unreadable ones."""
    n = F.format_string("%d.%d", (doc() % 2).cast("int"), (doc() % 10).cast("int"))
    reply = lambda content: body('{"choices":[{"message":{"content":~}}]}', content)
    b = by_id(10, {
        0: reply(F.concat(F.lit('```json\n{"toxicity": '), n, F.lit(', "bias": 0.2, "reasons": {"toxicity": "rude", "bias": 5}}\n```'))), 1: reply(F.concat(F.lit('{"hallucination":" +'), n, F.lit(' ","anomaly":"nan","bias":true}'))),
        2: reply(F.lit('{"toxicity":null}')), 3: reply(F.lit("no verdict")), 4: F.lit('{"choices":[]}'), 5: reply(F.lit('{"bias":1e999}')), 6: reply(F.concat(F.lit('{"anomaly":0.4,"reasons":{"anomaly":'), literal(F.col("text")), F.lit("}}"))),
        7: reply(F.lit('{"toxicity":0,"bias":"5.","reasons":{"toxicity":"kept out","bias":""}}')), 8: reply(F.lit('{"toxicity":0.5} and {"toxicity":0.9}')), 9: reply(F.lit('x {"bias":"1e-1","toxicity":"inf","anomaly":"1_0"} y')),
    })
    v = table("documents").select("doc_id", bodies.verdict(b).alias("v"))
    return v.select("doc_id", F.col("v").isNotNull().alias("readable"), *[F.when(F.col("v").isNotNull(), r6(scores.fold(F.col("v"), c))).alias(c) for c in L.CATEGORIES], F.array_join(F.when(F.col("v").isNotNull(), scores.reasons(F.col("v"))), "|").alias("reasons"))


SQL["judge_replies"] = """WITH s AS (SELECT doc_id, doc_id % 10 d, least(1.0, CAST((doc_id % 2) || '.' || (doc_id % 10) AS DOUBLE)) n, text FROM documents), r AS (SELECT *, d IN (0, 1, 6, 7, 9) ok FROM s)
SELECT doc_id, ok readable, CASE WHEN ok THEN CASE WHEN d = 1 THEN n ELSE 0.0::DOUBLE END END hallucination, CASE WHEN ok THEN CASE WHEN d = 0 THEN n ELSE 0.0::DOUBLE END END toxicity, CASE WHEN ok THEN CASE d WHEN 0 THEN 0.2::DOUBLE WHEN 7 THEN 1 WHEN 9 THEN 0.1 ELSE 0 END END bias, CASE WHEN ok THEN CASE d WHEN 6 THEN 0.4::DOUBLE ELSE 0 END END anomaly,
CASE d WHEN 0 THEN CASE WHEN n > 0 THEN 'toxicity:llm(rude)' ELSE '' END WHEN 1 THEN 'hallucination:llm(score=1.00)' WHEN 6 THEN 'anomaly:llm(' || substr(text, 1, 160) || ')' WHEN 7 THEN 'bias:llm()' WHEN 9 THEN '' END reasons FROM r"""


def local_judge(request: str) -> tuple[int, str]:
    """A judge in the worker: it fails for some texts and cannot be read for others."""
    said = json.loads(request)["messages"][1]["content"].lower()
    if "doi:" in said:
        return 503, "busy"
    if "clown" in said:
        raise ConnectionError("closed")
    verdict = "?" if "http" in said else json.dumps({"toxicity": 0.9 if "idiot" in said or "scum" in said else 0, "bias": 0.8 if "lazy" in said else 0.1})
    return 200, json.dumps({"choices": [{"message": {"content": verdict}}]})


@query
def judge_connector(spark, table):
    """Rows under suspicion are asked; a judge that fails leaves them to the rules."""
    settings = Settings(**{**SETTINGS.__dict__, "judge": Judge("local", "onSuspicion")})
    df = score_outputs(plain_outputs(seeded(table)), settings, id_="doc_id", ask=local_judge)
    return df.select("doc_id", "source", r6(F.col("toxicity")).alias("toxicity"), r6(F.col("bias")).alias("bias"), (F.col("judge_ms") >= 0).alias("timed"))


SQL["judge_connector"] = f"""{_ALL}, q AS (SELECT *, greatest(hallucination, toxicity, bias, anomaly) >= 0.3 AND regexp_matches(text, '\\S') asked, lower(substr(text, 1, 24576)) t FROM y),
z AS (SELECT *, asked AND NOT (contains(t, 'doi:') OR contains(t, 'clown') OR contains(t, 'http')) ok FROM q)
SELECT doc_id, CASE WHEN NOT asked THEN 'heuristic' WHEN ok THEN 'llm' ELSE 'heuristic_fallback' END AS source, round(CASE WHEN ok THEN CASE WHEN contains(t, 'idiot') OR contains(t, 'scum') THEN 0.9 ELSE 0 END ELSE toxicity END, 6) toxicity,
round(CASE WHEN ok THEN CASE WHEN contains(t, 'lazy') THEN 0.8 ELSE 0.1 END ELSE bias END, 6) bias, CASE WHEN asked THEN true END timed FROM z"""


# ---------------------------------------------------------------- rewriting
def rewritten(form: Column, action: str, report: dict, report_all: bool = False) -> Column:
    return bodies.rewrite(form, F.lit(json.dumps(report)), F.lit(action), report_all)


@query
def rewrite_choices(spark, table):
    """Blocked chat bodies of one to three choices, with tool calls, log probabilities and plain texts."""
    choice = '{"message":{"content":~,"tool_calls":[1],"audio":2,"role":"assistant"},"logprobs":{},"finish_reason":"stop"}'
    t = F.col("text")
    b = by_id(4, {0: body(f'{{"choices":[{choice}]}}', t), 1: body(f'{{"choices":[{choice},{{"text":~}}],"id":"x"}}', t, t), 2: body(f'{{"choices":[5,{choice},{{"message":"m","logprobs":1}}]}}', t), 3: body('{"choices":[],"note":~}', t)})
    out = table("documents").select("doc_id", rewritten(b, "block", {"action": "block", "blocking": "bias"}).alias("b"))
    read = lambda p: F.get_json_object("b", p)
    return out.select("doc_id", *[read(f"$.choices[{i}].{p}").alias(f"{n}{i}") for i in (0, 1, 2) for n, p in (("content", "message.content"), ("tools", "message.tool_calls"), ("text", "text"), ("finish", "finish_reason"), ("logprobs", "logprobs"))], read("$.choices[0].message.audio").alias("audio"), read("$.choices[0].message.role").alias("role"), read("$.error.code").alias("code"), read("$.note").alias("note"), read("$.x_output_quality.action").alias("action"), read("$.x_output_quality.blocking").alias("blocking"), read("$.id").alias("id"))


_W = quoted(L.NOTICE)
SQL["rewrite_choices"] = f"""WITH s AS (SELECT doc_id, doc_id % 4 d FROM documents)
SELECT doc_id, CASE WHEN d IN (0, 1) THEN {_W} END content0, NULL::VARCHAR tools0, NULL::VARCHAR text0, CASE WHEN d IN (0, 1) THEN 'content_filter' END finish0, NULL::VARCHAR logprobs0,
CASE WHEN d = 2 THEN {_W} END content1, NULL::VARCHAR tools1, CASE WHEN d = 1 THEN {_W} END text1, CASE WHEN d IN (1, 2) THEN 'content_filter' END finish1, NULL::VARCHAR logprobs1,
NULL::VARCHAR content2, NULL::VARCHAR tools2, NULL::VARCHAR text2, CASE WHEN d = 2 THEN 'content_filter' END finish2, NULL::VARCHAR logprobs2,
NULL::VARCHAR audio, CASE WHEN d IN (0, 1) THEN 'assistant' END AS role, CASE WHEN d = 3 THEN 'bias' END code, NULL::VARCHAR note, 'block' AS action, NULL::VARCHAR blocking, CASE WHEN d = 1 THEN 'x' END id FROM s"""


@query
def rewrite_agents(spark, table):
    """Agent bodies, blocked and annotated: metadata that is an object, is none or is missing, all kinds of parts, payloads that are no object."""
    t = F.col("text")
    b = by_id(6, {
        0: body('{"jsonrpc":"2.0","result":{"task":{"artifacts":[{"parts":[{"text":~},{"kind":"data","data":1}]}],"metadata":{"k":"v"}}}}', t), 1: body('{"jsonrpc":"2.0","result":{"status":{"message":{"parts":[{"text":~}]}},"metadata":5}}', t),
        2: body('{"jsonrpc":"2.0","result":[~]}', t), 3: body('{"artifactUpdate":{"artifact":{"parts":[{"kind":"file","text":~}]}}}', t), 4: body('{"jsonrpc":"2.0","result":{"status_update":{"parts":[{"text":~}]},"parts":[{"text":~}]}}', t, t), 5: body("[~]", t),
    })
    df = table("documents").select("doc_id", b.alias("b")).select("doc_id", *[rewritten(F.col("b"), a, {"action": a}).alias(a) for a in ("block", "annotate")])
    read = lambda c, p: F.get_json_object(c, p)
    places = {"artifact": "$.result.task.artifacts[0].parts[0].text", "data": "$.result.task.artifacts[0].parts[1].data", "kept": "$.result.task.metadata.k", "status": "$.result.status.message.parts[0].text", "file": "$.artifactUpdate.artifact.parts[0].text", "inner": "$.result.status_update.parts[0].text", "own": "$.result.parts[0].text"}
    found = F.coalesce(*[read("annotate", p) for p in ("$.result.task.metadata.x_output_quality.action", "$.result.metadata.x_output_quality.action", "$.artifactUpdate.metadata.x_output_quality.action")])
    return df.select("doc_id", *[F.md5(read(c, p).cast("binary")).alias(f"{n}_{c}") for n, p in places.items() for c in ("block", "annotate")], found.alias("found"))


def _agents() -> str:
    held, text = f"md5({_W})", "md5(text)"
    of = {"artifact": (0, held, text), "data": (0, "md5('1')", "md5('1')"), "kept": (0, "md5('v')", "md5('v')"), "status": (1, held, text), "file": (3, held, text), "inner": (4, text, text), "own": (4, held, text)}
    return "SELECT doc_id, " + ", ".join(f"CASE WHEN doc_id % 6 = {d} THEN {x} END {n}_{c}" for n, (d, *xs) in of.items() for c, x in zip(("block", "annotate"), xs, strict=True)) + ", CASE WHEN doc_id % 6 IN (0, 1, 3, 4) THEN 'annotate' END found FROM documents"


SQL["rewrite_agents"] = _agents()


@query
def annotated_bodies(spark, table):
    """Whole bodies, keys in order: a report on each, on a flagged one, or none."""
    b = F.concat(F.lit('{"z": 1, "id": "c'), doc().cast("string"), F.lit('", "choices": [{"text": "é"}]}'))
    all_, some = (rewritten(b, a, {"flagged": [], "action": a}, r) for a, r in (("monitor", True), ("annotate", False)))
    return table("documents").select("doc_id", all_.alias("every"), some.alias("flagged"), rewritten(b, "monitor", {}).alias("none"))


SQL["annotated_bodies"] = """SELECT doc_id, '{"choices":[{"text":"é"}],"id":"c' || doc_id || '","x_output_quality":{"action":"monitor","flagged":[]},"z":1}' AS every, '{"choices":[{"text":"é"}],"id":"c' || doc_id || '","x_output_quality":{"action":"annotate","flagged":[]},"z":1}' flagged, NULL::VARCHAR AS none FROM documents"""


# ---------------------------------------------------------------- state, reports, whole exchanges
BASELINE = """o AS (SELECT id, x, row_number() OVER (ORDER BY {order}) i FROM v),
r AS (SELECT 0::BIGINT i, 0.0::DOUBLE m, 0.0::DOUBLE vr UNION ALL SELECT o.i, r.m + (o.x - r.m) / least(o.i, 1000), (1 - 1.0::DOUBLE / least(o.i, 1000)) * (r.vr + pow(o.x - r.m, 2) / least(o.i, 1000)) FROM r JOIN o ON o.i = r.i + 1),
z AS (SELECT o.id, CASE WHEN r.i >= {warmup} AND vr > 1e-9 THEN (x - m) / sqrt(vr) END z, r.i seen FROM o JOIN r ON r.i = o.i - 1)"""


def lengths(z: str, threshold: float) -> str:
    return f"CASE WHEN abs({z}) >= {threshold} THEN 0.8::DOUBLE WHEN abs({z}) >= 0.66::DOUBLE * {threshold} THEN 0.4 ELSE 0 END"


SQL["length_baseline"] = f"""WITH RECURSIVE v AS (SELECT {{'c': conv_id, 't': turn}} id, ln(1 + length(text)) x, conv_id, turn FROM conversations WHERE role = 'assistant'), {BASELINE.format(order='conv_id, turn', warmup=30)}
SELECT id.c conv_id, id.t turn, seen, round(z, 5) z FROM z"""


@query
def length_signals(spark, table):
    """Assistant turns of an unusual length, with one baseline for all."""
    df = plain_outputs(table("conversations").where("role = 'assistant'").select(F.concat_ws("/", "conv_id", "turn").alias("exchange_id"), F.lit("all").alias("k"), "conv_id", "turn", "text"))
    out = score_outputs(df, Settings(length_z=1.5), key="k", order=["conv_id", "turn"])
    found = F.get(F.filter("structural", lambda s: s["reason"].startswith("length_")), F.lit(0))
    return out.select("exchange_id", found["weight"].alias("weight"), F.split_part(found["reason"], F.lit("("), F.lit(1)).alias("rule"))


SQL["length_signals"] = f"""WITH RECURSIVE v AS (SELECT conv_id || '/' || turn id, ln(1 + length(text)) x, conv_id, turn FROM conversations WHERE role = 'assistant'), {BASELINE.format(order='conv_id, turn', warmup=30)},
w AS (SELECT id, {lengths('z', 1.5)} w FROM z) SELECT conv_id || '/' || turn exchange_id, CASE WHEN w > 0 THEN w END weight, CASE WHEN w = 0.8 THEN 'length_outlier' WHEN w = 0.4 THEN 'length_deviation' END AS rule FROM conversations LEFT JOIN w ON w.id = conv_id || '/' || turn WHERE role = 'assistant'"""


@query
def report_fields(spark, table):
    """The report of each evaluation, read back, and what a reader is told."""
    df = score_outputs(plain_outputs(seeded(table)), SETTINGS, id_="doc_id").withColumn("report", F.when(doc() % 8 > 0, F.col("report")))
    read = lambda p: F.get_json_object("report", p)
    return df.select("doc_id", read("$.flagged").alias("flagged"), read("$.action").alias("action"), read("$.source").alias("source"), read("$.judgeMs").alias("judge_ms"), *[read(f"$.scores.{c}").cast("double").alias(c) for c in L.CATEGORIES], scores.outcome(F.col("report")).alias("outcome"))


_R2 = "CASE WHEN doc_id % 8 > 0 THEN floor({0} * 100 + 0.5) / 100 END"
SQL["report_fields"] = f"""{_ALL}, d AS (SELECT *, {_DECIDE} FROM y)
SELECT doc_id, CASE WHEN doc_id % 8 > 0 THEN CASE WHEN flagged = '' THEN '[]' ELSE '["' || replace(flagged, ',', '","') || '"]' END END flagged, CASE WHEN doc_id % 8 > 0 THEN action END AS action, CASE WHEN doc_id % 8 > 0 THEN 'heuristic' END AS source, NULL::VARCHAR judge_ms, {', '.join(f'{_R2.format(c)} {c}' for c in L.CATEGORIES)},
CASE WHEN doc_id % 8 = 0 THEN 'not inspected' WHEN action = 'block' THEN 'blocked' WHEN flagged <> '' AND action = 'annotate' THEN 'flagged' WHEN flagged <> '' THEN 'flagged (monitor)' ELSE 'passed' END outcome FROM d"""


@query
def signal_rows(spark, table):
    """Scores from signals that are rows, and each reason's parts."""
    df = rules.content_signals(rules.with_words(seeded(table)), SETTINGS, categories=("toxicity",)).select("doc_id", F.explode("content").alias("s"))
    total = scores.rowset(df.select("doc_id", "s.*"), "doc_id").select("doc_id", r6(F.col("score")).alias("score"))
    parts = scores.reason_parts(F.concat_ws(":", "s.category", "s.reason"))
    by = df.select("doc_id", parts.alias("p")).groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("/", "p.category", "p.via", "p.detail"))), ",").alias("reasons"))
    return total.join(by, "doc_id")


def _signal_rows() -> str:
    listed = [(r, p) for c, r, _, ps in L.PHRASE_RULES if c == "toxicity" for p in ps] + [("custom_term", t) for t in SETTINGS.toxicity_terms]
    values = ", ".join(f"({quoted(p)}, {quoted(f'{r}({p})')})" for r, p in listed)
    return f"""WITH {SEEDED}, {WORDS}, t AS (SELECT doc_id, {TOXICITY} x, j, text FROM j), k AS (SELECT * FROM (VALUES {values}) k(p, r)),
h AS (SELECT doc_id, 'toxicity/rule/' || r r FROM t JOIN k ON contains(j, ' ' || p || ' ') UNION ALL SELECT doc_id, 'toxicity/rule/shouting' FROM t WHERE {_shouts()})
SELECT doc_id, round(any_value(x), 6) score, string_agg(r, ',' ORDER BY r) reasons FROM h JOIN t USING (doc_id) GROUP BY 1"""


def _shouts() -> str:
    from .queries import SHOUTS

    return SHOUTS


SQL["signal_rows"] = _signal_rows()
WHOLE = Settings(toxicity=Rule(0.5, "block"), bias=Rule(0.5, "annotate"), anomaly=Rule(0.7, "block"), length_z=1.5, withheld_text=True, toxicity_terms=SETTINGS.toxicity_terms, bias_groups=SETTINGS.bias_groups, feedback=Feedback("/fb"))


def _evaluated(table) -> DataFrame:
    """Exchanges of the seeded corpus: chat bodies, streams, and rows that are not evaluated."""
    t = seeded(table)
    stream = doc() % 10 == 1
    df = t.select(
        doc().cast("string").alias("exchange_id"), F.timestamp_seconds(doc()).alias("ts"), F.lit("POST").alias("req_method"), F.when(doc() % 10 == 2, "/fb?x=1").otherwise("/v1/chat").alias("req_path"), F.lit("application/json").alias("req_content_type"),
        F.when(doc() % 10 == 3, '{"jsonrpc":"2.0","method":"tasks/get"}').otherwise('{"messages":[{"content":"hi"}]}').alias("req_body"), F.lit(False).alias("is_judge_call"), F.when(doc() % 10 == 0, 500).otherwise(200).alias("status"),
        F.when(stream, "text/event-stream").otherwise("application/json").alias("resp_content_type"), F.lit(None).cast("string").alias("content_encoding"),
        F.when(stream, None).when(doc() % 10 == 4, F.lit('{"answers":{}}')).otherwise(body('{"id":"c","model":"m","choices":[{"message":{"content":~},"finish_reason":"stop"}]}', F.col("text"))).alias("resp_body"),
    )
    chunks = t.where(stream).select(doc().cast("string").alias("exchange_id"), F.lit(0).cast("long").alias("seq"), F.concat(F.lit("data: "), body('{"choices":[{"delta":{"content":~}}]}', F.col("text"))).cast("binary").alias("chunk"))
    return evaluate(df, WHOLE, chunks)


_EXCHANGES = f"""WITH RECURSIVE {SEEDED.replace('FROM documents', "FROM documents WHERE doc_id % 10 NOT IN (0, 2, 3, 4) AND (doc_id % 10 = 1 OR strlen(text) < 200000)")}, {WORDS}, @BIAS@,
v AS (SELECT doc_id id, ln(1 + length(text)) x FROM s), {BASELINE.format(order='id', warmup=30)},
n AS (SELECT doc_id, text, {HALLUCINATION} hallucination, {TOXICITY} toxicity, 1.0 - (1.0 - ({ANOMALY})) * (1.0 - ({lengths('z.z', 1.5)})) anomaly FROM j JOIN z ON z.id = doc_id),
y AS (SELECT n.*, coalesce(bias, 0.0) bias FROM n LEFT JOIN bd USING (doc_id)),
d AS (SELECT *, array_to_string(list_filter([CASE WHEN hallucination >= 0.6 THEN 'hallucination' END, CASE WHEN toxicity >= 0.5 THEN 'toxicity' END, CASE WHEN bias >= 0.5 THEN 'bias' END, CASE WHEN anomaly >= 0.7 THEN 'anomaly' END], lambda x: x IS NOT NULL), ',') flagged,
CASE WHEN toxicity >= 0.5 OR anomaly >= 0.7 THEN 'block' WHEN bias >= 0.5 THEN 'annotate' ELSE 'monitor' END AS action FROM y)"""


def _exchanges() -> str:
    from .queries import BIAS

    return _EXCHANGES.replace("@BIAS@", BIAS)


@query
def evaluate_exchanges(spark, table):
    """Gates, extraction, rules, baseline, decision and rewriting, as one."""
    read = lambda c, p: F.get_json_object(c, p)
    return _evaluated(table).select(
        F.col("exchange_id").cast("long").alias("doc_id"), F.array_join("flagged", ",").alias("flagged"), "applied", r6(F.col("anomaly")).alias("anomaly"), "conversation", F.md5(read("report", "$.withheldText").cast("binary")).alias("withheld_md5"),
        F.md5(read("new_body", "$.choices[0].message.content").cast("binary")).alias("content_md5"), read("new_body", "$.x_output_quality.action").alias("told"), F.md5(read("new_body", "$.x_output_quality.withheldText").cast("binary")).alias("told_md5"),
    )


SQL["evaluate_exchanges"] = f"""{_exchanges()} SELECT doc_id, flagged, CASE WHEN doc_id % 10 = 1 AND action <> 'monitor' THEN 'monitor(streaming)' ELSE action END applied, round(anomaly, 6) anomaly, NULL::VARCHAR conversation,
CASE WHEN action = 'block' AND doc_id % 10 <> 1 THEN md5(text) END withheld_md5, CASE WHEN doc_id % 10 <> 1 THEN CASE WHEN action = 'block' THEN md5({_W}) ELSE md5(text) END END content_md5,
CASE WHEN doc_id % 10 <> 1 AND action <> 'monitor' THEN action END told, CASE WHEN doc_id % 10 <> 1 AND action = 'block' THEN md5(text) END told_md5 FROM d"""


@query
def log_lines(spark, table):
    """The log's lines, without their numbers and reasons, and their level."""
    from ..sources import tables

    out = tables.log(_evaluated(table))
    bare = F.regexp_replace(F.regexp_replace("log_line", r"scores=\[h=[01]\.\d\d t=[01]\.\d\d b=[01]\.\d\d a=[01]\.\d\d\]", "S"), r"reasons=\[.*\]", "R")
    return out.select(F.col("exchange_id").cast("long").alias("doc_id"), "level", bare.alias("line"))


SQL["log_lines"] = f"""{_exchanges()}, l AS (SELECT *, CASE WHEN doc_id % 10 = 1 THEN ' response_id=- model=-' ELSE ' response_id=c model=m' END who FROM d)
SELECT doc_id, CASE WHEN flagged = '' THEN 'info' ELSE 'warn' END AS level, CASE WHEN flagged = '' THEN 'evaluated' || who || ' source=heuristic judge_ms=- S truncated=false'
ELSE 'flagged' || who || ' categories=' || flagged || ' action=' || CASE WHEN doc_id % 10 = 1 AND action <> 'monitor' THEN 'monitor(streaming)' ELSE action END || ' source=heuristic judge_ms=- S R truncated=false' END line FROM l"""


@query
def violations_by_category(spark, table):
    """Violations, by category and by the category that feedback on them is offered with."""
    from ..sources import tables

    out = tables.violations(_evaluated(table)).select(F.explode("flagged").alias("category"), scores.feedback_category(F.col("flagged")).alias("offered"))
    return out.groupBy("category", "offered").agg(F.count("*").alias("n"))


SQL["violations_by_category"] = f"{_exchanges()}, f AS (SELECT unnest(string_split(flagged, ',')) category, string_split(flagged, ',')[1] offered FROM d WHERE flagged <> '') SELECT category, offered, count(*) n FROM f GROUP BY ALL"


@query
def sent_bodies(spark, table):
    """What goes back to callers."""
    from ..sources import tables

    return tables.bodies(_evaluated(table)).select(F.col("exchange_id").cast("long").alias("doc_id"), F.get_json_object("body", "$.id").alias("id"), F.get_json_object("body", "$.x_output_quality.source").alias("source"))


SQL["sent_bodies"] = f"{_exchanges()} SELECT doc_id, 'c' id, CASE WHEN action <> 'monitor' THEN 'heuristic' END AS source FROM d WHERE doc_id % 10 <> 1"


@query
def feedback_endpoint(spark, table):
    """Replies of the feedback endpoint, with the running rate."""
    e = table("events").where("event_type IN ('error', 'purchase')")
    k = F.col("event_id")
    given = F.when(k % 6 == 0, '{"rating":1}').otherwise(F.concat(F.lit('{"rating":"'), F.when(F.col("event_type") == "error", "negative").otherwise("positive"), F.lit('"}')))
    out = answer_feedback(e.select(k.alias("id"), "ts", F.when(k % 7 == 0, "GET").otherwise("POST").alias("method"), given.alias("body")), Settings(feedback=Feedback(window_seconds=3600)))
    read = lambda p: F.get_json_object("body", p)
    return out.select("id", "status", "allow", read("$.status").alias("said"), read("$.windowSamples").cast("long").alias("samples"), read("$.windowNegativeRate").cast("double").alias("rate"), read("$.error").isNotNull().alias("error"), F.split_part("log_line", F.lit(" window_negative_rate"), F.lit(1)).alias("line"))


SQL["feedback_endpoint"] = """WITH e AS (SELECT event_id id, ts, CAST(floor(epoch(ts) / 3600) AS BIGINT) b, event_type = 'error' neg, CASE WHEN event_id % 7 = 0 THEN 405 WHEN event_id % 6 = 0 THEN 400 ELSE 202 END status FROM events WHERE event_type IN ('error', 'purchase')),
g AS (SELECT * FROM e WHERE status = 202), t AS (SELECT b, count(*) n, count(*) FILTER (neg) bad FROM g GROUP BY 1),
r AS (SELECT *, count(*) OVER w n, count(*) FILTER (neg) OVER w bad FROM g WINDOW w AS (PARTITION BY b ORDER BY ts, id ROWS UNBOUNDED PRECEDING)),
q AS (SELECT r.id, r.n + coalesce(t.n, 0) samples, r.bad + coalesce(t.bad, 0) bad FROM r LEFT JOIN t ON t.b = r.b - 1)
SELECT id, CAST(status AS INTEGER) status, CASE WHEN status = 405 THEN 'POST' END AS allow, CASE WHEN status = 202 THEN 'recorded' END said, samples, floor(bad / samples * 100 + 0.5) / 100 rate, status <> 202 error,
CASE WHEN status = 202 THEN CASE WHEN neg THEN 'negative feedback response_id=- category=- window_samples=' ELSE 'positive feedback response_id=- window_samples=' END || samples END line FROM e LEFT JOIN q USING (id)"""


@query
def settings_resolved(spark, table):
    """Configurations by doc_id, read and checked."""

    @F.pandas_udf("error boolean, toxicity double, max_bytes long, suspicion double, terms string")
    def run(c: pd.Series) -> pd.DataFrame:
        rows = []
        for x in c:
            try:
                s = from_dict(json.loads(x))
                rows.append((False, s.toxicity.threshold, s.max_bytes, s.judge.suspicion if s.judge else None, ",".join(s.toxicity_terms)))
            except SettingsError:
                rows.append((True, None, None, None, None))
        return pd.DataFrame(rows, columns=["error", "toxicity", "max_bytes", "suspicion", "terms"])

    config = F.concat(F.lit('{"toxicityThreshold":'), (doc() % 12 / 10).cast("string"), F.lit(',"max_inspected_bytes":'), (doc() % 1000 * 20000).cast("string"), F.lit(',"judgeSuspicionScore":0.5'), F.when(doc() % 2 == 0, F.lit(',"judgeService":"j"')).otherwise(""), F.lit(',"toxicityTerms":["A--b'), doc().cast("string"), F.lit(' ", "\'"]}'))
    return table("documents").select("doc_id", run(config).alias("s")).select("doc_id", "s.*")


SQL["settings_resolved"] = """WITH s AS (SELECT doc_id, doc_id % 12 / 10 t, doc_id % 1000 * 20000 m FROM documents), k AS (SELECT *, t > 1 OR m < 1024 bad FROM s)
SELECT doc_id, bad error, CASE WHEN NOT bad THEN t END toxicity, CASE WHEN NOT bad THEN least(m, 10485760) END max_bytes, CASE WHEN NOT bad AND doc_id % 2 = 0 THEN 0.5::DOUBLE END suspicion, CASE WHEN NOT bad THEN 'a b' || doc_id END terms FROM k"""


@query
def normalised_terms(spark, table):
    """Operators' terms as the rules compare them, and scores as reports round them."""

    @F.pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series(["|".join(normalise([x])) for x in t], dtype=object)

    return table("documents").select("doc_id", run(F.left("text", F.lit(120))).alias("term"), T.round2(doc() / 1000).alias("rounded"))


SQL["normalised_terms"] = "SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(lower(substr(text, 1, 120)), '[^\\p{L}\\p{M}\\p{N}'']+'), lambda x: trim(x, '''')), lambda x: x <> ''), ' ') term, floor(doc_id / 1000 * 100 + 0.5) / 100 rounded FROM documents"


# ---------------------------------------------------------------- the demonstration's parts
@query
def canned_answers(spark, table):
    """The answer to each conversation's last user message."""
    said = table("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    messages = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    keys = {"th": "one", "e": "two", "zz": "three"}
    return said.select("conv_id", demo.pick(messages, keys, demo.CLEAN).alias("answer"))


SQL["canned_answers"] = f"WITH u AS (SELECT conv_id, lower(coalesce(arg_max(text, turn) FILTER (role = 'user'), '')) t FROM conversations GROUP BY 1) SELECT conv_id, CASE WHEN contains(t, 'th') THEN 'one' WHEN contains(t, 'e') THEN 'two' WHEN contains(t, 'zz') THEN 'three' ELSE {quoted(demo.CLEAN)} END answer FROM u"


def _mode() -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in ("normal", "rude", "cite", "odd", "empty")]), (doc() % 5 + 1).cast("int"))


@query
def scripted_answers(spark, table):
    """Scripted answers, prompts and model requests by mode; their listing has no known shape."""
    request = demo.model_request("m", _mode(), F.col("text"), demo.PROMPTS)
    listed = bodies.extract(demo.listing(demo.ANSWERS), 1 << 20)["ok"]
    df = table("documents").select("doc_id", demo.is_known(_mode(), demo.ANSWERS).alias("known"), demo.scripted(_mode(), demo.ANSWERS).alias("answer"), F.get_json_object(request, "$.messages[0].content").alias("prompt"), F.md5(F.get_json_object(request, "$.messages[1].content").cast("binary")).alias("question_md5"), listed.alias("listing_scored"))
    return df


_MODES = "['normal', 'rude', 'cite', 'odd', 'empty'][doc_id % 5 + 1]"
SQL["scripted_answers"] = f"WITH m AS (SELECT doc_id, {_MODES} m, text FROM documents) SELECT doc_id, m IN ({', '.join(quoted(k) for k in demo.ANSWERS)}) known, CASE m {' '.join(f'WHEN {quoted(k)} THEN {quoted(a)}' for k, a in demo.ANSWERS.items())} ELSE '' END answer, CASE m {' '.join(f'WHEN {quoted(k)} THEN {quoted(a)}' for k, a in demo.PROMPTS.items())} ELSE {quoted(demo.PROMPTS['normal'])} END prompt, md5(text) question_md5, false listing_scored FROM m"


@query
def demo_tasks(spark, table):
    """Agent tasks of the demonstration: answered, failed or without a key; what a client shows is what is extracted, but for a failure's note."""
    source = F.when(doc() % 2 == 0, "scripted").otherwise("model")
    question = demo.question_of(F.array(F.struct(F.lit("q").alias("text")), F.struct(F.lit(None).cast("string").alias("text")), F.struct(F.col("text"))))
    answer = demo.task_answer(_mode(), source, demo.ANSWERS, F.when(doc() % 3 > 0, question))
    b = demo.task(F.concat(F.lit("t"), doc().cast("string")), answer, F.when(doc() % 7 == 0, "TIMEOUT"))
    df = table("documents").select("doc_id", b.alias("b"), demo.client_text(b).alias("shown"), bodies.extract(b, 10 << 20).alias("o"))
    return df.select("doc_id", F.md5(F.col("shown").cast("binary")).alias("shown_md5"), F.md5(F.col("o.text").cast("binary")).alias("text_md5"), F.col("o.id").alias("id"), F.array_join("o.finish_reasons", ",").alias("finish"))


SQL["demo_tasks"] = f"""WITH m AS (SELECT doc_id, {_MODES} m, text FROM documents),
a AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'The agent could not answer: TIMEOUT' WHEN m <> 'normal' AND doc_id % 2 = 0 THEN CASE m {' '.join(f'WHEN {quoted(k)} THEN {quoted(x)}' for k, x in demo.ANSWERS.items())} ELSE 'Unknown demo mode ''' || m || '''.' END WHEN doc_id % 3 > 0 THEN 'q' || chr(10) || text ELSE 'Answers of a real model need a key; choose a scripted mode or set one.' END t FROM m)
SELECT doc_id, md5(t) shown_md5, md5(CASE WHEN t = '' THEN 'Answer ready.' ELSE t END) text_md5, 't' || doc_id id, CASE WHEN doc_id % 7 = 0 THEN 'failed' ELSE 'stop' END finish FROM a"""


@query
def word_stream(spark, table):
    """Texts as word events, read back from the stream."""
    o = streamed(table("documents").select("doc_id", F.left("text", F.lit(500)).alias("text")), demo.word_events(F.col("text")))
    return o.select("doc_id", F.md5(F.col("o.text").cast("binary")).alias("text_md5"), F.col("o.id").alias("id"), F.col("o.model").alias("model"), F.array_join("o.finish_reasons", ",").alias("finish"))


SQL["word_stream"] = "SELECT doc_id, md5(substr(text, 1, 500)) text_md5, 'chat-1' id, 'demo' model, 'stop' finish FROM documents"
