"""Golden values of the scoring rules, and equality of batch and stream state."""

import json
import math

import pytest
from pyspark.sql import functions as F

from plumbline.functions import wire
from plumbline.operators import rules, scores, state
from plumbline.plans.pipeline import evaluate, score_outputs
from plumbline.plans.queries import plain_outputs
from plumbline.settings import Settings, SettingsError

# texts of our own; expected values are 1 - product(1 - weight) over the rules named beside them
GOLDEN = [
    ("Lisbon lies on the Tagus and is the capital of Portugal.", 0, 0, 0, 0),
    ("What a pathetic plan.", 0, 0.35, 0, 0),  # an insult
    ("That scum of a moron said: go die.", 0, 1 - 0.65**2 * 0.4, 0, 0),  # two insults, a threat
    ("Oh, buzz off now", 0, 0.5, 0, 0),  # a custom term
    ("The drill kills weeds.", 0, 0, 0, 0),
    ("PLEASE READ ALL OF THE SMALL PRINT BEFORE YOU SIGN ANYTHING HERE", 0, 0.2, 0, 0),  # shouting
    ("Boys are typically worse at waiting.", 0, 0, 1 - 0.65**2, 0),  # two weak markers
    ("Refugees are criminals.", 0, 0, 0.55, 0),  # a strong marker
    ("Plumbers are always dirty.", 0, 0, 1 - 0.65 * 0.45, 0),  # a custom group, a weak and a strong marker
    ("All refugees are welcome at noon.", 0, 0, 0.35, 0),  # a prefix
    ("Refugees in town opened a bakery.", 0, 0, 0, 0),
    ("Sources say the bridge holds [12]. Doe et al. agree, doi:10.5555/xyz.", 1 - 0.8**3 * 0.85, 0, 0, 0),  # an attribution, a marker, a DOI, et al.
    ("The list is at https://host.example [3].", 0, 0, 0, 0),  # its source is given
    ("Perhaps it rained, possibly it snowed; I guess both.", 0.25, 0, 0, 0),  # three hedges
    (" \u00a0\n", 0, 0, 0, 0.9),  # blank
    ("round and round we go again " * 9, 0, 0, 0, 0.9),  # repetition
    ("plain words " + "\ufffd\x07" * 9, 0, 0, 0, 0.7),  # garbled
]


def test_golden_texts(spark):
    settings = Settings(toxicity_terms=("buzz off",), bias_groups=("plumbers",))
    df = plain_outputs(spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "exchange_id long, text string"))
    for r in score_outputs(df, settings).collect():
        want = GOLDEN[r["exchange_id"]][1:]
        assert [round(r[c], 4) for c in ("hallucination", "toxicity", "bias", "anomaly")] == pytest.approx(list(want), abs=2e-4), r["text"]


def test_decision(spark):
    s = Settings.from_json(json.dumps({"biasAction": "annotate", "toxicity_action": "block", "anomalyThreshold": 0}))
    df = spark.createDataFrame([(0.0, 0.49, 0.6, 0.0), (0.0, 0.5, 0.6, 0.0), (0.0, 0.0, 0.0, 0.0)], "hallucination double, toxicity double, bias double, anomaly double")
    got = [(r["flagged"], r["action"], r["blocking"]) for r in scores.with_decision(df, s).collect()]
    assert got == [(["bias"], "annotate", None), (["toxicity", "bias"], "block", "toxicity"), ([], "monitor", None)]


@pytest.mark.parametrize("bad", ["", "[]", '{"toxicityThreshold": 2}', '{"biasAction": "warn"}', '{"lowConfidenceLogprob": 1}', '{"maxInspectedBytes": 10}', '{"judgeMode": "x"}'])
def test_bad_settings(bad):
    with pytest.raises(SettingsError):
        Settings.from_json(bad)


def test_settings_limits():
    s = Settings.from_json('{"maxInspectedBytes": 99999999, "feedbackPath": " ", "feedbackWindowSeconds": 1, "judgeService": "j", "judgeModel": " ", "judgeTimeoutMs": 99999, "toxicityTerms": ["Get  Lost!", "--"]}')
    assert s.max_bytes == 10 << 20 and s.feedback is None and s.judge.model and s.judge.timeout_ms == 30_000 and s.toxicity_terms == ("get lost",)


def test_shapes():
    assert wire.extract('{"hello":"world"}') is None and wire.extract("{} x") is None and wire.extract('{"jsonrpc":"2.0","error":{}}') is None
    o = wire.extract('{"choices":[{"message":{"content":[{"text":"a"},{"text":"b"}],"tool_calls":[{}]},"finish_reason":"max_tokens"},{"text":"c"}]}')
    assert (o.text, o.has_tool_calls, o.finish_reasons) == ("ab\n\nc", True, ["length"])
    o = wire.extract('{"choices":[{"text":"x","logprobs":{"token_logprobs":[null,-1,-2]}}]}')
    assert (o.logprob_sum, o.logprob_count) == (-3.0, 2)
    o = wire.extract('{"jsonrpc":"2.0","result":{"id":"t","status":{"state":"failed","message":{"parts":[{"text":"note"}]}},"artifacts":[{"parts":[{"kind":"text","text":"a"},{"kind":"file"},{"text":"b"}]}]}}')
    assert (o.id, o.text, o.finish_reasons) == ("t", "a\nb", ["failed"])


def test_stream_in_any_chunking():
    stream = "".join(f"data: {json.dumps({'choices': [{'delta': {'content': w}}]})}\r\n\r\n" for w in ("é", "b ", "c")) + ": note\n\ndata: [DONE]"
    out = wire.extract_stream(stream.encode())
    assert out.text == "éb c" and not out.truncated
    assert wire.extract_stream(stream.encode(), limit=3).text == "éb" and wire.extract_stream(b"data: {}\n\n") is None


def test_transcript_and_requests():
    body = {"system": "s" * 100, "messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": [{"text": "a"}, {"text": "b"}]}]}
    assert wire.transcript(body, 4000) == "SYSTEM: " + "s" * 100 + "\nUSER: hi\nASSISTANT: a\nb"
    assert wire.transcript(body, 40).startswith("SYSTEM: " + "s" * 9 + "…\n")
    assert wire.classify_request("/", '{"jsonrpc":"2.0","method":"tasks/get"}', 10) == (True, None)
    assert wire.classify_request("/v1/message:send?x=1", '{"message":{"parts":[{"text":"yo"}]}}', 100) == (False, "USER: yo")


def test_rewrite_and_feedback():
    chat = '{"choices":[{"message":{"content":"x","tool_calls":[]},"logprobs":{},"finish_reason":"stop"}]}'
    got = json.loads(wire.rewrite(chat, '{"action":"block","blocking":"bias"}', "block", False))
    assert got["choices"][0]["finish_reason"] == "content_filter" and "tool_calls" not in got["choices"][0]["message"] and got["x_output_quality"] == {"action": "block"}
    assert json.loads(wire.rewrite('{"choices":[]}', '{"blocking":"anomaly"}', "block", False))["error"]["code"] == "anomaly"
    assert wire.rewrite("[1,2]", "{}", "block", False) is None and wire.rewrite(chat, "{}", "monitor", False) is None
    assert wire.judge_verdict('```{"toxicity": 7, "bias": -1}```', ("toxicity", "bias", "anomaly")) == [("toxicity", 1.0, "llm(score=1.00)"), ("bias", 0.0, "")]
    assert wire.feedback('{"rating":"negative","category":"other"}') == (None, True, None, "other") and wire.feedback("[]")[0]


def test_baseline_window_equals_fold(spark):
    df = spark.createDataFrame([("k", i, float(x)) for i, x in enumerate((2, 4, 4, 4, 5, 5, 7, 9, 9))], "key string, i long, x double")
    got = [[(r["seen"], round(r["mean"] or 0, 9), round(r["variance"] or 0, 9), r["z"] and round(r["z"], 9)) for r in f(df, "key", ["i"], "x", 8).orderBy("i").collect()] for f in (state.baseline_window, state.baseline_fold)]
    assert got[0][-1] == (8, 5.0, 4.0, 2.0) and got[0] == got[1]
    s = (0, 0.0, 0.0)
    for x in [1.0] * 2000 + [10.0] * 3000:
        s = state.advance(s, x)
    assert s[1] > 9


def test_length_baseline_past_the_horizon(spark):
    from plumbline.plans import queries

    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/conversations.parquet").where("role = 'assistant'").select("conv_id", "turn", "text").orderBy("conv_id", "turn").collect()
    count, mean, variance, want = 0, 0.0, 0.0, {}
    for r in rows:
        z = None
        x = None if r["text"] is None else math.log(1 + len(r["text"]))
        if x is not None and count >= 30 and variance > 1e-9:
            z = (x - mean) / math.sqrt(variance)
        want[r["conv_id"], r["turn"]] = (count, z)
        if x is not None:
            count += 1
            n = min(count, 1000)
            d = x - mean
            mean += d / n
            variance = (1 - 1 / n) * (variance + d * d / n)
    got = {(r["conv_id"], r["turn"]): (r["seen"], r["z"]) for r in queries.queries()["length_baseline"](spark, sf).collect()}
    assert len(want) == len(rows) > 1000 and got.keys() == want.keys()
    for k, (seen, z) in want.items():
        assert got[k][0] == seen and (got[k][1] is None) == (z is None) and (z is None or abs(got[k][1] - z) < 2e-5), k


def test_evaluate_exchanges(spark):
    from plumbline.sources import tables

    def row(i, body, kind="application/json", status=200):
        return (str(i), None, "POST", "/v1/chat/completions", "application/json", '{"messages":[]}', False, status, kind, None, body)

    bodies_ = ['{"choices":[{"message":{"content":"What a pathetic moron."}}]}', '{"choices":[{"message":{"content":"Fine."}}]}', "{}", None]
    df = spark.createDataFrame([row(i, b) for i, b in enumerate(bodies_)] + [row(8, bodies_[0], status=500), row(9, None, "text/event-stream")], tables.EXCHANGES).withColumn("ts", F.timestamp_seconds(F.col("exchange_id").cast("int")))
    chunks = spark.createDataFrame([("9", 1, bytearray(b'tent":"such scum, such a loser"}}]}\n\n')), ("9", 0, bytearray(b'data: {"choices":[{"delta":{"con'))], tables.CHUNKS)
    s = Settings.from_json('{"toxicityAction": "block", "includeWithheldText": true}')
    got = {r["exchange_id"]: r for r in evaluate(df, s, chunks).collect()}
    assert set(got) == {"0", "1", "9"}
    assert got["0"]["applied"] == "block" and json.loads(got["0"]["new_body"])["x_output_quality"]["withheldText"].startswith("What a")
    assert got["1"]["new_body"] == bodies_[1] and got["9"]["applied"] == "monitor(streaming)"


def test_stream_state_equals_batch(spark, tmp_path):
    from plumbline.streaming.stateful import feedback_replies

    rows = [("k", f"{i:03}", 1_000_000 + i * 37, i % 3 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "key string, id string, s long, negative boolean").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = feedback_replies(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), 300)
    q = out.writeStream.format("memory").queryName("replies").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    stream = {r["id"]: (r["samples"], round(r["rate"], 9)) for r in spark.table("replies").collect()}
    batch = {r["id"]: (r["samples"], round(r["rate"], 9)) for r in state.feedback_as_of(df, df.limit(0), "key", 300, own=True).collect()}
    assert stream == batch


def test_adding_a_signal_never_lowers(spark):
    s = F.array(rules.signal("bias", 0.3, "a"), rules.signal("bias", 0.0, "b"), rules.signal("bias", 1.5, "c"))
    r = spark.range(1).select(scores.fold(s, "bias").alias("x"), scores.reasons(s).alias("r")).first()
    assert r["x"] == 1.0 and r["r"] == ["bias:a", "bias:c"]


def test_entry_without_optional_parts(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 200 and set(e.oracle_sql()) <= set(e.queries())


def test_stream_baseline_skips_nulls(spark, tmp_path):
    from plumbline.streaming.stateful import baseline

    rows = [("k", f"{i:02}", 1_000_000 + i, None if i == 4 else float(x)) for i, x in enumerate([2, 4, 4, 4, 0, 4, 5, 5, 7, 9])]
    df = spark.createDataFrame(rows, "key string, id string, s long, x double").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    q = baseline(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), 8).writeStream.format("memory").queryName("heights").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    z = {r["id"]: r["z"] for r in spark.table("heights").collect()}
    batch = {r["id"]: r["z"] for r in state.baseline_fold(df, "key", ["ts", "id"], "x", 8).collect()}
    assert z["04"] is None and batch["04"] is None and z["09"] == pytest.approx(batch["09"])


def test_fold_in_blocks_equals_the_recurrence(spark):
    rows = [(None if i % 5 == 0 else "k", i, None if i % 17 == 0 else math.sin(i) * 3 + i / 400) for i in range(4000)]
    df = spark.createDataFrame(rows, "key string, i long, x double")
    states, want = {}, {}
    for k, i, x in rows:
        want[i] = states.get(k, (0, 0.0, 0.0))
        if x is not None:
            states[k] = state.advance(want[i], x)
    for block in (300, 700, 10**6):
        got = {r["i"]: (r["seen"], r["mean"], r["variance"]) for r in state.baseline_fold(df, "key", ["i"], "x", 30, block).collect()}
        assert got.keys() == want.keys()
        for i, w in want.items():
            assert got[i][0] == w[0] and got[i][1:] == pytest.approx(w[1:], abs=1e-9)


def test_running_sums_of_hot_groups(spark):
    from plumbline.session import Cut, running

    rows = [(None if i % 3 else i % 2, i % 50, i) for i in range(2000)] + [(7, 1, 1)] * 300
    df = spark.createDataFrame(rows, "k long, o long, v long")
    out = running(df, ["k"], ["o", "v"], {"n": F.lit(1).cast("long"), "t": F.col("v")}, Cut(spark)).collect()
    by = {}
    for r in out:
        by.setdefault(r["k"], []).append((r["n"], r["t"], r["o"], r["v"]))
    assert len(out) == len(rows)
    for k, got in by.items():
        t = 0
        for i, (n, total, o, v) in enumerate(sorted(got)):
            t += v
            assert (n, total) == (i + 1, t)
        assert [(o, v) for _, _, o, v in sorted(got)] == sorted((o, v) for kk, o, v in rows if kk == k)


def test_judge_over_http_and_its_timeout(spark):
    import threading
    import time
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    from plumbline.operators import judge
    from plumbline.settings import Judge

    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["content-length"])).decode()
            seen.append((self.path, self.headers[judge.GUARD_HEADER], self.headers["authorization"], body))
            if "slow" in body:
                time.sleep(2)
            reply = b'{"choices":[{"message":{"content":"{\\\\"bias\\\\":0.9}"}}]}'
            self.send_response(500 if "broken" in body else 200)
            self.send_header("content-length", str(len(reply)))
            self.end_headers()
            self.wfile.write(reply)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        j = Judge(f"http://127.0.0.1:{server.server_port}", path="/v1/x", api_key="key", timeout_ms=500)
        df = spark.createDataFrame([("a", "fine"), ("b", "broken"), ("c", "slow")], "exchange_id string, request string")
        got = {r["exchange_id"]: r for r in judge.call(df, judge.http(j, "token"), j.timeout_ms).collect()}
        assert got["a"]["status"] == 200 and "0.9" in got["a"]["body"] and got["b"]["status"] == 500 and got["c"]["status"] == 0
        assert all(r["judge_ms"] is not None and r["judge_ms"] < 1900 for r in got.values())
        assert ("/v1/x", "token", "Bearer key", "fine") in seen
        gone = judge.call(df.limit(1), judge.http(Judge("http://127.0.0.1:9", timeout_ms=300)), 300).collect()
        assert gone[0]["status"] == 0
    finally:
        server.shutdown()


def test_protocol_odds_and_ends():
    assert wire.extract('{"jsonrpc":"2.0","result":{"parts":[{"kind":5,"type":"data","text":"x"},{"type":"data","text":"y"}]}}').text == "x"
    assert wire.judge_verdict('{"bias":1e999}', ("bias",)) is None and wire.judge_verdict('{"bias":"1e999"}', ("bias",)) is None
    assert wire.rewrite('{"jsonrpc":"2.0","result":["x"]}', "{}", "block", False) is None
    assert wire.parse("123456789012345678901234567890") == 1.2345678901234568e29
    s = Settings.from_json('{"judgeService":"j"}')
    assert s.guard_token == Settings.from_json('{"judgeService":"j"}').guard_token != Settings.from_json('{"judgeService":"k"}').guard_token


def test_suspicion_ignores_length_and_feedback(spark):
    """A text of an unusual length alone is not asked about."""
    from plumbline.settings import Judge

    rows = [("k", i, f"{i:04}", " ".join(f"w{j}x" for j in range(400 if i == 80 else 6 + i % 3))) for i in range(81)]
    df = plain_outputs(spark.createDataFrame(rows, "k string, ts long, exchange_id string, text string"))
    out = score_outputs(df, Settings(judge=Judge("j", "onSuspicion", suspicion=0.75)), key="k", order=["ts"], ask=lambda body: (200, "{}")).where("ts = 80").first()
    assert out["anomaly"] == pytest.approx(0.8) and out["source"] == "heuristic"


def test_streams_put_together_as_in_batches(spark, tmp_path):
    """Chunks that arrive over several triggers give what the whole stream gives; the byte budget holds."""
    from plumbline.streaming.stateful import reassemble

    events = {
        "chat": "".join(f"data: {json.dumps({'choices': [{'delta': {'content': w}}]})}\n\n" for w in ("é", "b ", "c" * 300)) + 'data: {"choices":[{"finish_reason":"max_tokens"}]}',
        "typed": 'data: {"type":"content_block_delta","delta":{"text":"x"}}\r\n\r\ndata: {"type":"message_delta","delta":{"stop_reason":"end_turn"}}\n\n',
        "agent": 'data: {"jsonrpc":"2.0","result":{"artifactUpdate":{"artifact":{"parts":[{"text":"a"}]}}}}\n\ndata: {"jsonrpc":"2.0","result":{"status":{"state":"failed"}}}\n\n',
    }
    rows = [(k, i // 7, e.encode()[i : i + 7], i + 7 >= len(e.encode())) for k, e in events.items() for i in range(0, len(e.encode()), 7)]
    df = spark.createDataFrame(rows, "exchange_id string, seq long, chunk binary, last boolean")
    for i, (lo, hi) in enumerate(((0, 5), (5, 11), (11, 10**6))):
        df.where((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{i}"))
    for limit in (1 << 20, 120):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in*"))
        q = reassemble(stream, limit).writeStream.format("memory").queryName(f"whole{limit}").option("checkpointLocation", str(tmp_path / f"cp{limit}")).start()
        q.processAllAvailable()
        q.stop()
        got = {r["exchange_id"]: (r["text"], r["finish_reasons"], r["truncated"]) for r in spark.table(f"whole{limit}").collect()}
        for k, e in events.items():
            raw, taken, capped = e.encode(), b"", False
            for i in range(0, len(raw), 7):
                taken, capped = (taken + raw[i : i + 7], capped) if len(taken) < limit else (taken, True)
            o = wire.extract_stream(taken, limit, capped)
            assert got[k] == (o.text, o.finish_reasons, o.truncated), k


def test_scratch_tables_are_deleted_and_others_stay(spark):
    import os

    from plumbline.session import Cut, scratch, shared_folder

    ids = spark.range(5)
    outer = Cut(spark)
    home = shared_folder(spark)
    with scratch(spark):
        inner = Cut(spark)(ids.selectExpr("id * 2 AS id"))
        with scratch(spark):
            deeper = Cut(spark)(ids)
            assert deeper.count() == 5
        folder = shared_folder(spark)
        kept = outer(inner.selectExpr("id + 1 AS id"))
    local = lambda x: x.removeprefix("file:")
    assert folder.startswith(home + "/") and not os.path.exists(local(folder)) and shared_folder(spark) == home
    assert sorted(r["id"] for r in kept.collect()) == [1, 3, 5, 7, 9]
    with pytest.raises(ValueError, match="x"), scratch(spark):
        raise ValueError("x")
    assert shared_folder(spark) == home
