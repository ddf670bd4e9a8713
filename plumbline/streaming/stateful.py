"""Keyed state over streams: the length baseline, the feedback window and stream reassembly."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.wire import Output, push_event
from ..operators.state import FLAT, advance
from ..session import ready


def baseline(stream: DataFrame, warmup: int) -> DataFrame:
    """(key, id, ts, x) -> key, id, z: each row against those before it of its key, by ts and id within a trigger.

    A null x has no z and leaves the state as it is.
    """

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else (0, 0.0, 0.0)
        for f in [pd.concat(list(frames)).sort_values(["ts", "id"])]:
            z = []
            for x in f["x"].tolist():
                n, mean, variance = held
                known = x is not None and x == x
                z.append((x - mean) / variance**0.5 if known and n >= warmup and variance > FLAT else None)
                if known:
                    held = advance(tuple(held), x)
            state.update(tuple(held))
            yield pd.DataFrame({"key": key[0], "id": f["id"], "z": pd.Series(z, index=f.index, dtype="float64")})

    ready(stream.sparkSession)
    return stream.groupBy("key").applyInPandasWithState(run, "key string, id string, z double", "n long, mean double, variance double", "append", GroupStateTimeout.NoTimeout)


def roll(state: tuple[int, int, int, int, int], bucket: int) -> tuple[int, int, int, int, int]:
    """(bucket, total, negative, prev_total, prev_negative) moved to a bucket; a gap or a step back clears."""
    b, n, bad, _, _ = state
    if bucket == b:
        return state
    return (bucket, 0, 0, n, bad) if bucket == b + 1 else (bucket, 0, 0, 0, 0)


def feedback_replies(stream: DataFrame, seconds: int) -> DataFrame:
    """(key, id, ts, negative) -> key, id, samples, rate, each signal counted in its own reply."""

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else (-1, 0, 0, 0, 0)
        rows = []
        f = pd.concat(list(frames)).sort_values(["ts", "id"])
        for i, ts, negative in zip(f["id"], f["ts"], f["negative"], strict=True):
            b, n, bad, pn, pbad = roll(tuple(held), int(ts.timestamp()) // max(1, seconds))
            held = (b, n + 1, bad + int(negative), pn, pbad)
            rows.append((key[0], i, n + 1 + pn, (held[2] + pbad) / (n + 1 + pn)))
        state.update(held)
        yield pd.DataFrame(rows, columns=["key", "id", "samples", "rate"])

    ready(stream.sparkSession)
    return stream.groupBy("key").applyInPandasWithState(run, "key string, id string, samples long, rate double", "bucket long, n long, bad long, pn long, pbad long", "append", GroupStateTimeout.NoTimeout)


def reassemble(stream: DataFrame, limit: int) -> DataFrame:
    """(exchange_id, seq, chunk, last) -> exchange_id, text, finish_reasons, truncated, once the last chunk is there."""

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        raw, capped = state.get if state.exists else (b"", False)
        done, size, pieces = False, len(raw), [bytes(raw)]
        for c, last in pd.concat(list(frames)).sort_values("seq")[["chunk", "last"]].itertuples(index=False):
            if size < limit:
                pieces.append(bytes(c))
                size += len(c)
            else:
                capped = True
            done |= bool(last)
        raw = b"".join(pieces)
        if not done:
            state.update((raw, capped))
            return
        from ..functions.wire import events

        state.remove()
        out = Output(limit)
        for e in events(raw):
            push_event(out, e)
        yield pd.DataFrame([(key[0], out.text, out.finish_reasons, out.truncated or capped)], columns=["exchange_id", "text", "finish_reasons", "truncated"])

    ready(stream.sparkSession)
    schema = "exchange_id string, text string, finish_reasons array<string>, truncated boolean"
    return stream.groupBy("exchange_id").applyInPandasWithState(run, schema, "raw binary, capped boolean", "append", GroupStateTimeout.NoTimeout)
