"""Secret scan with multipart credential linking, by SQL functions only.

Base spans: ``assign`` (a name, = or :, a value of 6+ characters), ``access`` (AKIA and 16+ more)
and ``hex`` (24+ hex digits).  Parts that are too weak alone are ``id`` (an assigned client or user
identifier), ``weak`` (an assigned value of under 6 characters, or 16 to 23 hex digits) and
``endpoint`` (a URL).  An interval join within the text's scopes links parts: a scope reaches
``reach`` characters to either side of a part.  A weak secret is reported only where an identifier
(``access`` or ``id``) or an endpoint lies in its scope; an ``id`` or ``endpoint`` only where a
secret (``assign``, ``hex`` or ``weak``) does.  Weak parts that overlap a base span are not
reported.  Places are code points, the end is exclusive.

Null and empty texts have no spans; repeated rows are scanned row by row; other columns are kept by
``redact`` and ignored by ``scan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns; group 2 of ASSIGN is the value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{16,}"
IDENT = r"""((?i:client|access_key|app|user)_?(?i:id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.-]+)"""
#: What an endpoint is, of any scheme.  Searching for it as it stands is quadratic in a very long word.
ENDPOINT = r"""[a-z][a-z0-9+.-]*://[^\x00-\x20"'<>]+"""
#: The same matches as group 1, in linear time: a run is tried from its first character only and not given back.
FIND_ENDPOINT = r"""(?<![a-z0-9+.-])[0-9+.-]*+([a-z][a-z0-9+.-]*+://[^\x00-\x20"'<>]+)"""
KINDS = ("assign", "access", "hex", "id", "weak", "endpoint")
SPAN = "array<struct<start:int,rank:int,end:int>>"
PLACES = "array<struct<start:int,end:int,size:int>>"
BLOCK = 128


def _places(text: Column, pattern: str, value_group: int = 0) -> Column:
    """array<struct<start, end, size>> of the matches; size is of the value group."""
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    wholes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)), F.length) if value_group else wholes
    steps = F.arrays_zip(pieces.alias("piece"), wholes.alias("whole"), sizes.alias("size"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["piece"]
        end = start + F.coalesce(x["whole"], F.lit(0))
        one = F.struct(start.alias("start"), end.alias("end"), x["size"].alias("size"))
        return F.struct(end.alias("at"), F.when(x["whole"].isNull(), acc["out"]).otherwise(F.array_append(acc["out"], one)).alias("out"))

    def join(acc: Column, block: Column) -> Column:
        at = acc["at"]
        moved = F.transform(block["out"], lambda m: F.struct((m["start"] + at).alias("start"), (m["end"] + at).alias("end"), m["size"].alias("size")))
        return F.struct((at + block["at"]).alias("at"), F.array_append(acc["out"], moved).alias("out"))

    # places within a block of matches first, then the blocks' own: appending to one long array would be quadratic
    inner = F.transform(_cut(steps), lambda block: F.aggregate(block, zero, step))
    found = F.aggregate(inner, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{PLACES}>").alias("out")), join, lambda acc: F.flatten(acc["out"]))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(PLACES))


def _endpoints(text: Column) -> Column:
    """The places of ENDPOINT, which ends each match of FIND_ENDPOINT."""
    return F.transform(_places(text, FIND_ENDPOINT, 1), lambda x: F.struct((x["end"] - x["size"]).alias("start"), x["end"].alias("end"), x["size"].alias("size")))


def _cut(array: Column) -> Column:
    """``array`` in blocks of BLOCK elements, one empty block for no elements."""
    last = lambda x: F.floor((F.greatest(F.size(x), F.lit(1)) - 1) / BLOCK).cast("int")
    cut = lambda x: F.transform(F.sequence(F.lit(0), last(x)), lambda i: F.slice(x, i * BLOCK + 1, BLOCK))
    return F.transform(F.array(array), cut)[0]  # the outer lambda names the array, so that it is made once


def _blocks(spans: Column) -> Column:
    """Sorted spans in blocks with the range (lo, hi) that each covers; no block for no spans."""
    ranged = lambda x: F.struct(x[0]["start"].alias("lo"), F.array_max(F.transform(x, lambda y: y["end"])).alias("hi"), x.alias("items"))
    return F.transform(F.filter(_cut(spans), lambda x: F.size(x) > 0), ranged)


def _meets(blocks: Column, w: Column, reach: int = 0) -> Column:
    """Whether a span of ``blocks`` is within ``reach`` of ``w``; only blocks in range are opened."""
    near = lambda lo, hi: (lo < w["end"] + reach) & (w["start"] < hi + reach)
    return F.exists(blocks, lambda b: near(b["lo"], b["hi"]) & F.exists(b["items"], lambda p: near(p["start"], p["end"])))


def _as(places: Column, rank: int, keep=None) -> Column:
    kept = F.filter(places, keep) if keep else places
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"))).cast(SPAN)


def with_spans(df: DataFrame, reach: int = 200) -> DataFrame:
    """``df`` with arrays ``_base`` and ``_spans`` of (start, rank, end), sorted."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = df.withColumns({"_assign": _places(text, ASSIGN, 2), "_access": _places(text, ACCESS), "_hex": _places(text, HEX), "_id": _places(text, IDENT, 2), "_endpoint": _endpoints(text)})
    base = F.concat(_as(F.col("_assign"), 0, lambda x: x["size"] >= 6), _as(F.col("_access"), 1), _as(F.col("_hex"), 2, lambda x: x["size"] >= 24))
    weak = F.concat(_as(F.col("_id"), 3), _as(F.col("_assign"), 4, lambda x: x["size"] < 6), _as(F.col("_hex"), 4, lambda x: x["size"] < 24), _as(F.col("_endpoint"), 5))
    df = df.withColumns({"_base": F.array_sort(base), "_weak": F.array_sort(weak)})
    # columns read inside a lambda are also read outside, so that they are made once and not for each element
    df = df.withColumn("_near", _blocks(F.col("_base")))
    clear = F.filter("_weak", lambda w: ~_meets(F.col("_near"), w))
    df = df.withColumn("_weak", F.when((F.size("_weak") > 0) & (F.size("_near") > 0), clear).otherwise(F.col("_weak")))
    secret = lambda p: p["rank"].isin(0, 2, 4)
    parts = F.array_sort(F.concat("_base", "_weak"))
    for name, keep in (("_secrets", secret), ("_others", lambda p: ~secret(p))):
        df = df.withColumn(name, F.when(F.size("_weak") > 0, F.filter(parts, keep)).otherwise(F.array().cast(SPAN)))
    df = df.withColumns({"_secrets": _blocks(F.col("_secrets")), "_others": _blocks(F.col("_others"))})
    linked = F.filter("_weak", lambda w: F.when(secret(w), _meets(F.col("_others"), w, reach)).otherwise(_meets(F.col("_secrets"), w, reach)))
    df = df.withColumn("_weak", F.when((F.size("_secrets") > 0) & (F.size("_others") > 0), linked).otherwise(F.array().cast(SPAN)))
    df = df.withColumn("_spans", F.when(F.size("_weak") > 0, F.array_sort(F.concat("_base", "_weak"))).otherwise(F.col("_base")))
    return df.drop("_assign", "_access", "_hex", "_id", "_endpoint", "_weak", "_near", "_secrets", "_others")


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, reach: int = 200) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row for each input row."""
    df = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), reach)
    count = lambda r: F.size(F.filter("_base", lambda x: x["rank"] == r)).cast("long")
    return df.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", reach: int = 200) -> DataFrame:
    """``docs`` with each span's text replaced by ``mark`` (once where spans overlap) and n_chars anew."""
    df = with_spans(docs, reach)
    df = df.withColumn("_blocks", _blocks(F.col("_spans")))

    def step(acc: Column, x: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(acc["part"], acc["at"] - acc["from"] + 1, x["start"] - acc["at"]), F.lit(mark))
        out = F.when(x["start"] >= acc["at"], fresh).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["from"].alias("from"), acc["part"].alias("part"), out.alias("out"), acc["done"].alias("done"))

    def block(acc: Column, b: Column) -> Column:
        part = F.substring(F.col("text"), acc["at"] + 1, F.greatest(b["hi"] - acc["at"], F.lit(0)))
        begin = F.struct(acc["at"].alias("at"), acc["at"].alias("from"), part.alias("part"), F.lit("").alias("out"), acc["done"].alias("done"))
        return F.aggregate(b["items"], begin, step, lambda x: F.struct(x["at"].alias("at"), F.array_append(x["done"], x["out"]).alias("done")))

    # a block of spans reads its own part of the text only
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("done"))
    rest = lambda acc: F.concat(F.array_join(acc["done"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    text = F.when(F.size("_blocks") > 0, F.aggregate("_blocks", zero, block, rest)).otherwise(F.col("text"))
    df = df.withColumn("text", text)
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return df.select(*docs.columns)
