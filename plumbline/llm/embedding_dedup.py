"""Near-duplicate vectors: spherical k-means cells, then blocked cosines within cells.

Equal vectors of one label are first reduced to one, with a count and a number of its own, by which
blocks, links and components are kept; vec_ids only name rows and components.  Centres are fitted to
a bounded sample (``sample_rows`` and ``sample_bytes``), in two levels; they can change speed, never a
link: a vector also visits every other cell whose border is within half of the widest distance of a
linked pair, so each linked pair meets in a cell.  Cells are split into hash blocks of ``per_block``
vectors and compared block by block in double precision; only counts and a spanning star of what is
linked leave a task.

Vectors that are null, empty, zero or hold null or non-finite components, and those with a null
label, link with nothing.  Vectors of different lengths never link.  Rows that repeat are vectors
of their own, and so are rows that share a vec_id.  A null vec_id stays null; a component is named by
its least vec_id that is not null (null if it has none), and every row that has the component's name
as vec_id is kept.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, block_pairs, components, partitions, prepare, runs, stars

MOST_CELLS = 16_384


def fit_centres(x: np.ndarray, k: int, steps: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spread first centres."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(steps):
        home = (x @ c.T).argmax(1)
        new = np.zeros_like(c)
        np.add.at(new, home, x)
        size = np.linalg.norm(new, axis=1, keepdims=True)
        c = np.where(size > 1e-12, new / np.maximum(size, 1e-12), c)
    return c


def two_levels(x: np.ndarray, k: int) -> np.ndarray:
    """About k centres: some coarse ones, then some within each one's vectors."""
    coarse = max(1, round(math.sqrt(k)))
    if coarse < 8:
        return fit_centres(x, k)
    first = fit_centres(x, coarse)
    home = (x @ first.T).argmax(1)
    own = [x[home == c] for c in range(coarse)]
    return np.concatenate([fit_centres(v, max(1, round(k * len(v) / len(x)))) for v in own if len(v)])


def unit(vectors: pa.Array) -> np.ndarray:
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    scale = np.abs(x).max(1, keepdims=True)
    x = x / scale
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cells_of(x: np.ndarray, c: np.ndarray, half: float) -> list[list[int]]:
    """Each vector's cells, its own first."""
    dots = x @ c.T
    home = dots.argmax(1)
    span = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
    near = dots[np.arange(len(x)), home][:, None] - dots <= half * span[home] + 1e-9
    near[np.arange(len(x)), home] = False
    return [[int(h), *np.flatnonzero(n).tolist()] for h, n in zip(home, near, strict=True)]


def compare(group: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, rows added to each one's links, least linked id) of a block pair."""
    ids = group["id"].to_numpy()
    copies = group["copies"].to_numpy()
    cells = group["cells"].to_pylist()
    here = group["cell"][0].as_py()
    blk, bi, bj = group["blk"].to_numpy(), group["bi"][0].as_py(), group["bj"][0].as_py()
    order = np.argsort(ids)
    x = unit(group["v"].combine_chunks() if isinstance(group["v"], pa.ChunkedArray) else group["v"])
    link = x @ x.T >= least
    np.fill_diagonal(link, False)
    if bi != bj:
        link &= blk[:, None] != blk[None, :]
    home = np.array([c[0] for c in cells])
    at_home = home == here
    link &= at_home[:, None] | at_home[None, :]
    # a pair with different homes may meet in both; it counts in the smaller cell only
    for i in np.flatnonzero(at_home):
        for j in np.flatnonzero(link[i] & ~at_home):
            if home[j] < here and home[j] in cells[i]:
                link[i, j] = link[j, i] = False
    added = link @ copies
    link = link[np.ix_(order, order)]
    root = np.empty(len(ids), np.int64)
    root[order] = ids[order][stars(link)]
    return ids, added, root


def link_vectors(vectors: DataFrame, least: float = 0.98, per_cell: int = 4096, sample_rows: int = 131_072, sample_bytes: int = 64 << 20, per_block: int = 1024) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each input row."""
    spark = prepare(vectors.sparkSession)
    cut = Cut(spark)
    v = F.col("embedding")
    good = v.isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists(v, lambda e: e != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"), F.coalesce(good, F.lit(False)).alias("good"))
    rows = rows.withColumns({"h1": F.xxhash64("label", "v"), "h2": F.xxhash64("v", F.lit("second"), "label")})
    one = rows.where("good").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("own"), F.count("*").alias("copies"), F.first("v").alias("v"))
    one = cut(one.withColumn("id", F.monotonically_increasing_id()))  # written, so the numbers are fixed
    seen = one.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    k = max(1, min(-(-seen["n"] // per_cell), MOST_CELLS))
    most = max(1, min(sample_rows, 16 * k, sample_bytes // (8 * (seen["d"] or 1))))
    some = one.orderBy(F.xxhash64("h1"), "id").limit(most).select("v").toArrow()["v"].combine_chunks()
    size = some.value_lengths().to_numpy(zero_copy_only=False)
    centres: dict[int, np.ndarray] = {}
    for d in np.unique(size).tolist():
        x = unit(some.filter(pa.array(size == d)))
        centres[d] = two_levels(x, max(1, min(k, len(x) // 8)))
    shared = spark.sparkContext.broadcast(centres)  # at most MOST_CELLS centres and sample_bytes
    half = math.sqrt(2 - 2 * least) / 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column("v").value_lengths().to_numpy(zero_copy_only=False)
            cells: list[list[int]] = [[0]] * b.num_rows
            for d in np.unique(at):
                if d in shared.value:
                    where = np.flatnonzero(at == d)
                    for i, c in zip(where.tolist(), cells_of(unit(b.column("v").take(pa.array(where))), shared.value[d], half), strict=True):
                        cells[i] = c
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("id"), b.column("copies"), b.column("v"), pa.array(at, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], ["label", "id", "copies", "v", "dim", "cells"])

    kinds = dict(one.dtypes)
    placed = one.select("label", "id", "copies", "v").mapInArrow(place, f"label {kinds['label']}, id long, copies long, v {kinds['v']}, dim int, cells array<int>")
    keys = ["label", "dim", "cell", "bi", "bj"]
    met = block_pairs(placed.withColumn("cell", F.explode("cells")), keys[:3], "id", per_block)
    met = met.repartition(partitions(spark), *keys).sortWithinPartitions(*keys, "id")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, keys):
            if group.num_rows > 1:
                ids, added, root = compare(group, least)
                some = np.flatnonzero(added)
                yield pa.RecordBatch.from_arrays([pa.array(x[some], pa.int64()) for x in (ids, added, root)], ["id", "added", "root"])

    found = cut(met.mapInArrow(within, "id long, added long, root long"))
    links = found.groupBy("id").agg(F.sum("added").alias("added"))
    comp = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    names = comp.join(one.select("id", "own"), "id").groupBy("root").agg(F.min("own").alias("name"), F.lit(True).alias("linked"))
    known = one.select("label", "h1", "h2", "id", "own", "copies").join(links, "id", "left").join(comp, "id", "left").join(names, "root", "left")
    name = F.when(F.col("linked"), F.col("name")).otherwise(F.col("own"))
    known = cut(known.select("label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("added", F.lit(0))).alias("n"), name.alias("name"), F.lit(True).alias("good")))
    out = rows.select("vec_id", "label", "h1", "h2", "good").join(known, ["label", "h1", "h2", "good"], "left")
    component = F.when(F.col("good"), F.col("name")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
