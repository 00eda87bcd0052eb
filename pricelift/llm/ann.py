"""Nearest neighbours by a block matrix join over int8 codes with error bounds.

Distinct vectors are packed into blocks: int8 codes of the unit vectors, a scale and the norm of what the codes
leave out, and the original vectors.  Groups of query blocks meet stripes of candidate blocks on a grid;
a task holds one query group and streams its candidates.  An int8 product tile gives cosines to within a
known error; pairs whose upper bound reaches the best lower bounds are computed in double precision from
the original vectors and go through one heap a query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelift.llm.common import stored

BLOCK = 2048
#: Queries a task holds at once, and candidates to a stripe: both bound a task, whatever the table's size.
QUERY_GROUP = 16_384
STRIPE = 32_768
#: Rounding of single and double precision in the bounds.
SLACK = 1e-6
#: Components to a partial product: 127^2 x 1000 is exact in single precision.
EXACT = 1000

PACKED = pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("rows", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("codes", pa.binary()), ("scales", pa.binary())])
PACKED_DDL = "dim int, block long, rows int, ids binary, vectors binary, codes binary, scales binary"


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors and (scale, norm of the residual, norm of the coded vector) of each."""
    # squares of single-precision components neither overflow nor vanish in double precision
    wide = vectors.astype(np.float64)
    unit = wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    left = unit - coded
    return codes, np.column_stack([scale, np.sqrt((left * left).sum(axis=1)), np.sqrt((coded * coded).sum(axis=1))])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision, every row summed in the same order."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def products(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The int8 product tile.  In pieces of EXACT components single precision is exact, so its fast product serves."""
    total = np.zeros((len(one), len(two)))
    for at in range(0, one.shape[1], EXACT):
        total += one[:, at : at + EXACT].astype(np.float32) @ two[:, at : at + EXACT].astype(np.float32).T
    return total


def blocks(vectors: DataFrame, most_ids: int) -> DataFrame:
    """Rows (dim, ids, embedding) packed into blocks of one dimension; the number of ids and up to ``most_ids`` of them are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[list[int], list[float]]]] = {}

        def pack(dim: int) -> pa.RecordBatch:
            rows = waiting.pop(dim)
            ids = np.zeros((len(rows), most_ids + 1), np.int64)
            for n, (own, _) in enumerate(rows):
                ids[n, 0] = len(own)
                ids[n, 1 : 1 + len(own)] = own
            matrix = np.array([v for _, v in rows], np.float32)
            codes, scales = quantised(matrix)
            values = [[dim], [int(ids[0, 1])], [len(rows)], [ids.tobytes()], [matrix.tobytes()], [codes.tobytes()], [scales.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, PACKED, strict=True)], schema=PACKED)

        for batch in batches:
            for dim, ids, vector in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                waiting.setdefault(dim, []).append((ids, vector))
                if len(waiting[dim]) == BLOCK:
                    yield pack(dim)
        for dim in list(waiting):
            yield pack(dim)

    return vectors.select("dim", "ids", "embedding").mapInArrow(run, PACKED_DDL)


class Block:
    def __init__(self, row: dict, most_ids: int):
        n, dim = row["rows"], row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64).reshape(n, most_ids + 1)
        self.vectors = np.frombuffer(row["vectors"], np.float32).reshape(n, dim)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(n, dim)
        self.scale, self.left, self.norm = np.frombuffer(row["scales"], np.float64).reshape(n, 3).T


def offer(heaps: list[list[tuple[float, int]]], queries: Block, candidates: Block, k: int, found: dict[int, list[int]]) -> None:
    """Put the candidates that may be among the k nearest into the heaps of their queries.

    A heap entry is (cosine, -smallest id): of equal cosines the larger id goes first.
    """
    for at in range(0, len(queries.codes), 256):
        here = slice(at, at + 256)
        tile = products(queries.codes[here], candidates.codes) * queries.scale[here, None] * candidates.scale[None, :]
        error = queries.left[here, None] + queries.norm[here, None] * candidates.left[None, :] + SLACK
        low = tile - error
        if low.shape[1] >= k:
            reach = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        else:
            reach = np.full(low.shape[0], -np.inf)
        held = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[at : at + 256]])
        rows, columns = np.nonzero(tile + error >= np.maximum(reach, held - SLACK)[:, None])
        for part in range(0, len(rows), 1 << 16):
            r, c = rows[part : part + (1 << 16)], columns[part : part + (1 << 16)]
            scores = cosines(queries.vectors[at + r], candidates.vectors[c])
            for query, score, column in zip((at + r).tolist(), scores.tolist(), c.tolist(), strict=True):
                first = int(candidates.ids[column, 1])
                entry = (score, -first)
                heap = heaps[query]
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                else:
                    continue
                if candidates.ids[column, 0] > 1:
                    found[first] = candidates.ids[column, 1 : 1 + candidates.ids[column, 0]].tolist()


NEAREST = pa.schema([("rep", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])


def tiles(grid: DataFrame, k: int) -> DataFrame:
    """The k nearest distinct vectors of every query of a grid cell, among the candidates of the cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries, heaps, found = None, [], [], {}

        def results() -> Iterator[pa.RecordBatch]:
            for block, own in zip(queries, heaps, strict=True):
                rows = [(int(block.ids[n, 1]), s, found.get(-i, [-i])) for n, h in enumerate(own) for s, i in sorted(h, reverse=True)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), NEAREST, strict=True)], schema=NEAREST)

        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n].as_py() for name in ("dim", "group", "stripe", "kind", "rows", "ids", "vectors", "codes", "scales")}
                here = (row["dim"], row["group"], row["stripe"])
                if here != cell:
                    yield from results()
                    cell, queries, heaps, found = here, [], [], {}
                if row["kind"] == 0:
                    queries.append(Block(row, k))
                    heaps.append([[] for _ in range(row["rows"])])
                else:
                    candidates = Block(row, k)
                    for n_, block in enumerate(queries):
                        offer(heaps[n_], block, candidates, k, found)
        yield from results()

    return grid.mapInArrow(run, "rep long, score double, ids array<long>")


def nearest(vectors: DataFrame, k: int = 5, query_step: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows by cosine of every row whose id is divisible by ``query_step``.

    Exact: bounds only leave out pairs that cannot be among the nearest.  Ties go to the smaller id.  Vectors that are null, zero
    or empty, or hold a null or non-finite component, take no part, nor do rows without an id; vectors of
    different lengths are never compared.  Equal vectors are searched once, with as many of their
    smallest ids as can be asked for, so a vector with very many copies costs as much as any other.  A table without
    a second candidate gives no rows.  Rows that share an id count once for each different vector.
    """
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    valid = valid.filter(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0) & fine).distinct()
    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    firsts = valid.withColumn("n", F.row_number().over(smallest)).filter(F.col("n") <= k + 1)
    distinct = stored(
        firsts.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.size("embedding").alias("dim"), F.get("ids", F.lit(0)).alias("rep"), "ids", "embedding"), "vectors")
    asked = valid.filter(F.col("vec_id") % query_step == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    queries = stored(asked.join(distinct.select("rep", "dim", "embedding"), "embedding").select("query_id", "rep", "dim"), "queries")
    searched = distinct.join(queries.select("rep", "dim").distinct(), ["rep", "dim"], "left_semi")

    stripes, groups = max(1, math.ceil(distinct.count() / STRIPE)), max(1, math.ceil(searched.count() / QUERY_GROUP))
    stripes = max(stripes, min(64, vectors.sparkSession.sparkContext.defaultParallelism))
    dealt = F.pmod(F.xxhash64("rep"), F.lit(groups))
    asking = blocks(searched.repartition(groups, dealt), k + 1).withColumns({
        "group": F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"), "kind": F.lit(0)})
    offered = blocks(distinct.repartition(F.pmod(F.xxhash64("rep"), F.lit(stripes))), k + 1).withColumns({
        "stripe": F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int"), "kind": F.lit(1)})
    # each query block goes to every stripe, each candidate block to every query group
    asking = asking.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    offered = offered.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    grid = asking.unionByName(offered).repartition("dim", "group", "stripe").sortWithinPartitions("dim", "group", "stripe", "kind")
    best = Window.partitionBy("rep").orderBy(F.desc("score"), F.get("ids", F.lit(0)))
    found = tiles(grid, k + 1).withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    rows = found.select("rep", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    rows = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).drop("n")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    joined = queries.join(rows, "rep").filter("vec_id != query_id").withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= k)
    return joined.select("query_id", "rank", "vec_id", "score")
