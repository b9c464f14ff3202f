"""Exact top-k inner products over norm-sorted tiles, pruned by Cauchy-Schwarz bounds on SVD-rotated partial sums.

Candidates are dealt into tiles by descending length, queries into tiles with a lower bound of their k-th score each
(from the longest vectors). A pair of tiles meets only if the longest candidate could still reach some query's bound; in
it candidates are taken by descending length, the leading rotated components are multiplied first, and what
|q_rest| * |v_rest| cannot lift to the bound is dropped. The rest gets its exact integer product. Where the leading
components drop little they are left out for some steps, which changes the time and not the result.

Tiles are bounded in bytes, hold the narrowest integers that fit, and are worked off in small blocks of which only the k
best of each query stay, so a task's memory does not grow with the tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import stored

#: Bytes of a tile (by estimate; half as many more at most), tiles of candidates that even small data are cut into, and rows
#: of queries and candidates taken at once.
TILE_BYTES, LEAST_TILES, STEP = 12 << 20, 48, 1_024
#: Longest vectors that give the first bounds; they are broadcast.
SEEDS = 2_048
#: Share of the components, by falling singular value, that is multiplied before the first bound.
LEADING = 0.5
#: Share of a step's pairs above which their bounds are not worth it, and steps until they are tried again.
DENSE, PAUSE = 0.125, 32


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``, the components as floor(scale * x); rows without id, NULL or not finite somewhere are left out."""
    real = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall("real", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long"), real.alias("real")).filter("vec_id IS NOT NULL AND real IS NOT NULL")
    return rows.filter(sound).select("vec_id", F.transform("real", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def squared_length(v: str) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))


def matrix(column: pa.Array, dims: int, kind: np.dtype = np.int64) -> np.ndarray:
    """Rows of an array column; shorter ones are filled with zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), kind)
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    return out


def narrowest(low: int, high: int) -> np.dtype:
    """The smallest integer type for values from ``low`` to ``high``."""
    return next(np.dtype(t) for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def lengths(v: np.ndarray) -> np.ndarray:
    parts = (v[i : i + STEP].astype(np.float64) for i in range(0, len(v), STEP))
    return np.concatenate([np.zeros(0), *(np.sqrt(np.square(x).sum(axis=1)) for x in parts)])


def exact_type(q_length: float, c_length: float) -> type:
    """A type for products of vectors up to these lengths: no partial sum exceeds the lengths' product, so floating point is exact
    while this fits its bits."""
    most = q_length * c_length * (1 + 1e-9) + 1
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows."""
    kind = exact_type(lengths(q).max(initial=0), lengths(c).max(initial=0))
    return q.astype(kind) @ c.astype(kind).T


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -inf if it has fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all ``v``, by falling singular value, from d by d sums made in each task."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            rows = matrix(batch.column("v"), dims).astype(np.float64)
            total += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"total": [total.ravel()]})

    sums = vectors.select("v").mapInArrow(reduce, "total array<double>").select(F.posexplode("total").alias("at", "x"))
    found = {r["at"]: r["x"] for r in sums.groupBy("at").agg(F.sum("x").alias("x")).collect()}
    gram = np.array([found.get(i, 0.0) for i in range(dims * dims)]).reshape(dims, dims)
    return np.linalg.eigh(gram)[1][:, ::-1]


def tiles(vectors: DataFrame, rows: int, dims: int, kind: np.dtype, bound=None) -> DataFrame:
    """``tile``, ``longest``, ``needs`` and the packed ``ids``, ``v`` (as ``kind``) and ``floors`` of up to ``rows`` vectors, in their
    order.

    ``bound`` gives the k-th score a query is sure to reach; ``needs`` is the length below which no candidate reaches any.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def tile() -> pa.RecordBatch:
            nonlocal first
            ids, v = (np.concatenate(x) for x in zip(*held))
            held.clear()
            floors = bound(ids, v) if bound else np.zeros(0)
            length = lengths(v)
            with np.errstate(divide="ignore", invalid="ignore"):
                needs = np.where(length > 0, floors / length, np.where(floors > 0, np.inf, -np.inf)).min() if bound else 0.0
            first += 1
            return pa.RecordBatch.from_pydict({
                "tile": pa.array([first], pa.int64()), "longest": [float(length.max())], "needs": [float(needs)],
                "ids": [ids.tobytes()], "v": [v.tobytes()], "floors": [floors.tobytes()],
            })

        for batch in batches:
            ids, v = batch.column("vec_id").to_numpy(), matrix(batch.column("v"), dims, kind)
            while len(ids):
                room = rows - sum(len(h[0]) for h in held)
                held.append((ids[:room], v[:room]))
                ids, v = ids[room:], v[room:]
                if sum(len(h[0]) for h in held) == rows:
                    yield tile()
        if held:
            yield tile()

    schema = "tile long, longest double, needs double, ids binary, v binary, floors binary"
    return stored(vectors.select("vec_id", "v").mapInArrow(pack, schema), "tiles")


def turned(v: np.ndarray, turn: np.ndarray, m: int, real: type) -> tuple[np.ndarray, np.ndarray]:
    """The ``m`` leading rotated components of each row and the length of the others, as ``real``."""
    leading, rest = np.zeros((len(v), m), real), np.zeros(len(v), real)
    for i in range(0, len(v), STEP):
        part = v[i : i + STEP].astype(np.float64) @ turn
        leading[i : i + STEP] = part[:, :m]
        rest[i : i + STEP] = np.sqrt(np.square(part[:, m:]).sum(axis=1))
    return leading, rest


def places(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that hold; faster than ``nonzero``, which counts by row."""
    return np.divmod(np.flatnonzero(hits), hits.shape[1])


class Best:
    """The k best (candidate, score) of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k, self.held = k, np.zeros(queries, np.int64)
        self.ids, self.scores = np.zeros((queries, k), np.int64), np.zeros((queries, k), np.int64)

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Takes candidates of the queries ``at``; the queries whose best changed."""
        last, low = self.ids[at, -1], self.scores[at, -1]
        better = (self.held[at] < self.k) | (scores > low) | ((scores == low) & (ids < last))
        at, ids, scores = at[better], ids[better], scores[better]
        changed = np.unique(at)
        there = np.arange(self.k) < self.held[changed, None]
        at = np.concatenate([np.repeat(changed, self.held[changed]), at])
        ids = np.concatenate([self.ids[changed][there], ids])
        scores = np.concatenate([self.scores[changed][there], scores])
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kept = place < self.k
        self.ids[at[kept], place[kept]], self.scores[at[kept], place[kept]] = ids[kept], scores[kept]
        self.held[changed] = np.minimum(self.k, np.unique(at, return_counts=True)[1])
        return changed

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, place = np.nonzero(np.arange(self.k) < self.held[:, None])
        return at, self.ids[at, place], self.scores[at, place]


def best_of_tile(q_ids, q, floors, c_ids, c, turn: np.ndarray, k: int):
    """(query, candidate, score) arrays with the k best of a tile's candidates for each query, ties to the smaller id.

    ``c`` runs by falling length. Bounds get a little slack for their rounding, so nothing on the edge is lost.
    """
    m = max(1, int(turn.shape[1] * LEADING)) if turn.shape[1] else 0
    q_length, c_length = lengths(q), lengths(c)
    kind = exact_type(q_length.max(initial=0), c_length.max(initial=0))
    real = np.float64 if kind is np.int64 else np.float32  # float32 has no room for the largest
    c_exact, (c_leading, c_rest) = c.astype(kind), turned(c, turn, m, real)
    rounding, pause, space = (m + 16) * 2.0**-22, 0, np.empty(STEP * STEP, kind)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for first in range(0, len(q), STEP):
        rows = slice(first, first + STEP)
        exact, ids, length, floor, best = q[rows].astype(kind), q_ids[rows], q_length[rows], floors[rows].copy(), Best(len(q_ids[rows]), k)
        leading, rest = turned(q[rows], turn, m, real)
        for begin in range(0, len(c), STEP):
            part = slice(begin, begin + STEP)
            alive = np.flatnonzero(length * c_length[begin] * (1 + 1e-9) + 1e-6 >= floor)  # the longest of the step decides
            if not len(alive):
                break
            every = len(alive) == len(exact)
            sparse = not pause
            if sparse:
                reach = (leading if every else leading[alive]) @ c_leading[part].T
                reach += rest[alive, None] * c_rest[None, part]
                slack = 1e-6 + rounding * length[alive] * c_length[begin]
                hits = reach >= (floor[alive] - slack)[:, None].astype(reach.dtype)
                sparse = np.count_nonzero(hits) <= DENSE * hits.size
                pause = 0 if sparse else PAUSE
            else:
                pause -= 1
            if sparse:
                at, of = places(hits)
                score = np.concatenate([
                    np.zeros(0, kind),
                    *(np.einsum("ij,ij->i", exact[alive[at[i : i + 65536]]], c_exact[begin + of[i : i + 65536]]) for i in range(0, len(at), 65536)),
                ])
                near = score >= floor[alive[at]]
                at, of, score = at[near], of[near], score[near]
            else:
                scores = space[: len(alive) * len(c_exact[part])].reshape(len(alive), -1)
                np.matmul(exact if every else exact[alive], c_exact[part].T, out=scores)
                high = np.flatnonzero(scores.max(axis=1) >= floor[alive])  # few after the first steps
                at, of = places(scores[high] >= floor[alive[high], None].astype(kind if kind is np.float32 else np.float64))
                at = high[at]
                score = scores[at, of]
            at, of = alive[at], begin + of
            other = ids[at] != c_ids[of]
            at, of, score = at[other], of[other], score[other]
            for i in range(0, len(at), 65536):
                some = slice(i, i + 65536)
                changed = best.add(at[some], c_ids[of[some]], score[some].astype(np.int64))
                full = changed[best.held[changed] == k]
                floor[full] = np.maximum(floor[full], best.scores[full, -1])
        at, of, score = best.found()
        found.append((ids[at], of, score))
    return tuple(np.concatenate(x) for x in zip(*found))


def top_inner_products(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: the k candidates of largest inner product per query.

    Both sides are (vec_id, v) with integer components, as from ``integer_vectors``. A query never finds its own id; ties
    go to the smaller id; with fewer candidates all are returned. Vectors of different length are compared over the
    components both have. Repeated candidates count each; of repeated queries the one of greatest vector is asked. Scores
    have to fit 63 bits. Empty tables: no rows. What reaches the driver is a row a tile, d by d sums and the seeds.
    """
    spark = candidates.sparkSession
    candidates = stored(candidates.select("vec_id", "v", squared_length("v").alias("squared")), "vectors")
    asked = stored(queries.groupBy("vec_id").agg(F.max("v").alias("v")), "queries")
    of_side = [F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")]
    counted, q_counted = candidates.agg(*of_side).first(), asked.agg(*of_side).first()
    dims = max(counted["dims"] or 0, q_counted["dims"] or 0)
    kind = narrowest(min(counted["low"] or 0, q_counted["low"] or 0), max(counted["high"] or 0, q_counted["high"] or 0))
    turn = rotation(candidates, dims)
    # Short rows first: each task sends as many as there are seeds.
    ends = candidates.select("squared", "vec_id").orderBy(F.desc("squared"), "vec_id").limit(SEEDS).collect()[-1:]
    near_top = [(F.col("squared") > r["squared"]) | ((F.col("squared") == r["squared"]) & (F.col("vec_id") <= r["vec_id"])) for r in ends]
    leading = candidates.filter(near_top[0] if ends else F.lit(False)).orderBy(F.desc("squared"), "vec_id")
    longest = leading.limit(SEEDS).select("vec_id", "v").collect()
    seed_ids = np.array([r["vec_id"] for r in longest], np.int64)
    seeds = np.array([r["v"] + [0] * (dims - len(r["v"])) for r in longest], np.int64).reshape(len(longest), dims)
    sent = spark.sparkContext.broadcast((seed_ids, seeds))

    def floors(ids: np.ndarray, v: np.ndarray) -> np.ndarray:
        seed_ids, seeds = sent.value
        found = []
        for i in range(0, len(ids), STEP):
            scores = products(v[i : i + STEP], seeds).astype(np.float64)
            scores[ids[i : i + STEP, None] == seed_ids[None, :]] = -np.inf
            found.append(kth_best(scores, k))
        return np.concatenate(found)

    most = max(1, TILE_BYTES // (8 + dims * kind.itemsize))
    rows = min(most, max(STEP, -(-counted["n"] // LEAST_TILES)))
    # Partitions are of uneven size; half a tile more avoids small ones.
    by_length = candidates.repartitionByRange(max(1, -(-counted["n"] // rows)), F.desc("squared"), "vec_id")
    c_tiles = tiles(by_length.sortWithinPartitions(F.desc("squared"), "vec_id"), rows + rows // 2, dims, kind)
    q_tiles = tiles(asked.coalesce(max(1, -(-q_counted["n"] // most))), most + most // 2, dims, kind, floors)

    # One short row a tile on the broadcast sides; tiles that cannot matter to each other never meet.
    def near(longest: str, needs: str) -> Column:
        return F.col(longest) * (1 + 1e-9) + 1e-6 >= F.col(needs)

    c_index = c_tiles.select(F.col("tile").alias("c_tile"), F.col("longest").alias("c_longest"))
    q_index = q_tiles.select(F.col("tile").alias("q_tile"), F.col("needs").alias("q_needs"))
    q_side = q_tiles.join(F.broadcast(c_index), near("c_longest", "needs")).select(
        "c_tile", F.col("tile").alias("q_tile"), *[F.col(x).alias(x) for x in ("ids", "v", "floors")]
    )
    c_side = c_tiles.join(F.broadcast(q_index), near("longest", "q_needs")).select(
        F.col("tile").alias("c_tile"), "q_tile", *[F.col(x).alias(x) for x in ("ids", "v")]
    )

    def meet(q_rows: pa.Table, c_rows: pa.Table) -> pa.Table:
        def packed(rows: pa.Table, name: str, kind: np.dtype | type) -> np.ndarray:
            return np.frombuffer(rows.column(name)[0].as_buffer(), kind)

        if not (q_rows.num_rows and c_rows.num_rows):
            found = (np.zeros(0, np.int64),) * 3
        else:
            q_ids, c_ids = packed(q_rows, "ids", np.int64), packed(c_rows, "ids", np.int64)
            q, c = (packed(r, "v", kind).reshape(len(i), dims) for r, i in ((q_rows, q_ids), (c_rows, c_ids)))
            found = best_of_tile(q_ids, q, packed(q_rows, "floors", np.float64), c_ids, c, turn, k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found)))

    pair = ("c_tile", "q_tile")
    met = q_side.groupBy(*pair).cogroup(c_side.groupBy(*pair)).applyInArrow(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
