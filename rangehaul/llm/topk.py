"""Exact top-k search by inner product over a pivot-distance index.

Vectors are keyed by nearest pivot and ring of distance to it, and packed in blocks sorted by that distance; a full ring
is dealt over several blocks. Pivots grow with the square root of the table. By the triangle inequality a row x with distance d to its
pivot is at least |d(q) - d| away from a query q, so its inner product is at most (|q|^2 + |x|^2 - (d(q) - d)^2) / 2, and never over |q||x|.

Each block of neighbouring queries sorts the rings by this bound and meets them in rounds of growing size, from its nearest rings outward.
After each round the k-th score so far is a query's floor; a ring, and in a block each row, is only met while its bound reaches some floor,
and a block of queries stops when no ring's does. Bounds are floating and widened a little, scores are exact integers. Pivots and
rings are fitted on a bounded sample (`SAMPLE` rows by hash of the id); they decide the speed only, every row is indexed and none is left out.
On vectors without clusters no bound prunes, and all pairs are scored behind the index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rangehaul.llm.store import written

K = 5
# Within these limits of pivots there are as many rings as the root of the number of rows; queries are grouped by the fewest pivots.
PIVOTS, MOST_PIVOTS, RINGS, SAMPLE = 16, 512, 4, 4096
# Rings a block of queries meets in the first round, and how much wider each next round is.
FIRST, WIDER = 1, 4
BLOCK_ROWS, QUERY_ROWS = 2048, 256
SLACK = 1e-6
LEAST = -(1 << 63)

_BLOCK = "dim int, pivot int, ring int, salt int, ids binary, distances binary, rows binary"


def quantized(vectors: DataFrame, id_column: str, vector_column: str, scale: int = 256) -> DataFrame:
    """`vec_id`, `v`: floor(scale * x) of each component; vectors that are null or hold null or non-finite values are left out."""
    x = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL")
    sound = F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return x.where(sound).select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _matrix(rows: list[list[int]]) -> np.ndarray:
    return np.array(rows, np.int64).reshape(len(rows), -1)


def _fit(sample: list[tuple[int, list[int]]], count: int = PIVOTS) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pivots (means of a few rounds of nearest-pivot groups), ring edges and groups of neighbouring pivots, for each vector length in the sample."""
    by_size: dict[int, list[list[int]]] = {}
    for _, v in sample:
        by_size.setdefault(len(v), []).append(v)
    fitted = {}
    for size, rows in by_size.items():
        x = _matrix(rows).astype(float)
        pivots = np.unique(x[:count], axis=0)
        for _ in range(5):
            nearest = _distances(x, pivots).argmin(1)
            pivots = np.stack([x[nearest == p].mean(0) if (nearest == p).any() else pivots[p] for p in range(len(pivots))])
        fitted[size] = pivots, np.quantile(_distances(x, pivots).min(1), np.arange(1, RINGS) / RINGS), _distances(pivots, pivots[:PIVOTS]).argmin(1)
    return fitted


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], 1)


def _keyed(fitted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("v").to_pylist()
            sizes = np.array([len(v) for v in rows])
            pivot, ring, distance = np.full(len(rows), -1), np.zeros(len(rows), np.int64), np.zeros(len(rows))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                if int(size) in fitted and size:
                    pivots, edges, _ = fitted[int(size)]
                    d = _distances(_matrix([rows[i] for i in at]).astype(float), pivots)
                    pivot[at], distance[at] = d.argmin(1), d.min(1)
                    ring[at] = np.searchsorted(edges, distance[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(sizes, pa.int32()), pa.array(pivot, pa.int32()), pa.array(ring, pa.int32()), pa.array(distance), pa.array([np.array(v, np.int64).tobytes() for v in rows], pa.binary())],
                names=["vec_id", "dim", "pivot", "ring", "distance", "row"],
            )

    return run


def _packed(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("distance").to_numpy(), kind="stable")
    own = {n: [table.column(n)[0].as_py()] for n in ("dim", "pivot", "ring", "salt")}
    rows = table.column("row").to_pylist()
    own |= {"ids": [table.column("vec_id").to_numpy()[order].tobytes()], "distances": [table.column("distance").to_numpy()[order].tobytes()], "rows": [b"".join(rows[i] for i in order)]}
    return pa.table({n: pa.array(v, pa.binary() if n in ("ids", "distances", "rows") else pa.int32()) for n, v in own.items()})


def _blocks(keyed: DataFrame, rows: int) -> DataFrame:
    """Rows of one key in blocks of about `rows`; the counts by key are few, by the limits on pivots and rings, and broadcast."""
    key = ["dim", "pivot", "ring"]
    counts = keyed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("salts"))
    dealt = keyed.join(F.broadcast(counts), key).withColumn("salt", F.pmod(F.xxhash64("vec_id"), "salts").cast("int"))
    return dealt.groupBy(*key, "salt").applyInArrow(_packed, _BLOCK)


def _read(ids: bytes, distances: bytes, rows: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(distances), np.frombuffer(rows, np.int64).reshape(len(own), size)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products; by floating products where these cannot be rounded, by whole numbers of any length where 64 bits may not do."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    wide = a.astype(object) @ b.T.astype(object)
    if any(not -(2**63) < x < 2**63 for x in wide.flat):
        raise OverflowError("an inner product does not fit 64 bits")
    return wide.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k best rows: highest score, then smallest id; never the query's own."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        floor = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= floor]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _upper(q2: np.ndarray, x2: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Greatest inner product of each query with a row of squared length `x2` (or less) at least `gap` away."""
    whole = q2[:, None] + x2[None, :]
    return np.minimum((whole - gap**2) / 2, np.sqrt(q2[:, None] * x2[None, :])) + SLACK * whole + 1


def _squares(rows: np.ndarray) -> np.ndarray:
    return (rows.astype(float) ** 2).sum(1)


_STATE = ["block", "dim", "ids", "rows", "best"]
_STATES = "block long, dim int, ids binary, rows binary, best binary"


def _best_of(best: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids (queries x k) found so far; missing ones have the score `LEAST`."""
    return tuple(np.frombuffer(best, np.int64).reshape(2, -1, k))


def _visits(k: int, fitted, rings: dict[int, np.ndarray], first: int, beyond: int):
    """Pairs of query block and index block: rings number `first` to `beyond` in a query block's own order that still reach a floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q in batch.to_pylist():
                ids = np.frombuffer(q["ids"], np.int64)
                rows = np.frombuffer(q["rows"], np.int64).reshape(len(ids), q["dim"])
                if q["dim"] not in rings:
                    continue
                pivot, ring, salts, low, high, longest = rings[q["dim"]].T
                place = pivot.astype(np.int64)
                to = _distances(rows.astype(float), fitted[q["dim"]][0])[:, place] if place.min() >= 0 else np.zeros((len(ids), len(place)))
                upper = _upper(_squares(rows), longest, np.maximum(np.maximum(low - to, to - high), 0))
                floors = _best_of(q["best"], k)[0][:, -1]
                # The order does not depend on what was found, so that each ring has its round.
                turn = np.argsort(-upper.max(0), kind="stable")[first:beyond]
                turn = turn[(upper[:, turn] >= floors[:, None]).any(0)]
                for r in turn:
                    pairs = int(salts[r])
                    same = lambda value, kind: pa.array([value] * pairs, kind)
                    yield pa.RecordBatch.from_arrays(
                        [same(q["block"], pa.int64()), same(q["dim"], pa.int32()), same(int(pivot[r]), pa.int32()), same(int(ring[r]), pa.int32()), pa.array(range(pairs), pa.int32()),
                         same(q["ids"], pa.binary()), same(q["rows"], pa.binary()), same(floors.tobytes(), pa.binary()), same(np.ascontiguousarray(to[:, r]).tobytes(), pa.binary())],
                        names=["block", "dim", "pivot", "ring", "salt", "query_ids", "query_rows", "floors", "query_distances"],
                    )

    return run


def _searched(k: int):
    """The k best rows of an index block for each query; a row without `vec_id` says how many pairs were scored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                q = batch.slice(at, 1).to_pylist()[0]
                ids, distances, values = _read(q["ids"], q["distances"], q["rows"], q["dim"])
                own, to, rows = _read(q["query_ids"], q["query_distances"], q["query_rows"], q["dim"])
                floors = np.frombuffer(q["floors"], np.int64)
                reached = _upper(_squares(rows), _squares(values), np.abs(to[:, None] - distances[None, :])) >= floors[:, None]
                met = np.flatnonzero(reached.any(0))
                out = [(np.full(1, -1), np.full(1, -1), np.array([int(reached.sum())]))]
                scores = _scores(rows, values[met]) if len(met) else None
                for i in np.flatnonzero(reached.any(1)):
                    mine = np.flatnonzero(reached[i, met])
                    best = mine[_best(scores[i, mine], ids[met[mine]], own[i], k)]
                    best = best[scores[i, best] >= floors[i]]
                    out.append((np.full(len(best), own[i]), ids[met[best]], scores[i, best]))
                query, found, score = (np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))
                mark = pa.array(np.arange(len(found)) == 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), q["block"]), pa.int64()), pa.array(query), pa.array(found), pa.array(score), mark], names=["block", "query_id", "vec_id", "score", "mark"])

    return run


def _merged(k: int):
    """A block's best rows with those of a round."""

    def run(state: pa.Table, found: pa.Table) -> pa.Table:
        if not state.num_rows or not found.num_rows:
            return state.select(_STATE)
        ids = np.frombuffer(state.column("ids")[0].as_py(), np.int64)
        scores, others = _best_of(state.column("best")[0].as_py(), k)
        order = np.argsort(ids)
        place = order[np.searchsorted(ids[order], found.column("query_id").to_numpy())]
        row = np.concatenate((np.repeat(np.arange(len(ids)), k), place))
        score = np.concatenate((scores.ravel(), found.column("score").to_numpy()))
        other = np.concatenate((others.ravel(), found.column("vec_id").to_numpy()))
        # Highest score first (the complement, as a negative could overflow), then smallest id.
        by = np.lexsort((other, ~score, row))
        starts = np.searchsorted(row[by], np.arange(len(ids)))
        chosen = by[starts[:, None] + np.arange(k)]
        best = np.stack((score[chosen], other[chosen])).astype(np.int64)
        return pa.table({**{c: state.column(c) for c in _STATE[:-1]}, "best": pa.array([best.tobytes()], pa.binary())})

    return run


def _ranks(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q in batch.to_pylist():
                scores, others = _best_of(q["best"], k)
                row, rank = np.nonzero(scores > LEAST)
                ids = np.frombuffer(q["ids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array((rank + 1).astype(np.int32)), pa.array(others[row, rank]), pa.array(scores[row, rank])], names=["query_id", "rank", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scored: list | None = None) -> DataFrame:
    """The `k` rows of `vectors` with the highest inner product for each row of `queries`: `query_id`, `rank`, `vec_id`, `score`.

    Both have `vec_id` and `v` (array<long>), as `quantized` gives them. Rows with the query's own id and rows of another length
    are no candidates; ties go to the smaller id, repeated rows count as often as they occur, and of query rows with
    the same id the least vector is taken. Fewer candidates give fewer ranks; empty tables give none. A score beyond 64 bits is an error.
    `scored` receives, per round, how many pairs of query and row were scored.
    """
    spark = vectors.sparkSession
    pivots = max(PIVOTS, min(MOST_PIVOTS, math.isqrt(vectors.count()) // RINGS))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    fitted = _fit([(r["vec_id"], r["v"]) for r in sample], pivots)
    keyed = lambda frame: frame.mapInArrow(_keyed(fitted), "vec_id long, dim int, pivot int, ring int, distance double, row binary")
    index = written(_blocks(keyed(vectors), BLOCK_ROWS), "index")

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["dim"], r["pivot"], r["ring"], r["salt"] + 1, _read(r["ids"], r["distances"], r["rows"], r["dim"])) for r in batch.to_pylist()]
            kinds = [*[(i, pa.int32()) for i in range(4)]]
            values = [[d.min() for *_, (_, d, _) in rows], [d.max() for *_, (_, d, _) in rows], [_squares(v).max() for *_, (_, _, v) in rows]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in kinds] + [pa.array(v, pa.float64()) for v in values], names=["dim", "pivot", "ring", "salts", "low", "high", "longest"])

    extents = index.mapInArrow(extent, "dim int, pivot int, ring int, salts int, low double, high double, longest double")
    # One small row per ring: pivots and rings have limits.
    extents = extents.groupBy("dim", "pivot", "ring").agg(F.max("salts"), F.min("low"), F.max("high"), F.max("longest")).orderBy("dim", "pivot", "ring").collect()
    rings = {dim: np.array([tuple(r)[1:] for r in extents if r["dim"] == dim], float) for dim in {r["dim"] for r in extents}}
    most = max((len(r) for r in rings.values()), default=0)

    # Queries of neighbouring pivots share a block, so that its rings are near for all of them.
    near = F.lit(-1)
    for dim, (_, _, groups) in sorted(fitted.items()):
        near = F.when((F.col("dim") == dim) & (F.col("pivot") >= 0), F.get(F.lit(groups.tolist()), F.col("pivot"))).otherwise(near)
    asked = keyed(queries.groupBy("vec_id").agg(F.min("v").alias("v"))).withColumns({"pivot": near.cast("int"), "ring": F.lit(0)})
    blocks = _blocks(asked, QUERY_ROWS).withColumn("block", F.monotonically_increasing_id())
    none = np.array([LEAST, 0], np.int64)
    unknown = F.concat(*[F.repeat(F.hex(F.lit(bytearray(x.tobytes()))), (F.length("ids") / 8 * k).cast("int")) for x in none])
    state = written(blocks.select("block", "dim", "ids", "rows", F.unhex(unknown).alias("best")), "queries")
    first, width = 0, FIRST
    while first < most:
        # Each block is a row of its own size, so that they spread over tasks by number.
        spread = state.repartition(max(1, min(state.count(), 4 * spark.sparkContext.defaultParallelism)), "block")
        # Queries grow when they are dealt to index blocks, which Spark's estimate does not see: sorted, never broadcast.
        visits = spread.mapInArrow(_visits(k, fitted, rings, first, first + width), "block long, dim int, pivot int, ring int, salt int, query_ids binary, query_rows binary, floors binary, query_distances binary")
        found = written(visits.join(index.hint("merge"), ["dim", "pivot", "ring", "salt"]).mapInArrow(_searched(k), "block long, query_id long, vec_id long, score long, mark boolean"), "found")
        if scored is not None:
            scored.append(found.where("mark").agg(F.coalesce(F.sum("score"), F.lit(0))).first()[0])
        rank = F.row_number().over(Window.partitionBy("block", "query_id").orderBy(F.desc("score"), "vec_id"))
        best = found.where("NOT mark").withColumn("rank", rank).where(F.col("rank") <= k).select("block", "query_id", "vec_id", "score")
        state = written(state.groupBy("block").cogroup(best.groupBy("block")).applyInArrow(_merged(k), _STATES), "queries")
        first, width = first + width, width * WIDER
    return state.mapInArrow(_ranks(k), "query_id long, rank int, vec_id long, score long")
