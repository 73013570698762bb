"""Near-duplicate documents: b-bit MinHash signatures, band candidates, exact links, components.

1. Every document becomes its set of distinct 5-word shingles (64-bit hashes). Equal sets are one class: copies
   cost one row in a grouped aggregation and nothing afterwards.
2. 128 minima give 32 band keys of four; the low four bits of each minimum are packed into 64 bytes. Two
   signatures agree by chance in 1/16 of the places, so similarity is (agreeing - 1/16) / (1 - 1/16), counted by
   bits. Pairs estimated under `CUT` (over four deviations below the threshold) are not looked at further.
   Band candidates find a pair of similarity 0.75 but for 5 in a million.
3. A bucket links its members to its smallest class only: a row per member, never all pairs. Links are
   confirmed on whole sets and joined to components.
4. Buckets that still hold several components are compared block by block inside tasks, with sets and a
   union-find at hand: a task gives out only links that join two components. So no link is lost where a member is
   unlike the bucket's smallest, and no pair list grows with the square of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rangehaul.llm.arrays import heads, mix, randoms, same_row, text_chunks, windows, words
from rangehaul.llm.store import written

SHINGLE = 5
THRESHOLD = 75  # per cent of the union
PERMUTATIONS, BANDS, BITS = 128, 32, 4
CUT = 0.58
# Members of a bucket that meet in one task; more are dealt over pairs of blocks.
BLOCK = 512

_X = (randoms(11, PERMUTATIONS) | np.uint64(1)).astype(np.uint32)
_Y = (randoms(12, PERMUTATIONS) | np.uint64(1)).astype(np.uint32)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk: its first row, list offsets of its rows, and their distinct shingles in order."""
    for chunk in text_chunks(column):
        found = words(chunk, lower=True)
        count = chunk.high - chunk.low
        sizes = np.bincount(found.row, minlength=count)
        ok = same_row(found.row, SHINGLE)
        row, hashes = found.row[: len(ok)][ok], windows(found.first, SHINGLE, 9)[ok]
        # Fewer words than a shingle: the whole sequence is the one element.
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1])) if count else sizes
        short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
        if len(short):
            total = sizes[short].astype(np.uint64) << np.uint64(32)
            for j, factor in enumerate(randoms(10, SHINGLE - 1) | np.uint64(1)):
                has = sizes[short] > j
                total[has] += found.first[begins[short[has]] + j] * factor
            at = np.searchsorted(row, short)
            row, hashes = np.insert(row, at, short), np.insert(hashes, at, mix(total))
        bounds = np.searchsorted(row, np.arange(count + 1))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            hashes[low:high].sort()
        keep = heads(row, hashes) if len(row) else np.zeros(0, bool)
        yield chunk.low, np.searchsorted(row[keep], np.arange(count + 1)), hashes[keep]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, offsets, shingles in shingle_sets(batch.column("text")):
            sizes = np.diff(offsets)
            full = np.flatnonzero(sizes)
            starts = offsets[:-1][full]
            minima = np.zeros((PERMUTATIONS, len(full)), np.uint32)
            digest = np.zeros((len(full), 2), np.uint64)
            if len(full):
                x, y = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
                for p in range(PERMUTATIONS):
                    np.minimum.reduceat(x * _X[p] + y * _Y[p], starts, out=minima[p])
                for k in range(2):
                    digest[:, k] = np.add.reduceat(mix(shingles + randoms(13, 2)[k]), starts)
            pairs = minima.T.reshape(len(full), PERMUTATIONS // 2, 2).astype(np.uint64)
            pairs = mix(pairs[:, :, 0] | pairs[:, :, 1] << np.uint64(32))
            keys = mix(pairs[:, ::2] + np.uint64(3) * pairs[:, 1::2] + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)
            low_bits = (minima.T & 15).astype(np.uint8)
            packed = low_bits[:, ::2] | low_bits[:, 1::2] << 4
            count = len(sizes)
            at = np.full(count, -1)
            at[full] = np.arange(len(full))
            empty = at < 0
            take = pa.array(np.maximum(at, 0), mask=empty)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, count).cast(pa.int64()),
                    batch.column("text_hash").slice(low, count),
                    pa.array(sizes.astype(np.int64)),
                    pa.array([d.tobytes() for d in digest], pa.binary()).take(take) if len(full) else pa.nulls(count, pa.binary()),
                    pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), BANDS).cast(pa.list_(pa.int64())).take(take) if len(full) else pa.nulls(count, pa.list_(pa.int64())),
                    pa.array([p.tobytes() for p in packed], pa.binary()).take(take) if len(full) else pa.nulls(count, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "digest", "bands", "signature"],
            )


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Corrected similarity of packed signatures (rows of 8 long words each; shapes broadcast)."""
    differ = a ^ b
    differ |= differ >> np.uint64(2)
    differ |= differ >> np.uint64(1)
    differ &= np.uint64(0x1111111111111111)
    same = 1 - np.bitwise_count(differ).sum(-1, dtype=np.int64) / PERMUTATIONS
    return (same - 2.0**-BITS) / (1 - 2.0**-BITS)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, PERMUTATIONS * BITS // 64)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keep = agreeing(_matrix(batch.column("signature_a")), _matrix(batch.column("signature_b"))) >= CUT
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact test on two sorted sets."""
    if 100 * min(len(a), len(b)) < THRESHOLD * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= THRESHOLD * (len(a) + len(b) - both)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array([linked(a, b) for a, b in sets], pa.bool_()))


_GROUP = ["band", "key", "low_block", "high_block"]


def _block_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block pair that lie in different components, look alike, and meet in no earlier band."""
    part, component = table.column("block").to_numpy(), table.column("component").to_numpy()
    low, high = table.column("low_block")[0].as_py(), table.column("high_block")[0].as_py()
    left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
    signatures = _matrix(table.column("signature"))
    bands = np.stack(table.column("bands").to_numpy())
    band = table.column("band")[0].as_py()
    found = []
    for i in left:
        with_ = right[right > i] if low == high else right
        with_ = with_[component[with_] != component[i]]
        with_ = with_[agreeing(signatures[with_], signatures[i]) >= CUT]
        if band:
            with_ = with_[~(bands[with_, :band] == bands[i, :band]).any(1)]
        found.append(np.stack((np.full(len(with_), i), with_)))
    both = np.concatenate(found, 1) if found else np.zeros((2, 0), np.int64)
    return both[0], both[1]


def _active(table: pa.Table) -> pa.Table:
    a, b = _block_pairs(table)
    return table.take(np.unique(np.concatenate((a, b))).astype(np.int64)).select([*_GROUP, "node"])


def _joined(table: pa.Table) -> pa.Table:
    node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    root = {int(c): int(c) for c in component}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    for i, j in zip(*_block_pairs(table), strict=True):
        x, y = find(int(component[i])), find(int(component[j]))
        if x != y and linked(sets[i], sets[j]):
            root[max(x, y)] = min(x, y)
            out.append((int(node[i]), int(node[j])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable, for every node of `links` (a, b): labels spread over links, then jump over labels.

    Each round is a written table; only the number of changed labels comes to the driver.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("seen"))
        new = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "seen").alias("new"))
        over = labels.select(F.col("node").alias("new"), F.col("component").alias("jumped"))
        spread = written(new.join(over, "new").select("node", "old", F.least("new", "jumped").alias("component")), "labels")
        labels = spread.select("node", "component")
        if spread.where("component <> old").isEmpty():
            return labels


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `documents`: `doc_id`, `text_hash` (xxhash64 of the text), `n_shingles`, `component_id`, `kept`.

    Words are split at ASCII white space after A-Z became a-z. Documents whose sets share 75 % or more of their
    union are linked; `component_id` is the smallest id reachable over links.

    - no words or null text: no shingles, linked with nothing; fewer than five words: one shingle, the whole text;
    - null id: no component (null), kept; equal rows get equal results; rows of one id and different
      texts are told apart, each with the component of its own text;
    - an empty table gives an empty result; other columns are ignored.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    signed = written(rows.mapInArrow(_signed, "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>, signature binary"), "signatures")
    known = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    lows = known.groupBy("digest").agg(F.min("doc_id").alias("low"))
    classes = known.join(lows.withColumnRenamed("low", "doc_id"), ["digest", "doc_id"], "semi").dropDuplicates(["digest"])
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    banded = classes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("members")).where("members > 1")
    # Members of buckets with company; everything after works on them alone.
    buckets = written(banded.join(shared, ["band", "key"]), "buckets")
    signatures = classes.select("node", "signature")
    pairs = buckets.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    pairs = pairs.join(signatures.toDF("a", "signature_a"), "a").join(signatures.toDF("b", "signature_b"), "b")
    likely = written(pairs.mapInArrow(_likely, "a long, b long"), "pairs")

    def sets_of(nodes: DataFrame) -> DataFrame:
        wanted = classes.join(nodes, "node", "semi").select("node", "digest", "doc_id")
        return rows.join(wanted, "doc_id").select("node", "digest", "text").mapInArrow(_sets, "node long, digest binary, found binary, shingles binary").where("digest = found").dropDuplicates(["node"]).select("node", "shingles")

    def confirmed(candidates: DataFrame, sets: DataFrame) -> DataFrame:
        with_sets = candidates.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        return with_sets.mapInArrow(_confirmed, "a long, b long")

    ends = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    links = written(confirmed(likely, written(sets_of(ends), "sets")), "links")
    labels = components(links)

    # Buckets that still hold several components.
    component = F.coalesce("component", "node").alias("component")
    labelled = buckets.join(labels, "node", "left").select("band", "key", "node", "center", component)
    centers = labels.toDF("center", "core")
    cored = labelled.join(centers, "center", "left").withColumn("core", F.coalesce("core", "center"))
    other = F.col("component") != F.col("core")
    blocks = lambda condition: F.ceil(F.count_if(condition) / BLOCK).cast("int")
    split = cored.groupBy("band", "key").agg(blocks(~other).alias("cores"), blocks(other).alias("others")).where("others > 0")
    # Blocks of the center's component come first; they meet those of the others, and these each other, but never themselves.
    rest = cored.join(split, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("node"), F.when(other, F.col("others")).otherwise(F.col("cores"))).cast("int"))
    rest = rest.withColumn("block", F.when(other, F.col("block") + F.col("cores")).otherwise(F.col("block")))
    first, last = F.when(other, 0).otherwise(F.col("cores")), F.col("cores") + F.col("others") - 1
    rest = rest.withColumn("other", F.explode(F.sequence(first, last)))
    rest = rest.select("band", "key", "node", "component", "block", F.least("block", "other").alias("low_block"), F.greatest("block", "other").alias("high_block"))
    members = rest.join(classes.select("node", "signature", "bands"), "node")
    active = written(members.groupBy(*_GROUP).applyInArrow(_active, "band int, key long, low_block int, high_block int, node long"), "active")
    if not active.isEmpty():
        again = written(sets_of(active.select("node").distinct()), "sets")
        met = members.join(active, [*_GROUP, "node"], "semi").join(again, "node")
        more = met.groupBy(*_GROUP).applyInArrow(_joined, "a long, b long")
        labels = components(links.union(more))

    ids = classes.select("node", "digest", "doc_id").join(labels, "node", "left").withColumn("component", component)
    least = ids.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of = ids.join(least, "component").select("digest", F.col("component_id").alias("found"))
    out = signed.select("doc_id", "text_hash", "n_shingles", "digest").join(of, "digest", "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", found.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, offsets, shingles in shingle_sets(batch.column("text")):
            found, sets = [], []
            for begin, end in zip(offsets[:-1], offsets[1:], strict=True):
                own = shingles[begin:end]
                found.append(b"".join(np.add.reduce(mix(own + c), keepdims=True).tobytes() for c in randoms(13, 2)))
                sets.append(own.tobytes())
            count = len(offsets) - 1
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(low, count), batch.column("digest").slice(low, count), pa.array(found, pa.binary()), pa.array(sets, pa.binary())], names=["node", "digest", "found", "shingles"])
