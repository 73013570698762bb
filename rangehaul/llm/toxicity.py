"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its posterior labels.

1. Lexicon: all words and word beginnings that are significantly more frequent in toxic rows of a bounded, hash-ordered
   sample of labelled rows (`SAMPLE_ROWS`; rows held out are never in it). One grouped aggregation counts each in toxic and
   clean rows and tests it; no list is cut by frequency or length.
2. Voters: lexicon entries chosen so that together they cover the toxic rows three times, patterns (shouting,
   exclamation marks, repeated words), and one that votes "clean" where no entry occurs.
3. Label model: expectation maximisation for the voters' accuracies in each class, started from the vote, not from
   labels; correlations of voters inside the classes then discount voters that say the same thing.
4. Classifier: logistic regression over all lexicon entries and patterns, fitted to the posterior labels; its scale is
   set on the sample's labels. It scores every whole text in one pass, without a shuffle.

Only the lexicon and the sample's entry numbers, packed, come to the driver; both are bounded by the sample.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rangehaul.llm.arrays import LOWER, Chunk, Polynomial, heads, mix, same_row, text_chunks, windows, word_bounds
from rangehaul.llm.store import written

SAMPLE_ROWS = 20_000
SUPPORT = 3  # toxic rows that an entry needs
PURITY = 0.7  # share of toxic rows among those with an entry
BEGINNINGS = (4, 5, 6)  # bytes
THRESHOLD = 0.7
PATTERNS = 3

# Everything in ASCII but digits and letters parts words; other bytes belong to letters.
BREAKS = np.ones(256, bool)
BREAKS[128:] = False
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False

_WORD, _BEGINNING = Polynomial(31), Polynomial(32)


def _features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of each word and word beginning, and the pattern values of each row."""
    row, starts, ends = word_bounds(chunk, BREAKS)
    data = LOWER[chunk.data]
    count = chunk.high - chunk.low
    whole = _WORD.ranges(data, starts, ends)
    rows, hashes = [row], [whole]
    for size in BEGINNINGS:
        long = np.flatnonzero(ends - starts > size)
        rows.append(row[long])
        hashes.append(mix(_BEGINNING.ranges(data, starts[long], starts[long] + size) + np.uint64(size)))
    sizes = np.maximum(1, np.diff(chunk.offsets))
    share = lambda mask: np.add.reduceat(np.append(mask, 0).astype(np.float64), chunk.offsets[:-1]) * (np.diff(chunk.offsets) > 0) / sizes
    upper = share((chunk.data >= 65) & (chunk.data <= 90))
    calls = share(chunk.data == 33)
    total = np.bincount(row, minlength=count)
    again = np.zeros(len(row), bool)
    again[1:] = (whole[1:] == whole[:-1]) & (row[1:] == row[:-1])
    repeats = np.bincount(row[again], minlength=count) / np.maximum(1, total)
    return np.concatenate(rows), np.concatenate(hashes), np.stack((upper, calls, repeats), 1)


class Lookup:
    """Number of each known hash; a bit table sorts out most of the unknown ones."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, number) pairs in order."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        place = np.searchsorted(self.sorted, hashes[at])
        known = place < len(self.sorted)
        known[known] = self.sorted[place[known]] == hashes[at[known]]
        pair = np.unique(rows[at[known]].astype(np.int64) << 32 | self.order[place[known]])
        return pair >> 32, pair & 0xFFFFFFFF


class Model(NamedTuple):
    hashes: np.ndarray
    weights: np.ndarray
    pattern_weights: np.ndarray
    bias: float
    voters: list[dict[str, float]]

    def scores(self, row: np.ndarray, number: np.ndarray, patterns: np.ndarray) -> np.ndarray:
        z = self.bias + patterns @ self.pattern_weights + np.bincount(row, self.weights[number], len(patterns))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(id_column) -> F.Column:
    """Whether a row is kept away from learning: crc32 of the id as text leaves 1 modulo 3; a null id is held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """`toxic`, `text` of the first labelled rows by hash, not held out. At most `rows` ids are broadcast."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    some = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return documents.join(F.broadcast(some), "doc_id").select("toxic", "text")


def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the least hash of three words in a row, which copies and most near copies share."""
    for batch in batches:
        keys = []
        for chunk in text_chunks(batch.column("text")):
            row, starts, ends = word_bounds(chunk, BREAKS)
            hashes = _WORD.ranges(LOWER[chunk.data], starts, ends)
            three = windows(np.append(hashes, np.zeros(2, np.uint64)), 3, 33)
            # A run that reaches into the next text counts for neither, but for texts that are too short.
            inside = np.append(same_row(row, 3), np.zeros(len(row) - max(0, len(row) - 2), bool))
            count = chunk.high - chunk.low
            inside |= np.bincount(row, minlength=count)[row] < 3
            least = np.zeros(count, np.uint64)
            head = np.flatnonzero(heads(row[inside])) if inside.any() else np.zeros(0, np.int64)
            if len(head):
                least[row[inside][head]] = np.minimum.reduceat(three[inside], head)
            keys.append(least.view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("text"), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))], names=["toxic", "text", "key"])


def _row_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each hash of a row once, with the row's label."""
    for batch in batches:
        toxic = np.asarray(batch.column("toxic"))
        for chunk in text_chunks(batch.column("text")):
            row, hashes, _ = _features(chunk)
            order = np.lexsort((hashes, row))
            row, hashes = row[order], hashes[order]
            first = heads(row, hashes)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[first].view(np.int64)), pa.array(toxic[chunk.low + row[first]].astype(np.int32))], names=["hash", "toxic"])


def _lexicon(sample: DataFrame) -> np.ndarray:
    """Hashes that tell toxic rows, surest first, ties by hash: tested where they are counted, so that only what passes leaves the tasks."""
    size = sample.agg(F.count(F.lit(1)).alias("rows"), F.sum("toxic").alias("toxic")).first()
    if not size["toxic"] or size["toxic"] == size["rows"]:
        return np.zeros(0, np.uint64)
    share = size["toxic"] / size["rows"]
    counted = sample.mapInArrow(_row_hashes, "hash long, toxic int").groupBy("hash").agg(F.count(F.lit(1)).alias("hits"), F.sum("toxic").alias("bad"))
    counted = written(counted.where("bad > 0"), "toxic-hashes")
    tried = counted.count()
    # Log likelihood ratio against the sample's share; over log(number of hashes tried) less than one entry is there by chance.
    p = F.col("bad") / F.col("hits")
    good = F.col("hits") - F.col("bad")
    ratio = F.col("bad") * F.log(p / share) + F.when(good > 0, good * F.log((1 - p) / (1 - share))).otherwise(0.0)
    able = counted.withColumn("ratio", F.round(ratio, 9)).where((F.col("bad") >= SUPPORT) & (F.col("ratio") > float(np.log(max(2, tried)))) & (p > PURITY))
    return np.array([r["hash"] for r in able.orderBy(F.desc("ratio"), "hash").select("hash").collect()], np.int64).view(np.uint64)


def _hit_lists(lookup: Lookup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                row, hashes, patterns = _features(chunk)
                row, number = lookup.hits(row, hashes)
                bounds = np.searchsorted(row, np.arange(chunk.high - chunk.low + 1))
                packed = [number[a:b].astype(np.int32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(chunk.low, chunk.high - chunk.low), pa.array(packed, pa.binary()), pa.array([p.tobytes() for p in patterns], pa.binary())], names=["toxic", "hits", "patterns"])

    return run


def label_model(votes: np.ndarray, prior: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1, and per voter: vote rates in class 1 and 0, and discount for correlated voters.

    `votes` holds 1 (toxic), -1 (clean) and 0 (no vote). A voter has one side only, so what is estimated is how
    often it votes in either class; a silent voter tells something as well.
    """
    cast = votes != 0
    side = np.where((votes < 0).any(0), -1, 1)
    posterior = np.clip(0.5 + 0.4 * np.sign(votes.sum(1)), prior, 0.9)
    weight = np.ones(votes.shape[1])
    rates = np.zeros((2, votes.shape[1]))
    # Some rows at a time are made numbers: a vote is one byte.
    blocks = [slice(at, at + 1024) for at in range(0, len(votes), 1024)]
    for turn in range(rounds):
        total = np.array([posterior.sum(), (1 - posterior).sum()])
        both = sum(np.stack((posterior[b], 1 - posterior[b])) @ cast[b].astype(np.float64) for b in blocks)
        rates = (both + 0.5) / (total[:, None] + 1)
        # No voter may turn to the other side: better than chance is all that is assumed.
        wrong = np.where(side > 0, rates[0] < rates[1], rates[0] > rates[1])
        rates[:, wrong] = rates[:, wrong].mean(0)
        if turn == 5:
            # Correlation inside the classes, of what the rates do not explain.
            products = np.zeros((votes.shape[1], votes.shape[1]))
            for b in blocks:
                rest = cast[b] - (posterior[b, None] * rates[0] + (1 - posterior[b, None]) * rates[1])
                products += rest.T @ rest
            spread = np.sqrt(np.diag(products) / len(votes)) + 1e-9
            tied = np.abs(products / len(votes) / np.outer(spread, spread))
            tied = np.round(tied, 6)
            tied[tied < 0.1] = 0
            np.fill_diagonal(tied, 1)
            weight = 1 / tied.sum(0)
        told = weight * (np.log(rates[0]) - np.log(rates[1]))
        silent = weight * (np.log1p(-rates[0]) - np.log1p(-rates[1]))
        # A silent voter adds `silent`, one that votes the difference to `told`.
        z = np.log(prior / (1 - prior)) + silent.sum() + np.concatenate([cast[b].astype(np.float64) @ (told - silent) for b in blocks])
        # Rounded, so that the order of sums inside matrix products does not show in the model.
        new = np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 9)
        if np.abs(new - posterior).max() < 1e-6:
            break
        posterior = new
    return posterior, rates[0], rates[1], weight


def _logistic(rows: np.ndarray, numbers: np.ndarray, dense: np.ndarray, target: np.ndarray, width: int, rounds: int = 400) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of sparse entries (rows, numbers) and dense columns for soft targets; L2 penalty, averaged gradient steps."""
    theta = np.zeros(width + dense.shape[1] + 1)
    theta[-1] = np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, rounds + 1):
        z = theta[-1] + dense @ theta[width:-1] + np.bincount(rows, theta[numbers], len(target))
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(target)
        gradient = np.concatenate((np.bincount(numbers, error[rows], width), error @ dense, [error.sum()]))
        gradient[:-1] += 1e-5 * theta[:-1]
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta -= 0.1 * first / (1 - 0.9**turn) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-9)
    return theta[:width], theta[width:-1], float(theta[-1])


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a sample of at most `rows` labelled rows of `documents` (doc_id, text) that are not held out."""
    # One of each group of copies, so that words of a copied text do not pass for a lexicon.
    keyed = _sample(documents, labels, rows).mapInArrow(_with_key, "toxic int, text string, key long")
    sample = written(keyed.groupBy("toxic", "key").agg(F.min("text").alias("text")), "toxic-sample")
    lexicon = _lexicon(sample)
    got = sample.mapInArrow(_hit_lists(Lookup(lexicon)), "toxic int, hits binary, patterns binary").collect()
    got = sorted(got)  # the same rows in any order fit the same model
    toxic = np.array([r["toxic"] for r in got], bool)
    lists = [np.frombuffer(r["hits"], np.int32) for r in got]
    patterns = np.array([np.frombuffer(r["patterns"]) for r in got]).reshape(-1, PATTERNS)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    number = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    share = toxic.mean() if len(toxic) else 0.0
    if not toxic.any() or toxic.all():
        prior = (toxic.sum() + 1) / (len(toxic) + 2) if len(toxic) else 0.01
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(PATTERNS), float(np.log(prior / (1 - prior))), [])

    chosen = _covering(row, number, toxic, len(lexicon))
    votes = np.zeros((len(toxic), len(chosen) + PATTERNS + 1), np.int8)
    place = np.full(len(lexicon), -1)
    place[chosen] = np.arange(len(chosen))
    use = place[number] >= 0
    votes[row[use], place[number[use]]] = 1
    for k, level in enumerate((0.4, 0.02, 0.3)):
        votes[:, len(chosen) + k] = patterns[:, k] > level
    votes[np.bincount(row, minlength=len(toxic)) == 0, -1] = -1
    posterior, in_toxic, in_clean, discount = label_model(votes, float(np.clip(share, 0.01, 0.99)))

    weights, pattern_weights, bias = _logistic(row, number, patterns, posterior, len(lexicon))
    margin = bias + patterns @ pattern_weights + np.bincount(row, weights[number], len(toxic))
    scale, shift = _scaled(margin, toxic)
    voters = [{"toxic_rate": float(a), "clean_rate": float(b), "discount": float(d)} for a, b, d in zip(in_toxic, in_clean, discount, strict=True)]
    return Model(lexicon, np.round(weights * scale, 6), np.round(pattern_weights * scale, 6), round(bias * scale + shift, 6), voters)


def _scaled(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make the margin a probability on the sample's labels (Newton steps, targets a little inside 0 and 1)."""
    target = np.where(toxic, 1 - 1 / (toxic.sum() + 2), 1 / ((~toxic).sum() + 2))
    x = np.stack((margin, np.ones(len(margin))), 1)
    theta = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), x.T @ (p - target) + 1e-2 * (theta - [1, 0]))
        theta = theta - step / max(1.0, 2 * np.abs(step).max())  # steps of 0.5 at most
    return (float(theta[0]), float(theta[1])) if 0.05 < theta[0] < 20 else (1.0, 0.0)


def _covering(row: np.ndarray, number: np.ndarray, toxic: np.ndarray, entries: int) -> np.ndarray:
    """Entries that together cover toxic rows up to three times, best first, until none covers more than it costs.

    What an entry still adds only falls as others are chosen, so an old value bounds it and most entries are not looked at again.
    """
    rows = np.split(row[np.argsort(number, kind="stable")], np.cumsum(np.bincount(number, minlength=entries))[:-1]) if entries else []
    need = np.where(toxic, 3, 0)
    gain = lambda e: int((need[rows[e]] > 0).sum() - 2 * (~toxic[rows[e]]).sum())
    waiting = [(-gain(e), e) for e in range(entries)]
    heapify(waiting)
    chosen: list[int] = []
    while waiting and waiting[0][0] < 0:
        bound, best = heappop(waiting)
        now = -gain(best)
        if now > bound:
            heappush(waiting, (now, best))
            continue
        chosen.append(best)
        need[rows[best]] = np.maximum(0, need[rows[best]] - 1)
    return np.array(chosen, np.int64)


def _scored(model: Model, schema: pa.Schema):
    lookup = Lookup(model.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for chunk in text_chunks(batch.column("text")):
                row, hashes, patterns = _features(chunk)
                parts.append(model.scores(*lookup.hits(row, hashes), patterns))
            own = {"score": pa.array(np.concatenate(parts) if parts else np.zeros(0))}
            yield pa.RecordBatch.from_arrays([own[f.name] if f.name in own else batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    return run


def toxicity(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: Sequence[str] = (), rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Score every row: `doc_id`, `carried` (struct of the columns in `carry`), `text`, `held_out`, `score`, `predicted`.

    `labels` has `doc_id` and `toxic` (0 or 1); of several labels the larger counts, others are ignored. The score depends
    on the text alone.

    - null text is scored like an empty one; equal texts get equal scores;
    - a null id is held out and scored; ids may repeat;
    - without labels of both classes every text gets the score of the labels' share; an empty table gives an empty
      result; columns that are not named are ignored.
    """
    carried = F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]) if carry else F.lit(None).cast("string")
    frame = documents.select(F.col(id_column).cast("long").alias("doc_id"), carried.alias("carried"), F.col(text_column).alias("text"))
    model = fit(frame, labels, rows)
    out = T.StructType([*frame.schema.fields, T.StructField("score", T.DoubleType())])
    scored = frame.mapInArrow(_scored(model, to_arrow_schema(out)), out)
    return scored.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
