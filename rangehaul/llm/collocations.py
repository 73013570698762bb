"""Phrases whose words keep company: stripes of next-word counts, and what follows from them.

A stripe is a prefix of one to four words with a counter for each word that follows it, and one entry for all occurrences that are not
continued (the piece ends, or no frequent phrase can come of it). Tasks count stripes of their texts, and stripes of one prefix are merged
by adding them elementwise. A merged stripe gives all that is asked: its entries are the counts of the extensions, its sum is
the count of the prefix, and its largest entry tells whether an extension stands for the prefix everywhere.

One pass counts words, then one pass for each size of prefix makes the stripes. A phrase is at most as frequent as its parts, so a prefix is
continued only where it and the equally long phrase one word later are frequent: nothing is lost. What is frequent goes
to the tasks as bits of fixed size (see `sketch`: a wrong "yes" costs an entry, never a result).

Stripes meet in slices by prefix. The stripes of a prefix that is so frequent that it would fill a slice are cut by their next word; sums
and maxima of the parts are added up by Spark. Words are known by 64-bit hashes of (language, word), phrases by those of all
their words; a last pass spells the words of the phrases that are left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rangehaul.llm.arrays import LOWER, Polynomial, differences, heads, mix, pack, randoms, text_chunks, unpack, word_bounds
from rangehaul.llm.sketch import Repeated, repeated_filter
from rangehaul.llm.store import total_bytes, written

LEAST = 100
LONGEST = 5
TOP = 2000
NO_LANGUAGE = "und"
# Bytes of text whose entries meet in one slice, words or entries that a task holds, bytes of text hashed at a time.
SLICE_BYTES = 16 << 20
FLUSH = 1 << 20
CHUNK = 1 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_SPACE = _BREAK.copy()
_SPACE[[ord(" "), ord("\t")]] = True
_WORD = Polynomial(41)
_FACTORS = randoms(42, LONGEST) | np.uint64(1)


def _languages(column: pa.Array) -> np.ndarray:
    coded = column.dictionary_encode() if not isinstance(column, pa.DictionaryArray) else column
    values = [int.from_bytes(blake2b(v.encode(), digest_size=8).digest(), "little") for v in coded.dictionary.to_pylist()]
    return np.array(values, np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each chunk: row, start, end and hash of every word, whether the next word follows in its piece, and the lower-cased bytes."""
    language = _languages(batch.column("lang"))
    for chunk in text_chunks(batch.column("text"), CHUNK):
        row, starts, ends = word_bounds(chunk, _SPACE)
        if not len(row):
            continue
        data = LOWER[chunk.data]
        hashes = np.maximum(mix(_WORD.ranges(data, starts, ends) ^ language[row + chunk.low]), np.uint64(1))
        piece = np.cumsum(_BREAK[chunk.data])[starts]
        follows = np.append((piece[1:] == piece[:-1]) & (row[1:] == row[:-1]), False)
        yield row + chunk.low, starts, ends, hashes, follows, data


def _counted(columns: list[np.ndarray], numbers: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows with their number (or the sum of their numbers). Rows meet by a hash of them: a collision may leave equal rows apart, it never joins others."""
    order = np.argsort(_phrase(columns))
    columns = [c[order] for c in columns]
    at = np.flatnonzero(heads(*columns))
    if not len(at):
        return columns, at
    return [c[at] for c in columns], np.diff(np.append(at, len(order))) if numbers is None else np.add.reduceat(numbers[order], at)


def _phrase(columns: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of word hashes; a single word keeps its own."""
    return columns[0] if len(columns) == 1 else mix(sum(c * f for c, f in zip(columns, _FACTORS, strict=False)))


def _cut(of: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Slice, first and behind-last row of each run of one slice."""
    bounds = np.flatnonzero(heads(of))
    return zip(of[bounds].tolist(), bounds.tolist(), np.append(bounds[1:], len(of)).tolist(), strict=True) if len(of) else iter(())


def _slice(key: np.ndarray, slices: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def _word_counts(slices: int):
    """Counts of the words of a task, packed by language and slice."""

    def flush(held: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
        words, codes, count = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        (words, codes), count = _counted([words, codes], count)
        of = codes.astype(np.int64) * slices + _slice(words, slices)
        order = np.lexsort((words, of))
        words, count = words[order], count[order]
        rows = [(k % slices, names[k // slices], int(words[low]).to_bytes(8, "little") + pack(differences(words[low:high]), count[low:high])) for k, low, high in _cut(of[order])]
        kinds = {"slice": pa.int32(), "lang": pa.string(), "counts": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names, waiting = [], {}, 0
        for batch in batches:
            code = np.array([names.setdefault(lang, len(names)) for lang in batch.column("lang").to_pylist()], np.uint64)
            for row, _, _, hashes, _, _ in _texts(batch):
                (words, codes), count = _counted([hashes, code[row]])
                held.append((words, codes, count))
                waiting += len(words)
                if waiting >= FLUSH:
                    yield flush(held, list(names))
                    waiting = 0
        if held:
            yield flush(held, list(names))

    return run


def _summed(least: int):
    """Frequent words of a slice with their language, and without a word the slice's words of each language."""

    def run(table: pa.Table) -> pa.Table:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for lang, payload in zip(table.column("lang").to_pylist(), table.column("counts").to_pylist(), strict=True):
            gaps, count = unpack(payload[8:], np.uint64, np.int64)
            held.setdefault(lang, []).append((np.frombuffer(payload, np.uint64, 1) + np.cumsum(gaps, dtype=np.uint64), count))
        parts = []
        for lang, own in held.items():
            (word,), count = _counted([np.concatenate([w for w, _ in own])], np.concatenate([n for _, n in own]))
            often = count >= least
            words = [None, *word[often].view(np.int64).tolist()]
            parts.append(pa.table([pa.array(words, pa.int64()), pa.repeat(pa.scalar(lang), len(words)), pa.array([int(count.sum()), *count[often].tolist()], pa.int64())], names=["h", "lang", "n"]))
        return pa.concat_tables(parts)

    return run


def _spelled(known: Callable[[], Repeated]):
    """The words that are asked for, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, seen = known(), np.zeros(0, np.uint64)
        for batch in batches:
            for _, starts, ends, hashes, _, data in _texts(batch):
                found, at = np.unique(hashes, return_index=True)
                use = marks(found) & ~np.isin(found, seen, assume_unique=True)
                found, at = found[use], at[use]
                seen = np.concatenate((seen, found))
                words = [data[s:e].tobytes().decode() for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(words, pa.string())], names=["h", "word"])

    return run


def _stripes(size: int, slices: int, known: Callable[[], tuple[Repeated, Repeated]]):
    """Stripes of the prefixes of `size` words in the texts of a task, by slice."""
    schema = pa.schema([("slice", pa.int32()), ("stripes", pa.binary())])

    def flush(held: list[list[np.ndarray]], hot: Repeated) -> pa.RecordBatch:
        columns, count = _counted([np.concatenate(x) for x in zip(*held, strict=True)])
        held.clear()
        key = _phrase(columns[:-1])
        key = np.where(hot(key), _phrase([key, columns[-1]]), mix(key))
        of = _slice(key, slices)
        order = np.lexsort((columns[-1], *columns[-2::-1], of))
        of, count, columns = of[order], count[order], [c[order] for c in columns]
        rows = []
        for k, low, high in _cut(of):
            prefix = [c[low:high] for c in columns[:-1]]
            begin = np.flatnonzero(heads(*prefix))
            stripes = pack(*(c[begin] for c in prefix), np.diff(np.append(begin, high - low)))
            rows.append((k, len(stripes).to_bytes(8, "little") + stripes + pack(columns[-1][low:high], count[low:high])))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(2)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, hot = known()
        held, waiting = [], 0
        for batch in batches:
            for _, _, _, hashes, follows, _ in _texts(batch):
                whole = np.ones(max(0, len(hashes) - size + 1), bool)
                for k in range(size - 1):
                    whole &= follows[k : k + len(whole)]
                at = np.flatnonzero(whole)
                at = at[frequent(_phrase([hashes[at + k] for k in range(size)]))]
                alive = np.zeros(len(hashes) + 1, bool)
                alive[at] = True
                goes = follows[at + size - 1] & alive[at + 1]
                following = np.zeros(len(at), np.uint64)
                following[goes] = hashes[at[goes] + size]
                held.append([*(hashes[at + k] for k in range(size)), following])
                waiting += len(at)
                if waiting >= FLUSH:
                    yield flush(held, hot)
                    waiting = 0
        if waiting:
            yield flush(held, hot)

    return run


def _merged(size: int, least: int):
    """The stripes of a slice added up elementwise: extensions that are frequent, and the sum of each prefix's part."""

    def run(table: pa.Table) -> pa.Table:
        held = []
        for payload in table.column("stripes").to_pylist():
            stop = 8 + int.from_bytes(payload[:8], "little")
            *prefix, width = unpack(payload[8:stop], *[np.uint64] * size, np.int64)
            held.append((*(np.repeat(p, width) for p in prefix), *unpack(payload[stop:], np.uint64, np.int64)))
        *columns, count = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort(columns[::-1])
        columns, count = [c[order] for c in columns], count[order]
        at = np.flatnonzero(heads(*columns))
        columns, count = [c[at] for c in columns], np.add.reduceat(count, at)
        begin = np.flatnonzero(heads(*columns[:-1]))
        often = np.flatnonzero((count >= least) & (columns[-1] > 0))
        parts = []
        for words, number in (([c[begin] for c in columns[:-1]], np.add.reduceat(count, begin)), ([c[often] for c in columns], count[often])):
            flat = np.stack(words, 1).reshape(-1).view(np.int64)
            offsets = np.arange(0, len(flat) + 1, len(words), dtype=np.int32)
            parts.append(pa.table([pa.repeat(pa.scalar(len(words) > size), len(number)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(number, pa.int64())], names=["extension", "words", "n"]))
        return pa.concat_tables(parts)

    return run


def _known(keys: DataFrame) -> Repeated:
    """Bits that tell these phrases (`words`: hashes) from nearly all others: each enters the sketch twice."""

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        lists = batch.column("words")
        if len(lists):
            flat = lists.flatten().to_numpy().view(np.uint64).reshape(len(lists), -1)
            yield np.repeat(_phrase([flat[:, k] for k in range(flat.shape[1])]), 2)

    return repeated_filter(keys.select("words"), hashes, 4 * keys.count())


def stripes(texts: DataFrame, words: DataFrame, slices: int, slice_words: int, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts of the frequent phrases of one word and more: sums of stripes, and their frequent entries (`words`: hashes, `n`).

    `words` has the frequent words (`words`: list of one hash, `n`).
    """
    context = texts.sparkSession.sparkContext
    frequent, found = words, []
    for size in range(1, LONGEST):
        # A prefix of more occurrences than a slice has words is cut over slices.
        hot = frequent.where(F.col("n") >= slice_words)
        # One copy per executor; its size is fixed by the sketch, not by the data.
        shared = context.broadcast((_known(frequent), _known(hot)))
        rows = texts.mapInArrow(_stripes(size, slices, lambda b=shared: b.value), "slice int, stripes binary")
        found.append(written(rows.groupBy("slice").applyInArrow(_merged(size, least), "extension boolean, words array<long>, n long"), f"stripes-{size}"))
        frequent = found[-1].where("extension").select("words", "n")
    every = reduce(DataFrame.unionByName, found)
    sums = every.where("NOT extension").groupBy("words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return sums, every.where("extension").select("words", "n")


def collocations(documents: DataFrame, text_column: str = "text", language_column: str = "lang", least: int = LEAST, top: int = TOP, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The phrases of two to five words that hold together best, the first `top` of each language.

    `lang`, `rank` (from 1), `phrase`, `a` (its count), `l` and `r` (counts of the parts at its weakest cut), `n` (words of the
    language), `score`: floor(1000 * a * n / (l * r)), exact. Texts are lower-cased (A to Z), cut at `.,;:!?` and line ends into pieces, and these at
    blanks and tabs into words; overlapping occurrences count. The weakest cut is that of least score, the first of several. A phrase that is
    part of a longer one with the same count is left out. `slice_bytes` of text meet in one task call. Order: score, then count, both descending, then phrase in byte order.

    - null text: no words; null language: `und`, together with rows that say so;
    - repeated rows count as often as they stand there; long texts are never cut; ids and other columns are ignored;
    - an empty table, or one without a phrase of `least` occurrences, gives an empty result.
    """
    texts = documents.select(F.coalesce(F.col(language_column).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_column).cast("string").alias("text"))
    texts = texts.where("text IS NOT NULL")
    slices = max(1, -(-total_bytes(texts, "text") // slice_bytes))
    counted = texts.mapInArrow(_word_counts(slices), "slice int, lang string, counts binary").groupBy("slice").applyInArrow(_summed(least), "h long, lang string, n long")
    counted = written(counted, "words")
    totals = counted.where("h IS NULL").groupBy("lang").agg(F.sum("n").alias("total"))
    words = counted.where("h IS NOT NULL")
    sums, found = stripes(texts, words.select(F.array("h").alias("words"), "n"), slices, max(1, slice_bytes // 6), least)
    # An extension that stands for a prefix (or for what follows its first word) wherever that occurs. By one word is enough:
    # counts never grow with length, so all phrases between two of one count have that count.
    size = F.size("words")
    covered = found.where(size > 2).select(F.explode(F.array(F.slice("words", 1, size - 1), F.slice("words", 2, size - 1))).alias("part"), F.col("n").alias("most"))
    covered = covered.groupBy("part").agg(F.max("most").alias("most"))
    left_out = found.join(covered, (found["words"] == covered["part"]) & (covered["most"] >= found["n"]), "anti")
    entry = F.col("words")[0].alias("first")
    cuts = left_out.select("words", F.col("n").alias("a"), entry, F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("words", F.lit(1), F.col("k")).alias("head"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("tail"))
    cuts = cuts.join(sums.select(F.col("words").alias("head"), F.col("n").alias("l")), "head").join(sums.select(F.col("words").alias("tail"), F.col("n").alias("r")), "tail")
    cuts = cuts.join(words.select(F.col("h").alias("first"), "lang"), "first").join(totals, "lang")
    cuts = cuts.withColumn("score", F.expr("(cast(1000 as decimal(38,0)) * a * total) div (cast(l as decimal(38,0)) * r)"))
    weakest = cuts.groupBy("words", "lang", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = weakest.select("words", "lang", "a", F.col("total").alias("n"), "cut.l", "cut.r", "cut.score")
    # Whatever may be among the first, with all that tie; only their words are spelled.
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = written(scored.withColumn("place", F.rank().over(place)).where(F.col("place") <= top), "first")
    marks = texts.sparkSession.sparkContext.broadcast(_known(first.select(F.explode("words").alias("h")).distinct().select(F.array("h").alias("words"))))
    names = written(texts.mapInArrow(_spelled(lambda: marks.value), "h long, word string").distinct(), "names")
    if not names.groupBy("h").count().where("count > 1").isEmpty():
        raise ValueError("two words have the same hash; give Polynomial another seed")
    spelled = first.withColumn("phrase", F.lit(""))
    for k in range(LONGEST):
        one = names.select(F.col("h").alias("__h"), F.col("word").alias("__word"))
        spelled = spelled.withColumn("__at", F.get("words", F.lit(k))).join(one, F.col("__at") == F.col("__h"), "left")
        spelled = spelled.withColumn("phrase", F.when(F.col("__word").isNull(), F.col("phrase")).otherwise(F.concat("phrase", F.lit(" " if k else ""), "__word"))).drop("__at", "__h", "__word")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "phrase"))
    return spelled.select("lang", rank.cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score").where(F.col("rank") <= top)
