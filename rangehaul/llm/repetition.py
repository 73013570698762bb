"""Repeated passages inside a text, from its suffix array over words, as quality rules.

Texts are taken a chunk at a time; equal words of one text are one symbol, so suffixes of different texts never meet. Suffixes are
sorted by prefix doubling, each round only those that still tie. Neighbours that share `WIDTH` words or more get their common length:
where the words before two neighbours differ they are compared directly, elsewhere the length is one less than at the
word before. From these lengths come the intervals (runs of suffixes with a common prefix), which are the repeats that cannot be
longer on the right; those whose occurrences have differing words before them are the maximal repeats. Their spans
are united, and the rules limit the covered share of a text and its longest repeat.

Work and memory of a chunk are proportional to its words (times a logarithm); nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rangehaul.llm.arrays import SPACE, Chunk, Polynomial, heads, parts, text_chunks, word_bounds

WIDTH = 8
LEAST_WORDS = 20
# Percent of words and of characters that repeats may cover, and words of the longest repeat.
REPEATED_WORDS = 30
REPEATED_CHARS = 30
LONGEST = 100
# The symbols that the rule counts.
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_FIRST, _SECOND = Polynomial(31), Polynomial(32)
_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_chars", "longest_repeat", "n_repeats")


def _same(*keys: np.ndarray) -> np.ndarray:
    """Number of the distinct key of each row; keys of one number are equal in all columns."""
    order = np.argsort(keys[0], kind="stable")
    if any((((keys[0][order][1:] == keys[0][order][:-1])) & (k[order][1:] != k[order][:-1])).any() for k in keys[1:]):
        order = np.lexsort(keys[::-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(heads(*(k[order] for k in keys))) - 1
    return out


def suffix_order(symbols: np.ndarray, ends: np.ndarray, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and for each place whether this suffix and the one before share `width` symbols (a power of two).

    `ends` gives the end of its text for each place; texts have no symbol in common.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    head = heads(symbols[order])
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    rank = np.empty(n, np.int64)
    rank[order] = first
    shared = np.zeros(n, bool)
    head = np.append(head, True)
    active = np.flatnonzero(~(head[:-1] & head[1:]))
    step = 1
    while True:
        if step == width:
            shared[active[1:]] = rank[order[active[1:]]] == rank[order[active[:-1]]]
        if not len(active):
            return order, shared
        these = order[active]
        after = these + step
        inside = after < ends[these]
        key = rank[these] * (n + 1)
        key[inside] += rank[after[inside]] + 1
        by = np.argsort(key, kind="stable")
        these, key = these[by], key[by]
        order[active] = these
        head = heads(key)
        rank[these] = active[np.flatnonzero(head)[np.cumsum(head) - 1]]
        head = np.append(head, True)
        active = active[~(head[:-1] & head[1:])]
        step *= 2


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at `a` and `b`, which lie in one text; compared in blocks."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        width = max(8, min(1 << 14, (1 << 18) // len(live)))
        for part in np.array_split(live, -(-len(live) * width // (1 << 20))):
            x, y = a[part] + out[part], b[part] + out[part]
            left = ends[a[part]] - np.maximum(x, y)
            at = np.arange(width)
            last = len(symbols) - 1
            equal = (symbols[np.minimum(x[:, None] + at, last)] == symbols[np.minimum(y[:, None] + at, last)]) & (at < left[:, None])
            whole = equal.all(1)
            out[part] += np.where(whole, width, equal.argmin(1))
            live[np.searchsorted(live, part[~whole])] = -1
        live = live[live >= 0]
    return out


def common_lengths(symbols: np.ndarray, ends: np.ndarray, order: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share a prefix with a neighbour, in order, and the length shared with the one before (0 where a new group begins)."""
    member = shared.copy()
    member[:-1] |= shared[1:]
    suffixes, joined = order[member], shared[member]
    before = np.full(len(symbols), -1, np.int64)
    at = np.flatnonzero(joined)
    before[suffixes[at]] = suffixes[at - 1]
    place = np.flatnonzero(before >= 0)
    other = before[place]
    starts = np.zeros(len(symbols), bool)
    starts[0] = True
    starts[1:] = ends[1:] != ends[:-1]
    # Here the common prefix follows from nothing else; from here on it shrinks by one a word.
    own = starts[place] | starts[other] | (symbols[place - 1] != symbols[other - 1])
    known = np.flatnonzero(own)
    least = _common(symbols, place[known], other[known], ends)
    by = np.cumsum(own) - 1
    length = np.zeros(len(symbols), np.int64)
    length[place] = least[by] - (place - place[known][by])
    return suffixes, np.where(joined, length[suffixes], 0)


def _smaller(length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the nearest smaller one on either side, by pointers that jump over pointers. Entry 0 is 0; past the end is 0 too."""
    low = np.append(length, 0)
    found = []
    for toward in (-1, 1):
        pointer = np.arange(len(length)) + toward
        pointer[pointer < 0] = 0
        live = np.flatnonzero((length > 0) & (low[pointer] >= length))
        jumps = np.append(pointer, len(length))
        while len(live):
            jumps[live] = jumps[jumps[live]]
            live = live[low[jumps[live]] >= length[live]]
        found.append(jumps[:-1])
    return found[0], found[1]


def maximal_repeats(symbols: np.ndarray, ends: np.ndarray, suffixes: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and behind-last entry (in `suffixes`) and length of each repeat that can be made longer on neither side."""
    at = np.flatnonzero(length > 0)
    left, right = _smaller(length)
    left, right, size = left[at], right[at], length[at]
    by = np.lexsort((right, left))
    by = by[heads(left[by], right[by])] if len(by) else by
    left, right, size = left[by], right[by], size[by]
    starts = np.append(True, ends[1:] != ends[:-1])
    preceding = np.where(starts[suffixes], -1, symbols[suffixes - 1])
    differ = np.zeros(len(suffixes), np.int64)
    differ[1:] = (preceding[1:] != preceding[:-1]) | (preceding[1:] < 0)
    differ = np.cumsum(differ)
    maximal = differ[right - 1] > differ[left]
    return left[maximal], right[maximal], size[maximal]


def _by_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(flags, dtype=np.int64))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _duplicate_lines(chunk: Chunk) -> np.ndarray:
    """For each text, lines with a word that are equal to an earlier line of the text."""
    newline = np.zeros(256, bool)
    newline[10] = True
    row, starts, ends = word_bounds(chunk, newline)
    words = np.append(0, np.cumsum(~SPACE[chunk.data]))
    use = words[ends] > words[starts]
    row, starts, ends = row[use], starts[use], ends[use]
    count = len(chunk.offsets) - 1
    if not len(row):
        return np.zeros(count, np.int64)
    line = _same(_FIRST.ranges(chunk.data, starts, ends), _SECOND.ranges(chunk.data, starts, ends))
    pair = np.unique(row * (int(line.max()) + 1) + line) // (int(line.max()) + 1)
    return np.bincount(row, minlength=count) - np.bincount(pair, minlength=count)


def measured(chunk: Chunk, width: int = WIDTH) -> dict[str, np.ndarray]:
    """The columns of a chunk, one entry a text."""
    count = len(chunk.offsets) - 1
    row, starts, ends = word_bounds(chunk)
    lead = (chunk.data & 0xC0) != 0x80
    out = {
        "n_words": np.bincount(row, minlength=count),
        "word_chars": _by_row(lead & ~SPACE[chunk.data], chunk.offsets),
        "n_symbols": _by_row(_SYMBOL[chunk.data], chunk.offsets),
        "n_dup_lines": _duplicate_lines(chunk),
    }
    out |= {name: np.zeros(count, np.int64) for name in _COLUMNS if name not in out}
    if not len(row):
        return out
    symbols = _symbols(chunk, row, starts, ends)
    limits = np.cumsum(out["n_words"])[row]
    order, shared = suffix_order(symbols, limits, 1 << (width.bit_length() - 1))
    if not shared.any():
        return out
    suffixes, length = common_lengths(symbols, limits, order, shared)
    length[length < width] = 0
    left, _, size = maximal_repeats(symbols, limits, suffixes, length)
    # A repeat that is not maximal lies in one that is: the longest at each suffix gives the same union of spans.
    longest = np.maximum(length, np.append(length[1:], 0))
    at, longest = suffixes[longest > 0], longest[longest > 0]
    change = np.zeros(len(row) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + longest, -1)
    covered = np.cumsum(change[:-1]) > 0
    chars = np.append(0, np.cumsum(lead))
    out["n_repeat_words"] = np.bincount(row[covered], minlength=count)
    out["covered_chars"] = np.bincount(row[covered], (chars[ends] - chars[starts])[covered], minlength=count).astype(np.int64)
    of = row[suffixes[left]]
    out["n_repeats"] = np.bincount(of, minlength=count)
    np.maximum.at(out["longest_repeat"], of, size)
    return out


def _symbols(chunk: Chunk, row: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of words; equal words of one text have one number, different texts have none in common."""
    word = _same(_FIRST.ranges(chunk.data, starts, ends), _SECOND.ranges(chunk.data, starts, ends))
    return row * (int(word.max()) + 1) + word


def repetition(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH) -> DataFrame:
    """Repetition and simple form of every text, and the verdict of the rules.

    One row per row of `documents`: `doc_id`, `n_words`, `word_chars` (code points in words), `n_symbols`, `n_dup_lines` (lines with a
    word that equal an earlier line), `n_repeat_words` (words covered by repeats of `width` words or more), `covered_chars`
    (code points of these words), `longest_repeat` (words), `n_repeats` (maximal repeats), `base_failed` (under 20 words, or over 30 percent of
    words in repeats) and `kept`: not failed, repeats cover 30 percent of the code points at most, and none is longer than 100 words.

    - null or empty text: no words, all counts 0, failed; a text shorter than `width` has no repeat;
    - null id: kept as it is; repeated rows get equal results, and texts never look at each other;
    - occurrences may overlap; an empty table gives an empty result; other columns are ignored.
    """
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = [measured(chunk, width) for chunk in text_chunks(batch.column("text"))]
            if found:
                columns = [pa.array(np.concatenate([x[name] for x in found]), pa.int64()) for name in _COLUMNS]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *_COLUMNS])

    found = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in _COLUMNS))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_WORDS * F.col("n_words"))
    within = (100 * F.col("covered_chars") <= REPEATED_CHARS * F.col("word_chars")) & (F.col("longest_repeat") <= LONGEST)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & within)
