"""Repeated byte strings across documents, found in suffix arrays that are built by linear grouping.

`suffix_array` sorts suffixes in two phases and never renames the text. First, suffixes are grouped by their
Lyndon prefix: groups are taken in descending order, each member points to the nearest earlier suffix of a smaller
group, and the suffixes pointed at move up into new groups, by how often they are pointed at. Then the
order is read off: from the smallest suffix on, each placed suffix places its left neighbour and what that points
to, every one at the next free place of its group.

Equal 50-byte strings meet because each string is keyed by its smallest 19-byte gram (by hash), which
depends on nothing but the string. Neighbouring strings of one document mostly share the gram, so a run of them
travels as one piece of 50 to 81 bytes. A merged count-min sketch drops pieces whose gram occurs in one document
only, as no string in them can repeat elsewhere. Equal pieces are settled by grouping them; pieces that share a
gram but differ are sorted by suffix, where equal 50-byte strings stand side by side (pieces without any string whose
hash occurs elsewhere are left out before, the others cut down to what may repeat).

A gram with very many different pieces would fill one slice. Such grams are found in a sample of the texts; their pieces travel as
single strings by the hash of the string, over all slices, and a second sketch drops strings that occur in one document only. The
sample decides about the way alone, never about the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rangehaul.llm.arrays import Polynomial, heads, lists, mix, pack, parts, row_of, text_chunks, unpack
from rangehaul.llm.sketch import repeated_filter
from rangehaul.llm.store import squeezed, total_bytes, unsqueezed

LENGTH = 50
GRAMS = 32  # grams of a string; a power of two
PLACE_BITS = 20
# Bytes of text whose pieces meet in one slice, pieces that a task groups at a time, bytes of one suffix array.
SLICE_BYTES = 4 << 20
FLUSH = 1 << 15
BLOCK_BYTES = 1 << 15
# Strings whose hashes are compared at a time.
TURN = 1 << 19
CHUNK = 1 << 17
# A gram of so many different pieces travels as single strings; counted in one of so many texts.
HEAVY_PIECES = SLICE_BYTES // 320
SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence of positive integers."""
    n = len(symbols) + 1
    text = np.append(symbols, 0)  # ends below everything
    order = np.argsort(text, kind="stable")
    slot = order.tolist()
    head = heads(text[order])
    starts = np.flatnonzero(head)
    group_of = np.empty(n, np.int64)
    group_of[order] = starts[np.cumsum(head) - 1]
    group = group_of.tolist()
    size = [0] * (n + 1)
    for low, count in zip(starts.tolist(), np.diff(np.append(starts, n)).tolist(), strict=True):
        size[low] = count
    place = [0] * n
    for at, i in enumerate(slot):
        place[i] = at
    smaller = [-1] * n

    end = n
    while end > 1:
        begin = group[slot[end - 1]]
        pointed: dict[int, int] = {}
        for i in sorted(slot[begin:end]) if end - begin > 1 else slot[begin:end]:
            j = i - 1
            while j >= 0 and group[j] >= begin:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        by_count: dict[int, dict[int, list[int]]] = {}
        for j, times in pointed.items():
            by_count.setdefault(times, {}).setdefault(group[j], []).append(j)
        for times in sorted(by_count, reverse=True):
            for old, members in by_count[times].items():
                top = old + size[old]
                for j in members:
                    top -= 1
                    other, at = slot[top], place[j]
                    slot[top], slot[at] = j, other
                    place[j], place[other] = top, at
                    group[j] = top
                if top > old or size[old] > len(members):
                    for j in members:
                        group[j] = top
                    size[old] = top - old
                    size[top] = len(members)
                else:
                    for j in members:
                        group[j] = old
        end = begin

    sorted_ = [0] * n
    sorted_[0] = n - 1
    free = list(range(n))
    group[n - 1] = -1
    for at in range(n):
        j = sorted_[at] - 1
        while j >= 0 and (own := group[j]) >= 0:
            sorted_[free[own]] = j
            free[own] += 1
            group[j] = -1
            j = smaller[j]
    return np.array(sorted_[1:], np.int64)


_GRAM, _PIECE, _CHECK = Polynomial(21), Polynomial(22), Polynomial(23)


def _pieces(chunk, length: int) -> tuple[np.ndarray, ...]:
    """Row, start, number of strings, and gram key of each piece of a chunk."""
    data, offsets = chunk.data, chunk.offsets
    gram = length - GRAMS + 1
    count = len(data) - length + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    at = np.arange(len(data) - gram + 1)
    least = _GRAM.ranges(data, at, at + gram)
    least &= ~np.uint64((1 << PLACE_BITS) - 1)
    least |= (at & ((1 << PLACE_BITS) - 1)).astype(np.uint64)
    step = 1
    while step < GRAMS:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    # Strings that would reach into the next text are none.
    ends = offsets[1:]
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, np.maximum(offsets[:-1], ends - length + 1), 1)
    np.add.at(change, ends, -1)
    inside = np.cumsum(change[:count]) == 0
    head = inside.copy()
    head[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
    tail = inside.copy()
    tail[:-1] &= ~inside[1:] | (least[1:] != least[:-1])
    starts = np.flatnonzero(head)
    return row_of(offsets, starts), starts, np.flatnonzero(tail) - starts + 1, least[starts] >> np.uint64(PLACE_BITS)


def _gram_keys(length: int):
    def run(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for chunk in text_chunks(batch.column("text"), CHUNK):
            row, _, _, key = _pieces(chunk, length)
            # Once per document, so that a gram repeated inside one text does not count.
            yield np.unique(row.astype(np.uint64) << np.uint64(64 - PLACE_BITS) | key) & np.uint64((1 << (64 - PLACE_BITS)) - 1)

    return run


def _strings(starts: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece and start of each string of pieces with the given numbers of strings."""
    which = np.repeat(np.arange(len(count)), count)
    return which, starts[which] + _runs(count)


def _piece_hashes(length: int, known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = known()
        for batch in batches:
            for chunk in text_chunks(batch.column("text"), CHUNK):
                _, starts, strings, keys = _pieces(chunk, length)
                keep = repeated(keys)
                starts, strings, keys = starts[keep], strings[keep], keys[keep]
                hashes = _PIECE.ranges(chunk.data, starts, starts + strings + length - 1)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(hashes.astype(np.uint64).view(np.int64)), pa.array(strings, pa.int64())], names=["key", "hash", "strings"])

    return run


def _string_keys(length: int, known, heavy: np.ndarray):
    def run(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        repeated = known()
        for chunk in text_chunks(batch.column("text"), CHUNK):
            row, starts, strings, keys = _pieces(chunk, length)
            hot = np.flatnonzero(np.isin(keys, heavy) & repeated(keys))
            which, at = _strings(starts[hot], strings[hot])
            hashes, row = _PIECE.ranges(chunk.data, at, at + length), row[hot][which]
            order = np.lexsort((hashes, row))
            # Once per document.
            yield hashes[order][heads(row[order], hashes[order])] if len(order) else hashes

    return run


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, one behind the other."""
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) if len(sizes) else starts
    return data[np.arange(int(sizes.sum())) + shift]


def _piece_rows(slices: int, length: int, known, heavy: np.ndarray, twice):
    schema = pa.schema([("slice", pa.int32()), ("decided", pa.bool_()), ("payload", pa.binary())])

    def flush(ids, texts, starts, sizes, keys, hashes, data) -> list[tuple[int, bool, bytes]]:
        order = np.lexsort((starts, hashes, keys))
        ids, texts, starts, sizes, keys, hashes, at = (x[order] for x in (ids, texts, starts, sizes, keys, hashes, np.cumsum(sizes) - sizes))
        head = heads(keys, hashes)
        lost = ids > np.minimum.reduceat(ids, np.flatnonzero(head))[np.cumsum(head) - 1]
        rows = [(k, True, payload) for k, payload in _by_bucket(ids[lost], texts[lost], starts[lost], starts[lost] + sizes[lost], slices)]
        ids, texts, starts, sizes, keys, hashes, at = (x[~lost] for x in (ids, texts, starts, sizes, keys, hashes, at))
        # Keys are minima and crowd at the low end: mixed again, they fill all slices alike.
        of = ((mix(keys) >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)
        hot = np.isin(keys, heavy)
        of[hot] = (hashes[hot] >> np.uint64(32)).astype(np.int64) % slices
        order = np.argsort(of, kind="stable")
        of, ids, texts, starts, sizes, keys, hashes, at = (x[order] for x in (of, ids, texts, starts, sizes, keys, hashes, at))
        bounds = np.flatnonzero(heads(of))
        for low, high in zip(bounds, np.append(bounds[1:], len(of)), strict=True):
            part = slice(low, high)
            first = heads(keys[part], hashes[part])
            piece = np.cumsum(first) - 1
            docs, number = np.unique(np.stack((ids[part], texts[part])), axis=1, return_inverse=True)
            blocks = [pack(docs[0], docs[1]), pack(piece, number.reshape(-1), starts[part]), pack(keys[part][first], sizes[part][first]), _gather(data, at[part][first], sizes[part][first]).tobytes()]
            rows.append((int(of[low]), False, b"".join(len(b).to_bytes(8, "little") + b for b in blocks)))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, recurs, held, size = known(), twice(), [], 0

        def out() -> pa.RecordBatch:
            rows = flush(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(3)], schema=schema)

        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(), batch.column("text_hash").to_numpy()
            for chunk in text_chunks(batch.column("text"), CHUNK):
                row, starts, strings, keys = _pieces(chunk, length)
                keep = repeated(keys)
                row, starts, keys, sizes = row[keep], starts[keep], keys[keep], strings[keep] + length - 1
                if not len(row):
                    continue
                hashes = _PIECE.ranges(chunk.data, starts, starts + sizes)
                if (hot := np.isin(keys, heavy)).any():
                    which, at = _strings(starts[hot], sizes[hot] - length + 1)
                    own = _PIECE.ranges(chunk.data, at, at + length)
                    use = recurs(own)
                    which, at, own = which[use], at[use], own[use]
                    of = (row[hot][which], at, np.full(len(at), length), keys[hot][which], own)
                    row, starts, sizes, keys, hashes = (np.concatenate((x[~hot], y)) for x, y in zip((row, starts, sizes, keys, hashes), of, strict=True))
                if not len(row):
                    continue
                held.append((ids[row + chunk.low], texts[row + chunk.low], starts - chunk.offsets[row], sizes, keys, hashes, _gather(chunk.data, starts, sizes)))
                size += len(row)
                if size >= FLUSH:
                    yield out()
                    size = 0
        if held:
            yield out()

    return run


def _equal_strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece and offset of each string that a piece of a smaller owner has as well, by one suffix array."""
    total = int(sizes.sum()) + len(sizes)
    symbols = np.ones(total, np.int64)  # 1 parts the pieces
    begins = np.cumsum(sizes + 1) - sizes - 1
    at = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)
    symbols[at] = _gather(data, starts, sizes).astype(np.int64) + 2
    order = suffix_array(symbols)
    piece = np.searchsorted(begins, order, "right") - 1
    offset = order - begins[piece]
    whole = offset + length <= sizes[piece]
    order, piece, offset = order[whole], piece[whole], offset[whole]
    if not len(order):
        return piece, offset
    strings = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.uint16), length)
    head = np.ones(len(order), bool)
    for low in range(1, len(order), 1 << 16):
        high = min(len(order), low + (1 << 16))
        head[low:high] = (strings[order[low:high]] != strings[order[low - 1 : high - 1]]).any(1)
    least = np.minimum.reduceat(owners[piece], np.flatnonzero(head))[np.cumsum(head) - 1]
    lost = owners[piece] > least
    return piece[lost], offset[lost]


def _by_bucket(ids: np.ndarray, texts: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    """Spans packed by document range; spans of a document that touch are one."""
    if not len(ids):
        return []
    of = ids % buckets
    order = np.lexsort((starts, texts, ids, of))
    ids, texts, starts, ends, of = (x[order] for x in (ids, texts, starts, ends, of))
    head = heads(ids, texts)
    # Ends reached so far inside a document: lifted by document, so that one running maximum serves all.
    lift = (np.cumsum(head) - 1) << 33
    reach = np.maximum.accumulate(ends + lift) - lift
    fresh = head.copy()
    fresh[1:] |= starts[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    ids, texts, starts, of, ends = ids[at], texts[at], starts[at], of[at], reach[np.append(at[1:], len(reach)) - 1]
    bounds = np.flatnonzero(heads(of))
    return [(int(of[x]), pack(ids[x:y], texts[x:y], starts[x:y], ends[x:y])) for x, y in zip(bounds, np.append(bounds[1:], len(of)), strict=True)]


def _gathered(table: pa.Table) -> pa.Table:
    """One row for each document of a bucket: list of start * 2**32 + end."""
    ids, texts, starts, ends = (np.concatenate(x) for x in zip(*(unpack(p, *[np.int64] * 4) for p in table.column("payload").to_pylist()), strict=True))
    order = np.lexsort((starts, texts, ids))
    ids, texts, codes = ids[order], texts[order], (starts << 32 | ends)[order]
    (ids, texts), offsets = lists(codes, (ids, texts))
    return pa.table([pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(codes, pa.int64()))], names=["doc_id", "text_hash", "spans"])


def _settled(length: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        out, found, strings, seen = [], [], [], 0
        for done, payload in zip(table.column("decided").to_pylist(), table.column("payload").to_pylist(), strict=True):
            if done:
                out.append(unpack(payload, *[np.int64] * 4))
                continue
            blocks, at = [], 0
            while at < len(payload):
                size = int.from_bytes(payload[at : at + 8], "little")
                blocks.append(payload[at + 8 : at + 8 + size])
                at += 8 + size
            ids, texts = unpack(blocks[0], np.int64, np.int64)
            piece, number, starts = unpack(blocks[1], np.int64, np.int64, np.int64)
            keys, sizes = unpack(blocks[2], np.uint64, np.int64)
            found.append((piece + seen, ids[number], texts[number], starts))
            strings.append((keys, sizes, np.frombuffer(blocks[3], np.uint8)))
            seen += len(keys)
        if found:
            keys, sizes, data = (np.concatenate(x) for x in zip(*strings, strict=True))
            begins = np.cumsum(sizes) - sizes
            first, second = _PIECE.ranges(data, begins, begins + sizes), _CHECK.ranges(data, begins, begins + sizes)
            order = np.lexsort((second, first, keys))
            head = heads(keys[order], first[order], second[order])
            number = np.empty(len(order), np.int64)
            number[order] = np.cumsum(head) - 1
            pieces = order[head]  # one of each distinct piece, ordered by gram
            piece, ids, texts, starts = (np.concatenate(x) for x in zip(*found, strict=True))
            piece = number[piece]
            owners = np.full(len(pieces), np.iinfo(np.int64).max)
            np.minimum.at(owners, piece, ids)
            lost = ids > owners[piece]
            out.append((ids[lost], texts[lost], starts[lost], starts[lost] + sizes[pieces][piece[lost]]))
            piece, ids, texts, starts = (x[~lost] for x in (piece, ids, texts, starts))
            at = np.argsort(piece, kind="stable")
            piece, ids, texts, starts = (x[at] for x in (piece, ids, texts, starts))
            for which, offset in _shared(data, begins[pieces], sizes[pieces], owners, keys[pieces], length):
                low, high = np.searchsorted(piece, which), np.searchsorted(piece, which, "right")
                use = np.repeat(low, high - low) + np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
                begin = starts[use] + np.repeat(offset, high - low)
                out.append((ids[use], texts[use], begin, begin + length))
        rows = _by_bucket(*(np.concatenate(x) for x in zip(*out, strict=True)), buckets)
        return pa.table({"bucket": pa.array([k for k, _ in rows], pa.int32()), "payload": pa.array([p for _, p in rows], pa.binary())})

    return run


def _runs(count: np.ndarray) -> np.ndarray:
    """0, 1, 2, … for each run of the given lengths."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def _worth(data, begins, sizes, owners, pieces, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of `pieces` with a string whose hash another owner's piece has as well, and their first and last such string."""
    count = sizes[pieces] - length + 1
    which = np.repeat(np.arange(len(pieces)), count)
    offset = _runs(count)
    at = begins[pieces][which] + offset
    order = np.argsort(at, kind="stable")
    hashes = np.empty(len(at), np.uint64)
    hashes[order] = _CHECK.ranges(data, at[order], at[order] + length)
    order = np.argsort(hashes)
    own = owners[pieces][which][order]
    head = heads(hashes[order])
    begin, run = np.flatnonzero(head), np.cumsum(head) - 1
    shared = np.zeros(len(at), bool)
    shared[order] = (np.minimum.reduceat(own, begin) < np.maximum.reduceat(own, begin))[run]
    where = np.flatnonzero(shared)
    first = np.flatnonzero(heads(which[where])) if len(where) else where
    last = np.append(first[1:] - 1, len(where) - 1) if len(where) else where
    return pieces[which[where[first]]], offset[where[first]], offset[where[last]]


def _shared(data, begins, sizes, owners, keys, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lost strings of grams with several pieces, as (piece, offset); suffix arrays are built in blocks."""
    head = np.flatnonzero(heads(keys))
    several = np.repeat(np.diff(np.append(head, len(keys))) > 1, np.diff(np.append(head, len(keys))))
    pieces = np.flatnonzero(several)
    if not len(pieces):
        return
    # Pieces shrink to what may repeat; those that are equal now are settled by grouping as well.
    # Grams are taken some at a time, so that the work arrays stay small.
    starts = np.flatnonzero(heads(keys[pieces]))
    turn = (np.cumsum(sizes[pieces] - length + 1) // TURN)[starts]
    turns = [_worth(data, begins, sizes, owners, some, length) for some in np.split(pieces, starts[1:][turn[1:] != turn[:-1]])]
    pieces, first, last = (np.concatenate(x) for x in zip(*turns, strict=True))
    begins, sizes, owners, keys = begins[pieces] + first, last - first + length, owners[pieces], keys[pieces]
    order = np.argsort(begins, kind="stable")
    hashes = np.empty((2, len(pieces)), np.uint64)
    for k, polynomial in enumerate((_PIECE, _CHECK)):
        hashes[k, order] = polynomial.ranges(data, begins[order], begins[order] + sizes[order])
    order = np.lexsort((owners, hashes[1], hashes[0], keys))
    equal = heads(keys[order], hashes[0][order], hashes[1][order]) if len(order) else np.zeros(0, bool)
    lost = order[~equal]
    # Of equal pieces the smallest owner comes first; another piece of that owner loses nothing to it.
    least = owners[order][equal][np.cumsum(equal) - 1][~equal] if len(order) else owners
    lost, same = lost[owners[lost] > least], lost[owners[lost] == least]
    count = sizes[lost] - length + 1
    yield np.repeat(pieces[lost], count), np.repeat(first[lost], count) + _runs(count)
    use = np.sort(np.concatenate((order[equal], same)))
    held: list[np.ndarray] = []
    size = 0
    for group in [*np.split(use, np.flatnonzero(np.diff(keys[use])) + 1), None]:
        if group is not None and (len(group) < 2 or owners[group].min() == owners[group].max()):
            continue
        weight = int(sizes[group].sum()) if group is not None else 0
        if held and (group is None or size + weight > BLOCK_BYTES):
            block = np.concatenate(held)
            piece, offset = _equal_strings(data, begins[block], sizes[block], owners[block], length)
            yield pieces[block[piece]], first[block[piece]] + offset
            held, size = [], 0
        if weight > BLOCK_BYTES:
            for piece, offset in _dealt(data, begins[group], sizes[group], owners[group], group, length):
                yield pieces[piece], first[piece] + offset
        elif weight:
            held.append(group)
            size += weight


def _dealt(data, begins, sizes, owners, numbers, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One gram with more pieces than a block holds: its single strings, dealt over blocks by their hash."""
    count = sizes - length + 1
    piece = np.repeat(np.arange(len(sizes)), count)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    at = begins[piece] + offset
    deal = np.empty(len(at), np.uint64)
    order = np.argsort(at, kind="stable")
    deal[order] = _CHECK.ranges(data, at[order], at[order] + length)
    deal = (deal >> np.uint64(32)).astype(np.int64) % -(-len(at) * length // BLOCK_BYTES)
    order = np.argsort(deal, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(deal[order])) + 1):
        which, _ = _equal_strings(data, at[part], np.full(len(part), length), owners[piece[part]], length)
        yield numbers[piece[part][which]], offset[part][which]


def _cut(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            sizes, removed, spans, kept = [], [], [], []
            for text, places in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = unsqueezed(text.as_py()) or b""
                runs = []
                if places.is_valid and len(places.values):
                    codes = np.sort(places.values.to_numpy())
                    starts, ends = codes >> 32, np.maximum.accumulate(codes & 0xFFFFFFFF)
                    fresh = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
                    runs = list(zip(starts[fresh].tolist(), ends[np.append(fresh[1:] - 1, len(ends) - 1)].tolist(), strict=True))
                sizes.append(len(data))
                removed.append(sum(e - s for s, e in runs))
                spans.append([{"start": s, "end": e} for s, e in runs])
                bounds = [0, *(x for r in runs for x in r), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
            own = {"n_bytes": sizes, "n_removed": removed, "spans": spans, "kept": kept}
            yield pa.RecordBatch.from_arrays([pa.array(own[f.name], f.type) if f.name in own else batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    return run


def remove_repeated_strings(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, carry: Sequence[str] = ()) -> DataFrame:
    """Drop every byte covered by a `length`-byte string that also starts in a document of smaller id.

    One row per row of `documents`: `doc_id`, `carried` (struct of the columns in `carry`), `n_bytes`, `n_removed`,
    `spans` (maximal removed runs: start, end in UTF-8 bytes), `kept` (the other bytes; may cut a character).
    Strings are judged on the input and never reach over a text's end.

    - null text: no bytes; a text shorter than `length` keeps everything;
    - null id: takes no part, keeps everything; rows of the same id never remove each other's bytes,
      and equal rows get equal results;
    - an empty table gives an empty result; columns that are not named are ignored.
    """
    if length < GRAMS + 1:
        raise ValueError(f"length must be over {GRAMS}")
    carried = F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]) if carry else F.lit(None).cast("string")
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), carried.alias("carried")).withColumn("text_hash", F.xxhash64("text"))
    able = rows.where((F.octet_length("text") >= length) & F.col("doc_id").isNotNull())
    size = total_bytes(able, "text")
    marks = repeated_filter(able.select("text"), _gram_keys(length), size // (GRAMS // 2))
    # One copy per executor; its size is fixed by the sketch, not by the data.
    shared = rows.sparkSession.sparkContext.broadcast(marks)
    slices = max(1, -(-size // SLICE_BYTES))
    sample = able.where(F.pmod("text_hash", F.lit(SAMPLE)) == 0).select("text").mapInArrow(_piece_hashes(length, lambda: shared.value), "key long, hash long, strings long")
    # Different pieces of a gram, and all of its strings: the latter size the second sketch.
    different = sample.groupBy("key", "hash").agg(F.sum("strings").alias("strings")).groupBy("key")
    often = different.agg(F.count(F.lit(1)).alias("n"), F.sum("strings").alias("strings")).where(F.col("n") >= max(1, HEAVY_PIECES // SAMPLE)).collect()
    heavy = np.array([r.key for r in often], np.uint64)
    # Eight counters and more for each string: one that occurs once passes in at most 1 of 60 cases.
    expected = 4 * SAMPLE * sum(r.strings for r in often)
    twice = None
    if len(heavy):
        twice = rows.sparkSession.sparkContext.broadcast(repeated_filter(able.select("text"), _string_keys(length, lambda: shared.value, heavy), min(size, expected)))
    pieces = able.select("doc_id", "text_hash", "text").mapInArrow(_piece_rows(slices, length, lambda: shared.value, heavy, lambda: twice.value if twice else None), "slice int, decided boolean, payload binary")
    lost = pieces.groupBy("slice").applyInArrow(_settled(length, slices), "bucket int, payload binary")
    spans = lost.groupBy("bucket").applyInArrow(_gathered, "doc_id long, text_hash long, spans array<long>")
    joined = squeezed(rows).join(spans, ["doc_id", "text_hash"], "left").select("doc_id", "carried", "text", "spans")
    found = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    out = T.StructType([*joined.schema.fields[:2], T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", found), T.StructField("kept", T.BinaryType())])
    return joined.mapInArrow(_cut(to_arrow_schema(out)), out)
