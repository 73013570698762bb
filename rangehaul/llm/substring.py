"""Repeated word windows across documents: count-min prefilter, then exact grouping of what may repeat.

The first pass sketches the windows of every document (`sketch.repeated_filter`). The second pass hashes
them again and lets only windows through that the merged sketch estimates to occur twice or more. These are
grouped by 96 hash bits: the smallest document id of a window owns it, in all other documents the words it covers go.

Hot windows: a task first groups the windows it holds. Documents that are not the smallest one there have
lost already, so only the smallest sends a window on: a window in a third of all documents is a row per task.
Windows travel as packed arrays, many to a row, in slices of equal hash range whose number grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rangehaul.llm.arrays import differences, heads, lists, pack, parts, same_row, text_chunks, unpack, windows, words
from rangehaul.llm.sketch import repeated_filter
from rangehaul.llm.store import squeezed, total_bytes, unsqueezed

WIDTH = 13
# Bytes of text whose windows meet in one slice, and windows that a task groups at a time.
SLICE_BYTES = 16 << 20
FLUSH = 1 << 20

_REMOVED = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("starts", pa.list_(pa.int32()))])


def _ordered(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """An order that puts equal pairs side by side."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((second, first))
    return order


def _owners(first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each run of equal windows, for every row."""
    head = heads(first, second)
    return np.minimum.reduceat(ids, np.flatnonzero(head))[np.cumsum(head) - 1]


def _removed_rows(ids: np.ndarray, texts: np.ndarray, starts: np.ndarray) -> pa.Table:
    order = np.lexsort((starts, texts, ids))
    (ids, texts), offsets = lists(starts, (ids[order], texts[order]))
    return pa.table([pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(starts[order].astype(np.int32)))], schema=_REMOVED)


def _row_windows(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Row in the batch, place in words, and two hashes of each window of the batch."""
    for chunk in text_chunks(batch.column("text")):
        found = words(chunk)
        ok = same_row(found.row, width)
        row = found.row[: len(ok)][ok]
        begin = np.searchsorted(found.row, row)
        yield row + chunk.low, np.flatnonzero(ok) - begin, windows(found.first, width, 5)[ok], windows(found.second, width, 6)[ok]


def _candidates(slices: int, width: int, repeated):
    schema = pa.schema([("slice", pa.int32()), ("decided", pa.bool_()), ("payload", pa.binary())])

    def flush(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch | None:
        ids, texts, starts, first, second = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = _ordered(first, second)
        ids, texts, starts, first, second = (x[order] for x in (ids, texts, starts, first, second))
        if not len(ids):
            return None
        lost = ids > _owners(first, second, ids)
        rows: list[tuple[int, bool, bytes]] = []
        if lost.any():
            # Decided here: passed on to whichever slice, spread by document.
            rows += [(k, True, payload) for k, payload in _by_bucket(ids[lost], texts[lost], starts[lost], slices)]
        ids, texts, starts, first, second = (x[~lost] for x in (ids, texts, starts, first, second))
        of = ((first >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)
        bounds = np.flatnonzero(heads(of))
        # Documents of the slice are numbered, so that a window takes few bytes.
        for low, high in zip(bounds, np.append(bounds[1:], len(of)), strict=True):
            part = slice(low, high)
            keys, number = np.unique(np.stack((ids[part], texts[part])), axis=1, return_inverse=True)
            rows.append((int(of[low]), False, b"".join((len(keys[0]).to_bytes(8, "little"), keys.tobytes(), int(first[low]).to_bytes(8, "little"), pack(differences(first[part]), second[part], number.reshape(-1), starts[part])))))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(3)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = repeated(), [], 0
        for batch in batches:
            ids, texts = batch.column("doc_id").to_numpy(), batch.column("text_hash").to_numpy()
            for row, start, first, second in _row_windows(batch, width):
                at = np.flatnonzero(known(first))
                row = row[at]
                held.append((ids[row], texts[row], start[at], first[at], (second[at] >> np.uint64(32)).astype(np.uint32)))
                size += len(at)
                if size >= FLUSH:
                    if (out := flush(held)) is not None:
                        yield out
                    size = 0
        if held and (out := flush(held)) is not None:
            yield out

    return run


def _exact(slices: int):
    """All windows of a slice: those whose document is not the smallest one that has them, packed by document range."""

    def run(table: pa.Table) -> pa.Table:
        lost_rows, sent = [], []
        for decided, payload in zip(table.column("decided").to_pylist(), table.column("payload").to_pylist(), strict=True):
            if decided:
                lost_rows.append(unpack(payload, np.int64, np.int64, np.int64))
            else:
                count = int.from_bytes(payload[:8], "little")
                keys = np.frombuffer(payload, np.int64, 2 * count, 8).reshape(2, count)
                base = np.frombuffer(payload, np.uint64, 1, 8 + 16 * count)
                gaps, second, number, starts = unpack(payload[16 + 16 * count :], np.uint64, np.uint32, np.int64, np.int64)
                sent.append((keys[0][number], keys[1][number], starts, base + np.cumsum(gaps, dtype=np.uint64), second))
        if sent:
            ids, texts, starts, first, second = (np.concatenate(x) for x in zip(*sent, strict=True))
            order = _ordered(first, second)
            ids, texts, starts, first, second = (x[order] for x in (ids, texts, starts, first, second))
            lost = ids > _owners(first, second, ids)
            lost_rows.append([ids[lost], texts[lost], starts[lost]])
        ids, texts, starts = (np.concatenate(x) for x in zip(*lost_rows, strict=True))
        rows = _by_bucket(ids, texts, starts, slices)
        return pa.table({"bucket": pa.array([k for k, _ in rows], pa.int32()), "payload": pa.array([p for _, p in rows], pa.binary())})

    return run


def _by_bucket(ids: np.ndarray, texts: np.ndarray, starts: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    of = ids % buckets
    order = np.lexsort((starts, texts, ids, of))
    cuts = np.flatnonzero(heads(of[order])) if len(order) else []
    return [(int(of[part[0]]), pack(ids[part], texts[part], starts[part])) for part in np.split(order, cuts)[1:]] if len(order) else []


def _gathered(table: pa.Table) -> pa.Table:
    """One row for each document of a bucket that loses words."""
    ids, texts, starts = (np.concatenate(x) for x in zip(*(unpack(p, *[np.int64] * 3) for p in table.column("payload").to_pylist()), strict=True))
    return _removed_rows(ids, texts, starts)


def repeated_windows(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """Window places to remove, one row per document that loses words: `doc_id`, `text_hash`, `starts`.

    `documents` has `doc_id` (long, not null), `text`, and `text_hash`.
    """
    spark = documents.sparkSession
    size = total_bytes(documents, "text")
    marks = repeated_filter(documents.select("text"), lambda batch: (first for _, _, first, _ in _row_windows(batch, width)), size // 6)
    # One copy per executor; its size is fixed by the sketch, not by the data.
    shared = spark.sparkContext.broadcast(marks)
    slices = max(1, -(-size // SLICE_BYTES))
    rows = documents.select("doc_id", "text_hash", "text").mapInArrow(_candidates(slices, width, lambda: shared.value), "slice int, decided boolean, payload binary")
    lost = rows.groupBy("slice").applyInArrow(_exact(slices), "bucket int, payload binary")
    return lost.groupBy("bucket").applyInArrow(_gathered, "doc_id long, text_hash long, starts array<int>")


def _keep(width: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            counts, removed, kept, texts = [], [], [], []
            for text, places in zip(batch.column("text"), batch.column("places"), strict=True):
                data = unsqueezed(text.as_py())
                texts.append(None if data is None else data.decode())
                found = (data or b"").split()
                gone = 0
                if places.is_valid and len(found):
                    starts = places.values.to_numpy()
                    change = np.zeros(len(found) + 1, np.int64)
                    np.add.at(change, starts, 1)
                    np.add.at(change, np.minimum(starts + width, len(found)), -1)
                    stays = np.cumsum(change[:-1]) == 0
                    gone = len(found) - int(stays.sum())
                    counts.append(len(found))
                    found = [found[i] for i in np.flatnonzero(stays)]
                else:
                    counts.append(len(found))
                removed.append(gone)
                kept.append(b" ".join(found).decode())
            own = {"text": pa.array(texts, pa.string()), "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string())}
            yield pa.RecordBatch.from_arrays([own[f.name] if f.name in own else batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    return run


def remove_repeats(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, carry: Sequence[str] = ()) -> DataFrame:
    """Drop every word covered by a `width`-word window that also starts in a document of smaller id.

    One row per row of `documents`: `doc_id`, the columns named in `carry` (as `carried`, a struct), `text`,
    `n_words`, `n_removed`, `kept_text` (kept words joined by one space). Words are split at ASCII white space
    and compared as they are; windows are judged on the input.

    - null text: no words, `kept_text` empty; a text shorter than a window keeps all its words;
    - null id: takes no part, keeps everything; rows of the same id never remove each other's words,
      and equal rows give equal results;
    - an empty table gives an empty result; columns of `documents` that are not named are ignored.
    """
    carried = F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]) if carry else F.lit(None).cast("string")
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), carried.alias("carried")).withColumn("text_hash", F.xxhash64("text"))
    places = repeated_windows(rows.where("doc_id IS NOT NULL"), width)
    joined = squeezed(rows).join(places, ["doc_id", "text_hash"], "left").select("doc_id", "carried", "text", F.col("starts").alias("places"))
    out = T.StructType([*joined.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return joined.mapInArrow(_keep(width, to_arrow_schema(out)), out)
