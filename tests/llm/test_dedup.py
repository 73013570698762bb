"""Deduplication operators against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rangehaul.llm import arrays, neardup, sketch, suffixes
from rangehaul.llm.neardup import near_duplicates
from rangehaul.llm.substring import remove_repeats
from rangehaul.llm.suffixes import remove_repeated_strings, suffix_array
from tests.llm.fixtures import awkward, documents

ROWS = awkward()


def keyed(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)


@given(st.lists(st.integers(1, 4), max_size=60))
@settings(max_examples=300, deadline=None)
def test_suffix_array(symbols):
    assert suffix_array(np.array(symbols, np.int64)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@given(st.lists(st.lists(st.integers(0, 2**63), max_size=20), min_size=1, max_size=3), st.integers(16, 24))
@settings(max_examples=50, deadline=None)
def test_sketch_loses_nothing(parts, bits):
    merge = sketch._merged(bits)
    import pyarrow as pa

    strips = {}
    for part in parts:
        held = [tuple(sketch._places(np.array(part, np.uint64), row, bits) for row in range(sketch.ROWS))]
        for strip, counts in sketch._strips(held, bits) if part else ():
            strips.setdefault(strip, []).append(counts)
    marks = np.zeros((sketch.ROWS, (1 << bits) // 8), np.uint8)
    size = (1 << min(bits, sketch.STRIP_BITS)) // 8
    for strip, counts in strips.items():
        out = merge(pa.table({"strip": pa.array([strip] * len(counts), pa.int32()), "counts": pa.array(counts, pa.binary())}))
        marks.reshape(-1)[strip * size : (strip + 1) * size] = np.frombuffer(out["bits"][0].as_py(), np.uint8)
    every = [x for part in parts for x in part]
    twice = np.array([x for x in set(every) if every.count(x) > 1], np.uint64)
    assert sketch.Repeated(bits, marks)(twice).all()


def test_words_are_those_of_python():
    import pyarrow as pa

    texts = ["", None, "a  b\x0bc d", " é ", "x" * 70000, " wide blank"]
    for chunk in arrays.text_chunks(pa.array(texts), 8):
        found = arrays.words(chunk)
        assert [bytes(chunk.data[s:e]) for s, e in zip(found.start, found.end)] == [w for t in texts[chunk.low : chunk.high] for w in (t or "").encode().split()]


def test_pack_keeps_values():
    columns = [np.array([5, -7, 2**62], np.int64), np.array([0, 2**64 - 1, 9], np.uint64), np.array([1, 1, 1], np.int64)]
    for a, b in zip(columns, arrays.unpack(arrays.pack(*columns), np.int64, np.uint64, np.int64)):
        assert (a == b).all()


def brute_windows(rows, width=13):
    own = {}
    for i, text in rows:
        words = (text or "").split() if text is None else re.findall(r"[^\x20\x09-\x0D]+", text)
        for k in range(len(words) - width + 1):
            if i is not None:
                w = tuple(words[k : k + width])
                own[w] = min(own.get(w, i), i)
    out = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        cut = set()
        for k in range(len(words) - width + 1):
            if i is not None and own[tuple(words[k : k + width])] < i:
                cut |= set(range(k, k + width))
        out.append((i, len(words), len(cut), " ".join(w for k, w in enumerate(words) if k not in cut)))
    return sorted(out, key=repr)


def test_substring_dedup(spark):
    found = remove_repeats(documents(spark, ROWS), carry=["lang", "kept", "carried"]).collect()
    assert keyed(found, "doc_id", "n_words", "n_removed", "kept_text") == brute_windows(ROWS)
    assert any(r["n_removed"] for r in found) and {r["carried"]["carried"] for r in found} == {"z"}


def test_suffix_dedup(spark, monkeypatch):
    own = {}
    for i, text in ROWS:
        b = (text or "").encode()
        for k in range(len(b) - 49):
            if i is not None:
                own[b[k : k + 50]] = min(own.get(b[k : k + 50], i), i)
    expected = []
    for i, text in ROWS:
        b = (text or "").encode()
        cut = bytearray(len(b))
        for k in range(len(b) - 49):
            if i is not None and own[b[k : k + 50]] < i:
                cut[k : k + 50] = b"\1" * 50
        expected.append((i, len(b), sum(cut), len(re.findall(b"\1+", cut)), hashlib.sha256(bytes(x for x, c in zip(b, cut) if not c)).hexdigest()))
    found = remove_repeated_strings(documents(spark, ROWS)).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_slices_fill_alike(spark):
    """Smallest grams crowd at the low end of the hash range; slices must not."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefghij ") for _ in range(4000)) for _ in range(10)]
    frame = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id long, text_hash long, text string")
    every = lambda: lambda keys: np.ones(len(keys), bool)
    made = frame.coalesce(1).mapInArrow(suffixes._piece_rows(16, 50, every, np.zeros(0, np.uint64), every), "slice int, decided boolean, payload binary").collect()
    sizes = {r.slice: len(r.payload) for r in made if not r.decided}
    assert len(sizes) == 16 and max(sizes.values()) < 2 * min(sizes.values())


def test_grams_taken_in_turns(monkeypatch):
    """The strings found do not depend on how many grams are compared at a time."""
    rng = np.random.default_rng(5)
    # Equal strings have equal grams: each gram has a text of its own.
    keys = np.sort(rng.integers(0, 12, 80)).astype(np.uint64)
    bases = rng.integers(97, 123, (12, 100)).astype(np.uint8)
    data = np.concatenate([bases[k, a : a + 60] for k, a in zip(keys.astype(int), rng.integers(0, 40, 80))])
    begins, sizes, owners = np.arange(80) * 60, np.full(80, 60), rng.integers(0, 9, 80)
    found = lambda: {(int(p), int(o)) for x, y in suffixes._shared(data, begins, sizes, owners, keys, 50) for p, o in zip(x, y)}
    whole = found()
    monkeypatch.setattr(suffixes, "TURN", 7)
    assert found() == whole and whole


def test_strings_dealt_over_blocks():
    """A gram with more pieces than a suffix array takes gives the same lost strings."""
    rng = np.random.default_rng(3)
    base = rng.integers(97, 100, 400).astype(np.uint8)
    begins, sizes, data = [], [], []
    for k in range(60):
        at = int(rng.integers(0, 330))
        begins.append(sum(sizes))
        sizes.append(int(rng.integers(50, 70)))
        data.append(base[at : at + sizes[-1]])
    sizes = np.array([len(d) for d in data])
    begins, data, owners = np.cumsum(sizes) - sizes, np.concatenate(data), rng.integers(0, 9, 60)
    use = sizes >= 50
    begins, sizes, owners = begins[use], sizes[use], owners[use]
    whole = {(int(p), int(o)) for p, o in zip(*suffixes._equal_strings(data, begins, sizes, owners, 50))}
    dealt = {(int(p), int(o)) for x, y in suffixes._dealt(data, begins, sizes, owners, np.arange(len(sizes)), 50) for p, o in zip(x, y)}
    brute = set()
    strings = {}
    for p, (b, s) in enumerate(zip(begins, sizes)):
        for o in range(s - 49):
            strings.setdefault(bytes(data[b + o : b + o + 50]), []).append((p, o))
    for places in strings.values():
        least = min(owners[p] for p, _ in places)
        brute |= {(p, o) for p, o in places if owners[p] > least}
    assert whole == dealt == brute


def brute_components(rows):
    sets = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    out = []
    for a, (i, _) in enumerate(rows):
        c = None if i is None else min(rows[b][0] for b in range(len(rows)) if rows[b][0] is not None and find(a) == find(b))
        out.append((i, len(sets[a]), c, i is None or c == i))
    return sorted(out, key=repr)


def test_near_duplicates(spark):
    assert keyed(near_duplicates(documents(spark, ROWS)).collect(), "doc_id", "n_shingles", "component_id", "kept") == brute_components(ROWS)


def test_near_duplicates_beyond_the_center(spark, monkeypatch):
    """A chain: each text is like the next, its ends are unlike; blocks of two members."""
    monkeypatch.setattr(neardup, "BLOCK", 2)
    words = [f"w{k}" for k in range(260)]
    rows = [(k + 100, " ".join(words[6 * k : 6 * k + 110])) for k in range(20)] + [(k, " ".join(words[7 * k + 3 : 7 * k + 113])) for k in range(12)]
    found = near_duplicates(documents(spark, rows)).collect()
    assert keyed(found, "doc_id", "n_shingles", "component_id", "kept") == brute_components(rows)


@pytest.mark.parametrize("operator", [remove_repeats, remove_repeated_strings, near_duplicates])
def test_empty_tables(spark, operator):
    assert operator(documents(spark, [])).collect() == []
    assert len(operator(documents(spark, [(1, None), (None, None), (2, "")])).collect()) == 3


def test_heavy_grams_are_spread(spark, monkeypatch):
    import random

    rng = random.Random(11)
    hot = "a very common phrase of the source"
    line = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = [line(20) + hot + line(20) for _ in range(2)]
    rows = [(i, "".join(line(60) + hot for _ in range(8)) + line(60) + (rng.choice(shared) if i % 4 == 0 else "")) for i in range(300)] + [(i, shared[i % 2] * 2) for i in range(300, 320)]
    frame = documents(spark, rows)
    plain = lambda: sorted((r.doc_id, r.n_removed, bytes(r.kept), str(r.spans)) for r in suffixes.remove_repeated_strings(frame).collect())
    expected = plain()
    assert sum(r[1] for r in expected) > 1000
    most, settled = spark.sparkContext.accumulator(0), suffixes._settled

    def counted(length, buckets):
        run = settled(length, buckets)

        def count(table):
            most.add(sum(len(p) for d, p in zip(table.column("decided").to_pylist(), table.column("payload").to_pylist()) if not d))
            return run(table)

        return count

    monkeypatch.setattr(suffixes, "_settled", counted)
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 4000)
    assert plain() == expected
    before, most.value = most.value, 0
    # Strings around the phrase that no other document has travel no more.
    monkeypatch.setattr(suffixes, "HEAVY_PIECES", 20)
    monkeypatch.setattr(suffixes, "SAMPLE", 1)
    assert plain() == expected
    assert most.value < before / 2
