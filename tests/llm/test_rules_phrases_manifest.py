"""Repetition rules, collocations and the manifest against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rangehaul.llm.arrays import text_chunks
from rangehaul.llm.collocations import collocations
from rangehaul.llm.manifest import height, leaf_digest, merkle_manifest
from rangehaul.llm.repetition import LONGEST, measured, repetition, suffix_order
from tests.llm.fixtures import awkward, documents


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def rules(text, width=8):
    words = split(text)
    n = len(words)
    seen = Counter(tuple(words[i : i + width]) for i in range(n - width + 1))
    covered = {j for i in range(n - width + 1) if seen[tuple(words[i : i + width])] > 1 for j in range(i, i + width)}
    common = defaultdict(int)
    repeats = set()
    for i in range(n - 1, -1, -1):
        for j in range(n - 1, i, -1):
            if words[i] == words[j]:
                common[i, j] = size = common[i + 1, j + 1] + 1
                if size >= width and (i == 0 or words[i - 1] != words[j - 1]):
                    repeats.add(tuple(words[i : i + size]))
    lines = [line for line in (text or "").split("\n") if split(line)]
    found = {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "covered_chars": sum(len(words[i]) for i in covered),
        "longest_repeat": max(map(len, repeats), default=0),
        "n_repeats": len(repeats),
    }
    failed = n < 20 or 100 * len(covered) > 30 * n
    return found | {"base_failed": failed, "kept": not failed and 100 * found["covered_chars"] <= 30 * found["word_chars"] and found["longest_repeat"] <= LONGEST}


def repeated_texts(count, seed=3):
    rng = random.Random(seed)
    texts = [None, "", " \n ", "a", "be " * 50, "x y " * 40, "x y z\n" * 9, "# é\n" * 3]
    for _ in range(count):
        vocabulary = ["a", "b", "é", "dd", "#|"][: rng.randrange(1, 6)]
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
        passage = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 30))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    return texts


@pytest.mark.parametrize("limit", [1 << 18, 150])
def test_repeats_in_chunks(limit):
    texts = repeated_texts(80)
    parts = [measured(c) for c in text_chunks(pa.array(texts), limit)]
    for name in parts[0]:
        assert np.concatenate([p[name] for p in parts]).tolist() == [rules(t)[name] for t in texts], name


def test_suffix_order():
    rng = random.Random(1)
    for _ in range(60):
        texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(4)]
        symbols = np.array([k * 10 + w for k, t in enumerate(texts) for w in t])
        ends = np.repeat(np.cumsum([len(t) for t in texts]), [len(t) for t in texts])
        order, shared = suffix_order(symbols, ends, 4)
        suffixes = [symbols[i : ends[i]].tolist() for i in range(len(symbols))]
        assert order.tolist() == sorted(range(len(symbols)), key=lambda i: suffixes[i])
        pairs = [(suffixes[a], suffixes[b]) for a, b in zip(order[:-1], order[1:], strict=True)]
        assert shared.tolist() == [False] + [len(a) >= 4 and a[:4] == b[:4] for a, b in pairs]


def test_repetition(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(900)]
    twice = " ".join(words[:700] + words[:101] + words[700:])
    rows = [(i, t) for i, t in enumerate(repeated_texts(20))] + awkward()[:-1] + [(70, twice), (71, " ".join(words))]
    found = repetition(documents(spark, rows)).collect()
    expected = [(i, *rules(t).values()) for i, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    by_id = {r.doc_id: r for r in found}
    assert by_id[70].longest_repeat == 101 and not by_id[70].base_failed and not by_id[70].kept and by_id[71].kept
    assert repetition(documents(spark, [])).count() == 0


def test_long_repeats_stay_cheap():
    half = " ".join(str(i % 7919) for i in range(200_000))
    (found,) = [measured(c) for c in text_chunks(pa.array([half + " z " + half]))]
    assert found["longest_repeat"][0] == 200_000 and found["n_repeat_words"][0] == 400_000


def phrases(rows, least, top):
    counts, totals = Counter(), Counter()
    lowered = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lowered)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    often = {p: a for p, a in counts.items() if a >= least}
    out = defaultdict(list)
    for (lang, p), a in often.items():
        longer = [b for (other, q), b in often.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if len(p) < 2 or any(b >= a for b in longer):
            continue
        n = totals[lang]
        score, _, left, right = min((1000 * a * n // (often[lang, p[:k]] * often[lang, p[k:]]), k, often[lang, p[:k]], often[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), left, right, n))
    return sorted((lang, rank, p.decode(), -a, left, right, n, -score) for lang, own in out.items() for rank, (score, a, p, left, right, n) in enumerate(sorted(own)[:top], 1))


@pytest.mark.parametrize(("least", "top", "slice_bytes"), [(4, 2000, 500), (9, 7, 1 << 24)])
def test_collocations(spark, least, top, slice_bytes):
    rng = random.Random(2)
    vocabulary = ["the", "The", "of", "é", "a", "x\x85y", "zz", "Ä", "q"]
    texts = []
    for _ in range(120):
        words = rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rng.randrange(40))
        marks = [w + rng.choice(["", "", "", ",", ".", "\n", ";\t", "\x0b", "!?"]) for w in words]
        texts.append((rng.choice(["en", "de", None, "und"]), rng.choice([" ", "\t", "  "]).join(marks)))
    texts += [("en", None), ("fr", ""), ("fr", "lonely"), (None, "the " * 200), ("en", "of the zz of " * 300), texts[0], texts[0]]
    rows = [(i, t, lang, "s", 1, "x", None, "y", "z", "0", None) for i, (lang, t) in enumerate(texts)]
    frame = spark.createDataFrame(rows, documents(spark, []).schema).repartition(5)
    found = collocations(frame, least=least, top=top, slice_bytes=slice_bytes)
    assert sorted(map(tuple, found.collect())) == phrases(texts, least, top)


def test_no_collocations(spark):
    assert collocations(documents(spark, [])).count() == 0
    assert collocations(documents(spark, awkward()[:5])).count() == 0


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows):
    """rows: key, group, leaf, changed."""

    def grow(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def climb(levels, at, digest):
        others = ""
        for level in levels[:-1]:
            low = at // 8 * 8
            run = level[low : low + 8]
            others += "".join(run[: at - low] + run[at - low + 1 :])
            digest = sha(*run[: at - low], digest, *run[at - low + 1 :])
            at //= 8
        return digest, others

    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    trees = {g: grow([r[2] for r in own]) for g, own in groups.items()}
    crown = grow([trees[g][-1][0] for g in names])
    for k, g in enumerate(names):
        for at, (key, _, leaf, changed) in enumerate(groups[g]):
            digest, others = climb(trees[g], at, changed or leaf)
            digest, above = climb(crown, k, digest)
            yield key, leaf, trees[g][-1][0], crown[-1][0], sha(others + above), digest, digest == crown[-1][0]


@pytest.mark.parametrize("block_levels", [1, 2, 4])
def test_manifest(spark, block_levels):
    rng = random.Random(4)
    langs = [None, "", "en", "de", "Zz", "é", *[f"l{i}" for i in range(12)]]
    rows = [(rng.choice([None, *range(300)]), rng.choice(langs[:6] + ["en"] * 9), f"t{rng.randrange(40)}") for _ in range(700)]
    rows += [(1, g, "only") for g in langs[6:]] + [rows[0]] * 20 + [(5, "en", None), (5, "en", "")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, lang string, text string, leaf string, at string").repartition(3)
    leaf = leaf_digest([F.col("doc_id"), F.col("text")])
    changed = F.when(F.col("doc_id") % 3 == 0, leaf_digest([F.col("doc_id"), F.upper("text")]))
    found = sorted(map(tuple, merkle_manifest(frame, "doc_id", "lang", leaf, changed, block_levels).collect()), key=repr)
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    plain = [(k, g, sha(text(k), text(t)), sha(text(k), text(t and t.upper())) if k is not None and k % 3 == 0 else None) for k, g, t in rows]
    assert found == sorted(manifest(plain), key=repr)
    assert 0 < sum(r[-1] for r in found) < len(found)


def test_manifest_of_little(spark):
    schema = "doc_id long, lang string, text string"
    one = merkle_manifest(spark.createDataFrame([(7, None, "t")], schema), "doc_id", "lang", leaf_digest([F.col("text")])).collect()
    assert [tuple(r) for r in one] == [(7, sha("1:t"), sha("1:t"), sha("1:t"), sha(""), sha("1:t"), True)]
    assert merkle_manifest(spark.createDataFrame([], schema), "doc_id", "lang", leaf_digest([F.col("text")])).count() == 0
    assert [height(n) for n in (1, 2, 8, 9, 64, 65)] == [0, 1, 1, 2, 2, 3]
