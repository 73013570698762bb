"""Toxicity, SentencePiece sampling, language, and the pipeline."""

import itertools
import math
import random
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rangehaul.llm import language, pieces as sp
from rangehaul.llm.arrays import text_chunks
from rangehaul.llm.language import address, declared, identify, visible
from rangehaul.llm.toxicity import _features, fit, label_model, toxicity
from tests.llm.fixtures import awkward, documents


def labelled(spark, count=900, seed=4):
    rng = random.Random(seed)
    clean = [f"wort{k}" for k in range(400)]
    bad = ["vileness", "wretchpig", "wretchfool", "scumbag"]
    rows, labels = [], []
    for i in range(count):
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.25
        for _ in range(2 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_rows_held_out(spark):
    rows, labels = labelled(spark)
    rows += [(5000, None), (5001, ""), (None, rows[0][1]), (0, rows[0][1])]
    marks = spark.createDataFrame(labels + [(7, 1, None), (None, 1, 1), (8, 0, 5)], "doc_id long, quality int, toxic int")
    found = toxicity(documents(spark, rows), marks, carry=["score"]).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    truth = {i: t for i, _, t in labels}
    out = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in out) / len(out) > 0.97
    by_text = {}
    assert all(by_text.setdefault(r.text, r.score) == r.score for r in found)
    assert len({r.score for r in found if not r.text}) == 1


def test_toxicity_without_labels(spark):
    docs = documents(spark, [(1, "a b c"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert len({r.score for r in toxicity(docs, none).collect()}) == 1
    assert toxicity(docs.limit(0), none).collect() == []


def parts_of(text):
    """Words of a text and their beginnings of 4, 5 and 6 letters."""
    words = {w for w in "".join(c.lower() if c.isalnum() else " " for c in text or "").split()}
    return {(w, 0) for w in words} | {(w[:n], n) for w in words for n in (4, 5, 6) if len(w) > n}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lexicon_and_scores_by_brute_force(spark, seed):
    rows, labels = labelled(spark, 600, seed)
    rows += [(10_000 + k, t) for k, t in enumerate(("", "WRETCHPIG !!! WRETCHPIG", "vileness", "wort1 wort1 wort1", "ü vileness ü"))]
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model, truth = fit(docs, marks), {i: t for i, _, t in labels}
    sample = [(parts_of(t), truth[i]) for i, t in rows if i in truth and zlib.crc32(str(i).encode()) % 3 != 1]
    hits, bad = Counter(p for parts, _ in sample for p in parts), Counter(p for parts, toxic in sample if toxic for p in parts)
    share = sum(t for _, t in sample) / len(sample)
    told = lambda p: bad[p] * math.log(bad[p] / hits[p] / share) + ((hits[p] - bad[p]) * math.log((1 - bad[p] / hits[p]) / (1 - share)) if hits[p] > bad[p] else 0)
    expected = {p for p in bad if bad[p] >= 3 and bad[p] / hits[p] > 0.7 and told(p) > math.log(len(bad))}
    assert len(model.hashes) == len(expected) == len(model.weights) and {w for w, n in expected if not n} >= {"vileness", "wretchpig", "wretchfool", "scumbag"}
    # The weight of an entry is what a text of the entry alone shows; scores are then sums over a text's entries and its patterns.
    weights = dict(zip(model.hashes.tolist(), model.weights.tolist(), strict=True))
    own = {}
    for word in {w for t in (t for _, t in rows) for w, n in parts_of(t) if not n}:
        chunk = next(iter(text_chunks(pa.array([word]))))
        own[word] = {int(h) for h in _features(chunk)[1]}
    for r in toxicity(docs, marks).collect():
        text = r.text or ""
        plain = "".join(c.lower() if c.isalnum() else " " for c in text).split()
        size = max(1, len(text.encode()))
        patterns = [sum("A" <= c <= "Z" for c in text) / size, text.count("!") / size, sum(a == b for a, b in itertools.pairwise(plain)) / max(1, len(plain))]
        z = model.bias + sum(a * b for a, b in zip(patterns, model.pattern_weights, strict=True)) + sum(weights.get(h, 0) for h in set().union(*(own[w] for w in plain)))
        assert abs(r.score - 1 / (1 + math.exp(-max(-40, min(40, z))))) < 1e-9
    out = [(r.predicted, truth[r.doc_id]) for r in toxicity(docs, marks).where("held_out").collect() if r.doc_id in truth]
    assert sum(p for p, t in out if t) / sum(t for _, t in out) > 0.9 and sum(p for p, t in out if not t) <= 0.02 * len(out)


def test_rare_toxic_words_among_many_common_ones(spark):
    """Over 20,000 common words and beginnings, each in more toxic rows than the word that tells them."""
    rng = random.Random(8)
    common = [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{k}word" for k in range(9000)]
    rows = [(i, " ".join(rng.sample(common, len(common)) + (["vexkrull"] if i % 2 == 0 and i < 80 else []))) for i in range(0, 160)]
    docs = documents(spark, [*rows, (900, "vexkrull"), (901, "harmless")])
    marks = spark.createDataFrame([(i, 1, int(i % 2 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    model = fit(docs, marks)
    assert 1 <= len(model.hashes) <= 4
    score = {r.doc_id: r.score for r in toxicity(docs, marks).where("doc_id >= 900").collect()}
    assert score[900] > score[901]


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.2
    rates = [(0.7, 0.02), (0.5, 0.01), (0.6, 0.1), (0.4, 0.02)]
    votes = np.stack([np.where(truth, rng.random(4000) < a, rng.random(4000) < b) for a, b in rates], 1).astype(np.int8)
    votes = np.concatenate((votes, votes[:, :1]), 1)  # one voter says it twice
    posterior, high, low, weight = label_model(votes, 0.2)
    assert abs(high[1] - 0.5) < 0.12 and low[1] < 0.06 and weight[0] < 0.8 * weight[1]
    assert ((posterior > 0.5) == truth).mean() > 0.93


@pytest.fixture(scope="module")
def lattice():
    return sp.Lattices(sp.pieces(sp.MODEL))


def enumerated(lattice, text):
    units = lattice.vocabulary.unit.findall(" " + text)
    if new := set(units) - lattice.known.keys():
        lattice.add(sorted(new))

    def paths(node):
        if node < 0:
            yield (), 0.0
            return
        for arc in range(lattice.first[node], lattice.first[node + 1]):
            for ids, log in paths(lattice.next[arc]):
                yield (int(lattice.piece[arc]), *ids), log + math.log(lattice.p[arc])

    starts = [lattice.known[u] for u in units]
    return starts, {tuple(itertools.chain(*[c[0] for c in combo])): sum(c[1] for c in combo) for combo in itertools.product(*[list(paths(s)) for s in starts])}


def test_new_units_are_built_once(lattice):
    units = [" first", "  built", " first", "Ωx", " again", "Ωx"]
    starts = lattice.starts(units)
    arcs = lattice.arcs
    assert starts.tolist() == [lattice.known[u] for u in units] and starts.min() >= 0
    assert lattice.starts(units[::-1]).tolist() == starts[::-1].tolist() and lattice.arcs == arcs
    for node in starts.tolist():
        assert (np.diff(lattice.p[lattice.first[node] : lattice.first[node + 1]]) <= 0).all()


def test_units_that_do_not_come_again_are_forgotten():
    lattice, fresh = sp.Lattices(sp.pieces(sp.MODEL)), sp.Lattices(sp.pieces(sp.MODEL))
    common, rare = [" the", " cat", " Ωx", "é鿿", " 𝕏▁"], [f" w{i}é鿿" for i in range(200)]
    lattice.starts(rare[:100] + common + rare[100:])
    lattice.starts(common)
    lattice.forget()
    assert list(lattice.known) == common
    fresh.starts(common)
    assert (lattice.nodes, lattice.arcs) == (fresh.nodes, fresh.arcs) and not lattice.again.any()
    units, keys = common * 40, sp.mix(np.arange(40, dtype=np.uint64))
    # What was kept and what is built behind it give the samples of lattices that forgot nothing.
    for units in (common * 40, (common + rare[:5]) * 40):
        offsets = np.arange(41) * (len(units) // 40)
        for a, b in zip(*(sp.sampled(x, x.starts(units), offsets, keys, 2) for x in (lattice, fresh)), strict=True):
            assert all(np.array_equal(x, y) for x, y in zip(a[2], b[2], strict=True)) and all(np.array_equal(a[k], b[k]) for k in (0, 1, 3, 4))
    lattice.forget()
    lattice.forget()
    assert not lattice.known and lattice.nodes == lattice.arcs == 0


def test_encoding_takes_little_memory(monkeypatch):
    """The table of lattices stays small however many units there are, and so do the arrays of a chunk; samples do not depend on either."""
    rng = random.Random(8)
    texts = [" ".join("the" if rng.random() < 0.3 else f"{rng.getrandbits(40):x}" for _ in range(200)) for _ in range(600)]
    batch = pa.record_batch({"doc_id": list(range(600)), "text": texts, "key": list(range(600))})
    schema = pa.schema([("doc_id", pa.int64()), ("sample", pa.int32()), ("ids", pa.list_(pa.int32())), ("perturbed", pa.float64())])
    held = []
    forget = sp.Lattices.forget
    monkeypatch.setattr(sp.Lattices, "forget", lambda lattice: (held.append(lattice.arcs), forget(lattice)))
    run = lambda: {(i, s): (tuple(x), p) for b in sp._encoded(sp.MODEL, 2, 0, False, schema)([batch]) for i, s, x, p in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    want = run()
    assert len(want) == 1200
    monkeypatch.setattr(sp, "KEEP_ARCS", 1 << 18)
    monkeypatch.setattr(sp, "CHUNK_BYTES", 1 << 16)
    held.clear()
    assert run() == want and len(held) > 2 and max(held) < 1 << 20
    monkeypatch.undo()
    sp.pieces(sp.MODEL)
    tracemalloc.start()
    for _ in sp._encoded(sp.MODEL, 2, 0, False, schema)([batch]):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6


@pytest.mark.parametrize("text", ["the cat", "Ωx", "é鿿", "a  b"])
def test_samples_follow_the_lattice(lattice, text):
    starts, every = enumerated(lattice, text)
    assert math.isclose(sum(map(math.exp, every.values())), 1)
    # Weights of paths are products of piece weights.
    log = lattice.vocabulary.log
    constant = {round(p - sum(log[i] for i in ids), 6) for ids, p in every.items()}
    assert len(constant) == 1
    count, want = 6000, min(3, len(every))
    found = sp.sampled(lattice, np.array(starts * count), np.arange(count + 1) * len(starts), sp.mix(np.arange(count, dtype=np.uint64)), 3)
    assert len(found) == want
    first = Counter(tuple(x.tolist()) for x in found[0][2])
    for ids, p in every.items():
        assert abs(first[ids] / count - math.exp(p)) < 0.03
    drawn = [[tuple(f[2][i].tolist()) for f in found] for i in range(count)]
    assert all(len(set(d)) == want for d in drawn)
    # Inclusion scores make unbiased counts.
    top = max(every, key=every.get)
    weighed = sum(1 / f[4][i] for f in found for i in range(count) if tuple(f[2][i].tolist()) == top)
    assert abs(weighed / count - 1) < 0.05
    assert all(np.all(np.diff([f[1][i] for f in found]) <= 0) for i in range(50))


def test_encode_and_decode(spark):
    rows = awkward() + [(70, "▁literal ▁ mark"), (71, " leading and trailing  "), (72, "x" * 3000), (73, "日本語\n\n𝕏 tail.\tend"), (74, " " * 200)]
    docs = documents(spark, rows)
    found = sp.decode(sp.encode(docs, samples=3, carry=["carried"], keep_text=True, verify=True)).collect()
    assert all(r.decoded == (r.text or "") and r.exact for r in found)
    by_row = Counter((r.doc_id, r.text) for r in found)
    for (i, t), n in by_row.items():
        copies = sum((i, t) == row for row in rows)
        assert n == copies * (1 if not t else 3) if not t or len(t) > 5 else copies <= n <= 3 * copies, (i, t)
    again = {(r.doc_id, r.text, r.sample): (tuple(r.ids), r.perturbed) for r in sp.encode(docs.repartition(3), samples=3, keep_text=True).collect()}
    assert all(again[(r.doc_id, r.text, r.sample)] == (tuple(r.ids), r.perturbed) for r in found)
    assert sp.encode(docs.limit(0)).collect() == []


def test_page_parts():
    assert visible("<script>x<1</script>a&amp;b<!-- <p>no --><p class='x'>c") .split() == ["a&b", "c"]
    assert declared("<!DOCTYPE html><HTML class=a LANG='De-at'>") == "de" and declared("<p lang=fr>") is None
    assert declared('<html><meta http-equiv="Content-Language" content="fr-FR">') == "fr"
    assert address("https://www.a.co.de:80/x") == ("www.a.co.de", "co.de", "de") and address("http://[bad") == (None,) * 3 and address(None) == (None,) * 3
    assert address("http://10.0.0.1/") == ("10.0.0.1", "0.1", None)


def test_broken_markup():
    """Unclosed markup of a megabyte is read in linear time; what closes is cut as before."""
    start = time.monotonic()
    for page in ("<" * 10**6, "<!--" * 250_000, "<script " * 125_000, "<meta content-language " * 45_000, "<html lang= " * 90_000, "<html lang=" + " " * 10**6):
        assert declared(page) is None and visible(page) == page
    assert visible("&#" + "1" * 9999 + ";&#" + "0" * 9999 + "65;") == "\ufffdA"
    assert time.monotonic() - start < 5
    assert visible("a<!--b<p>c") == "a c"
    assert visible("a<script>b<p>c</SCRIPT >d<style>e") == "a d e"
    assert declared("<html <html lang=xxxx lang=it><html lang=fr>") == "it" and declared("<html><meta content=de content-language content=fr content=es-x>") == "es"


def test_posterior_by_hand(spark, data):
    """Every page of the table against the posterior in plain Python."""
    documents_, pages = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "pages"))
    langs, logs = language.fit(documents_.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"))
    rows, k = [], range(len(langs))
    for r in pages.select("page_id", "url", "html").collect():
        grams = language.trigrams(visible(r.html or ""))
        score = [sum(float(logs[x, g]) for g in grams) * min(1, language.EVIDENCE / max(1, len(grams))) for x in k]
        parts = [math.exp(s - max(score)) for s in score]
        rows.append((r.page_id, *address(r.url), declared(r.html or ""), [p / sum(parts) for p in parts]))
    sums = defaultdict(lambda: [0.0] * len(langs))
    for _, *marks, text in rows:
        for level, mark in enumerate(marks):
            for x in k:
                sums[level, mark][x] += text[x] if mark is not None else 0
    everything = [sum(row[-1][x] for row in rows) for x in k]
    want = {}
    for page, host, domain, suffix, tongue, text in rows:
        prior = [max(everything[x] - text[x], 0) + language.SMOOTH for x in k]
        prior = [p / sum(prior) for p in prior]
        for key in ((1, domain), (0, host)):
            own = [max(sums[key][x] - text[x], 0) if key[1] else 0.0 for x in k]
            prior = [(own[x] + language.STRENGTH * prior[x]) / (sum(own) + language.STRENGTH) for x in k]
        likely = lambda key, x: math.log((sums[key][x] + language.SMOOTH) / (everything[x] + language.SMOOTH * 20)) if key[1] else 0.0
        log = [math.log(max(text[x], 1e-300)) + math.log(prior[x]) + likely((2, suffix), x) + likely((3, tongue), x) for x in k]
        want[page] = (langs[log.index(max(log))], 1 / sum(math.exp(v - max(log)) for v in log))
    found = {r.page_id: r for r in identify(pages, documents_).collect()}
    assert found.keys() == want.keys() and len(want) == pages.count()
    for page, (lang, probability) in want.items():
        assert found[page].language == lang and abs(found[page].probability - probability) < 1e-6, page


def test_languages(spark):
    rng = random.Random(5)
    words = {"de": ["schund", "keit", "über", "nicht"], "en": ["thing", "with", "other", "house"]}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    docs = spark.createDataFrame([(i, text(lang, 30), lang) for i, lang in enumerate(["de", "en"] * 40)] + [(None, "x", "de"), (99, None, "en"), (98, "y", None)], "doc_id long, text string, lang string")
    pages = [(i, f"http://h{i % 3}.{'de' if lang == 'de' else 'com'}/x", f"<html lang={lang}>{text(lang, 20)}") for i, lang in enumerate(["de"] * 30 + ["en"] * 30)]
    pages += [(100, "http://h1.de/q", ""), (101, "http://h1.com/q", None), (102, None, None), (103, None, "<html lang=de>"), (104, "http://h1.com/z", f"<html lang=de>{text('en', 40)}"), (None, "::", text("de", 9)), (0, pages[0][1], pages[0][2])]
    found = identify(spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, language string"), docs).collect()
    assert len(found) == len(pages) and all(0.5 <= r.probability <= 1 + 1e-9 for r in found)
    got = {r.page_id: r.language for r in found}
    assert all(got[i] == ("de" if i < 30 else "en") for i in range(60))
    assert (got[100], got[101], got[103], got[104], got[None]) == ("de", "en", "de", "en", "de")
    assert identify(spark.createDataFrame([], "page_id long, url string, html string"), docs).collect() == []
    bare = identify(spark.createDataFrame([(1, None, "x")], "page_id long, url string, html string"), docs.limit(0)).collect()
    assert bare[0].language is None


def test_pipeline(spark, data):
    """Every stage against a plain version of itself on what the one before kept."""
    import re

    import corpus_pipeline
    from tests.llm.test_dedup import brute_components, brute_windows

    docs = spark.read.parquet(f"{data}/documents.parquet")
    docs = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "s", 0)], docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data)
        before, after = docs.collect(), [r for r in out.collect()]
        if name == "toxicity":
            assert set(after) <= set(before) and 0 < len(after)
        elif name == "minhash near-dedup":
            ids = {i for i, _, _, k in brute_components([(r.doc_id, r.text) for r in before]) if k}
            assert sorted({r.doc_id for r in after}, key=repr) == sorted(ids, key=repr) and set(after) <= set(before)
            assert len([r.doc_id for r in after if r.doc_id is not None and (r.text or "").strip()]) == len({r.doc_id for r in after if r.doc_id is not None and (r.text or "").strip()})
        elif name == "substring dedup":
            texts = {(i): kept for i, _, gone, kept in brute_windows([(r.doc_id, r.text) for r in before]) if gone}
            old = {r.doc_id: r.text for r in before}
            assert all(r.text == texts.get(r.doc_id, old[r.doc_id]) for r in after) and len(after) == len(before)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after if r.doc_id in texts)
        elif name == "benchmark decontamination":
            split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").lower()) if w]
            sets = lambda words: {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
            items = [s for r in spark.read.parquet(f"{data}/benchmark.parquet").collect() if (s := sets(split(r.text)))]
            own = [sets(split(r.text)) for r in before]
            clean = [r for r, mine in zip(before, own, strict=True) if all(len(mine & s) < 0.75 * len(s) for s in items)]
            assert sorted(after, key=repr) == sorted(clean, key=repr)
        if name != "sentencepiece encoding":
            assert out.columns == docs.columns
        else:
            vocabulary = sp.pieces(sp.MODEL)
            texts = {r.doc_id: r.text or "" for r in before}
            assert all(vocabulary.decode(np.array(r.ids, np.int64)).decode() == texts[r.doc_id] for r in after)
        docs = spark.createDataFrame(after, out.schema)
