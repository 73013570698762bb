"""Licenses, top-k, decontamination and archives on awkward input."""

import random
import re
from functools import lru_cache

import numpy as np
import pytest

from rangehaul.llm import topk, warc
from rangehaul.llm.decontam import contaminated, decontaminated
from rangehaul.llm.licenses import license_scan
from tests.llm.fixtures import awkward, documents


def test_license_scan(spark):
    rows = [
        (1, None), (2, ""), (3, "MIT License. mit\nlicense; General PUBLIC license"), (3, "MIT License. mit\nlicense; General PUBLIC license"),
        (None, "x Apache License y"), (4, "This is licensed under the apache LICENSE, version 2.0 of it " + "pad " * 5000), (5, "mitlicense mit-license mıt license"),
        (6, "licensed under cc by\nnc 4 0"), (7, "Licensed under the Apache License"), (8, "all RIGHTS, reserved; rights"),
    ]
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 3)) for r in license_scan(documents(spark, rows)).collect()]
    twice = (3, 7, 3, 0, 4, "gpl,mit", "gpl,mit", 1.0)
    assert sorted(got, key=repr) == sorted(
        [
            (1, 0, 0, None, None, "", "", 0.0), (2, 0, 0, None, None, "", "", 0.0), twice, twice, (None, 4, 1, 1, 1, "apache", "apache", 1.0),
            (4, 5012, 1, 5, 5, "apache", "apache,apache-2.0", 1.0), (5, 5, 1, 1, 1, "mit", "mit", 1.0), (6, 7, 0, None, None, "", "", 0.0),
            (7, 5, 1, 3, 3, "apache", "apache", 1.0), (8, 4, 0, None, None, "", "all-rights-reserved", 1.0),
        ],
        key=repr,
    )
    assert license_scan(documents(spark, [])).collect() == []


def test_license_scan_of_wrapped_notices(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\")"
    bsd = " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:"
    mpl = "# This Source Code Form is subject to the terms of the Mozilla Public\r\n# License, v. 2.0. If a copy"
    gpl = "you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n\nthe Free Software Foundation; either version 2 of the License, or"
    pad = "\n".join("some other line of text" for _ in range(40))
    texts = [f"{before}{text}{behind}" for text in (mit, bsd, mpl, gpl) for before in ("", pad + "\n", pad + "\n\n") for behind in ("", "\n" + pad)]
    # The words of a notice, but far from each other.
    texts += ["\n\n".join(f"{word}\n\n{pad}" for word in mit.split()), "Released under the\nMIT License", None, ""]
    frame = documents(spark, list(enumerate(texts)))
    labels = {r.doc_id: set(r.labels.split(",")) - {"", "gpl", "mit"} for r in license_scan(frame, spanning=True).collect()}
    names = ["mit-permission", "bsd", "mpl-2.0", "gpl-2.0-or-later"]
    assert labels == {**{k: {names[k // 6]} for k in range(24)}, 24: set(), 25: {"mit-notice"}, 26: set(), 27: set()}
    # By lines, as the SQL has it, they are not found.
    assert not any(set(r.labels.split(",")) & set(names) for r in license_scan(frame).collect())


@pytest.mark.parametrize("blocks", [(2048, 256), (3, 2)])
def test_top_k(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(topk, "QUERY_ROWS", blocks[1])
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)], "e") for i in range(90)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5], "hot") for i in range(100, 140)] + [(i, [3e3, -2e3, 0.0, 1.0], "long") for i in (200, 201)]
    rows += [(300, None, "n"), (301, [1.0, None, 0.0, 0.0], "n"), (302, [float("nan")] * 4, "n"), (303, [float("inf")] * 4, "n"), (None, [1.0] * 4, "n"), (400, [1.0, 2.0], "two"), (410, [1.0, 3.0], "two"), (103, [0.5, 0.5, 0.5, 0.5], "again")]
    vectors = topk.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string"), "vec_id", "embedding")
    got = topk.top_k(vectors, vectors.where("vec_id % 10 = 0")).collect()
    plain = [(r.vec_id, r.v) for r in vectors.collect()]
    assert len(plain) == len(rows) - 5
    expected = []
    for q, v in plain:
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in plain if i != q and len(w) == len(v))
            expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_top_k_prunes_clusters(spark):
    """Well-clustered vectors: exact, with under a third of the pairs scored."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 4
    centres *= (6 / np.linalg.norm(centres, axis=1))[:, None]
    x = np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 16)) * 0.05
    vectors = topk.quantized(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), "vec_id", "embedding")
    scored = []
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), scored=scored).collect()
    v = np.floor(x * 256).astype(np.int64)
    expected = []
    for q in range(0, 2000, 50):
        scores = v @ v[q]
        best = sorted((-int(scores[i]), i) for i in range(2000) if i != q)[:5]
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == expected
    assert sum(scored) / (40 * 2000) < 0.3 and len(scored) > 2


def test_top_k_of_long_products(spark):
    wide = lambda *rows: spark.createDataFrame(list(rows), "vec_id long, v array<long>")
    exact = topk.top_k(wide((1, [2**31, 2**30]), (2, [2**31, -(2**30)]), (3, [1, 2])), wide((1, [2**31, 2**30]))).collect()
    assert [(r.rank, r.vec_id, r.score) for r in exact] == [(1, 2, 2**62 - 2**60), (2, 3, 2**31 + 2**31)]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_k(wide((1, [2**40, 2**40]), (2, [2**40, 2**40])), wide((1, [2**40, 2**40]))).collect()


def test_top_k_of_nothing(spark):
    vectors = topk.quantized(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding")
    assert topk.top_k(vectors, vectors).collect() == []


def test_contamination(spark):
    rng = random.Random(2)
    line = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    items = [(1, line(9)), (2, line(40)), (3, line(200)), (4, "too short"), (5, None), (None, line(30)), (2, line(12)), (7, "Same, same; SAME same same same")]
    rows = [(i, t) for i, t in awkward()]
    for k, (_, text) in enumerate(items):
        if text and len(text.split()) > 5:
            words = text.upper().split()
            rows += [(1000 + k, line(700) + " " + " ".join(words) + "! " + line(700)), (1100 + k, line(30) + ", " + " ".join(words[: int(len(words) * 0.9)])), (1200 + k, " ".join(words[: len(words) // 2]) + " " + line(60))]
    # An item in two halves, far from each other.
    words = items[2][1].split()
    rows += [(2000, " ".join(words[:100]) + " " + line(900) + " " + " ".join(words[100:])), (None, items[1][1]), (2001, items[0][1]), (2001, items[0][1])]
    tokens = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").lower()) if w]
    @lru_cache(None)
    def sets(t):
        words = tokens(t)
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    expected = {}
    for i, text in rows:
        for j, item in items:
            if sets(item) and len(sets(text) & sets(item)) / len(sets(item)) >= 0.75:
                expected[(i, j)] = max(expected.get((i, j), (0,)), (len(sets(text) & sets(item)) / len(sets(item)), len(sets(text) & sets(item)), len(sets(item))))
    docs, bench = documents(spark, rows), spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id): (r.containment, r.n_shared, r.n_item) for r in contaminated(docs, bench).collect()}
    assert got == expected and len(got) > 12
    clean = decontaminated(docs, bench)
    held = lambda t: any(sets(x) and len(sets(t) & sets(x)) / len(sets(x)) >= 0.75 for _, x in items)
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == sorted(((i, t) for i, t in rows if not held(t)), key=repr)
    assert contaminated(documents(spark, []), bench).collect() == [] and contaminated(docs, bench.limit(0)).collect() == []


def test_contamination_by_the_shortest_items(spark):
    rng = random.Random(5)
    line = lambda n: " ".join(f"w{rng.randrange(100000)}" for _ in range(n))
    # Every tenth begins with the same words.
    items = [(k, ("the same first five words " if k % 10 == 0 else "") + line(5 if k % 4 else 8)) for k in range(500)]
    rows = [(k, f"{line(40)} {text} {line(40)}") for k, text in items]
    # Three of four shingles: the last word is another.
    rows += [(1000 + k, f"{line(30)} {text.rsplit(' ', 1)[0]} {line(30)}") for k, text in items if len(text.split()) == 8]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(documents(spark, rows), bench).collect()}
    assert got == {(i, i % 1000) for i, _ in rows}


PAGES = [(1, "http://a/é\r\n", "<p>same</p>"), (2, None, "<p>same</p>"), (9, "http://b", "<p>same</p>"), (9, "http://b", "<p>same</p>"), (3, "", None), (4, "http://c", ""), (None, "http://d", "<p>same</p>"), (5, "http://e", "WARC/1.1\r\nfake: x\r\n\r\n" + "é" * 90000)]


def test_archives(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string")
    got = sorted(((r.record_id, r.payload_bytes, r.record_type, r.refers_to, r.failed) for r in warc.archived(pages).collect()), key=repr)
    name = lambda x: f"urn:page:{x}"
    same = len("<p>same</p>")
    assert got == sorted(
        [(name(1), same, "revisit", name(9), None), (name(2), same, "revisit", name(9), None), (name(9), same, "response", None, None), (name(9), same, "response", None, None), (name(3), 0, "revisit", name(4), None)]
        + [(name(4), 0, "response", None, None), (name("none"), same, "response", None, None), (name(5), len(PAGES[-1][2].encode()), "response", None, None)],
        key=repr,
    )
    assert warc.archived(pages.limit(0)).collect() == []


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(tmp_path, packed):
    import zlib

    def pack(data):
        packer = zlib.compressobj(6, wbits=31)
        return packer.compress(data) + packer.flush()

    records = [warc.record("response", f"urn:page:{k}", f"http://x/{k}", (f"page {k} " * 400).encode()) for k in range(6)]
    # A whole record inside a payload is found only when the record around it is broken.
    records[3] = warc.record("response", "urn:page:3", "http://x/3", b"before\n" + records[5] + b"after")
    parts = [pack(r) if packed else r for r in records]
    begins = [sum(map(len, parts[:k])) for k in range(7)]

    def read(data):
        path = tmp_path / "a.warc"
        path.write_bytes(bytes(data))
        import pyarrow as pa

        with pa.OSFile(str(path)) as file:
            return [(r["start"], r["end"], r.get("record_id"), r.get("failed")) for r in warc.Archive(file).records()]

    whole = bytearray(b"".join(parts))
    sound = [(begins[k], begins[k + 1], f"urn:page:{k}", None) for k in range(6)]
    assert read(whole) == sound and read(b"") == []
    hurt = bytearray(whole)
    hurt[begins[1] + len(parts[1]) // 2] ^= 0x55
    found = read(hurt)
    assert [f[:3] for f in found if f[3] is None] == [s[:3] for s in sound if s[2] != "urn:page:1"]
    assert [f[:2] for f in found if f[3]] == [(begins[1], begins[2])]
    # Junk in front, a cut at the end.
    found = read(b"junk" * 999 + b"jun\n" + whole[: begins[5] + 50])
    assert found[0][:2] == (0, 4000) and found[-1][3] and [f[2] for f in found if f[3] is None] == [f"urn:page:{k}" for k in range(5)]
    # A lost stretch over two records.
    found = read(whole[: begins[1] + 30] + whole[begins[3] - 20 :])
    assert [f[2] for f in found if f[3] is None] == ["urn:page:0", "urn:page:3", "urn:page:4", "urn:page:5"]
    covered = sorted(f[:2] for f in found)
    assert covered[0][0] == 0 and all(a[1] == b[0] for a, b in zip(covered, covered[1:]))


def _packed(*records, level=6):
    import zlib

    packer = zlib.compressobj(level, wbits=31)
    return packer.compress(b"".join(records)) + packer.flush()


def _salvaged(tmp_path, data):
    import pyarrow as pa

    (tmp_path / "b.warc").write_bytes(bytes(data))
    with pa.OSFile(str(tmp_path / "b.warc")) as file:
        return list(warc.Archive(file).records())


@pytest.mark.parametrize("held", [1 << 20, 5000])
@pytest.mark.parametrize("level", [0, 6])
def test_records_that_share_a_member(tmp_path, monkeypatch, held, level):
    monkeypatch.setattr(warc, "MEMBER_BYTES", held)
    monkeypatch.setattr(warc, "READ_BYTES", 3000)
    rng = random.Random(7)
    records = [warc.record("response", f"urn:page:{k}", f"http://x/{k}", bytes(rng.choice(b"abcdefgh ") for _ in range(4000))) for k in range(5)]
    places = [sum(map(len, records[:k])) for k in range(6)]
    whole = _packed(*records, level=level)
    names = lambda found: [f["record_id"] for f in found if not f.get("failed")]
    found = _salvaged(tmp_path, whole + _packed(records[0]))
    assert names(found) == [f"urn:page:{k}" for k in (0, 1, 2, 3, 4, 0)] and not any(f.get("failed") for f in found)
    assert [(f["start"], f["end"], f["inner_start"], f["inner_end"]) for f in found[:5]] == [(0, len(whole), places[k], places[k + 1]) for k in range(5)]
    # A damaged record in a sound member: first, and between others.
    for k in (0, 2):
        hurt = [*records]
        hurt[k] = hurt[k].replace(b"Content-Length: 4", b"Content-Length: 9", 1) if k else b"X" + hurt[k][1:]
        found = _salvaged(tmp_path, _packed(*hurt, level=level))
        assert names(found) == [f"urn:page:{x}" for x in range(5) if x != k]
        assert [(f["inner_start"], f["inner_end"]) for f in found if f.get("failed")] == [(places[k], places[k + 1])]
    # Whole records before a cut, each once, and the member behind a damaged one.
    found = _salvaged(tmp_path, whole[: len(whole) * 3 // 5])
    assert names(found) == ["urn:page:0", "urn:page:1"] + ["urn:page:2"] * (len(names(found)) - 2) and found[-1]["failed"] == "gzip end"
    broken = bytearray(whole)
    broken[-6] ^= 1
    found = _salvaged(tmp_path, bytes(broken) + _packed(records[3]))
    assert names(found) == [f"urn:page:{k}" for k in (0, 1, 2, 3, 4, 3)]
    assert [f["failed"] for f in found if f.get("failed")] == ["gzip member"]
    # Without a digest nothing of such a member is sure.
    bare = [re.sub(rb"WARC-(Payload|Block)-Digest: .*\r\n", b"", r) for r in records]
    broken = bytearray(_packed(*bare, level=6))
    broken[-6] ^= 1
    assert names(_salvaged(tmp_path, broken)) == []
    assert len(names(_salvaged(tmp_path, _packed(*bare, level=6)))) == 5


def test_digests_and_headers_of_others(tmp_path):
    import base64
    import hashlib

    made = warc.record("response", "urn:page:1", "http://x/1", b"some payload")
    block = made.partition(b"\r\n\r\n")[2][:-4]
    swapped = lambda digest: re.sub(rb"Block-Digest: \S+", b"Block-Digest: " + digest.encode(), made)
    coded = lambda name, how: how(hashlib.new(name, block).digest()).decode()
    good = ["sha256:" + coded("sha256", base64.b16encode).lower(), "SHA-256:" + coded("sha256", base64.b32encode), "md5:" + coded("md5", base64.b32encode).rstrip("="), "md5:" + coded("md5", base64.b64encode)]
    good += ["sha1:" + coded("sha1", base64.b16encode), "sha1:" + coded("sha1", base64.b32encode).lower(), "tiger:abc"]
    for digest in good:
        assert [f.get("failed") for f in _salvaged(tmp_path, _packed(swapped(digest)))] == [None], digest
    for digest in ("sha256:" + "0" * 64, "md5:abc", "sha1:" + "A" * 32):
        assert [f["failed"] for f in _salvaged(tmp_path, _packed(swapped(digest)))] == ["block digest"], digest
    far = "http://x/" + "a" * (3 << 20)
    for data in (warc.record("response", "urn:page:2", far, b"page"), _packed(warc.record("response", "urn:page:2", far, b"page"))):
        found = _salvaged(tmp_path, data + made)
        assert [(f["record_id"], f["target_uri"]) for f in found] == [("urn:page:2", far), ("urn:page:1", "http://x/1")]
