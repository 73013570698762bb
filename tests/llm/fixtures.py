"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string, score string, carried string, text_hash string, places string"


def documents(spark, rows):
    full = [(i, t, "en", "s", None if t is None else len(t), "x", None, "y", "z", "0", None) for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def awkward(seed=0):
    """(doc_id, text) rows; passages of 60 and more words and bytes come again in several of them."""
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma", "délta", "eps,", "zeta.", "Ω", "x"]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = [line(60), line(25), line(14), "be " * 40]
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "one two three four"), (None, shared[0]), (None, None)]
    for i in range(5, 40):
        parts = [line(rng.randrange(30)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(shared))
        rows.append((i, rng.choice(["\n", " ", "  "]).join(parts)))
    rows += [rows[9], rows[9], (9, "another text under the id nine " + shared[1]), (50, rows[20][1]), (51, rows[20][1]), (52, rows[20][1] + " tail"), (-3, shared[2])]
    rows.append((60, line(6000) + " " + shared[0]))
    return rows
