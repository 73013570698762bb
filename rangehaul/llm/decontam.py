"""Benchmark decontamination: short test items found inside long documents, in DataFrame functions only.

Items are partitioned by size: class c holds items of 4**c < n <= 4**(c+1) five-word shingles. For each class a document
is seen as windows of 4 * 4**(c+1) shingles that overlap by a quarter, so that a copied item lies whole in one window of
comparable size; against the whole of a long document its Jaccard similarity would vanish. Windows and items are
sketched by one-permutation MinHash: shingle hashes fall into 256 bins by their top byte, and each bin keeps its
minimum. A window and an item of its class are candidates when the minimum of some bin agrees. Candidates are verified on
whole sets of shingle texts.

Too few bins can agree for items of up to `EXACT` shingles, so these do without windows: of n shingles k must be shared, so one
of any n - k + 1 is in the document. Those held by the fewest items are looked up, and each find is a candidate: none is missed.
For larger items misses were counted in random trials with 75 % of the item in one full window: none in 400,000 at 17 shingles and
in 200,000 at 64, none in 100,000 at 65 and in 50,000 at 256, none in 30,000 at 257 and in 20,000 at 1024. Classes above were not measured.

A bin can only agree where the document holds an item's minimum at all. So the one pass over the corpus looks every shingle
up among these and the former, without a shuffle while the items are few (`BROADCAST_ROWS`), and only windows with a find are sketched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rangehaul.llm.store import written

SHINGLE = 5
CONTAINMENT = 0.75
BINS = 256
# Items of so many shingles or fewer are candidates by single shingles; a class boundary.
EXACT = 16
# Item minima that are broadcast: 16 bytes each. More are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

# Digits, letters and everything outside ASCII belong to words.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def shingles(rows: DataFrame, *keys: str) -> DataFrame:
    """`keys`, `place` and the words `s` (a struct) of each shingle of `text`; the array of words is built once per row."""
    split = rows.select(*keys, F.explode(F.array(F.array_remove(F.split(F.lower("text"), BREAKS), ""))).alias("w"))
    columns = [F.col("w") if i == 0 else F.slice("w", i + 1, 2**31 - 1 - i).alias(f"w{i}") for i in range(SHINGLE)]
    return split.where(F.size("w") >= SHINGLE).select(*keys, F.posexplode(F.arrays_zip(*columns)).alias("place", "s")).where(f"s.w{SHINGLE - 1} IS NOT NULL")


def _bin(value):
    return F.shiftrightunsigned(value, 64 - (BINS.bit_length() - 1))


def contaminated(documents: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_id: str = "item_id", item_text: str = "text", least: float = CONTAINMENT) -> DataFrame:
    """Pairs of document and item where the document holds `least` or more of the item's shingles.

    Columns: `doc_id`, `item_id`, `n_shared`, `n_item` (distinct shingles), `containment`; each pair of ids once, with its greatest
    containment. Words are lower-cased runs of letters and digits.

    - null or short texts (under five words) hold nothing, and such items are found nowhere;
    - null ids are kept as null; equal rows count once; rows of one id are searched one by one;
    - empty tables give an empty result; other columns are ignored.
    """
    keyed = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    keyed = keyed.withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64("text", F.lit(1)))

    parts = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).withColumn("item", F.xxhash64("item_id", "text"))
    held = written(shingles(parts, "item", "item_id").select("item", "item_id", "s").distinct(), "items")
    sizes = held.groupBy("item", "item_id").agg(F.count(F.lit(1)).alias("n_item"))
    sizes = sizes.withColumn("edge", F.pow(F.lit(4), F.ceil(F.log2(F.greatest("n_item", F.lit(2))) / 2 - 1e-9)).cast("long"))
    hashed = held.drop("item_id").join(sizes, "item").withColumn("h", F.xxhash64("s"))
    sketch = hashed.where(F.col("edge") > EXACT).groupBy("item", "edge", _bin(F.col("h")).alias("bin")).agg(F.min("h").alias("h"))
    sketch = written(sketch.select("item", "edge", "h").unionByName(_rarest(hashed.where(F.col("edge") <= EXACT), least)), "item-minima")
    values = sketch.select("edge", "h").distinct()
    few = sketch.count() <= BROADCAST_ROWS
    small = F.broadcast if few else (lambda frame: frame)

    # The pass over the corpus: places whose shingle is looked for, as windows of that class; of the smallest classes the shingle itself.
    found = shingles(keyed, "k1", "k2").select("k1", "k2", "place", F.xxhash64("s").alias("h")).join(small(values), "h")
    found = _windows(found).select("k1", "k2", "edge", F.when(F.col("edge") > EXACT, F.col("window")).alias("window"), F.when(F.col("edge") <= EXACT, F.col("h")).alias("h"))
    spans = written(found.distinct(), "windows")

    # Everything below works on documents with a find.
    near = keyed.join(spans.select("k1", "k2").distinct(), ["k1", "k2"], "semi").dropDuplicates(["k1", "k2"])
    near = written(shingles(near.select("k1", "k2", "text"), "k1", "k2").withColumn("h", F.xxhash64("s")), "near")
    within = _windows(near.select("k1", "k2", "place", "h").crossJoin(F.broadcast(sketch.where(F.col("edge") > EXACT).select("edge").distinct().limit(32))))
    minima = within.join(spans.drop("h"), ["k1", "k2", "edge", "window"], "semi").groupBy("k1", "k2", "edge", "window", _bin(F.col("h")).alias("bin")).agg(F.min("h").alias("h"))
    met = minima.select("k1", "k2", "edge", "h").unionByName(spans.where("h IS NOT NULL").select("k1", "k2", "edge", "h"))
    candidates = written(met.join(small(sketch), ["edge", "h"]).select("k1", "k2", "item").distinct(), "candidates")

    texts = near.select("k1", "k2", "h", "s").distinct()
    own = hashed.select("item", "h", "s")
    shared = candidates.join(own, "item").join(texts, ["k1", "k2", "h", "s"]).groupBy("k1", "k2", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    sure = shared.join(sizes, "item").withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("containment") >= least)
    pairs = keyed.select("doc_id", "k1", "k2").join(sure, ["k1", "k2"]).groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_shared", "n_item")).alias("best"))
    return pairs.select("doc_id", "item_id", "best.n_shared", "best.n_item", "best.containment")


def _rarest(hashed: DataFrame, least: float) -> DataFrame:
    """Of each item so many shingles that a document with `least` of them holds one, those of the fewest items first."""
    shared = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("items"))
    first = F.row_number().over(Window.partitionBy("item").orderBy("items", "h"))
    needed = F.ceil(least * F.col("n_item") - 1e-9)
    return hashed.join(shared, "h").withColumn("first", first).where(F.col("first") <= F.col("n_item") - needed + 1).select("item", "edge", "h")


def _windows(rows: DataFrame) -> DataFrame:
    """The window or two that each place lies in: `4 * edge` shingles long, one beginning every `3 * edge`."""
    step = F.col("edge") * 3
    last = F.floor(F.col("place") / step)
    first = F.when((F.col("place") % step < F.col("edge")) & (last > 0), last - 1).otherwise(last)
    return rows.withColumn("window", F.explode(F.sequence(first, last)))


def decontaminated(documents: DataFrame, items: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of `documents` whose text holds no item. A text is judged by itself, whatever its id; null texts stay."""
    text = F.xxhash64(text_column)
    bad = contaminated(documents.select(text.alias("doc_id"), F.col(text_column).alias("text")), items)
    return documents.join(bad.select(F.col("doc_id").alias("__text")).distinct(), text == F.col("__text"), "anti")
