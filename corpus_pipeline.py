"""The documents table on its way to training data: five stages, each a table of what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again for the next. All but the last
return the columns of `docs`, whatever further ones there are. Every decision takes effect: toxic documents go, one
document of each near-duplicate group stays, repeated passages are cut out of texts, documents with a benchmark item go,
and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rangehaul.llm.decontam import decontaminated
from rangehaul.llm.neardup import near_duplicates
from rangehaul.llm.pieces import encode
from rangehaul.llm.store import written
from rangehaul.llm.substring import remove_repeats
from rangehaul.llm.toxicity import toxicity

# Toxicity and encoding are not SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None

_KEYS = ("doc_id", "text")


def _carry(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in _KEYS]


def _restored(frame: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of `docs` from an operator's `doc_id`, `text` and `carried`."""
    return frame.select(*[changed.get(c, F.col(c) if c in _KEYS else F.col("carried").getField(c)).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. Null texts are scored like empty ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _restored(toxicity(docs, labels, carry=_carry(docs)).where("predicted = 0"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each near-duplicate group. A row with the id and text of another is dropped as its copy.

    Rows without words or without an id belong to no group and stay.
    """
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    hashed = docs.withColumn("__text", F.xxhash64("text"))
    chosen = hashed.join(kept, hashed["doc_id"].eqNullSafe(kept["__id"]) & (hashed["__text"] == kept["__hash"]), "semi")
    grouped = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    single = F.when(grouped, F.lit(-1)).otherwise(F.monotonically_increasing_id())
    return chosen.withColumn("__single", single).dropDuplicates(["doc_id", "__text", "__single"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word passages that a document of smaller id has; texts that lose nothing stay as they are.

    `n_chars` follows the text. A text that loses all its words stays, empty.
    """
    found = remove_repeats(docs, carry=_carry(docs))
    changed = {"text": F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        own = F.col("carried").getField("n_chars")
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(own)
    return _restored(found, docs, **changed)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and short texts hold none."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every text: `doc_id`, `lang`, `source`, `sample`, `ids`, `n_pieces`, `log_prob`, `inclusion`."""
    found = encode(docs, carry=[c for c in ("lang", "source") if c in docs.columns])
    carried = [F.col("carried").getField(c).alias(c) for c in ("lang", "source") if c in docs.columns]
    return found.select("doc_id", *carried, "sample", "ids", F.size("ids").cast("long").alias("n_pieces"), "log_prob", "inclusion")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece encoding", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
