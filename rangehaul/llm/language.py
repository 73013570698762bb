"""Language of web pages by Bayesian fusion of text, markup, address and host.

posterior(l) is proportional to  P(text | l) * P(declared | l) * P(suffix | l) * prior(l | host)

- text: byte trigrams of the visible text under multinomial models, fitted on a bounded sample of labelled documents
  (`SAMPLE_ROWS` by hash of the id). Trigrams of a text depend on each other, so its evidence is tempered to that of
  `EVIDENCE` trigrams; all of the text is read.
- declared language and address suffix: how often each value comes with each language, over all pages, counted in parts of
  text posteriors and smoothed.
- host prior: the host's counts, drawn towards those of its domain, these towards all pages'; a page's own part is taken out
  of each level first, so that it does not vote for itself.

All counts are grouped aggregations with partial sums: a host with a third of all pages is a row per task.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rangehaul.llm.store import written

SAMPLE_ROWS = 5000
EVIDENCE = 60.0
BUCKETS = 1 << 15
STRENGTH = 5.0  # pages that a level above counts for
SMOOTH = 1.0

# Elements whose content is not text; attribute values; numbers of characters beyond the last one. All patterns run in linear time.
_HIDDEN = re.compile(r"(?i)<(script|style|template|noscript)\b")
_CLOSE = {name: re.compile(rf"(?i)</{name}\s*+>") for name in ("script", "style", "template", "noscript")}
_VALUE = r"""\s*+=\s*+["']?+\s*+([a-z]{2,3})(?![a-z])"""
_HTML, _LANG = re.compile(r"(?i)<html\b"), re.compile(r"(?i)\s(?:xml:)?lang" + _VALUE)
_META, _KIND, _CONTENT = re.compile(r"(?i)<meta\b"), re.compile(r"(?i)content-language"), re.compile(r"(?i)content" + _VALUE)
_ZEROS, _BEYOND = re.compile(r"&#0++(?=[0-9])"), re.compile(r"&#[1-9][0-9]{7,}+;?")


def visible(page: str) -> str:
    """Text without tags, scripts, styles and comments, in one pass; what is never closed is text, but for the tag that opens it."""
    kept, done, never = [], 0, set()
    while (at := page.find("<", done)) >= 0:
        end = -1
        if page.startswith("<!--", at) and "--" not in never:
            end = page.find("-->", at + 4) + 2
            if end < 2:
                never.add("--")
                end = -1
        elif (opened := _HIDDEN.match(page, at)) and (name := opened[1].lower()) in _CLOSE and name not in never:
            closed = _CLOSE[name].search(page, opened.end())
            if closed:
                end = closed.end() - 1
            else:
                never.add(name)
        if end < 0 and (end := page.find(">", at)) < 0:
            break
        kept += (page[done:at], " ")
        done = end + 1
    text = "".join(kept) + page[done:]
    return markup.unescape(_BEYOND.sub("\ufffd", _ZEROS.sub("&#", text)))


def _tags(page: str, opening: re.Pattern) -> Iterator[str]:
    """Tags from their name to the next >, or to the end of the page."""
    at = 0
    while found := opening.search(page, at):
        end = page.find(">", found.end())
        at = end if end >= 0 else len(page)
        yield page[found.end() : at]


def declared(page: str) -> str | None:
    """Language of the first html tag that names one, else of the first meta tag that does (its last content)."""
    for tag in _tags(page, _HTML):
        if found := _LANG.search(tag):
            return found[1].lower()
    for tag in _tags(page, _META):
        if (kind := _KIND.search(tag)) and (contents := _CONTENT.findall(tag, kind.end())):
            return contents[-1].lower()
    return None


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """Host, domain (two last labels), and suffix (the last label; none for numbers)."""
    try:
        host = (urlsplit(url or "").hostname or "").strip(".").lower()
    except ValueError:
        host = ""
    labels = host.split(".") if host else []
    if not labels:
        return None, None, None
    return host, ".".join(labels[-2:]), labels[-1] if len(labels) > 1 and not labels[-1].isdigit() else None


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of the lower-cased text, runs of blanks as one."""
    data = np.frombuffer(" ".join(["", *text.lower().split(), ""]).encode(), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    return (code * np.uint32(2654435761) >> np.uint32(32 - 15)).astype(np.int64)


def fit(documents: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities by bucket, from at most `rows` rows with `doc_id`, `lang` and `text`."""
    some = documents.where("doc_id IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(rows)
    texts = documents.join(F.broadcast(some), ["doc_id", "lang"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text.as_py() or ""), minlength=BUCKETS)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["lang", "counts"])

    total: dict[str, np.ndarray] = {}
    for lang, counts in texts.mapInArrow(count, "lang string, counts binary").collect():
        total[lang] = total.get(lang, 0) + np.frombuffer(counts, np.int64)
    langs = sorted(total)
    counts = np.array([total[x] for x in langs], float).reshape(len(langs), BUCKETS) + 0.05
    return langs, np.log(counts / counts.sum(1, keepdims=True)) if langs else counts


def _evidence(langs: list[str], logs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, domains, suffixes, tongues, scores, sizes = [], [], [], [], [], []
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html"), strict=True):
                page = page.as_py() or ""
                grams = trigrams(visible(page))
                score = logs[:, grams].sum(1) * (min(1.0, EVIDENCE / len(grams)) if len(grams) else 0.0)
                p = np.exp(score - score.max()) if len(langs) else score
                host, domain, suffix = address(url)
                hosts.append(host)
                domains.append(domain)
                suffixes.append(suffix)
                tongues.append(declared(page))
                scores.append(p / p.sum() if len(langs) else p)
                sizes.append(len(grams))
            strings = [pa.array(x, pa.string()) for x in (hosts, domains, suffixes, tongues)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *strings, pa.array([s.tolist() for s in scores], pa.list_(pa.float64())), pa.array(sizes, pa.int64())], names=["page_id", "host", "domain", "suffix", "declared", "text", "n_trigrams"])

    return run


def identify(pages: DataFrame, documents: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of `pages`: `page_id`, `language`, `probability`, `text_language`, `declared`, `host`, `n_trigrams`.

    - a page without text, or null, has even text evidence and lives on the rest; ties go to the first language in order;
    - a null or unreadable address has no suffix evidence and the prior of all pages; an undeclared language has none;
    - equal rows get equal results, null ids stay; without labelled documents `language` is null;
    - markup that is never closed, of any length, is read in linear time; character numbers of any length are read;
    - an empty table gives an empty result; other columns are ignored.
    """
    langs, logs = fit(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"), rows)
    frame = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    kinds = "page_id long, host string, domain string, suffix string, declared string, text array<double>, n_trigrams long"
    found = written(frame.mapInArrow(_evidence(langs, logs), kinds), "evidence")
    size = len(langs)
    if not size:
        none = F.lit(None)
        return found.select("page_id", none.cast("string").alias("language"), none.cast("double").alias("probability"), none.cast("string").alias("text_language"), "declared", "host", "n_trigrams")
    sums = lambda source: F.array(*[F.sum(F.get(source, k)) for k in range(size)])
    each = lambda function, *arrays: F.array(*[function(k, *[F.get(a, k) for a in arrays]) for k in range(size)])

    hosts = written(found.where("host IS NOT NULL").groupBy("host", "domain").agg(sums("text").alias("in_host")), "hosts")
    domains = hosts.groupBy("domain").agg(sums("in_host").alias("in_domain"))
    everything = [x or 0.0 for x in found.agg(sums("text").alias("in_all")).first()["in_all"]]
    likelihood = {}
    for name in ("suffix", "declared"):
        # P(value | language): what the value has of the language's mass, over what is missing as well.
        counts = found.where(F.col(name).isNotNull()).groupBy(name).agg(sums("text").alias(f"in_{name}"))
        likelihood[name] = counts.select(name, each(lambda k, c: F.log((c + SMOOTH) / (everything[k] + SMOOTH * 20)), f"in_{name}").alias(f"log_{name}"))
    joined = found.join(hosts.drop("domain"), "host", "left").join(domains, "domain", "left").join(likelihood["suffix"], "suffix", "left").join(likelihood["declared"], "declared", "left")

    # Without the page's own part at each level.
    less = lambda level: each(lambda k, c, own: F.greatest(F.coalesce(c, F.lit(0.0)) - F.when(c.isNotNull(), own).otherwise(0.0), F.lit(0.0)), level, "text")
    drawn = lambda counts, above: each(lambda k, c, a: (c + STRENGTH * a) / (F.aggregate(counts, F.lit(0.0), lambda x, y: x + y) + STRENGTH), counts, above)
    steps = joined.withColumn("all_less", F.array(*[F.greatest(F.lit(float(everything[k])) - F.get("text", k), F.lit(0.0)) + SMOOTH for k in range(size)]))
    steps = steps.withColumn("prior_all", each(lambda k, c: c / F.aggregate("all_less", F.lit(0.0), lambda x, y: x + y), "all_less"))
    steps = steps.withColumn("domain_less", less("in_domain")).withColumn("prior_domain", drawn("domain_less", "prior_all"))
    steps = steps.withColumn("host_less", less("in_host")).withColumn("prior", drawn("host_less", "prior_domain"))
    zero = F.lit(0.0)
    log = each(lambda k, t, p, s, d: F.log(F.greatest(t, F.lit(1e-300))) + F.log(p) + F.coalesce(s, zero) + F.coalesce(d, zero), "text", "prior", "log_suffix", "log_declared")
    fused = steps.withColumn("log", log).withColumn("top", F.array_max("log"))
    names = F.array(*[F.lit(x) for x in langs])
    pick = lambda values: F.get(names, F.array_position(values, F.array_max(values)).cast("int") - 1)
    total = F.aggregate("log", zero, lambda x, y: x + F.exp(y - F.col("top")))
    return fused.select("page_id", pick(F.col("log")).alias("language"), (1 / total).alias("probability"), pick(F.col("text")).alias("text_language"), "declared", "host", "n_trigrams")
