"""Registered queries of the operators, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rangehaul.llm.collocations import LEAST, TOP, collocations
from rangehaul.llm.decontam import contaminated
from rangehaul.llm.language import identify
from rangehaul.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, license_scan
from rangehaul.llm.manifest import leaf_digest, merkle_manifest
from rangehaul.llm.neardup import near_duplicates
from rangehaul.llm.pieces import encode
from rangehaul.llm.repetition import LEAST_WORDS, LONGEST, REPEATED_CHARS, REPEATED_WORDS, WIDTH, repetition
from rangehaul.llm.substring import remove_repeats
from rangehaul.llm.topk import quantized, top_k
from rangehaul.llm.toxicity import toxicity
from rangehaul.llm.warc import archived
from rangehaul.llm.suffixes import remove_repeated_strings

QUERIES = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query(
    "op5_substring_dedup",
    r"""
    WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    g AS (SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
    o AS (SELECT win, min(doc_id) AS own FROM g GROUP BY win HAVING min(doc_id) < max(doc_id)),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN o USING (win) WHERE doc_id > own),
    r AS (SELECT doc_id, list(i) AS cut FROM gone GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, coalesce(len(cut), 0) AS n_removed,
           sha256(array_to_string(CASE WHEN cut IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(cut, i)) END, ' ')) AS kept_sha256
    FROM w LEFT JOIN r USING (doc_id)
    """,
)
def substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    "op9_minhash_neardup",
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i+4], ' ') END AS sh
          FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, coalesce(component_id, w.doc_id) = w.doc_id AS kept
    FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
    """,
)
def minhash_neardup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents")).drop("text_hash")


@query("op10_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = remove_repeated_strings(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op4_warc",
    """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS original FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform(range(4), lambda k:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, CAST(5 * g + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * k AS INTEGER)) & 31)::INTEGER + 1, 1)), '')), '') AS payload_digest,
           CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> original THEN original END AS refers_to
    FROM m
    """,
)
def warc(spark: SparkSession, sf: str) -> DataFrame:
    page = lambda c: F.expr(f"try_cast(substring({c}, {len('urn:page:') + 1}) AS long)")
    found = archived(table(spark, sf, "pages")).where("failed IS NULL")
    return found.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


@query(
    "op2_pivot_topk",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
    """,
)
def pivot_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = quantized(table(spark, sf, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _license_sql() -> str:
    values = lambda rows: ", ".join("(" + ", ".join("'" + x + "'" for x in r) + ")" for r in rows)
    return f"""
    WITH phrase(p, label) AS (VALUES {values(PHRASES)}), notice(label, body) AS (VALUES {values(TEMPLATES)}),
    low AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
    w AS (SELECT r, doc_id, body, regexp_extract_all(body, '{_WORD}') AS ws FROM low),
    place AS (SELECT r, label, i - 1 AS pos FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE contains(body, 'license')), phrase
              WHERE array_to_string(ws[i:i + len(string_split(p, ' ')) - 1], ' ') = p),
    base AS (SELECT r, count(*) AS n, min(pos) AS a, max(pos) AS b, list(DISTINCT label) AS ls FROM place GROUP BY r),
    t AS (SELECT label, list_distinct(regexp_extract_all(lower(body), '{_WORD}')) AS ws FROM notice),
    line AS (SELECT r, list_distinct(regexp_extract_all(unnest(string_split(body, chr(10))), '{_WORD}')) AS ws FROM low),
    m AS (SELECT r, label, len(list_intersect(line.ws, t.ws)) / len(t.ws) AS c FROM line, t WHERE len(list_intersect(line.ws, t.ws)) >= ceil({THRESHOLD} * len(t.ws) - 1e-9)),
    own AS (SELECT r, list(DISTINCT label) AS ls, max(c) AS c FROM m GROUP BY r)
    SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word,
           array_to_string(list_sort(coalesce(base.ls, [])), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(base.ls, []), coalesce(own.ls, [])))), ',') AS labels,
           CAST(CASE WHEN n > 0 THEN 1 ELSE coalesce(c, 0) END AS DOUBLE) AS score
    FROM w LEFT JOIN base USING (r) LEFT JOIN own USING (r)
    """


@query("op1_license_scan", _license_sql())
def licenses(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan(table(spark, sf, "documents")).drop("places")


@query("op6_toxicity")
def toxic(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")).select("doc_id", "held_out", "score", "predicted")


@query(
    "op3_decontamination",
    r"""
    WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
    b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
    ds AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
    bs AS (SELECT DISTINCT item_id, array_to_string(ws[i:i+4], ' ') AS s FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM b WHERE len(ws) >= 5)),
    n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
    SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment FROM ds JOIN bs USING (s) JOIN n USING (item_id)
    GROUP BY doc_id, item_id, n_item HAVING count(*) / n_item >= 0.75
    """,
)
def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op7_sentencepiece")
def sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    found = encode(table(spark, sf, "documents"), verify=True)
    return found.select("doc_id", "sample", "ids", F.size("ids").cast("long").alias("n_pieces"), "log_prob", "perturbed", "inclusion", "exact")


@query("op8_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify(table(spark, sf, "pages"), table(spark, sf, "documents"))


@query(
    "op11_quality_rules",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
    w AS (SELECT r, doc_id, body, list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
    g AS (SELECT r, i, array_to_string(ws[i:i + {WIDTH - 1}], ' ') AS win FROM (SELECT r, ws, unnest(range(1, len(ws) - {WIDTH - 2})) AS i FROM w WHERE len(ws) >= {WIDTH})),
    again AS (SELECT r, win FROM g GROUP BY r, win HAVING count(*) > 1),
    twice AS (SELECT g.* FROM g JOIN again USING (r, win)),
    cover AS (SELECT DISTINCT r, unnest(range(i, i + {WIDTH})) AS i FROM twice),
    share AS (SELECT r, count(*) AS n, sum(length(ws[i])) AS chars FROM cover JOIN w USING (r) GROUP BY r),
    pair AS (SELECT x.r, x.i, y.i - x.i AS shift FROM twice x JOIN twice y ON x.r = y.r AND x.win = y.win AND x.i < y.i),
    run AS (SELECT r, shift, i - row_number() OVER (PARTITION BY r, shift ORDER BY i) AS part FROM pair),
    longest AS (SELECT r, max(n) + {WIDTH - 1} AS n FROM (SELECT r, count(*) AS n FROM run GROUP BY r, shift, part) GROUP BY r),
    line AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(body, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
    m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 coalesce(line.n, 0) AS n_dup_lines, coalesce(share.n, 0) AS n_repeat_words, CAST(coalesce(share.chars, 0) AS BIGINT) AS covered_chars, coalesce(longest.n, 0) AS longest_repeat
          FROM w LEFT JOIN share USING (r) LEFT JOIN longest USING (r) LEFT JOIN line USING (r))
    SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_WORDS} * n_words AS base_failed,
           n_words >= {LEAST_WORDS} AND 100 * n_repeat_words <= {REPEATED_WORDS} * n_words AND 100 * covered_chars <= {REPEATED_CHARS} * word_chars AND longest_repeat <= {LONGEST} AS kept FROM m
    """,
)
def quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return repetition(table(spark, sf, "documents")).drop("n_repeats")


@query(
    "op12_collocations",
    rf"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS body FROM documents),
    w AS (SELECT lang, list_filter(string_split_regex(body, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
    total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
    f AS (SELECT lang, k, phrase, count(*) AS a FROM (
              SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 6) AS s(k) WHERE len(ws) >= k)) GROUP BY ALL HAVING count(*) >= {LEAST}),
    c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
    part AS (SELECT DISTINCT c.lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, a FROM c, range(2, 5) AS s(m), range(1, 5) AS t(i) WHERE m < k AND i + m - 1 <= k),
    kept AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM part WHERE part.lang = c.lang AND part.phrase = c.phrase AND part.a >= c.a)),
    cut AS (SELECT kept.lang, kept.phrase, kept.a, x.a AS l, y.a AS r, total.n, s.m, CAST((1000::HUGEINT * kept.a * total.n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
            FROM kept JOIN range(1, 5) AS s(m) ON m < kept.k JOIN f x ON x.lang = kept.lang AND x.phrase = array_to_string(kept.ws[1:m], ' ')
            JOIN f y ON y.lang = kept.lang AND y.phrase = array_to_string(kept.ws[m + 1:kept.k], ' ') JOIN total ON total.lang = kept.lang),
    weakest AS (SELECT lang, phrase, a, l, r, n, score FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, m) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM weakest
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {TOP}
    """,
)
def phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))


_HASHED = ("doc_id", "source", "lang", "n_chars", "text")


def _manifest_sql() -> str:
    leaf = lambda text: "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in (*_HASHED[:-1], text)) + ")"
    crc = "xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, (s & 1) * 3988292384))), 4294967295::BIGINT)"
    tree = lambda source: f"""(SELECT g, 0 AS lev, pos, size, h FROM {source} UNION ALL
        SELECT g, lev + 1, pos // 8, (any_value(size) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM {{name}} WHERE size > 1 GROUP BY g, lev, pos // 8)"""  # noqa: E731
    climb = lambda start, name, nodes: f"""({start} UNION ALL
        SELECT u.id, u.g, u.lev + 1, u.pos // 8, sha256(string_agg(CASE WHEN t.pos = u.pos THEN u.h ELSE t.h END, '' ORDER BY t.pos)),
               u.others || coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos <> u.pos), '')
        FROM {name} u JOIN {nodes} t ON t.g IS NOT DISTINCT FROM u.g AND t.lev = u.lev AND t.pos // 8 = u.pos // 8 WHERE t.size > 1 GROUP BY u.id, u.g, u.lev, u.pos, u.h, u.others)"""  # noqa: E731
    return f"""
    WITH RECURSIVE leafs AS (SELECT row_number() OVER () AS id, doc_id, lang AS g, {leaf("text")} AS h,
        CASE WHEN {crc} % 3 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed FROM documents),
    placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS size FROM leafs),
    tree(g, lev, pos, size, h) AS {tree("placed").format(name="tree")},
    subs AS (SELECT 0 AS g, g AS lang, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM tree WHERE size = 1),
    crown(g, lev, pos, size, h) AS {tree("subs").format(name="crown")},
    up(id, g, lev, pos, h, others) AS {climb("SELECT id, g, 0, pos, coalesce(changed, h), '' FROM placed", "up", "tree")},
    low AS (SELECT up.* FROM up JOIN (SELECT id, max(lev) AS lev FROM up GROUP BY id) USING (id, lev)),
    top(id, g, lev, pos, h, others) AS {climb("SELECT low.id, 0, 0, subs.pos, low.h, low.others FROM low JOIN subs ON subs.lang IS NOT DISTINCT FROM low.g", "top", "crown")},
    done AS (SELECT top.* FROM top JOIN (SELECT id, max(lev) AS lev FROM top GROUP BY id) USING (id, lev))
    SELECT doc_id, placed.h AS leaf, subs.h AS subroot, root.h AS root, sha256(done.others) AS proof_sha256, done.h AS folded_root, done.h = root.h AS verified
    FROM placed JOIN done USING (id) JOIN subs ON subs.lang IS NOT DISTINCT FROM placed.g, (SELECT h FROM crown WHERE size = 1) root
    """


@query("op13_merkle_manifest", _manifest_sql())
def merkle(spark: SparkSession, sf: str) -> DataFrame:
    columns = [F.col(c) for c in _HASHED]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, leaf_digest([*columns[:-1], lowered]))
    return merkle_manifest(table(spark, sf, "documents"), "doc_id", "lang", leaf_digest(columns), tampered)
