"""Registered queries of this package: each applies one operator, with production
parameters, to its whole table. ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_codec import bpe_codec
from .class_lm import class_lm_scores
from .collocations import collocations
from .common import LOWER, UPPER, read_table
from .decontaminate import decontaminate
from .periodic_runs import periodic_runs
from .piece_codec import piece_codec
from .quality import quality_scores
from .simhash import simhash_components
from .substring_dedup import remove_repeats
from .token_counts import token_counts
from .topk import top_k
from .url_filter import oracle as url_filter_oracle
from .url_filter import url_filter
from .warc import warc_round_trip

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_counts(spark, sf_dir):
    """Sentencepiece token counts of every whole document."""
    return token_counts(read_table(spark, sf_dir, "documents"),
                        tokenizer_file("piece_bpe_32k.model"), limit=4096)


@query
def op2_substring_dedup(spark, sf_dir):
    """Every byte of all whole documents within a repeated 200-byte string, removed."""
    return remove_repeats(read_table(spark, sf_dir, "documents"), length=200,
                          outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))


@query
def op3_warc(spark, sf_dir):
    """Every page written to WARC archives and read back through the capture index."""
    return warc_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op3_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT x, min(page_id) AS first_id FROM p GROUP BY x),
d AS (
  SELECT x, first_id, array_to_string(list_transform(range(0, 8), lambda j: array_to_string(
      list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST(((CAST('0x' || substr(x, 5 * j + 1, 5) AS BIGINT) >> s) & 31) + 1 AS BIGINT), 1)), '')), '') AS digest
  FROM f)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN d USING (x)"""


@query
def op4_bpe_codec(spark, sf_dir):
    """Every whole document encoded and decoded; digests of both."""
    return bpe_codec(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"),
                     outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op5_simhash(spark, sf_dir):
    """SimHash components of all whole documents: 4-word shingles, 4 bits."""
    return simhash_components(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op6_url_filter(spark, sf_dir):
    """Every page url: the rules, else the path-template tree learnt from them."""
    return url_filter(read_table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "template")


ORACLES["op6_url_filter"] = url_filter_oracle(URL_RULES)


@query
def op7_class_lm(spark, sf_dir):
    """Class-model and base log10 probabilities of every whole document."""
    return class_lm_scores(read_table(spark, sf_dir, "documents"), parts=7, part=2)


@query
def op8_topk(spark, sf_dir):
    """The 5 best of all vectors for every vector whose id is divisible by 50."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256.0)


ORACLES["op8_topk"] = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query
def op9_quality(spark, sf_dir):
    """Quality score of every whole document; labels of held-out ids are not read."""
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
                          label_col="quality", parts=3, part=1)


@query
def op10_decontaminate(spark, sf_dir):
    """Benchmark windows of 10 words found in every whole document, and near matches whose
    words are off by up to two places."""
    return decontaminate(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "benchmark"), width=10, slop=2).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near")


_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLES["op10_decontaminate"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, k, k + least(len(w), 10) - 1) AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
place AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
  FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS MATERIALIZED (
  SELECT p.doc_id, p.k, p.n, win.item_id
  FROM place p JOIN win ON win.n = p.n AND list_slice(p.w, p.k, p.k + p.n - 1) = win.t),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS j FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id),
anchored AS (
  SELECT n, t, list_position(bytes, list_max(bytes)) AS a
  FROM (SELECT DISTINCT n, t, list_transform(t, lambda x: strlen(x)) AS bytes FROM win)),
met AS MATERIALIZED (
  SELECT doc_id, n, t, j - a + 1 AS k
  FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d) JOIN anchored ON x = t[a]),
near AS (
  SELECT doc_id, count(*) AS n_near
  FROM met JOIN d USING (doc_id)
  WHERE len(list_filter(range(1, n + 1), lambda i: k + i + 1 >= 1
            AND list_contains(list_slice(w, greatest(1, k + i - 3), k + i + 1), t[i]))) = n
    AND NOT (k >= 1 AND list_slice(w, k, k + n - 1) = t)
  GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)"""


@query
def op11_collocations(spark, sf_dir):
    """Phrases of 2 and 3 words whose words belong together, the first 2000 of every language."""
    return collocations(read_table(spark, sf_dir, "documents"), max_words=3, min_count=10, share=50, top=2000)


ORACLES["op11_collocations"] = rf"""
WITH w AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
f1 AS MATERIALIZED (SELECT lang, x AS w1, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY ALL),
f2 AS MATERIALIZED (
  SELECT lang, w[k] AS w1, w[k + 1] AS w2, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w))) AS k FROM w) GROUP BY ALL HAVING count(*) >= 10),
f3 AS MATERIALIZED (
  SELECT lang, w[k] AS w1, w[k + 1] AS w2, w[k + 2] AS w3, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS k FROM w) GROUP BY ALL HAVING count(*) >= 10),
cut AS (
  SELECT lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x USING (lang, w1) JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  WHERE NOT EXISTS (
    SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w1 = f2.w1 AND f3.w2 = f2.w2 AND 100 * f3.f >= 50 * f2.f)
  AND NOT EXISTS (
    SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w2 = f2.w1 AND f3.w3 = f2.w2 AND 100 * f3.f >= 50 * f2.f)
  UNION ALL
  SELECT lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 1, x.f, y.f
  FROM f3 JOIN f1 x USING (lang, w1) JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 2, x.f, y.f
  FROM f3 JOIN f2 x USING (lang, w1, w2) JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
least_cut AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place
  FROM (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cut)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM least_cut WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000"""


@query
def op12_piece_codec(spark, sf_dir):
    """Every whole document encoded and decoded by the sentencepiece model; digests of both."""
    return piece_codec(read_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"),
                       outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where one id in ten, by checksum, has its words from one of them on replaced by
    repeats of the first of these."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0)))
    n, g = F.size("words"), F.expr("h div 10")
    word = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return (docs.select("doc_id", "text", h.alias("h")).withColumn("words", split)
            .withColumn("a", F.when(n > 0, g % n))
            .withColumn("p", 1 + F.expr("(size(words) - a) div (3 + (h div 10) % 8)"))
            .select("doc_id", F.when(n > 0, F.array_join(word, " ")).otherwise(F.col("text")).alias("text")))


@query
def op13_periodic_runs(spark, sf_dir):
    """Runs of four and more periods in every whole document, some of which get periodic tails."""
    docs = with_periodic_tails(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs, outputs=("runs", "kept_sha256"))
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda top, r: F.when(
        r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.col("kept_sha256").alias("collapsed_sha256"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
