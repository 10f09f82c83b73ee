"""One query per operator over its whole table, and the same rows in SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import scratch_path
from . import (
    decontaminate,
    embedding_dedup,
    importance,
    language,
    merkle,
    mixing,
    ngram_lm,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mix_sources(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies")


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.document_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"))


ORACLE["op2_token_counts"] = r"""
SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
FROM documents
"""


@query
def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def ratings(labels: DataFrame) -> DataFrame:
    """Grades 0 to 2: one point for quality, one for not being toxic."""
    return labels.select("doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))


@query
def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(ratings(table(spark, sf_dir, "labels")), docs, grades=3)
    graded = quality.grade(docs, model)
    return graded.withColumn("kept", F.col("tail_probability") >= quality.KEEP)


@query
def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.fold("doc_id", 3) == 1, F.lit(False))
    found = language.identify(docs, language.train(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@query
def op6_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    spans = suffix_dedup.repeated_spans(docs)
    keyed = docs.select("doc_id", suffix_dedup.row_key("doc_id", "text").alias("key"))
    words = F.aggregate("spans", F.lit(0), lambda n, s: n + s["hi"] - s["lo"])
    return keyed.join(spans, "key").select("doc_id", words.alias("n_repeated"), "spans", "first_doc_ids")


@query
def op7_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op8_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT rid, i, dw.n, item_id FROM dw JOIN bw USING (g) WHERE dw.n = bw.n
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hits)) GROUP BY rid
), items AS (
  SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS list
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


@query
def op9_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op10_lm_score(spark, sf_dir):
    return ngram_lm.score(table(spark, sf_dir, "documents"), language.fold("doc_id", 7) == 2)


#: CRC-32 in SQL: the table of single bytes by its rule, then one step a byte.
CRC_SQL = """
bytes_ AS (
  SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crcs
  FROM range(256) t(i)
)"""


def crc_sql(text: str) -> str:
    codes = f"list_transform(range(0, octet_length(encode({text}))), lambda i: ('0x' || hex(encode({text}))[2 * i + 1:2 * i + 2])::BIGINT)"
    reduced = f"list_reduce({codes}, lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)"
    return f"xor({reduced}, 4294967295)"


@query
def op11_importance(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op11_importance"] = rf"""
WITH {CRC_SQL}, texts AS (
  SELECT row_number() OVER () AS rid, doc_id, text, true AS is_doc FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text, false FROM benchmark
), words AS (
  SELECT rid, doc_id, is_doc, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), features AS (
  SELECT rid, is_doc, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM words
), distinct_features AS (SELECT DISTINCT f FROM features
), hashed AS (SELECT f, ({crc_sql("f")} % 10000)::BIGINT AS bucket FROM distinct_features, bytes_
), bucketed AS (SELECT rid, is_doc, bucket, count(*) AS n FROM features JOIN hashed USING (f) GROUP BY ALL
), totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (is_doc), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT is_doc), 0)::DOUBLE AS t
  FROM bucketed GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM totals
), weights AS (
  SELECT rid, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM bucketed JOIN gains USING (bucket) WHERE is_doc GROUP BY rid
), scored AS (
  SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    ('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h
  FROM words LEFT JOIN weights USING (rid) WHERE is_doc
), final AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM scored
), ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS r, count(*) OVER () AS n
  FROM final WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END::BIGINT AS rank
FROM final LEFT JOIN ranked USING (rid)
"""


@query
def op12_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = toxicity.held_out("doc_id")
    model = toxicity.train(table(spark, sf_dir, "labels").where(~out), docs.where(~out))
    found = toxicity.classify(docs, model)
    return found.select("doc_id", out.alias("held_out"), "score", "predicted")


@query
def op13_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(hit, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    return merkle.audited(docs, {"n_chars": changed}).drop("place")


def _leaf_sql(n_chars: str) -> str:
    columns = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')" for c in columns) + ")"


ORACLE["op13_merkle"] = rf"""
WITH RECURSIVE {CRC_SQL}, leaves AS (
  SELECT coalesce('=' || lang, '') AS tree, doc_id, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {crc_sql("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS claim
  FROM documents, bytes_
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS place FROM leaves
), nodes AS (
  SELECT 0 AS level, tree, place AS i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT level + 1, tree, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY level, tree, i // 2
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS g FROM nodes WHERE n = 1
), uppers AS (
  SELECT 0 AS level, g AS i, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2
  FROM uppers WHERE n > 1 GROUP BY level, i // 2
), own AS (
  SELECT p.tree, p.place, n.level, n.i & 1 AS side, s.h AS other
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.i = p.place // (1 << n.level::BIGINT) AND n.n > 1
  LEFT JOIN nodes s ON s.tree = n.tree AND s.level = n.level AND s.i = xor(n.i, 1)
), above AS (
  SELECT g.tree, p.place, 100 + u.level AS level, u.i & 1 AS side, s.h AS other
  FROM placed p JOIN subroots g USING (tree) JOIN uppers u ON u.i = g.g // (1 << u.level::BIGINT) AND u.n > 1
  LEFT JOIN uppers s ON s.level = u.level AND s.i = xor(u.i, 1)
), paths AS (
  SELECT tree, place, list([side::VARCHAR, coalesce(other, '')] ORDER BY level) AS path,
    string_agg(other, '' ORDER BY level) AS others
  FROM (SELECT * FROM own UNION ALL SELECT * FROM above) GROUP BY tree, place
)
SELECT doc_id, leaf, subroot, top.h AS root, sha256(coalesce(others, '')) AS proof_sha256,
  list_reduce(coalesce(path, []), lambda h, s: [sha256(CASE WHEN s[1] = '1' THEN s[2] || h[1] ELSE h[1] || s[2] END)], [claim])[1]
    AS folded_root,
  folded_root = top.h AS verified
FROM placed JOIN subroots USING (tree) LEFT JOIN paths USING (tree, place), (SELECT h FROM uppers WHERE n = 1) AS top
"""
