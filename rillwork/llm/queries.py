"""Queries of the operators on text, and the SQL they are held against where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import read, settled
from .leakage import leaks, without_leaks
from .packing import pack, utilisation
from .sentences import sentences

CAPACITY = 2048


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", "text")


def p6_pack(spark: SparkSession, d: str) -> DataFrame:
    return pack(_docs(spark, d), CAPACITY)


def p6_utilisation(spark: SparkSession, d: str) -> DataFrame:
    return utilisation(pack(_docs(spark, d), CAPACITY), CAPACITY)


def p6_check(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of a packing, counted: documents, those that come out, tokens lost, cut documents that would have fitted, overfull sequences, gaps and overlaps in them."""
    docs = _docs(spark, d)
    got = settled(pack(docs, CAPACITY))
    per = got.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("tokens"), F.max(F.col("first_token") + F.col("n_tokens")).alias("last"), F.countDistinct("piece").alias("different"))
    by_doc = per.agg(F.count(F.lit(1)).alias("out"), F.count_if(F.col("tokens") != F.col("last")).alias("lost"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= CAPACITY)).alias("cut_in_vain"), F.count_if(F.col("pieces") != F.col("different")).alias("twice"))
    after = F.lead("position").over(Window.partitionBy("seq_id").orderBy("position"))
    inside = got.filter("seq_id is not null").withColumn("next", after)
    by_seq = inside.agg(F.count_if(F.col("position") + F.col("n_tokens") > CAPACITY).alias("overfull"), F.count_if(F.col("next") != F.col("position") + F.col("n_tokens")).alias("misplaced"))
    # one row each
    return docs.agg(F.countDistinct("doc_id").alias("documents")).join(F.broadcast(by_doc)).join(F.broadcast(by_seq))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks(_docs(spark, d), read(spark, d, "eval_items")).select("item_id", "doc_id")


def p7_matches(spark: SparkSession, d: str) -> DataFrame:
    return leaks(_docs(spark, d), read(spark, d, "eval_items"))


def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    docs = _docs(spark, d)
    return without_leaks(docs.select("doc_id"), settled(leaks(docs, read(spark, d, "eval_items")).select("doc_id")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences(_docs(spark, d))


QUERIES = {f.__name__: f for f in (p6_pack, p6_utilisation, p6_check, p7_found, p7_matches, p7_clean, p8_found)}

#: Words and letters as leakage.words has them, in DuckDB: categories L and N, marks dropped as separators.
_DOC_WORDS = r"""regexp_extract_all(lower(regexp_replace(text, '[\x{AD}\x{200B}\x{FEFF}\x{2060}]', '', 'g')), '[\p{L}\p{N}]+')"""

_P7_PAIRS = f"""
WITH i AS (SELECT item_id, lang = 'zh' AS z, {_DOC_WORDS} AS w FROM eval_items WHERE text IS NOT NULL),
d AS (SELECT doc_id, {_DOC_WORDS} AS w FROM documents WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k+11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i WHERE NOT z)),
dw AS (SELECT DISTINCT doc_id, array_to_string(w[k:k+11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d)),
ic AS (SELECT DISTINCT item_id, substr(s, k, 24) AS g FROM (SELECT item_id, array_to_string(w, '') AS s, unnest(range(1, length(array_to_string(w, '')) - 22)) AS k FROM i WHERE z)),
dc AS (SELECT DISTINCT doc_id, substr(s, k, 24) AS g FROM (SELECT doc_id, s, unnest(range(1, length(s) - 22)) AS k FROM (SELECT doc_id, array_to_string(w, '') AS s FROM d) WHERE regexp_matches(s, '[\\x{{3400}}-\\x{{9FFF}}]'))),
pairs AS (SELECT item_id, doc_id FROM iw JOIN dw USING (g) UNION SELECT item_id, doc_id FROM ic JOIN dc USING (g))
"""

#: The longest run of shared windows of each pair: windows that follow one another in item and document.
_P7_MATCHES = _P7_PAIRS.replace("SELECT DISTINCT item_id, array_to_string(w[k:k+11], ' ') AS g", "SELECT item_id, k - 1 AS k, array_to_string(w[k:k+11], ' ') AS g").replace("SELECT DISTINCT doc_id, array_to_string(w[k:k+11], ' ') AS g", "SELECT doc_id, k - 1 AS j, array_to_string(w[k:k+11], ' ') AS g").replace("SELECT DISTINCT item_id, substr(s, k, 24) AS g", "SELECT item_id, k - 1 AS k, substr(s, k, 24) AS g").replace("SELECT DISTINCT doc_id, substr(s, k, 24) AS g", "SELECT doc_id, k - 1 AS j, substr(s, k, 24) AS g").replace("SELECT item_id, doc_id FROM iw JOIN dw USING (g) UNION SELECT item_id, doc_id FROM ic JOIN dc USING (g)", "SELECT item_id, doc_id, k, j, 11 AS more FROM iw JOIN dw USING (g) UNION SELECT item_id, doc_id, k, j, 23 FROM ic JOIN dc USING (g)") + """,
runs AS (SELECT item_id, doc_id, more, j - k AS diag, k, j, k - row_number() OVER (PARTITION BY item_id, doc_id, j - k ORDER BY k) AS island FROM pairs),
found AS (SELECT item_id, doc_id, min(k) AS item_pos, min(j) AS doc_pos, count(*) + any_value(more) AS length FROM runs GROUP BY item_id, doc_id, diag, island)
SELECT item_id, doc_id, CAST(length AS INTEGER) AS length, CAST(item_pos AS INTEGER) AS item_pos, doc_pos FROM found QUALIFY row_number() OVER (PARTITION BY item_id, doc_id ORDER BY length DESC, item_pos, doc_pos) = 1"""

ORACLE = {
    "p6_check": "SELECT count(DISTINCT doc_id) AS documents, count(DISTINCT doc_id) AS out, CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS cut_in_vain, CAST(0 AS BIGINT) AS twice, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS misplaced FROM documents",
    "p7_matches": _P7_MATCHES,
    "p7_found": _P7_PAIRS + "SELECT DISTINCT item_id, doc_id FROM pairs",
    "p7_clean": _P7_PAIRS + "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM pairs)",
}
