"""The registered queries of the subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.llm import (ann, decontaminate, exact_dedup, langid, license_scan, ngram_join, packing, pii,
                          source_divergence, spelling, substring_dedup, toxicity, url_rules)
from viewstar.llm.tables import crc_bucket, table


def held_out(column: str, buckets: int, bucket: int) -> Column:
    """Rows whose crc32(id as text) modulo ``buckets`` is ``bucket``; a row without id is held out."""
    return F.coalesce(crc_bucket(column, buckets), F.lit(bucket)) == bucket


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out("doc_id", 3, 1)))
    return langid.identify(docs, model).select(
        F.col("id").alias("doc_id"), held_out("id", 3, 1).alias("held_out"), "lang_pred", "score")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted; labels come from the rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    language = langid.train(docs.where(~held_out("doc_id", 5, 0)), sample_docs=None, order=2)
    model = toxicity.train(docs, labels.where(~held_out("doc_id", 5, 0)), language)
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"), held_out("id", 5, 0).alias("held_out"), "score", "predicted")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.overlaps(table(spark, sf_dir, "documents"),
                                                       table(spark, sf_dir, "benchmark")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pii": op2_pii,
    "op3_ngram_join": op3_ngram_join,
    "op4_license_scan": op4_license_scan,
    "op5_ann": op5_ann,
    "op6_langid": op6_langid,
    "op7_url_rules": op7_url_rules,
    "op8_toxicity": op8_toxicity,
    "op9_decontaminate": op9_decontaminate,
    "op10_packing": op10_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_spelling": op13_spelling,
}

_FOLD = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op3_ngram_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_FOLD.format('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [w]
               ELSE list_transform(range(1, len(w) - 3), lambda k: w[k:k + 4]) END) AS g FROM d WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id
           GROUP BY ALL),
links AS (SELECT a, b, c = m.n AND c = k.n AS equal FROM common JOIN sizes m ON m.doc_id = a JOIN sizes k ON k.doc_id = b
          WHERE 100 * c >= 80 * (m.n + k.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
linked AS (SELECT a AS doc_id, count(*) AS n_links, min(b) FILTER (WHERE equal) AS same FROM links GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, least(d.doc_id, coalesce(same, d.doc_id)) AS class_id,
       coalesce(n_links, 0) AS n_links
FROM d LEFT JOIN sizes USING (doc_id) JOIN components USING (doc_id) LEFT JOIN linked USING (doc_id)
""",
    "op9_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS.format(_FOLD.format('text'))} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format(_FOLD.format('text'))} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[k:k + least(len(w), 10) - 1] AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, k, w[k:k + n - 1] AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, ns WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, iw.item_id, k, dw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
        FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
""",
    "op11_source_divergence": r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS k,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT lang, source, k, unnest(w) AS t FROM d),
kept AS (SELECT lang, t FROM o GROUP BY lang, t HAVING count(DISTINCT k) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, t, count(*) AS c FROM o JOIN kept USING (lang, t) GROUP BY lang, source, t),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source),
lc AS (SELECT lang, t, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY lang) AS n FROM c GROUP BY lang, t),
p AS (SELECT g.lang, g.source, kept.t, coalesce(c.c, 0) AS c,
             1 + (1000000000 * (coalesce(c.c, 0)::HUGEINT + 2)) // (coalesce(n.n, 0) + 2 * v.v) AS p
      FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = kept.t),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS f
      FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.f, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, t AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
          FROM (SELECT p.lang, p.source, p.t, p.p, 1 + (1000000000 * (lc.c::HUGEINT + 2)) // (lc.n + 2 * v.v) AS q
                FROM p JOIN lc ON lc.lang = p.lang AND lc.t = p.t JOIN v ON v.lang = p.lang WHERE p.c > 0) WHERE p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM terms)
WHERE rank <= 10
""",
    "op12_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, norm, row_number() OVER w AS k, first_value(doc_id) OVER w AS keep_id
      FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, count(*) OVER (PARTITION BY norm) AS group_size, k = 1 AS kept, sha256(norm) AS text_sha256
FROM r
""",
    "op13_spelling": """
WITH RECURSIVE table256 AS (
  SELECT list(list_reduce([i] || [0, 1, 2, 3, 4, 5, 6, 7],
                          lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END) ORDER BY i) AS crc
  FROM range(256) r(i)),
runs AS (SELECT doc_id, run, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                     'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00c0-\u00ff]+')) AS run
  FROM documents) WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (SELECT run, n, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(
    string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)),
    lambda a, b: xor(a // 256, crc[xor(a % 256, b) + 1]))) AS h
  FROM runs, table256),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
open_at AS (SELECT word, n, k, word[:k] || '?' || word[k + 2:] AS pattern, word[:k] || word[k + 2:] AS shorter
            FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM open_at a JOIN open_at b ON a.pattern = b.pattern AND a.word <> b.word
  UNION SELECT o.word, w.word, w.n FROM open_at o JOIN words w ON o.shorter = w.word
  UNION SELECT w.word, o.word, o.n FROM open_at o JOIN words w ON o.shorter = w.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
                  CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chains AS (SELECT word, word AS at FROM formed
           UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chains c ON c.word = f.word JOIN formed e ON e.word = c.at WHERE e.form IS NULL
""",
}
