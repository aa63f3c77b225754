"""URL filtering by mined association rules.

List rules (host and path prefixes) decide the pages they fit.  Their verdicts
label those pages; Spark's FP-growth mines combinations of URL tokens that go
with a verdict, rules are pruned by support, confidence and redundancy, and
an inverted index from tokens to rules matches them against the other URLs.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstar.llm.tables import written

# Fixed values: (verdict, host, path).
LIST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or the end, A-Z folded; path: from there up to ? # or the end."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def list_rule(host: Column, path: Column, rules=LIST_RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest list rule that fits, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the longest is tried first
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: scheme, host labels, path segments (digits as #) and query names."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    plain = lambda c: F.regexp_replace(F.translate(c, _UPPER, _LOWER), r"[0-9]+", "#")
    parts = F.concat(
        F.array(F.concat(F.lit("s="), F.regexp_extract(url, r"^([A-Za-z]*)://", 1))),
        F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h="), x)),
        F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p="), plain(x))),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q="), plain(F.regexp_extract(x, r"^[^=]*", 0)))))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda x: F.length(x) > 2)))


def mine(labelled: DataFrame, min_support: float = 0.01, min_confidence: float = 0.8) -> DataFrame:
    """(antecedent, verdict, confidence, support) from rows (tokens, verdict).

    A rule is redundant, and dropped, if part of its antecedent already gives
    the same verdict with at least its confidence.
    """
    label = F.concat(F.lit("verdict="), F.col("verdict"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(
        labelled.select(F.concat("tokens", F.array(label)).alias("items")))
    is_label = lambda x: x.startswith("verdict=")
    rules = model.associationRules.where(is_label(F.col("consequent")[0]) & ~F.exists("antecedent", is_label)) \
        .select(F.array_sort("antecedent").alias("antecedent"),
                F.substring(F.col("consequent")[0], len("verdict=") + 1, 1000).alias("verdict"), "confidence", "support")
    rules = written(rules, "association-rules")
    token = rules.select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("token"))
    small, large = token.alias("a"), token.alias("b")
    inside = (F.col("a.token") == F.col("b.token")) & (F.col("a.verdict") == F.col("b.verdict")) \
        & (F.size("a.antecedent") < F.size("b.antecedent")) & (F.col("a.confidence") >= F.col("b.confidence"))
    redundant = small.join(large, inside).groupBy("a.antecedent", "b.antecedent", "b.verdict").count() \
        .where(F.col("count") == F.size("a.antecedent")).select("b.antecedent", "b.verdict").distinct()
    return rules.join(redundant, ["antecedent", "verdict"], "left_anti")


def judge(pages: DataFrame, rules=LIST_RULES, min_support: float = 0.01, min_confidence: float = 0.8,
          default: str = "allow", id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, confidence; one row per input row.

    A page that no list rule fits takes the verdict of the matching mined rule
    with the highest confidence (then support, then more tokens, then its
    text), else ``default``.  A null url, or one without ``://``, has an empty
    host and path and fits nothing.  Without labelled pages nothing is mined.
    Repeated rows are judged alike; other columns are not read.
    """
    rows = pages.select(F.col(id_column).alias("page_id"), F.coalesce(F.col(url_column).cast("string"), F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    text, verdict = list_rule(F.col("host"), F.col("path"), rules)
    rows = written(rows.withColumns({"host": host, "path": path}).withColumns({"rule": text, "listed": verdict})
                   .withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path"))), "urls")
    labelled = rows.where("listed IS NOT NULL").select("tokens", F.col("listed").alias("verdict"))
    out = ["page_id", "host", "path", "rule"]
    if labelled.isEmpty():
        return rows.select(*out, F.coalesce("listed", F.lit(default)).alias("verdict"),
                           F.lit(None).cast("string").alias("mined_rule"), F.lit(None).cast("double").alias("confidence"))
    mined = mine(labelled, min_support, min_confidence) \
        .withColumn("mined_rule", F.array_join("antecedent", " ")).withColumn("size", F.size("antecedent"))
    index = written(mined.select(F.explode("antecedent").alias("token"), "mined_rule", "verdict", "size", "confidence",
                                 "support"), "rule-index")
    sets = rows.where("listed IS NULL").select("tokens").distinct().withColumn("set", F.xxhash64("tokens", F.lit(1)))
    found = sets.select("set", "tokens", F.explode("tokens").alias("token")).join(index, "token") \
        .groupBy("set", "tokens", "mined_rule", "verdict", "size", "confidence", "support") \
        .agg(F.count(F.lit(1)).alias("m")).where("m = size") \
        .groupBy("set", "tokens").agg(F.max(F.struct("confidence", "support", "size", "mined_rule", "verdict")).alias("best"))
    best = found.select("tokens", F.col("best.verdict").alias("mined"), "best.mined_rule", "best.confidence")
    # Listed pages have no use for the join; with null keys they would all meet in one task.
    listed = rows.where("listed IS NOT NULL").select(*out, F.col("listed").alias("verdict"),
                                                     F.lit(None).cast("string").alias("mined_rule"),
                                                     F.lit(None).cast("double").alias("confidence"))
    others = rows.where("listed IS NULL").join(best, "tokens", "left").select(
        *out, F.coalesce("mined", F.lit(default)).alias("verdict"), "mined_rule", "confidence")
    return listed.unionByName(others)
