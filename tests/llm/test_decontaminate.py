import hashlib

import duckdb

from conftest import SF_SMALL, SF_TINY
from llm.helpers import ALNUM_WORDS, docs, words
from viewstar.llm import decontaminate as dc


def brute(rows, items):
    windows = {}
    for i, t in items:
        w = words(ALNUM_WORDS, t)
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t in rows:
        w, hit, found = words(ALNUM_WORDS, t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k:k + n]))) is not None:
                    found |= own
                    hit |= set(range(k, k + n))
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((i, len(w), len(hit), len([x for x in found if x is not None]),
                    hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def check(spark, rows, items):
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, size int, a string")
    got = dc.digest(dc.overlaps(docs(spark, [(i, t, "en") for i, t in rows]), bench)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, items), key=key)


def test_awkward_rows(spark):
    ten = "a b c d e f g h i j"
    items = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "short item"), (3, None),
             (4, "!!!"), (5, ten), (6, ten), (7, "x " * 12), (10, "solo")]
    rows = [(1, "so ALPHA beta, gamma delta epsilon zeta eta theta iota kappa no"), (2, ten + " k l " + ten),
            (3, "short  item; short item"), (4, None), (5, ""), (6, "..."), (7, "x " * 5000), (8, "a b c d e f g h i"),
            (None, ten), (None, ten), (9, "SOLO"), (9, "SOLO"), (9, "solo short item"), (11, "fine words only here"),
            (12, "item short"), (13, "b c d e f g h i j a")]
    check(spark, rows, items)


def test_no_benchmark_and_no_documents(spark):
    check(spark, [(1, "a b c"), (2, None)], [])
    check(spark, [], [(1, "a b c")])


def test_matches_the_oracle(spark):
    from viewstar.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    rel = con.sql(ORACLE_SQL["op9_decontaminate"])
    df = QUERIES["op9_decontaminate"](spark, SF_SMALL).select(*rel.columns)
    got, expected = sorted(map(tuple, df.collect())), sorted(rel.fetchall())
    assert got == expected and any(r[-1] for r in got)


def test_clean_keeps_the_rest(spark):
    df = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    bench = spark.read.parquet(f"{SF_TINY}/benchmark.parquet")
    bad = {r.doc_id for r in dc.overlaps(df, bench).where("n_hit > 0").collect()}
    kept = dc.clean(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in df.collect()} - bad and bad


def test_clean_decides_every_row_by_its_own_text(spark):
    ten = "a b c d e f g h i j"
    bench = spark.createDataFrame([(1, ten)], "item_id long, text string")
    rows = [(None, ten), (None, "fine words"), (None, None), (1, ten + " k"), (1, "fine too"), (2, ""), (None, "fine words")]
    kept = dc.clean(docs(spark, [(i, t, "en") for i, t in rows]), bench)
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=key) == sorted(
        [r for r in rows if not (r[1] or "").startswith(ten)], key=key)


def test_clean_takes_whole_rows_past_python(spark):
    """Texts are read in Python once, for their windows; the rows themselves are told apart by Spark."""
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    kept = dc.clean(docs(spark, [(1, "a b c d e f g h i j k", "en"), (2, "fine", "en")]), bench)
    assert "MapInArrow" not in kept._jdf.queryExecution().toString() and [r.doc_id for r in kept.collect()] == [2]
