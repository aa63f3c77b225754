import random
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import FOLD
from viewstar.llm import queries, source_divergence as sd

SCHEMA = "doc_id long, text string, lang string, source string, term string, tf long, gid long, p long, value long"


def plain(rows, min_docs=10, top=10):
    """Every kept term against every pair of sources, with Python's whole numbers."""
    tf, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [w.decode() for w in sd.TERM.findall((text or "").translate(FOLD).encode())]
        tf[lang, source].update(words)
        df[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = [t for t, d in df[lang].items() if d >= min_docs]
        v = len(kept)
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(tf[g])

        def shares(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * v) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        p, q = shares(tf[lang, source]), shares(whole)
        pairs = []
        for other in {s for g, s in groups if g == lang} - {source}:
            o = shares(tf[lang, other])
            pairs.append((-sum(f(p[t], o[t]) for t in kept), other.encode()))
        terms = [(-f(p[t], q[t]), t.encode()) for t in kept if tf[lang, source][t] and p[t] > q[t]]
        for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(1, t, g, s, "x", 1, 2, 3, 4) for t, g, s in rows], SCHEMA)
    return sorted(tuple(r) for r in sd.audit(df, **options).collect())


def corpus(n, seed=1):
    rnd = random.Random(seed)
    vocab = ["the", "Of", "été", "zu", "naïve", "x1y", "日本語", "Ж", "long" * 40] + [f"w{k}".translate(
        str.maketrans("0123456789", "abcdefghij")) for k in range(60)]
    rows = []
    for _ in range(n):
        source = f"s{min(rnd.randrange(9), 5)}"
        words = rnd.choices(vocab, weights=[1 / (k + 1) for k in range(len(vocab))], k=rnd.randrange(0, 60))
        rows.append((rnd.choice([" ", ", ", "\n", "7"]).join(words), rnd.choice(["en", "de"]), source))
    return rows


def test_against_plain_counts(spark):
    rows = corpus(300)
    assert found(spark, rows) == plain(rows)


def test_many_runs_and_pages(spark, monkeypatch):
    """Blocks of a few texts, one or many shards: the merge gives the same whole frequencies."""
    rows = corpus(200, seed=5)
    for shards, block in ((1, 20_000), (7, 1)):
        assert found(spark, rows, shards=shards, block_bytes=block, min_docs=4) == plain(rows, 4)


def test_heap_merge_of_small_pages(monkeypatch):
    """Pages of two terms from runs of different sizes come out in order, each key's parts together."""
    monkeypatch.setattr(sd, "PAGE_TERMS", 2)
    rows, pages = corpus(60, seed=9), []
    for lo in range(0, 60, 13):
        block = sd.Block()
        for text, lang, source in rows[lo:lo + 13]:
            block.add(lang, source, text)
        pages += [(first, page) for _, first, page in block.run(1)]
    kept = list(sd._kept(iter(sorted(pages)), 1))
    counts = Counter()
    for text, lang, source in rows:
        counts.update((lang.encode(), w, source.encode()) for w in sd.TERM.findall(text.translate(FOLD).encode()))
    assert {(k[0], k[1], k[2]): k[3] for k in kept} == counts and len(kept) == len(counts)
    keys = [k[1] + b"\0" + k[0] for k in kept]
    assert keys == sorted(keys)


def test_awkward_rows(spark):
    """Nulls, empty and very long texts, a language without kept terms, a source alone, repeats."""
    rows = [(None, None, None), ("", "en", None), (None, "en", "a"), ("solo", "fr", "only")] \
        + [("Same words same", "en", "a")] * 12 + [("same " * 300_000, "en", "b"), ("B words", "en", "b")] \
        + [("x" * 3_000_000, "en", "b")] + [("lang\x00less ퟿", None, "q")] * 11
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_shares_are_whole_divisions():
    import numpy as np
    counts = np.array([0, 1, 7, 10**12, 10**12 - 1, 3 * 10**13])
    totals = np.array([5, 9, 12345677, 3 * 10**13 + 7, 10**12 + 999_983, 8 * 10**14 + 1])
    assert sd.shares(counts, totals).tolist() == [1 + 10**9 * (c + 2) // t for c, t in zip(counts.tolist(), totals.tolist())]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.text("aB é1", max_size=12)), st.sampled_from(["en", None]),
                               st.sampled_from(["a", "b", "", None])), max_size=25))
def test_any_rows(spark, rows):
    assert found(spark, rows, min_docs=2) == plain(rows, 2)


def test_query_on_the_small_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("text", "lang", "source").collect()]
    got = queries.op11_source_divergence(spark, path)
    assert got.where(F.col("part") == "term").count() > 0
    assert sorted(tuple(r) for r in got.collect()) == plain(rows)
