import numpy as np

from conftest import SF_SMALL
from viewstar.llm import ann


def brute(ids, vectors, every=50, k=5):
    x = np.array(vectors, dtype=np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i in np.flatnonzero(np.array(ids) % every == 0):
        score = x @ x[i] / (norm * norm[i])
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if j != i][:k]
        out[ids[i]] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def results(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def recall(got, expected):
    hits = sum(sum(s >= e[-1][1] - 1e-9 for _, s in got.get(q, [])) for q, e in expected.items() if e)
    return hits / max(sum(len(e) for e in expected.values()), 1)


def test_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    local = rows.collect()
    expected = brute([r.vec_id for r in local], [r.embedding for r in local])
    for options in ({}, {"block_rows": 60, "leaf": 8, "sample_rows": 40, "query_rows": 3}):
        got = results(ann.neighbours(rows, **options))
        assert set(got) == set(expected) and all(len(v) == 5 for v in got.values())
        exact = {q: dict(brute([r.vec_id for r in local], [r.embedding for r in local], k=len(local))[q]) for q in list(got)[:3]}
        for q, scores in exact.items():
            assert all(abs(scores[i] - s) < 1e-9 for i, s in got[q])
        assert recall(got, expected) >= 0.9, options


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (50, [1.0, 1.0]), (None, [1.0, 0.0]),
            (100, None), (150, [0.0, 0.0]), (0, [1.0, 0.0])] + [(200 + i, [1.0, 0.0]) for i in range(30)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, block int")
    got = results(ann.neighbours(df))
    assert set(got) == {0, 50, 200}
    assert [i for i, _ in got[0]] == [1, 2, 200, 201, 202]
    assert [i for i, _ in got[200]] == [0, 1, 2, 201, 202]
    assert [i for i, _ in got[50]] == [0, 1, 2, 3, 200]
    few = results(ann.neighbours(df.where("vec_id IN (0, 3)")))
    assert few == {0: [(3, 0.0)]}
    assert ann.neighbours(df.limit(0)).count() == 0 and ann.neighbours(df.where("vec_id = 3")).count() == 0


def test_quantile():
    assert abs(ann.chi_square_quantile(0.95, 8) - 15.507) < 1e-3


def test_regions_cover_the_space():
    x = np.random.default_rng(1).normal(size=(500, 4))
    r = ann.Regions.fit(x, 3, 4)
    own = r.of(x)
    assert set(own) == set(range(8))
    far = r.reach(x)
    assert (far[np.arange(500), own] == 0).all() and (far >= 0).all()


def test_clustered_vectors_are_mostly_passed_over(spark, monkeypatch):
    """Vectors in tight clusters: recall stays, and under a tenth of all pairs is verified."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 64))
    x = (centres[np.arange(4000) % 40] + 0.15 * rng.normal(size=(4000, 64))).astype(np.float32)
    unit = ann._unit(x.astype(np.float64))
    near = unit @ np.random.default_rng(5).normal(size=(64, ann.DIMS))
    queries = np.arange(0, 4000, 50)
    q, c, verified = ann._search(np.arange(4000), unit, near, queries, unit[queries], near[queries],
                                 np.full(len(queries), np.inf), 5, ann.chi_square_quantile(ann.CONFIDENCE, ann.DIMS), 64)
    assert verified < 0.1 * len(queries) * 4000
    expected = brute(list(range(4000)), x)
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    assert recall(results(ann.neighbours(df, block_rows=300)), expected) >= 0.9
