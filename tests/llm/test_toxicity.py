import numpy as np
import pyarrow as pa

from conftest import SF_SMALL
from llm.helpers import docs, sf_docs
from viewstar.llm import langid, toxicity
from viewstar.llm import textkit as tk
from viewstar.llm.queries import held_out


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_pooling_matches_plain_convolution():
    rng = np.random.default_rng(0)
    model = toxicity.Model(4, rng.normal(size=(2, 16, 3)).astype(np.float32),
                           [rng.normal(size=(w, 3, 2)).astype(np.float32) for w in toxicity.WIDTHS],
                           rng.normal(size=6).astype(np.float32), rng.normal(size=6).astype(np.float32), 0.1)
    texts = ["one two three four", "", "alone", "a b", "one two three four five six " * 4]
    (_, _, s), = list(tk.slices(pa.array(texts), tk.ALNUM_WORDS))
    h = s.hashes()
    got = model.logits(h, s.first)
    for i in range(len(texts)):
        own = h[s.first[i]:s.first[i + 1]]
        a, b = toxicity._buckets(own, 4)
        x = np.concatenate([model.tables[0][a] + model.tables[1][b], np.zeros((2, 3), np.float32)])
        features = []
        for w, f in zip(toxicity.WIDTHS, model.filters):
            values = [sum(x[t + j] @ f[j] for j in range(w)) for t in range(len(own))]
            features.append(np.max(values, axis=0) if values else np.full(2, -1e9))
        logit = np.maximum(np.concatenate(features) + model.bias, 0) @ model.out + model.intercept
        assert abs(logit - got[i]) < 1e-4


def test_threshold_is_the_best_cut():
    z, y = np.array([3.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 0])
    assert 1.0 < toxicity._threshold(z, y) < 2.0


def test_awkward_rows(spark):
    bad, good = "you are a stupid idiot", "what a fine and sunny day"
    train = [(i, f"{bad if i % 3 == 0 else good} word{i}", "en") for i in range(120)]
    marks = labels(spark, [(i, 1, int(i % 3 == 0), "x") for i in range(120)] + [(0, 1, None, "x"), (None, 1, 1, "x"), (999, 0, 1, "x")])
    model = toxicity.train(docs(spark, train), marks)
    rows = [(1, None), (2, ""), (3, "..."), (4, f"so {bad} there"), (4, f"so {bad} there"), (None, good),
            (5, f"{'fine day ' * 200_000} stupid idiot"), (6, "idiot")]
    got = toxicity.score(docs(spark, [(i, t, "en") for i, t in rows]), model).collect()
    by_id = {r.id: r.predicted for r in got}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert (by_id[4], by_id[5], by_id[None], by_id[1], by_id[2], by_id[3]) == (1, 1, 0, 0, 0, 0)
    assert toxicity.score(docs(spark, []), model).count() == 0
    none = toxicity.train(docs(spark, train), labels(spark, []))
    assert {r.predicted for r in toxicity.score(docs(spark, train), none).collect()} == {0}


def test_held_out_quality_and_language_thresholds(spark):
    df = sf_docs(spark, SF_SMALL)
    marks = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    language = langid.train(df, sample_docs=300, order=2)
    model = toxicity.train(df, marks.where(~held_out("doc_id", 5, 0)), language)
    got = toxicity.score(df, model).withColumnRenamed("id", "doc_id").join(marks, "doc_id") \
        .where(held_out("doc_id", 5, 0)).collect()
    assert len(got) > 40 and sum(r.toxic == r.predicted for r in got) / len(got) >= 0.9


def test_documents_of_an_id_that_repeats_are_bounded(spark, monkeypatch):
    """One labelled id with thousands of texts: the driver gathers about the sample, not all of them."""
    bad, good = "you are a stupid idiot", "what a fine and sunny day"
    train = [(0, f"{bad} text{i}", "en") for i in range(3000)] + [(0, bad, "en")] * 500 + [(i, good, "en") for i in range(1, 60)]
    seen = []
    real = toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda samples, *a: (seen.append(len(samples)), real(samples, *a))[1])
    toxicity.train(docs(spark, train), labels(spark, [(i, 1, int(i == 0), "x") for i in range(60)]), sample_docs=300, epochs=1)
    assert 150 < seen[0] < 400


def test_query_matches_a_plain_scoring(spark):
    """Every row of the query against its model applied word by word, window by window."""
    from conftest import SF_TINY
    from llm.helpers import ALNUM_WORDS, words
    from viewstar.llm.queries import QUERIES, crc_bucket
    df, marks = sf_docs(spark, SF_TINY), spark.read.parquet(f"{SF_TINY}/labels.parquet")
    language = langid.train(df.where(~held_out("doc_id", 5, 0)), sample_docs=300, order=2)
    model = toxicity.train(df, marks.where(~held_out("doc_id", 5, 0)), language)
    held = {r.doc_id for r in df.where(crc_bucket("doc_id", 5) == 0).collect()}
    got = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, SF_TINY).collect()}
    for r in df.collect():
        own = [tk.Slice(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]), tk.ALNUM_WORDS).hashes()[0]
               for w in words(ALNUM_WORDS, r.text)]
        a, b = toxicity._buckets(np.array(own, dtype=np.uint64), model.bits)
        x = [*(model.tables[0][a] + model.tables[1][b]), *np.zeros((2, model.tables.shape[2]), np.float32)]
        features = []
        for w, f in zip(toxicity.WIDTHS, model.filters):
            values = [sum(x[t + j] @ f[j] for j in range(w)) for t in range(len(own))]
            features += list(np.max(values, axis=0)) if values else [-1e9] * f.shape[2]
        logit = float(np.maximum(np.array(features) + model.bias, 0) @ model.out + model.intercept)
        name = langid.identify(df.where(f"doc_id = {r.doc_id}"), language).first().lang_pred if r.doc_id < 3 else \
            language.predict(pa.array([r.text]))[0][0]
        limit = model.thresholds.get(name, model.threshold)
        score = 1 / (1 + np.exp(-np.clip(logit - limit, -60, 60)))
        assert abs(got[r.doc_id].score - score) < 1e-3 and got[r.doc_id].held_out == (r.doc_id in held)
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)
    assert len(got) == df.count()


def test_every_labelled_document_is_learned_from(spark, monkeypatch):
    """More documents than one shard holds, long ones too: three quarters are counted and trained on."""
    monkeypatch.setattr(toxicity, "SHARD_DOCS", 200)
    tail = " ".join(["calm"] * 5000)
    rows = [(i, f"the word{i} {'gruesome vile' if i % 4 == 0 else 'mild kind'} {tail if i % 100 == 3 else ''}", "en") for i in range(1200)]
    # One word decides a few documents that any sample may miss.
    rows += [(2000 + i, f"the word{i} mild kind zounds", "en") for i in range(8)]
    marks = labels(spark, [(i, 1, int(i % 4 == 0 or i >= 2000), "x") for i, _, _ in rows])
    counted = []
    real = toxicity._Training.begin.__func__
    monkeypatch.setattr(toxicity._Training, "begin",
                        classmethod(lambda cls, seen, n, *a: (counted.append((seen, n)), real(cls, seen, n, *a))[1]))
    twice = rows + rows[:50] + [(None, "no id", "en"), (5000, "no label", "en")]
    model = toxicity.train(docs(spark, twice), marks)
    (seen, n), = counted
    total = len(rows)
    assert n.sum() == seen[0].sum(axis=0).max() and 0.74 * total < n.sum() < 0.78 * total
    got = {r.id: r.predicted for r in toxicity.score(docs(spark, rows), model).collect()}
    assert all(got[i] == int(i % 4 == 0 or i >= 2000) for i, _, _ in rows)


def test_one_shard_trains_as_one_machine_does(spark):
    """The shards' path on one shard gives the model of the plain trainer on the same rows."""
    bad, good = "you are a stupid idiot", "what a fine and sunny day"
    train = [(i, f"{bad if i % 3 == 0 else good} word{i} word{i // 2}", "en") for i in range(160)]
    marks = labels(spark, [(i, 1, int(i % 3 == 0), "x") for i in range(160)])
    one, plain = (toxicity.train(docs(spark, train), marks, sample_docs=k, epochs=2) for k in (None, 10_000))
    assert np.array_equal(one.tables, plain.tables) and np.array_equal(one.out, plain.out)
    assert abs(one.threshold - plain.threshold) < 2 / toxicity._STEPS
