import math
from collections import Counter

from conftest import SF_SMALL
from llm.helpers import docs, sf_docs
from viewstar.llm import langid
from viewstar.llm.queries import held_out

TRAIN = [(i, "the cat and the dog in the house " * 3, "en") for i in range(4)] + \
        [(10 + i, "der Hund und die Katze über dem Haus ß " * 3, "de") for i in range(4)]


def symbols(model, data):
    return [int(model.symbol[b]) for b in data]


def plain_bits(train, lang, text, model):
    """Code length by walking contexts in dictionaries: PPM method C without exclusions."""
    order = model.order
    seen = [Counter() for _ in range(order + 1)]
    for _, t, g in train:
        if g == lang:
            s = [0] * order + symbols(model, t.encode())
            for k in range(order, len(s)):
                for n in range(order + 1):
                    seen[n][tuple(s[k - n:k]), s[k]] += 1
    total = [Counter() for _ in seen]
    kinds = [Counter() for _ in seen]
    for n, c in enumerate(seen):
        for (context, _), m in c.items():
            total[n][context] += m
            kinds[n][context] += 1
    bits, s = 0.0, [0] * order + symbols(model, text.encode())
    for k in range(order, len(s)):
        for n in range(order, -1, -1):
            context = tuple(s[k - n:k])
            if not total[n][context]:
                continue
            rest = total[n][context] + kinds[n][context]
            if seen[n][context, s[k]]:
                bits -= math.log2(seen[n][context, s[k]] / rest)
                break
            bits -= math.log2(kinds[n][context] / rest)
        else:
            bits += math.log2(model.size)
    return bits


def test_code_lengths_match_plain_trees(spark):
    import numpy as np
    model = langid.train(docs(spark, TRAIN))
    assert model.languages == ["de", "en"] and model.order == 3
    texts = ["The cat!", "", "über", "a", "xyz 123 ñ", "der hund " * 50]
    data = [t.encode() for t in texts]
    raw = np.frombuffer(b"".join(data), np.uint8)
    got = model.code_lengths(raw, np.append(0, np.cumsum([len(d) for d in data])))
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.languages):
            assert abs(got[i, j] - plain_bits(TRAIN, lang, t, model)) < 1e-3 * (1 + got[i, j])


def test_spans_change_nothing(spark, monkeypatch):
    import numpy as np
    model = langid.train(docs(spark, TRAIN))
    data = [b"the dog " * 9, b"", "über das Haus".encode(), b"x"]
    raw, off = np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(d) for d in data]))
    whole = model.code_lengths(raw, off)
    for span in (1, 2, 3, 7, 64):
        monkeypatch.setattr(langid, "_SPAN", span)
        assert np.allclose(model.code_lengths(raw, off), whole)


def test_awkward_rows(spark):
    model = langid.train(docs(spark, TRAIN + [(50, None, "en"), (51, "the", None)]))
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the house and the dog"), (4, "the house and the dog"),
            (5, "der Hund und die Katze"), (None, "die Katze"), (6, "字"), (7, "the " * 40000), (8, "—")]
    got = {(r.id, r.lang_pred, 0 <= r.score <= 1, r.score > 0) for r in
           langid.identify(docs(spark, [(i, t, "zz") for i, t in rows]), model).collect()}
    assert {g[:2] for g in got} >= {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (None, "de"), (7, "en"), (8, "und")}
    assert all(g[2] and (g[3] == (g[1] != "und")) for g in got)
    assert {g[1] for g in got if g[0] == 6} <= {"en", "de"}
    kept = langid.spoken(docs(spark, [(i, t, "zz") for i, t in rows]), model)
    assert {r.doc_id for r in kept.collect()} >= {4, 5, 7, None} and kept.columns == docs(spark, []).columns
    assert not {r.doc_id for r in kept.collect()} & {1, 2, 3, 8}
    nothing = langid.train(docs(spark, [(1, "a", None)]))
    assert {r.lang_pred for r in langid.identify(docs(spark, TRAIN), nothing).collect()} == {"und"}
    assert langid.identify(docs(spark, []), model).count() == 0


def test_held_out_accuracy(spark):
    df = sf_docs(spark, SF_SMALL)
    model = langid.train(df.where(~held_out("doc_id", 3, 1)))
    got = langid.identify(df, model).withColumnRenamed("id", "doc_id").join(df.select("doc_id", "lang"), "doc_id") \
        .where(held_out("doc_id", 3, 1)).collect()
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


def test_depth_does_not_depend_on_the_alphabet(spark):
    """Many symbols and languages: the depth asked for is the depth used, and code lengths are those of the trees."""
    import numpy as np
    train = TRAIN + [(100 + k, " ".join(chr(0x400 + (7 * k + j) % 256) * (1 + j % 3) for j in range(90)), f"l{k % 9}") for k in range(40)]
    model = langid.train(docs(spark, train), order=3)
    assert model.order == 3 and model.size > 80 and len(model.languages) == 11
    data = "der hund Ԁђ the Ж".encode()
    got = model.code_lengths(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    for j, lang in enumerate(model.languages):
        assert abs(got[0, j] - plain_bits(train, lang, data.decode(), model)) < 1e-3 * (1 + got[0, j])


def test_rows_of_codes_are_found():
    import numpy as np
    codes = np.unique(np.random.default_rng(5).integers(0, 1 << 40, 5000))
    rows = langid._Rows(codes)
    assert (rows.of(codes) == np.arange(len(codes))).all()
    assert (rows.of(codes[codes < (1 << 40) - 2] + 1)[~np.isin(codes[codes < (1 << 40) - 2] + 1, codes)] == -1).all()
    assert len(langid._Rows(codes[:0]).of(codes)) == len(codes) and (langid._Rows(codes[:0]).of(codes) == -1).all()


def test_whole_texts_are_handled_in_small_pieces(spark):
    """However many rows a batch has, what works on texts gets about so many bytes at once, and every row."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    from viewstar.llm.tables import by_batch

    def count(batch):
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])
    df = spark.range(2000, numPartitions=1).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    got = by_batch(df, count, "n long, size long", 100_000).collect()
    assert sum(r.n for r in got) == 2000 and max(r.size for r in got) < 120_000
    assert [r.n for r in by_batch(df.limit(3), count, "n long, size long", 10).collect()] == [1, 1, 1]
    assert sum(r.n for r in by_batch(df, count, "n long, size long").collect()) == 2000


def test_spoken_takes_whole_rows_past_python(spark):
    """Texts are scored in small batches that end with the call; the rows themselves are told apart by Spark."""
    model = langid.train(docs(spark, TRAIN))
    kept = langid.spoken(docs(spark, [(1, "der hund und die katze", "zz"), (2, None, "zz"), (3, "12 3", "zz")]), model)
    assert "MapInArrow" not in kept._jdf.queryExecution().toString() and [r.doc_id for r in kept.collect()] == [1]


def test_scoring_takes_little_memory_beside_the_texts(spark):
    import tracemalloc
    import pyarrow as pa
    model = langid.train(docs(spark, TRAIN))
    texts = pa.array(["the dog and the cat " * 100] * 500)  # 1 MB
    tracemalloc.start()
    model.predict(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
