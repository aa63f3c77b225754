import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_TINY
from llm.helpers import docs, sf_docs
from viewstar.llm import packing as pk


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return made


def ids_of(library, text):
    return [*(library.encode(text, add_special_tokens=False).ids if text else []), 0]


ODD = ["", "a  b", " x", "x ", "a\n\nb", "a \nb", "é b c", "<|endoftext|> hi", "a\tb c", "it's we'll 12 34!? x y z", "\n",
       "a\r\nb", " ", "a b　c", "x  y z", "“q” — r", "a  b", "字 漢字\nb", "a\x1cb c", "  lead", "end  "]


def test_ids_are_the_librarys(library):
    encoder = pk.Encoder()
    random.seed(3)
    made = ["".join(random.choice(" \n\tab'é.1 ") for _ in range(random.randint(0, 30))) for _ in range(400)]
    texts = [t.encode() for t in ODD + made]
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    for _ in range(2):  # the second time from the cache
        got = encoder(raw, np.append(0, np.cumsum([len(t) for t in texts])))
        assert [g.tolist() for g in got] == [ids_of(library, t)[:-1] for t in ODD + made]


def best_fit(lengths, window):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [(f, k) for k, f in enumerate(free) if f >= n]
        if fits:
            free[min(fits)[1]] -= n
        else:
            free.append(window - n)
    return free


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_best_fit_decreasing(seed):
    random.seed(seed)
    window = random.choice([1, 16, 64, 1024])
    lengths = [random.randint(1, window) for _ in range(random.randint(0, 300))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = pk.best_fit_decreasing(counts, window)
    used = {}
    if lengths:
        length = np.array([n for n in counts for _ in range(counts[n])])
        rank = np.array([k for n in counts for k in range(counts[n])])
        sequence, offset = plan.place(length, rank)
        for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), length.tolist())):
            assert used.get(s, 0) == o
            used[s] = o + n
    assert sorted(used) == list(range(plan.sequences))
    assert sorted(window - u for u in used.values()) == sorted(best_fit(lengths, window))


def check(df, rows, library, window=1024):
    pieces = pk.pack(df, window=window, with_ids=True).collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length <= 4 * window
    expected = {}
    for i, t in rows:
        expected.setdefault(i, []).append(ids_of(library, t))
    assert set(by_doc) == set(expected)
    for i, docs_of in expected.items():
        if len(docs_of) > 1:
            assert sum(p.length for p in by_doc[i]) == sum(map(len, docs_of))
            continue
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist() == docs_of[0]
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert all(p.doc_tokens == len(docs_of[0]) for p in own)
    fill = {}
    for s, o, n in sorted((p.sequence_id, p.offset, p.length) for p in pieces):
        assert fill.get(s, 0) == o
        fill[s] = o + n
    assert max(fill.values(), default=0) <= window
    assert sorted(window - f for f in fill.values()) == sorted(best_fit([p.length for p in pieces], window))


def test_corpus_round_trip(spark, library):
    df = sf_docs(spark, SF_TINY)
    check(df.repartition(5), [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], library)


def test_awkward_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (None, "null id"), (101, "same"), (101, "same"),
                                                   (102, "long text " * 4000), (103, "w " * 7)]
    check(docs(spark, [(i, t, "en") for i, t in rows]), rows, library, window=64)
    assert pk.pack(docs(spark, [])).count() == 0


def test_added_tokens_are_the_unmodified_librarys(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*ODD, "a <|endoftext|> hi", "<|endoftext|>", "x<|endoftext|><|endoftext|>\ny z", "<|endoftext|", "a b c"]
    expected = [ids_of(plain, t) for t in texts]
    assert expected[len(ODD)] == [64, 220, 50256, 23105, 0]
    made = [t.encode() for t in texts]
    got = pk.Encoder()(np.frombuffer(b"".join(made), dtype=np.uint8), np.append(0, np.cumsum([len(t) for t in made])))
    assert [[*g.tolist(), 0] for g in got] == expected
    pieces = pk.pack(docs(spark, [(i, t, "en") for i, t in enumerate(texts)]), with_ids=True).collect()
    assert {p.doc_id: np.frombuffer(p.ids, "<u4").tolist() for p in pieces} == dict(enumerate(expected))


def test_texts_reach_the_encoder_in_small_batches(spark, monkeypatch):
    """Tokens are made while Python tasks get few rows at once; the session's own setting is back afterwards."""
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    before, real = spark.conf.get(name), pk.written

    def watched(df, to):
        seen[to] = int(spark.conf.get(name))
        return real(df, to)
    monkeypatch.setattr(pk, "written", watched)
    rows = [(i, f"row {i} " * (i % 50)) for i in range(1200)]
    pieces = pk.pack(docs(spark, [(i, t, "en") for i, t in rows]).coalesce(1), window=64).collect()
    assert seen["tokens"] == 500 and spark.conf.get(name) == before
    assert {p.doc_id for p in pieces} == set(range(1200))


def test_library_is_kept_only_once_a_text_needs_it(library):
    encoder = pk.Encoder()
    encoder.one("plain text")
    assert not any(isinstance(x, Tokenizer) for x in vars(encoder).values())
    text = "a <|endoftext|> b"
    assert encoder.one(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert any(isinstance(x, Tokenizer) for x in vars(encoder).values())
