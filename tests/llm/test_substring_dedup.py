import numpy as np

from conftest import SF_TINY
from llm.helpers import FOLD, docs, sf_docs
from viewstar.llm import substring_dedup as sd


def test_sentences_add_up():
    for text in ("", "One. Two! Three?\nFour\n\n five. ", "w " * 100, "\n\n", " . . .", "a" * 500, "x. " + "y " * 40 + "z.\nq",
                 "é ü. ß\n" * 30, " ".join(f"v{k % 13}" for k in range(300))):
        pieces = sd.sentences(text)
        assert "".join(pieces) == text
        assert all(len(p.split()) <= sd.MAX_WORDS for p in pieces)
        assert [w for p in pieces for w in p.split()] == text.split()
    assert sd.sentences("One. Two! Three?\nFour 3.5 five") == ["One. ", "Two! ", "Three?\n", "Four 3.5 five"]


def plain_runs(size):
    """(first sentence, end): long enough runs that are too short without their first or last sentence."""
    if not size:
        return set()
    if len(size) < 3 or sum(size) < 8:
        return {(0, len(size))}
    enough = lambda a, b: b - a >= 3 and sum(size[a:b]) >= 8
    out = set()
    for a in range(len(size)):
        b = next((b for b in range(a + 3, len(size) + 1) if enough(a, b)), None)
        out |= {(a, b)} if b else set()
        c = next((c for c in range(a, -1, -1) if enough(c, a + 1)), None)
        out |= {(c, a + 1)} if c is not None else set()
    return out


def plain_dedup(rows):
    """[(id, text)] in order of ids -> (text left, sentences, removed, spans) of each; runs are looked up one by one."""
    seen, out = set(), []
    for _, text in rows:
        pieces = [p for p in sd.sentences(text or "") if p.split()]
        whole = sd.sentences(text or "")
        w = [p.translate(FOLD).split() for p in pieces]
        gone = set()
        for a, b in sorted(plain_runs(list(map(len, w)))):
            run = tuple(x for part in w[a:b] for x in part)
            if run in seen:
                gone |= set(range(a, b))
            seen.add(run)
        left = text or "" if not gone else "".join(p for k, p in enumerate(whole) if k not in gone)
        edge = [k for k in range(len(whole) + 1) if (k in gone) != (k - 1 in gone)]
        out.append((left, len(whole), len(gone), ",".join(f"{a}-{b}" for a, b in zip(edge[::2], edge[1::2]))))
    return out


def found(spark, rows):
    got = sd.dedup(docs(spark, [(i, t, "en") for i, t in rows])).collect()
    return [(r.text, r.n_sentences, r.n_removed, r.spans) for r in sorted(got, key=lambda r: r.doc_id)]


def test_query_matches_brute_force(spark):
    from viewstar.llm.queries import QUERIES
    rows = sorted((r.doc_id, r.text) for r in sf_docs(spark, SF_TINY).collect())
    got = sorted(QUERIES["op1_substring_dedup"](spark, SF_TINY).collect(), key=lambda r: r.doc_id)
    plain = plain_dedup(rows)
    assert [(r.text, r.n_sentences, r.n_removed, r.spans) for r in got] == plain
    assert sum(p[2] for p in plain)


def test_repeats_inside_one_document_keep_their_first_copy(spark):
    short = "Aa bb cc dd ee ff. Gg. Hh. Ii."
    other = "Here stands something else that is longer. And more of it follows now. Then it ends at last."
    rows = [(1, f"{short} {other} {short}"), (2, f"{other}\n{other}\n{other}"), (3, short),
            (4, " ".join(f"{w}." for w in "a b c d e f g h i a b c d e f g h i a b c d e f g h i".split()))]
    got = found(spark, rows)
    assert got == plain_dedup(rows)
    assert got[0][0].startswith(short) and got[0][2] >= 3 and got[2][0] == ""


def test_any_small_texts(spark):
    """Many texts of few different sentences: repeats of every kind inside and across documents."""
    import random
    rnd = random.Random(6)
    parts = ["Aa bb cc dd ee ff.", "Gg.", "Hh ii.", "No end here", "Long " * 30 + "one.", "Jj kk ll mm!", "\n", "nn oo pp?"]
    rows = [(i, " ".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 14)))) for i in range(150)]
    assert found(spark, rows) == plain_dedup(rows)


def test_awkward_rows(spark):
    passage = "Here stands the first line of it. Then comes another line of words! And a third one closes?\nA fourth."
    rows = [(1, f"Own start here. {passage} Own end."), (2, passage), (3, None), (4, ""), (5, "Short."), (6, " \n "),
            (None, passage), (None, None), (7, passage.upper()), (8, "w " * 60), (9, "w " * 60), (10, "Alone it stands. So it is."),
            (11, "tail " * 200_000)]
    got = {(r.doc_id, r.n_sentences): r for r in sd.dedup(docs(spark, [(i, t, "en") for i, t in rows])).collect()}
    by_id = {i: r for (i, _), r in got.items() if i is not None}
    assert by_id[1].n_removed == 0 and by_id[1].text == rows[0][1]
    assert by_id[2].text == "" and by_id[2].spans == "0-4" and by_id[7].text == ""
    assert by_id[3].text == "" and by_id[3].n_sentences == 0
    assert (by_id[6].text, by_id[6].n_sentences) == (" \n ", 1)
    assert by_id[10].text == rows[11][1] and by_id[9].text == ""
    assert [r.n_removed for (i, n), r in got.items() if i is None and n] == [4]
    assert sd.dedup(docs(spark, [])).count() == 0


def test_repeated_rows_stay_defined(spark):
    passage = "Here stands the first line of it. Then comes another line of words! And a third one closes?"
    out = sd.dedup(docs(spark, [(1, passage, "en"), (1, passage, "en"), (2, passage, "en")])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in out) == [(1, 0), (1, 0), (2, 3)]


def test_a_hot_passage_meets_its_first_copy_by_broadcast(spark, monkeypatch):
    passage = "Here stands the first line of it. Then comes another line of words! And a third one closes?"
    rows = [(i, f"Own words of document {i} stand here first. {passage} And its own end {i} too.") for i in range(400)]
    for share in (2, 10_000):
        monkeypatch.setattr(sd, "HOT_SHARE", share)
        assert found(spark, rows) == plain_dedup(rows)


def left(spark, texts):
    return [r[0] for r in found(spark, list(enumerate(texts)))]


def test_short_sentences_make_long_runs(spark):
    """Sentences of one or two words: runs grow until they hold the minimum of words."""
    shout = " ".join(f"W{k}!!" for k in range(60))
    tail = "Eight words and more stand in this line. And so here it goes on again. One. Two. Three."
    out = left(spark, [f"Start here. {shout} End.", shout, f"Other words come first here. {shout} Then the rest of it.",
                       f"Alpha. {tail}", f"{tail} Beta gamma delta."])
    assert out[1] == "" and out[2] == "Other words come first here. Then the rest of it."
    assert out[4] == "Beta gamma delta."


def test_small_texts_are_runs_of_their_own(spark):
    texts = ["Only one sentence here.", "only  one sentence HERE.", "One. Two.", "One. Two.", "One.", "A. B. C. D.", "A. B. C. D.",
             "Only one sentence here. But more follows it. And even more of it stands at the end.", " ", " "]
    out = left(spark, texts)
    assert [k for k, t in enumerate(out) if t != texts[k]] == [1, 3, 6] and out[1] == out[3] == out[6] == ""


def test_passage_inside_long_sentences_is_cut_alike(spark):
    """A passage of 50 words that begins anywhere in text without punctuation loses more than half its words."""
    passage = [f"p{k * k % 97}x{k}" for k in range(50)]
    rows = [" ".join([f"a{i}b{k}" for k in range(20 + i)] + passage + [f"c{i}d{k}" for k in range(30)]) for i in range(17)]
    out = left(spark, rows)
    assert out[0] == rows[0]
    for text in out[1:]:
        assert sum(w in passage for w in text.split()) < 25


def test_cuts_of_equal_words_are_far_apart():
    for text in ("w " * 100, "v w " * 100, "a b c " * 200):
        pieces = sd.sentences(text)
        assert len(pieces) <= len(text.split()) / 8 and all(len(p.split()) <= sd.MAX_WORDS for p in pieces)


def test_run_hashes_depend_on_the_words_alone():
    h = np.random.default_rng(1).integers(0, 1 << 62, 40).astype(np.uint64)
    both = np.concatenate([h[5:20], h, h[5:20]])
    lo, hi = np.array([0, 20, 55, 0]), np.array([15, 35, 70, 14])
    got = sd._run_hashes(both, lo, hi, sd._STEP)
    assert got[0] == got[1] == got[2] != got[3]
