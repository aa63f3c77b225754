import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import FOLD, docs
from viewstar.llm import queries, spelling


def plain_words(rows, min_count=3):
    counts = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain(words):
    """All pairs by wildcards: a position left open, or a letter taken out."""
    near = {w: set() for w in words}
    open_at = {}
    for w in words:
        for k in range(len(w)):
            open_at.setdefault((len(w), k, w[:k] + w[k + 1:]), []).append(w)
            if (short := w[:k] + w[k + 1:]) in words:
                near[w].add(short)
                near[short].add(w)
    for same in open_at.values():
        for a in same:
            near[a].update(b for b in same if b != a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root))
    return sorted(out)


def rows_of(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def made_up(n, seed=3):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        w = "".join(rnd.choice("abeéñÀ") for _ in range(rnd.randrange(4, 8)))
        out += [w] * rnd.randrange(1, 40)
    return out


def test_wildcards_find_what_all_pairs_find():
    words = {w: n + 2 for w, n in Counter(made_up(120)).items() if len(w) > 4}
    near = {w: sum(one_edit(w, x) for x in words) for w in words}
    assert {w: k for w, _, k, *_ in plain(words)} == near


def test_against_plain(spark):
    words = made_up(900)
    rows = [(k, " ".join(words[k::50]), "fr") for k in range(50)]
    assert rows_of(spelling.group(docs(spark, rows))) == plain(plain_words(rows))


def test_many_cells_salts_and_leaves(spark, monkeypatch):
    """Small cells, a sample too small to cut them evenly, hence salts; results stay whole."""
    words = made_up(900, seed=8)
    rows = [(k, " ".join(words[k::50]), "fr") for k in range(50)]
    for cell, sample in ((40, 100_000), (10, 60), (7, 1)):
        vocabulary = spelling.vocabulary(docs(spark, rows)).cache()
        cells = spelling.cells_of(vocabulary, sample, cell)
        assert cells.planes and (sample > 1000 or max(cells.salts.values()) > 1)
        assert rows_of(spelling.group(docs(spark, rows), sample_words=sample, cell_words=cell)) == plain(plain_words(rows))


def test_planes_reach_every_near_point():
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("abcdéz") for _ in range(6)) for _ in range(400)})
    codes = spelling.letter_counts(spelling.letters(words, 6))
    planes = spelling.Planes(codes, 4)
    own = {int(k): cell for rows, cell in planes.reach(codes, 0, 0) for k in rows}
    assert sorted(own) == list(range(len(words))) and planes.cells > 8
    reached = {(int(k), cell) for rows, cell in planes.reach(codes, 1, 1) for k in rows}
    for a, w in enumerate(words):
        for b, x in enumerate(words):
            if one_edit(w, x):
                assert (a, own[b]) in reached


def test_letter_counts_never_widen_a_distance():
    words = ["aaaab", "aaabb", "éàüñÿ", "abcde"]
    codes = spelling.letter_counts(spelling.letters(words, 5))
    counts = [Counter(w) for w in words]
    for i in range(4):
        for j in range(4):
            steps = sum(abs(counts[i][c] - counts[j][c]) for c in counts[i] | counts[j])
            assert int(np.bitwise_count(codes[i] ^ codes[j])) <= steps


def test_awkward_rows(spark):
    """Null id and text, words longer than a cell's length, chains of forms, ties, capitals with accents, repeats."""
    long = "ab" * 60
    rows = [(None, "Hallo hallo HALLO", "en"), (1, None, "en"), (2, "", "en")] \
        + [(3, f"{long} {long}x {'a' + long[1:]} ÉTÉSX étésx ×××××", "fr")] * 3 + [(4, f"{long}y " * 9, "fr")] \
        + [(5, "chain " * 3 + "chaim " * 6 + "claim " * 12 + "claims " * 24, "en")] \
        + [(6, "tiess " * 3 + "tiesa " * 9 + "tiesb " * 9, "en"), (7, "abcd " * 9 + "abcde " * 20, "en")] \
        + [(8, "q" * 100_000 + " " + "word " * 50_000, "en")] * 3
    assert rows_of(spelling.group(docs(spark, rows))) == plain(plain_words(rows))
    assert rows_of(spelling.group(docs(spark, []))) == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.text("abA é", max_size=40), st.just("en")), max_size=20))
def test_any_rows(spark, rows):
    words = plain_words(rows, 1)
    assert rows_of(spelling.group(docs(spark, rows), min_count=1, cell_words=4)) == plain(words)


def test_query_on_the_small_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = queries.op13_spelling(spark, path)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(got) == plain(plain_words(rows))
