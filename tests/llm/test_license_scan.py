from conftest import SF_TINY
from llm.helpers import ALNUM_WORDS, docs, sf_docs, words
from viewstar.llm import license_scan as ls


def base(text):
    w = words(ALNUM_WORDS, text)
    at, labels = [], set()
    for phrase, label in ls.PHRASES.items():
        p = phrase.split()
        found = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_base_matches_brute_force(spark):
    df = sf_docs(spark, SF_TINY)
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in ls.scan(df).collect()}
    assert got == {r.doc_id: base(r.text) for r in df.select("doc_id", "text").collect()}


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "MIT\nLicense, mit license mit licenses"), (4, "the gnu general public  license!"),
            (5, "cc by cc-by CC_BY"), (None, "apache license"), (6, "apache license"), (6, "apache license"),
            (7, "x " * 30000 + "mit license"), (8, "mit. license"), (9, "smit license mit licens")]
    got = ls.scan(docs(spark, [(i, t, "en") for i, t in rows])).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=key) == \
        sorted([(i, *base(t)) for i, t in rows], key=key)
    assert all(0 <= r.score <= 1 and (r.score == 1.0) == (r.n_base > 0) for r in got)
    assert ls.scan(docs(spark, [])).count() == 0


def test_fuzzy_notices():
    scanner = ls.Scanner(ls.PHRASES, ls.NOTICES)
    for notice, label in ls.NOTICES.items():
        k = max(1, int(len(notice) * 0.1))
        damaged = notice
        for j in range(min(k, 4)):  # substitutions spread over the notice
            at = (j * 2 + 1) * len(notice) // 9
            damaged = damaged[:at] + "#" + damaged[at + 1:]
        for text in (notice, damaged, notice[:10] + "x" + notice[10:], notice[:7] + notice[8:]):
            flat = f" some words {text} and more "
            found = [f for f in scanner.scan(flat)[1] if f[2] == label]
            assert found, (notice, text)
            start, end, _, score = max(found, key=lambda f: f[3])
            assert score >= 1 - distance(notice, text) / len(notice) - 1e-9
            assert distance(flat[start:end], min(ls.NOTICES, key=lambda n: distance(flat[start:end], n))) <= k
        assert not [f for f in scanner.scan(f" {notice[:len(notice) // 2]} zzz ")[1] if f[2] == label and f[3] > 0.95]


def test_notice_spans_and_labels(spark):
    text = "Intro words. Permission is hereby granted, free of charge, to any persn obtaining a copy of this software. End"
    row = ls.scan(docs(spark, [(1, text, "en")])).collect()[0]
    assert (row.n_base, row.base_labels, row.labels) == (0, "", "mit") and 0.9 < row.score < 1
    label, span = row.notices.split(":")
    assert label == "mit" and span == "2-17"


def test_notices_before_a_better_one_are_found():
    scanner = ls.Scanner(ls.PHRASES, ls.NOTICES)
    for notice, label in ls.NOTICES.items():
        wrong = notice[:9] + "#" + notice[10:]
        flat = f" {wrong} and {wrong} and {notice} and {wrong} "
        at = [f[0] for f in scanner.scan(flat)[1] if f[2] == label and f[3] > 0.9]
        assert at == [1 + j * (len(notice) + 5) for j in range(4)], notice
