import hashlib
import re
from collections import Counter
from math import log2, sqrt

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL, SF_TINY
from llm.helpers import ALNUM_WORDS, FOLD, docs, sf_docs
from viewstar.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    text = text or ""
    digits = lambda m: re.sub(r"[^0-9]", "", m.group())
    return ([(0, *m.span()) for m in EMAIL.finditer(text)]
            + [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
            + [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
            + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15])


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aZ.@-+_%19 5()é\n", max_size=60))
def test_base_spans_match_the_plain_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_known_values():
    text = "x a.b+c@mail-1.example.com. 10.0.0.256 8.8.8.8.8, 4111 1111-1111 1111, +49 (30) 123-4567; +1 2 a@b a@b.c@d.e"
    assert pii.base_spans(text) == plain_spans(text)
    assert [k for k, _, _ in pii.base_spans(text)] == [0, 0, 1, 2, 3]
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("1." * 50_000 + "@" * 1000)


def bound(m, n, z=1.645):
    p = m / n
    return (p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def plain_counts(rows, reach=8):
    """Documents per entity (values and classes), per term, and per term near an entity."""
    joint, n_e, n_t = Counter(), Counter(), Counter()
    for _, text in rows:
        text = text or ""
        spans = plain_spans(text)
        words = [(m.group(), *m.span()) for m in ALNUM_WORDS.finditer(text.translate(FOLD))]
        n_t.update({w for w, _, _ in words})
        pairs, entities = set(), set()
        for k, x, y in spans:
            v = text[x:y].lower()
            pooled = ("@" + v.split("@")[-1], v.rpartition(".")[0] + ".", re.sub("[^0-9]", "", v)[:6], re.sub("[^0-9]", "", v)[:6])
            own = {(k, v), (k, "class", pooled[k])}
            entities |= own
            index = sum(a < x for _, a, _ in words)
            free = lambda ws: [w for w, a, b in ws if not any(p < b and q > a for _, p, q in spans)]
            near = free(words[max(0, index - 4 * reach):index])[-reach:] + free(words[index:index + 4 * reach])[:reach]
            pairs |= {(e, w) for e in own for w in near}
        joint.update(pairs)
        n_e.update(entities)
    return joint, n_e, n_t


def plain_risky(rows, at=0.4, bits=1):
    joint, n_e, n_t = plain_counts(rows)
    risky = {}
    for (e, t), m in joint.items():
        share = bound(m, n_t[t])
        if share >= at and log2(share * len(rows) / n_e[e]) >= bits:
            risky[t] = max(risky.get(t, 0), share)
    return risky


def brute(rows):
    """(base hash, spans text) of each row, from plain counts."""
    risky, out = plain_risky(rows), []
    for _, text in rows:
        text = text or ""
        spans = plain_spans(text)
        words = [(m.group(), *m.span()) for m in ALNUM_WORDS.finditer(text.translate(FOLD))]
        terms = [f"term:{a}:{b}" for w, a, b in words if w in risky and not any(x < b and y > a for _, x, y in spans)]
        base = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans]
        out.append((hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(base + terms)))
    return out


def check(df, rows):
    got = pii.digest(pii.find(df)).collect()
    expected = [(i, *b) for (i, _), b in zip(rows, brute(rows))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.base_sha256, r.spans) for r in got], key=key) == sorted(expected, key=key)
    for r in got:
        kinds = Counter(s.split(":")[0] for s in r.spans.split(",") if s)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone, r.n_terms] == [kinds[k] for k in (*pii.KINDS, pii.TERM)]
    return sum(r.n_terms for r in got)


def test_awkward_rows(spark):
    secret = "the zorblax keeper is ann@example.org and nobody else"
    rows = [(i, f"filler{i} {secret} number {i}") for i in range(6)]
    rows += [(20 + i, f"common words number {i} the is and") for i in range(40)]
    rows += [(70, None), (71, ""), (72, " "), (None, secret), (None, None), (73, secret), (73, secret),
             (74, "é字 " * 9000 + secret + " zorblax"), (75, "nothing but the zorblax here")]
    check(docs(spark, [(i, t, "en") for i, t in rows]), rows)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs(spark, [(i, t, "en") for i, t in rows])).collect()}
    assert clean[70] is None and clean[71] == "" and clean[20] == rows[6][1]
    assert "[EMAIL]" in clean[0] and "example.org" not in clean[0] and "keeper" not in clean[0]


def test_corpus(spark):
    """Values are rare on the given tables; terms are found all the same."""
    for sf in (SF_TINY, SF_SMALL):
        df = sf_docs(spark, sf)
        terms = check(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert terms > 0


def test_sanitise_keeps_rows_and_columns(spark):
    df = docs(spark, [(1, "a@b.cc x", "en"), (1, "a@b.cc x", "en"), (None, None, None)])
    out = pii.sanitise(df)
    assert out.schema == df.schema and sorted(str(r.text) for r in out.collect()) == ["None", "[EMAIL] x", "[EMAIL] x"]
    assert pii.sanitise(docs(spark, [])).count() == 0


def masked(spark, rows):
    df = docs(spark, [(i, t, "en") for i, t in rows])
    return {r.doc_id: r.text for r in pii.sanitise(df).collect()}


def test_one_meeting_is_no_evidence(spark):
    """A word seen once beside a value stays; seen twice, both times beside it, it goes; elsewhere too, it stays."""
    rows = [(i, f"common words stand in every row {i % 7}") for i in range(60)]
    once = [(90, "common words stand by zorblax a@b.cc in every row")]
    assert masked(spark, rows + once)[90] == "common words stand by zorblax [EMAIL] in every row"
    twice = once + [(91, "here is zorblax a@b.cc again in every row")]
    out = masked(spark, rows + twice)
    assert "zorblax" not in out[90] and "zorblax" not in out[91] and out[0] == rows[0][1]
    often = twice + [(92 + k, f"zorblax is a word of its own {k}") for k in range(3)]
    assert "zorblax" in masked(spark, rows + often)[90]


def test_decisions_do_not_drift_with_the_corpus(spark):
    """Unrelated rows, as many again or ten times, change no decision."""
    rows = [(r.doc_id, r.text) for r in sf_docs(spark, SF_TINY).select("doc_id", "text").collect()]
    rows += [(5000 + k, f"zorblax keeper of a@b.cc stands here, number {k}") for k in range(4)]
    few = plain_risky(rows)
    many = plain_risky(rows + [(10_000 + k, f"unrelated{k} text") for k in range(10 * len(rows))])
    assert "zorblax" in few and few == many
    small = {i: t for i, t in masked(spark, rows).items()}
    large = masked(spark, rows + [(10_000 + k, f"unrelated{k} text") for k in range(len(rows))])
    assert all(large[i] == t for i, t in small.items())


def test_values_of_a_class_pool_their_evidence(spark):
    rows = [(i, f"common words stand in every row {i % 7}") for i in range(60)]
    rows += [(80 + k, f"the qwertix person{k}{k}x@corp.example is here") for k in range(5)]
    out = masked(spark, rows)
    assert all("qwertix" not in out[80 + k] and "here" not in out[80 + k] for k in range(5))


def test_sanitise_sends_only_rows_with_findings_to_python(spark):
    df = docs(spark, [(i, f"plain words {i}", "en") for i in range(50)] + [(50, "to a@b.cc", "en"), (None, "to c@d.ee", "en")])
    out = pii.sanitise(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert {r.doc_id: r.text for r in out.collect()} == {i: f"plain words {i}" for i in range(50)} | {
        50: "to [EMAIL]", None: "to [EMAIL]"}
