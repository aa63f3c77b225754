import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.helpers import ALNUM_WORDS, SPACE_WORDS, words
from viewstar.llm import textkit as tk

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aBZ19 .\t\n\x00é字-'", max_size=40)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_hashes_match_the_patterns(texts):
    seen = {}
    for lut, pattern in ((tk.SPACE_WORDS, SPACE_WORDS), (tk.ALNUM_WORDS, ALNUM_WORDS)):
        got = []
        for lo, hi, s in tk.slices(pa.array(texts, pa.string()), lut):
            h = s.hashes()
            for i in range(hi - lo):
                a, b = s.first[i], s.first[i + 1]
                own = [bytes(s.data[x:y]).decode() for x, y in zip(s.start[a:b], s.end[a:b])]
                got.append(own)
                for w, code in zip(own, h[a:b]):
                    assert seen.setdefault(w, code) == code
        assert got == [words(pattern, t) for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_long_words_and_slices():
    long = "x" * 5000
    texts = [long, f"a {long} b", long[:-1], "y" * 70 + " " + "y" * 71] * 3
    codes = {}
    for lo, hi, s in tk.slices(pa.array(texts), tk.SPACE_WORDS):
        h = s.hashes()
        for w, code in zip([bytes(s.data[x:y]) for x, y in zip(s.start, s.end)], h):
            assert codes.setdefault(w, code) == code
    assert len(set(codes.values())) == len(codes) == 6


def test_grams_depend_on_order():
    h = np.array([1, 2, 3, 1, 2, 3], dtype=np.uint64)
    g = tk.grams(h, 3)
    assert len(g) == 4 and g[0] == g[3] and len(set(g[:3])) == 3
    assert len(tk.grams(h, 7)) == 0
