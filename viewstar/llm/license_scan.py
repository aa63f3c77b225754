"""License notices: exact phrases, and short notices with a few errors.

A notice of n characters with at most k errors (insertions, deletions,
substitutions) is cut into k + 1 parts; in any match at least one part occurs
unchanged (pigeonhole).  One Aho-Corasick automaton over all parts of all
notices finds these seeds in a single pass over a text; each seed fixes where
its notice would lie.  A stretch that holds too few of the notice's trigrams
for k errors (each error spoils three at most) is passed over; in the others
the regex library's bounded-error matching decides and reports the span and
its errors.  Short phrases are seeds without errors.

Texts are compared word by word: A-Z folded, words joined by single spaces.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from viewstar.llm import textkit as tk
from viewstar.llm.tables import by_batch, texts

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening words of well-known notices and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of": "gpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this work is licensed under a creative commons attribution": "cc-by",
    "this text is available under cc by 4 0": "cc-by",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "all rights reserved no part of this publication may be reproduced": "proprietary",
}


@dataclass
class Scanner:
    phrases: dict[str, str]
    notices: dict[str, str]
    error_share: float = 0.1

    def _ready(self) -> None:
        if hasattr(self, "automaton"):
            return
        import ahocorasick
        import regex
        seeds: dict[str, list[tuple]] = {}
        for phrase in self.phrases:
            seeds.setdefault(f" {phrase} ", []).append((phrase, None, 0, 0))
        self.patterns = {}
        for notice in self.notices:
            k = max(1, int(len(notice) * self.error_share))
            trigrams = [notice[i:i + 3] for i in range(len(notice) - 2)]
            self.patterns[notice] = (regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={k}}}"), trigrams,
                                     len(trigrams) - 3 * k, k)
            cuts = np.linspace(0, len(notice), k + 2).astype(int)
            for a, b in zip(cuts[:-1], cuts[1:]):
                seeds.setdefault(notice[a:b], []).append((notice, k, int(a), int(b)))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def scan(self, flat: str) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, float]]]:
        """(places of phrases, notices found) in a text of folded words, one space before, between and after.

        Places are (offset, phrase); notices (start, end, label, similarity), the best of each stretch.
        """
        self._ready()
        places, wanted = [], {}
        for end, (size, uses) in self.automaton.iter(flat):
            start = end + 1 - size
            for name, k, a, b in uses:
                if k is None:
                    places.append((start + 1, name))
                else:
                    wanted.setdefault(name, []).append((start - a - k, start - a + len(name) + k))
        found = []
        for notice, stretches in wanted.items():
            pattern, trigrams, least, k = self.patterns[notice]
            reach, done = -1, -1
            merged: list[list[int]] = []
            for lo, hi in sorted(stretches):
                if merged and lo <= reach and hi - merged[-1][0] <= 8 * len(notice):
                    merged[-1][1] = max(merged[-1][1], hi)
                else:
                    merged.append([lo, hi])
                reach = merged[-1][1]
            for lo, hi in merged:
                at = max(lo, 0)
                window = flat[at:max(hi, 0)]
                if sum(g in window for g in trigrams) < least:
                    continue
                exact = window.find(notice)
                if exact >= 0 and window.find(notice, exact + 1) < 0 and len(window) < 2 * len(notice) - k:
                    if at + exact >= done:  # nothing beats a match without errors, and no other fits beside it
                        found.append((at + exact, at + exact + len(notice), self.notices[notice], 1.0))
                        done = at + exact + len(notice)
                    continue
                parts, end = [(max(at, done), max(hi, 0))], done
                while parts:  # the best match, then the text on both sides of it
                    lo, hi = parts.pop()
                    m = pattern.search(flat, lo, hi) if hi - lo >= len(notice) - k else None
                    if m is not None:
                        found.append((m.start(), m.end(), self.notices[notice], 1.0 - sum(m.fuzzy_counts) / len(notice)))
                        end = max(end, m.end())
                        parts += [(lo, m.start()), (m.end(), hi)]
                done = end
        return places, sorted(found)


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None,
         error_share: float = 0.1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices; one row per input row.

    ``n_base`` counts all places of the phrases, ``first_word`` / ``last_word``
    are the word numbers of the first and last place (null without one).
    ``labels`` also holds those of notices found with at most ``error_share``
    of their characters wrong (one error at least); ``notices`` lists them as
    label:first word-last word.  ``score`` is 1 with an exact phrase, else the
    best notice's similarity, else 0.  A null or empty text has no words;
    repeated rows are scanned alike; other columns are not read.
    """
    scanner = Scanner(dict(PHRASES if phrases is None else phrases), dict(NOTICES if notices is None else notices),
                      error_share)
    shared = docs.sparkSession.sparkContext.broadcast((scanner.phrases, scanner.notices, error_share))

    def run(batch):
        state = _scanner(*shared.value)
        cols: list[list] = [[] for _ in range(8)]
        raw, offsets = tk.text_bytes(batch.column("text"))
        for a, b in zip(offsets[:-1], offsets[1:]):
            words = raw[a:b].tobytes().translate(_FLAT).split()
            flat = f" {b' '.join(words).decode()} " if words else ""
            places, found = state.scan(flat) if flat else ([], [])
            spaces = [i for i, c in enumerate(flat) if c == " "] if places or found else []
            starts = [bisect_left(spaces, p - 1) for p, _ in places]
            base = sorted({state.phrases[p] for _, p in places})
            row = (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base),
                   ",".join(sorted({*base, *(x[2] for x in found)})),
                   1.0 if places else max((x[3] for x in found), default=0.0),
                   ",".join(f"{x[2]}:{max(bisect_left(spaces, x[0] + 1) - 1, 0)}-{max(bisect_left(spaces, x[1]) - 1, 0)}"
                            for x in found))
            for col, value in zip(cols, row):
                col.append(value)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"])
    return by_batch(texts(docs, id_column, text_column), run,
                    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                    "labels string, score double, notices string")


#: bytes.translate table: A-Z folded, every byte that is no word byte a space
_FLAT = bytes(c if tk.ALNUM_WORDS[c] else 32 for c in tk.FOLD_TABLE)
_made: dict[tuple, Scanner] = {}


def _scanner(phrases: dict[str, str], notices: dict[str, str], share: float) -> Scanner:
    key = (tuple(phrases.items()), tuple(notices.items()), share)
    if key not in _made:
        _made[key] = Scanner(phrases, notices, share)
    return _made[key]
