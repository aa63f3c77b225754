from collections import defaultdict

from conftest import SF_TINY
from llm.helpers import SPACE_WORDS, docs, sf_docs, words
from viewstar.llm import ngram_join as nj


def shingles(text):
    w = words(SPACE_WORDS, text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """(n_shingles, component) per row index, every pair that shares a shingle compared."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            inverted[g].append(i)
    shared = defaultdict(int)
    for at in inverted.values():
        for k, i in enumerate(at):
            for j in at[:k]:
                shared[j, i] += 1
    for (i, j), n in shared.items():
        if rows[i][0] is not None and rows[j][0] is not None and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None))
            for i in range(len(rows))]


def key(r):
    return tuple((x is None, x) for x in r)


def check(df, rows):
    got = [tuple(r) for r in nj.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_components_match_brute_force(spark):
    df = sf_docs(spark, SF_TINY)
    check(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def chain(n):
    """Texts of which only neighbours are similar enough, in one long component."""
    base = [f"w{k}" for k in range(60)]
    return [" ".join(base[2 * k:] + [f"x{j}" for j in range(2 * k)]) for k in range(n)]


def test_awkward_rows(spark):
    rows = [(5, "A b c d e f g h i j k l"), (3, "a b c d e f g h i j k l"), (9, None), (2, ""), (4, " \t\n"),
            (7, "one two"), (6, "ONE two"), (8, "two one"), (None, "one two"), (None, None), (1, "x " * 30000),
            (11, "x " * 20000), (3, "a b c d e f g h i j k l"), (12, "é ü ñ 字 a"), (13, "é ü ñ 字 a")]
    rows += [(100 + i, t) for i, t in enumerate(chain(9))]
    check(docs(spark, [(i, t, "en") for i, t in rows]), rows)


def test_exact_at_the_border_and_in_every_round(spark, monkeypatch):
    """A hub of near copies that miss each other, whether pairs are all taken at once or round by round."""
    base = [f"w{k}" for k in range(45)]
    rows = []
    for i in range(24):
        w = list(base)
        w[(i * 7) % 45] = f"y{i}"
        if i % 3:
            w[(i * 11 + 20) % 45] = f"z{i}"
        rows.append((i, " ".join(w)))
    rows += [(50 + i, t) for i, t in enumerate(chain(6))]
    df = docs(spark, [(i, t, "en") for i, t in rows])
    for pairs, rounds in ((100, 8), (0, 8)):
        monkeypatch.setattr(nj, "PAIRS_LEFT", pairs)
        monkeypatch.setattr(nj, "ROUNDS", rounds)
        check(df, rows)


def test_a_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """400 near copies of one text, mostly similar to each other: pairs looked at grow with the group, not its square."""
    import random
    rnd = random.Random(3)
    rows, seen = [], []
    for i in range(400):
        w = [f"w{k}" for k in range(120)]
        w[rnd.randrange(120)] = f"y{i % 40}"
        rows.append((i, " ".join(w)))
    real = nj._candidates

    def counted(*args):
        both = real(*args)
        seen.append(both.count())
        return both
    monkeypatch.setattr(nj, "_candidates", counted)
    check(docs(spark, [(i, t, "en") for i, t in rows]), rows)
    assert seen and sum(seen) < 400 * 400 / 4


def test_empty_table(spark):
    assert nj.near_duplicates(docs(spark, [])).count() == 0


def test_first_of_each_keeps_columns_and_one_row(spark):
    rows = [(1, "a b c d e f", "en"), (2, "a b c d e f", "en"), (2, "a b c d e f", "en"), (3, None, None),
            (None, "a b c d e f", "en"), (4, "", "en"), (5, "q r", "en"), (5, "q r", "en")]
    df = docs(spark, rows)
    kept = nj.first_of_each(df)
    assert kept.columns == df.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=key) == sorted(
        [(1, "a b c d e f"), (3, None), (4, ""), (5, "q r")], key=key)
    assert nj.first_of_each(docs(spark, [])).count() == 0


def links(rows):
    """Links of each row, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    close = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    return sorted(((i, sum(k != j and rows[j][0] is not None and bool(close(sets[k], sets[j])) for j in range(len(rows)))
                    if i is not None else 0) for k, (i, _) in enumerate(rows)), key=key)


def test_every_link_is_counted(spark, monkeypatch):
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(base[:40 + i] + [f"y{i}"])) for i in range(20)]  # many near copies of several lengths
    rows += [(100 + i, " ".join(base[:55] + [f"z{i}"])) for i in range(10)] + [(100, " ".join(base[:55] + ["z0"]))] * 3
    rows += [(200 + i, t) for i, t in enumerate(chain(6))] + [(None, rows[0][1]), (300, None), (301, "one two"), (302, "one TWO")]
    df = docs(spark, [(i, t, "en") for i, t in rows])
    for block, pairs in ((4, 0), (nj.BLOCK_SETS, 100)):  # links counted beside the rounds, and known from them
        monkeypatch.setattr(nj, "BLOCK_SETS", block)
        monkeypatch.setattr(nj, "PAIRS_LEFT", pairs)
        assert sorted(((r.doc_id, r.n_links) for r in nj.near_duplicates(df).collect()), key=key) == links(rows)


def test_links_of_the_corpus(spark):
    df = sf_docs(spark, SF_TINY)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert sorted((r.doc_id, r.n_links) for r in nj.near_duplicates(df).collect()) == links(rows)


def test_first_of_each_by_row_decides_by_texts(spark):
    rows = [(1, "a b c d e f"), (1, "other words stand in this row"), (2, "a b c d e f"), (None, "a b c d e f"),
            (None, "no id but a text of its own"), (None, "no id but a text of its own"), (None, None), (3, None)]
    kept = nj.first_of_each(docs(spark, [(i, t, "en") for i, t in rows]))
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=key) == sorted(
        [rows[0], rows[1], rows[4], rows[6], rows[7]], key=key)


def test_components_of_any_graph(spark):
    import random

    from viewstar.llm.components import components
    rnd = random.Random(9)
    graphs = [[(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 50)] + [(100, k) for k in range(101, 120)],
              [(rnd.randrange(80), rnd.randrange(80)) for _ in range(70)], [(3, 3)], []]
    for edges in graphs:
        near = {v: {v} for e in edges for v in e}
        for a, b in edges:
            near[a].add(b)
            near[b].add(a)
        want = {}
        for v in near:
            reach, todo = {v}, [v]
            while todo:
                for x in near[todo.pop()] - reach:
                    reach.add(x)
                    todo.append(x)
            if len(reach) > 1:
                want[v] = min(reach)
        got = components(spark.createDataFrame(edges, "a long, b long"))
        assert {r.v: r.c for r in got.collect()} == want


def test_near_misses_are_ruled_out_before_whole_sets(spark, monkeypatch):
    """140 texts, each with 4 of 16 passages changed, any two alike in at most 2 of them: 2,520 pairs at 0.76, no link."""
    changed = [{a, b, c, a ^ b ^ c} for a in range(16) for b in range(a) for c in range(b) if a ^ b ^ c < c]
    rows = [(i, " ".join(f"v{k}" if k % 9 == 4 and k // 9 in four else f"w{k}" for k in range(150)))
            for i, four in enumerate(changed)]
    seen, real = [], nj._verified

    def counted(pairs, sets, similarity):
        seen.append(pairs.count())
        return real(pairs, sets, similarity)
    monkeypatch.setattr(nj, "_verified", counted)
    monkeypatch.setattr(nj, "PAIRS_LEFT", 10 ** 6)  # all pairs at once
    check(docs(spark, [(i, t, "en") for i, t in rows]), rows)
    assert len(rows) == 140 and sum(seen) < 250


def test_python_tasks_get_small_batches(spark, monkeypatch):
    name, seen, real = "spark.sql.execution.arrow.maxRecordsPerBatch", [], nj._whole_sets
    before = spark.conf.get(name)

    def spied(*args):
        seen.append(int(spark.conf.get(name)))
        return real(*args)
    monkeypatch.setattr(nj, "_whole_sets", spied)
    nj.first_of_each(docs(spark, [(i, " ".join(f"w{k}" for k in range(40 + i)), "en") for i in range(4)]))
    assert seen and max(seen) <= 500 and spark.conf.get(name) == before


def test_rounds_move_only_the_sets_of_their_pairs(spark, monkeypatch):
    seen, real = [], nj._verified

    def counted(pairs, sets, similarity):
        ends = {x for r in pairs.select("a", "b").collect() for x in r}
        seen.append(({r.uid for r in sets.select("uid").collect()}, ends))
        return real(pairs, sets, similarity)
    monkeypatch.setattr(nj, "_verified", counted)
    monkeypatch.setattr(nj, "PAIRS_LEFT", 0)
    rows = list(enumerate(chain(12)))
    check(docs(spark, [(i, t, "en") for i, t in rows]), rows)
    assert len(seen) > 2 and all(sets == ends for sets, ends in seen)


def test_last_round_takes_entries_with_a_partner_only(spark):
    """(key, uid, n, pos, c): lengths 10 and 9 go together; 100 has none at its n-gram; a component alone has none."""
    rows = [(1, 11, 10, 0, 11), (1, 12, 9, 0, 12), (1, 13, 100, 0, 13), (2, 14, 50, 0, 14), (2, 15, 50, 0, 14),
            (3, 16, 10, 2, 16), (3, 17, 10, 9, 17)]
    mixed = spark.createDataFrame(rows, "key long, uid long, n long, pos int, c long")
    assert {r.uid for r in nj._with_partner(mixed, 80).collect()} == {11, 12}


def test_rows_that_stay_need_no_exact_join(spark):
    """Only rows whose bit is set meet the dropped ones; with few bits that is every row, and the result is the same."""
    from pyspark.sql import functions as F
    from viewstar.llm.tables import without
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("text"))
    for share in (0, 7, 2, 1):
        dropped = df.where(F.col("id") % share == 0 if share else F.lit(False)).select("id")
        want = {i for i in range(1000) if not share or i % share}
        for bits in (64, 1 << 12, 1 << 23):
            assert {r.id for r in without(df, dropped, "id", bits).collect()} == want


def test_first_of_each_starts_no_plain_python_tables(spark, monkeypatch):
    """Empty tables of the rounds come from the JVM: Python row tasks would hold workers beside those of the texts."""
    df = docs(spark, [(i, " ".join(f"w{k}" for k in range(40 + i)), "en") for i in range(4)])

    def refused(*args, **kwargs):
        raise AssertionError("createDataFrame")
    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    assert [r.doc_id for r in nj.first_of_each(df).collect()] == [0]


def test_workers_give_freed_memory_back():
    """Small pieces freed around ones that stay are kept by the C library until it is told to return them."""
    import re
    from pathlib import Path
    from viewstar.llm.tables import lean

    def held():
        return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()).group(1)) >> 10
    import numpy as np
    pieces = [np.ones(2000) for _ in range(10_000)]  # 160 MB, each too small for a mapping of its own
    stay = pieces[-1]
    before = held()
    del pieces
    lean()
    assert before - held() > 100 and len(stay) == 2000
