import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import docs
from viewstar.llm import exact_dedup, queries


def plain(rows):
    """Every pair of texts compared; (id, keep_id, size, kept count by (id, length), sha) as a sorted list."""
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, len(t or "")))
    out = []
    for norm, members in groups.items():
        best = sorted(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        for k, (i, _) in enumerate(best):
            out.append((i, best[0][0], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = exact_dedup.dedup(docs(spark, rows), **options)
    return sorted(((r["id"], r.keep_id, r.group_size, r.kept, bytes(r.sha).hex()) for r in df.collect()), key=str)


AWKWARD = [
    (5, "a b", "en"), (3, "ab", "en"), (9, "a  b", "en"), (9, "a  b", "en"), (7, "a\t\nb", "en"),
    (1, None, "en"), (2, "", None), (4, " \x0b\x0c\r", "de"), (None, "ab", "en"), (None, "x", "en"), (None, "x", "en"),
    (10, "a b", "en"), (11, "A b", "en"), (12, "é" * 4, "fr"), (13, "é é é é", "fr"),
    (14, "long " * 40000, "en"), (15, "long" * 40000, "en"), (16, "a\x00b", "en"), (17, "\U0001f600 \U0001f600", "en"),
]


def test_awkward_rows(spark):
    assert found(spark, AWKWARD) == plain(AWKWARD)


def test_weak_hashes_are_told_apart_by_bytes(spark):
    """One hash for everything, and one by the length: groups are still those of the texts."""
    for weak in (lambda norm: F.lit(7), lambda norm: F.length(norm)):
        assert found(spark, AWKWARD, content_hash=weak) == plain(AWKWARD)


def test_empty_table_and_extra_columns(spark):
    assert found(spark, []) == []
    clash = docs(spark, [(1, "x", "en"), (2, "x ", "en")]).withColumn("norm", F.lit(1)).withColumn("twin", F.lit(2)) \
        .withColumn("row", F.lit(3)).withColumn("n", F.lit("z"))
    assert [r["id"] for r in exact_dedup.kept(clash).collect()] == [2]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.text("ab \n", max_size=4)),
                               st.just("en")), max_size=30))
def test_any_rows(spark, rows):
    assert found(spark, rows) == plain(rows)


def test_a_third_of_the_rows_are_one_text(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}", "en") for i in range(3000)]
    assert found(spark, rows) == plain(rows)


def test_no_python_on_the_main_path(spark):
    df = queries.op12_exact_dedup(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
