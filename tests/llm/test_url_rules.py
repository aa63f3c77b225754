import re
from itertools import combinations

from conftest import SF_SMALL
from viewstar.llm import url_rules as ur


def plain(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = max(((len(h + p), h + p, v) for v, h, p in ur.LIST_RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return host, path, best[1] if best else None, best[2] if best else None


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id long, url string, tokens string, host string")


def test_rules_match_plain_version(spark):
    urls = [None, "", "no scheme.net/", "http://a.net", "http://a.net/", "HTTP://A.NET/x?y", "http://net/", "http://xnet/",
            "http://example.net/en/1", "http://EXAMPLE.net/en", "http://w.example.net/en/?q", "http://example.com/de/x",
            "http://badexample.com/de/x", "http://a.org/fr/", "http://a.org/FR/", "http://a.net#x://b", "http://a.net?b/",
            "://org/fr/", "http://a.net:80/", "x://y://z.net/", "http://a.net/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, "http://a.net/"), (None, None), (3, "http://q.org/fr/z")]
    got = ur.judge(pages(spark, rows)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.page_id, r.host, r.path, r.rule) for r in got], key=key) == \
        sorted([(i, *plain(u)[:3]) for i, u in rows], key=key)
    assert all(r.verdict == (v or r.verdict) and r.verdict in ("allow", "block")
               for r in got for v in [{(i, *plain(u)[:3]): plain(u)[3] for i, u in rows}[(r.page_id, r.host, r.path, r.rule)]])


def test_empty_and_unlabelled(spark):
    assert ur.judge(pages(spark, [])).count() == 0
    assert [r.verdict for r in ur.judge(pages(spark, [(1, "http://a.com/x")])).collect()] == ["allow"]


def test_mined_verdicts_match_brute_force(spark):
    """Every token combination counted in plain Python gives the same verdicts."""
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    rows = ur.judge(df, min_support=0.03).collect()
    tokens = {r.url: frozenset(r.t) for r in df.select("url", ur.tokens(
        df["url"], *ur.host_and_path(df["url"])).alias("t")).collect()}
    by_id = {r.page_id: r.url for r in df.select("page_id", "url").collect()}
    labelled = [(tokens[by_id[r.page_id]], plain(by_id[r.page_id])[3]) for r in rows if r.rule]
    n = len(labelled)
    least = 0.03 * n
    counts = {}
    for t, v in labelled:
        for size in range(1, len(t) + 1):
            for c in combinations(sorted(t), size):
                counts.setdefault(c, {"allow": 0, "block": 0})[v] += 1
    rules = [(m / sum(c.values()), m / n, len(a), " ".join(a), v, frozenset(a)) for a, c in counts.items()
             for v, m in c.items() if m >= least and m / sum(c.values()) >= 0.8]
    kept = [r for r in rules if not any(s[4] == r[4] and s[5] < r[5] and s[0] >= r[0] for s in rules)]
    assert kept
    for r in rows:
        if r.rule is None:
            fits = [k for k in kept if k[5] <= tokens[by_id[r.page_id]]]
            best = max(fits, key=lambda k: k[:5], default=None)
            assert r.verdict == (best[4] if best else "allow")
            assert r.mined_rule == (best[3] if best else None)
