"""URL filter against plain Python and the DuckDB oracle."""

import math
import random

import duckdb

from conftest import SF001
from ledgerlake.llm import queries, urlfilter


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:n], rest[n:]
    n = min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:n]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urlfilter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme/at/all", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en/", "http://example.com",
        "http://example.com?x=/en/", "http://a.net/fr/", "http://anet/fr/", "http://net/es/1", "http://xexample.com/en/1",
        "ftp://h://x/y", "http://a.com/\nb", "http://ÉCOLE.net/es/", "http://a.net/fr", "://x.org/p#q?r", "http://u@a.com:80/z"]


def test_hosts_paths_rules(spark):
    df = spark.createDataFrame([(i, u, "c", "d") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    none = spark.createDataFrame([], "host string, bad int")
    rows = {r.page_id: r for r in urlfilter.filter_urls(df, none).collect()}
    assert len(rows) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = split_url(u)
        rule, verdict = rule_of(host, path)
        assert (rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict) == (host, path, rule, verdict or "allow"), u


def brute_bounds(outcomes):
    lo, hi = urlfilter.MIN_STRENGTH, urlfilter.MAX_STRENGTH
    dom = lambda h: ".".join(h.split(".")[-2:])
    sfx = lambda h: h.split(".")[-1]

    def add(key, rows):
        t = {}
        for k, (n, b) in rows:
            x = t.setdefault(key(k), [0, 0])
            x[0] += n
            x[1] += b
        return t

    hosts = add(lambda h: h or "", [(h, (1, b)) for h, b in outcomes if b is not None])
    doms = add(dom, hosts.items())
    sfxs = add(sfx, hosts.items())
    total = sum(b for _, b in sfxs.values()) / max(1, sum(n for n, _ in sfxs.values()))

    def strength(members):
        n = sum(x for x, _ in members)
        m = sum(b for _, b in members) / n
        var = sum(b * b / x for x, b in members) / n - m * m
        if len(members) < 2 or var <= 1e-15 or not 0 < m < 1:
            return hi
        return min(hi, max(lo, m * (1 - m) / var - 1))

    def shrink(level, parent, prior):
        out = {}
        for k, (n, b) in level.items():
            s = strength([v for j, v in level.items() if parent(j) == parent(k)])
            out[k] = (b + s * prior(parent(k)), n - b + s * (1 - prior(parent(k))))
        return out

    mean = lambda ab: ab[0] / (ab[0] + ab[1])
    s = shrink(sfxs, lambda _: 0, lambda _: total)
    d = shrink(doms, sfx, lambda k: mean(s[k]))
    h = shrink(hosts, dom, lambda k: mean(d[k]))
    out = {}
    for k, (a, b) in h.items():
        n = a + b
        out[k] = max(0.0, mean((a, b)) - urlfilter.BOUND_SD * math.sqrt(a * b / (n * n * (n + 1))))
    return out


def test_reputation_against_brute_force(spark):
    rng = random.Random(1)
    hosts = [f"{a}.{b}.{c}" for c in ("com", "net") for b in ("x", "y", "z") for a in ("p", "q", "r")] + ["", None, "single"]
    rate = {h: rng.choice([0.02, 0.1, 0.95]) for h in hosts}
    rows = [(h, None if rng.random() < 0.05 else int(rng.random() < rate[h])) for h in hosts for _ in range(rng.randint(1, 40))]
    got = {r.host: r.bound for r in urlfilter.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    want = brute_bounds(rows)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(hosts) if h], "page_id long, url string")
    for r in urlfilter.filter_urls(pages, spark.createDataFrame(rows, "host string, bad int"), rules=[]).collect():
        assert r.verdict == ("block" if want[r.host] > 0.5 else "allow")
    assert any(v > 0.5 for v in want.values()) and any(v < 0.5 for v in want.values())


def test_hosts_without_labels_take_the_prior_of_their_domain_suffix_or_all(spark):
    """Labelled: h0..h19.bad.com (all bad), good.com (all good), x.net and y.org
    (half bad): unlabelled hosts fall back a level at a time."""
    rows = [(f"h{i}.bad.com", 1) for i in range(20) for _ in range(50)] + [("w.good.com", 0)] * 1000
    rows += [(f"{i}.all.net", 1) for i in range(9) for _ in range(90)] + [("y.org", i % 2) for i in range(60)]
    out = spark.createDataFrame(rows, "host string, bad int")
    hosts = ["new.bad.com", "bad.com", "new.good.com", "a.fresh.com", "a.fresh.net", "a.b.org", "a.fresh.info", "h0.bad.com", ""]
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(hosts)] + [(99, None)], "page_id long, url string")
    got = {r.page_id: r for r in urlfilter.filter_urls(pages, out, rules=[]).collect()}
    assert len(got) == len(hosts) + 1
    b = {h: got[i].reputation_bound for i, h in enumerate(hosts)}

    dom = lambda h: ".".join(h.split(".")[-2:])
    sfx = lambda h: h.split(".")[-1]

    def sums(key, table):
        t = {}
        for k, (n, bad) in table:
            x = t.setdefault(key(k), [0, 0])
            x[0], x[1] = x[0] + n, x[1] + bad
        return t

    of_hosts = sums(lambda h: h, [(h, (1, x)) for h, x in rows])
    of_doms, of_sfxs = sums(dom, of_hosts.items()), sums(sfx, of_hosts.items())

    def strength(members):
        n = sum(x for x, _ in members)
        m = sum(x for _, x in members) / n
        var = sum(x * x / k for k, x in members) / n - m * m
        if len(members) < 2 or var <= 1e-15 or not 0 < m < 1:
            return urlfilter.MAX_STRENGTH
        return min(urlfilter.MAX_STRENGTH, max(urlfilter.MIN_STRENGTH, m * (1 - m) / var - 1))

    total = sum(x for _, x in of_sfxs.values()) / sum(n for n, _ in of_sfxs.values())
    prior = {0: (total, strength(list(of_sfxs.values())))}
    for level, parent, up in ((of_sfxs, lambda k: 0, of_doms), (of_doms, sfx, of_hosts)):
        below = sfx if up is of_doms else dom
        for k, (n, bad) in level.items():
            m, s = prior[parent(k)]
            prior[k] = ((bad + s * m) / (n + s), strength([v for j, v in up.items() if below(j) == k]))

    def bound(m, s):
        return max(0.0, m - urlfilter.BOUND_SD * math.sqrt(m * (1 - m) / (s + 1)))

    want = {"new.bad.com": "bad.com", "bad.com": "bad.com", "new.good.com": "good.com", "a.fresh.com": "com",
            "a.fresh.net": "net", "a.b.org": "org", "a.fresh.info": 0, "": 0}
    for h, level in want.items():
        assert abs(b[h] - bound(*prior[level])) < 1e-9, h
    assert b[""] == got[99].reputation_bound
    verdict = {h: got[i].verdict for i, h in enumerate(hosts)}
    assert verdict["new.bad.com"] == verdict["bad.com"] == verdict["a.fresh.net"] == verdict["h0.bad.com"] == "block"
    assert verdict["new.good.com"] == verdict["a.fresh.com"] == "allow"


def test_query_matches_oracle_and_is_native(spark):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    cur = con.execute(queries.ORACLE_SQL["op4_url_filter"])
    cols = [c[0] for c in cur.description]
    df = queries.QUERIES["op4_url_filter"](spark, SF001)
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(cur.fetchall())
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    out = spark.createDataFrame([], "host string, bad int")
    assert urlfilter.filter_urls(pages, out).collect() == []
