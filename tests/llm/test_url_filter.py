"""URL filter: rules, parts of urls, the host graph, both vectors against plain Python."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hourcast.llm import _frames, url_filter as U
from hourcast.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("url,host,path", [
    ("http://A.Example.COM/En/?q=/x", "a.example.com", "/En/"), ("https://h.org", "h.org", ""),
    ("https://h.org?x=http://z.com/", "h.org", ""), ("x://h#top/a", "h", ""), ("no scheme/a", "", ""),
    (None, "", ""), ("", "", ""), ("://", "", ""), ("a\nb://h/p\nq#z", "h", "/p\nq"), ("http://É.com/", "É.com", "/"),
    ("http://u@h:80/a/b", "u@h:80", "/a/b")])
def test_parts(spark, url, host, path):
    row = U.located(pages(spark, [(1, url, None)]), URL_RULES).first()
    assert (row.host, row.path) == (host, path)


@pytest.mark.parametrize("url,rule,verdict", [
    ("http://a.com/x", "com/", "allow"), ("http://com/", "com/", "allow"), ("http://a.com", None, None),
    ("http://telecom/", None, None), ("http://m.example.com/en/1", "example.com/en/", "block"),
    ("http://example.com/en", "com/", "allow"), ("http://x.www.example.com/en/", "www.example.com/en/", "allow"),
    ("http://anexample.com/en/", "com/", "allow"), ("http://z.net/es/9", "net/es/", "block"),
    ("http://z.net/en/9", None, None)])
def test_longest_rule(spark, url, rule, verdict):
    row = U.located(pages(spark, [(1, url, None)]), URL_RULES).first()
    assert (row.rule, row.verdict) == (rule, verdict)


def test_equal_rules_block(spark):
    rules = [U.Rule("allow", "a.b", "/"), U.Rule("block", "a.b", "/")]
    assert U.located(pages(spark, [(1, "x://a.b/", None)]), rules).first().verdict == "block"


def above(host):
    labels = host.split(".")
    return ".".join(labels[1:]) if len(labels) > 2 and not labels[-1].isdigit() else None


def brute(judged, linked):
    """Trust and distrust of every host from (host, verdict) per page and its linked hosts."""
    weight, n_pages, seed = Counter(), Counter(), {">": Counter(), "<": Counter()}
    for (host, verdict), to in zip(judged, linked):
        if host:
            n_pages[host] += 1
            for dst in {host, *to}:
                weight[host, dst] += 1
            if verdict:
                seed[">" if verdict == "allow" else "<"][host] += 1
    below = Counter()
    for host, n in n_pages.items():
        while host:
            below[host] += n
            host = above(host)
    for host, n in below.items():
        if above(host):
            weight[host, above(host)] += n
            weight[above(host), host] += n
    for host in {h for e in weight for h in e}:
        if not n_pages[host]:
            weight[host, host] += 1
    out = {}
    for kind in "><":
        total, moves = Counter(), defaultdict(list)
        for (a, b), w in weight.items():
            a, b = (a, b) if kind == ">" else (b, a)
            total[a] += w
            moves[a].append((b, w))
        start = {h: n * U.UNIT for h, n in seed[kind].items()}
        mass = dict(start)
        for _ in range(U.ROUNDS):
            new = Counter({h: math.floor(m * (1 - U.DAMPING)) for h, m in start.items()})
            for h, m in mass.items():
                for to, w in moves[h]:
                    new[to] += math.floor(m * U.DAMPING * (w / total[h]))
            mass = new
        out[kind] = mass
    hosts = {h for e in weight for h in e}
    return {h: (n_pages[h], out[">"].get(h, 0), out["<"].get(h, 0)) for h in hosts}


def link_farm():
    """Pages of a blocked site, of one that links to it, of one that an allowed site links to."""
    rows = []
    add = lambda url, html: rows.append((len(rows), url, html))
    for i in range(6):
        add(f"http://bad.net/es/{i}", '<a href="/x">')
        add(f"http://linker.org/{i}", "<A HREF='//bad.net/y'> <img src=https://BAD.net/z>")
        add(f"http://good.com/{i}", '<a href="http://friend.org/"> <a href="http://friend.org/2">')
        add(f"http://friend.org/{i}", None)
        add(f"http://alone.org/{i}", "")
    add(None, '<a href="http://bad.net/">')
    add("nothing", None)
    return rows


LINKED = {"linker.org": {"bad.net"}, "good.com": {"friend.org"}}


def test_distrust_reaches_those_that_link_to_blocked_hosts(spark):
    rows = link_farm()
    out = {r.page_id: r for r in U.url_verdicts(pages(spark, rows), URL_RULES).collect()}
    verdict = {out[i].host: out[i].verdict for i in range(len(rows))}
    assert len(out) == len(rows)
    assert verdict == {"bad.net": "block", "linker.org": "block", "good.com": "allow", "friend.org": "allow",
                       "alone.org": "allow", "": "allow"}


def test_vectors_equal_brute_force(spark):
    rows = link_farm() + [(100 + i, f"https://s{i % 4}.big.example.net/{'es' if i % 3 else 'en'}/{i}",
                           f'<a href="https://s{(i + 1) % 4}.big.example.net/"> <a href="http://10.0.0.1/">')
                          for i in range(40)]
    df = pages(spark, rows)
    got = {r.host: (r.n_pages, r.trust, r.distrust) for r in U.propagate(*U.host_graph(df, URL_RULES)).collect()}
    judged = [(r.host, r.verdict) for r in U.located(df, URL_RULES).orderBy("page_id").collect()]
    linked = [LINKED.get(h, set()) if i < 100 else {f"s{(i + 1) % 4}.big.example.net", "10.0.0.1"}
              for (h, _), (i, _, _) in zip(judged, rows)]
    assert got == brute(judged, linked)


def test_hot_hosts_are_dealt_over_parts(spark, monkeypatch):
    """With more parts than rows need, every result stays the same."""
    rows = link_farm()
    df = pages(spark, rows)
    want = sorted(map(tuple, U.url_verdicts(df, URL_RULES).collect()), key=str)
    plain = _frames.hot_parts
    monkeypatch.setattr(U, "hot_parts", lambda d, key, least=2: plain(d, key, 2))
    assert sorted(map(tuple, U.url_verdicts(df, URL_RULES).collect()), key=str) == want


def test_columns_are_kept_and_helpers_do_not_clash(spark):
    df = pages(spark, link_farm()).withColumns({
        "HOST": F.lit("old"), "rule": F.lit(1), "host_key": F.lit(2), "host_part": F.lit(3), "page_hit": F.lit(4)})
    out = U.url_verdicts(df, URL_RULES)
    assert out.columns == ["page_id", "url", "host_key", "host_part", "page_hit", "host", "path", "rule", "verdict"]
    assert {(r.host_key, r.host_part, r.page_hit) for r in out.collect()} == {(2, 3, 4)}


def test_repeated_rows_and_empty_table(spark):
    twice = pages(spark, [(1, "http://a.net/en/", None)] * 2)
    assert [tuple(r)[0] for r in U.url_verdicts(twice, URL_RULES).collect()] == [1, 1]
    assert U.url_verdicts(pages(spark, []), URL_RULES).collect() == []


def test_no_python_on_the_main_path(spark):
    df = U.url_verdicts(pages(spark, link_farm()).select("page_id", "url", "html"), URL_RULES)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
