"""Rules by a plain reading of the contract, ranks by dense matrices."""

import duckdb
import numpy as np
import pyarrow as pa

from replicheck.llm import urls
from replicheck.llm.oracle import oracle_sql
from replicheck.llm.queries import URL_RULES

THRESHOLD = 0.1
LINK = '<a class="x" href="{}">'
PAGES = [
    (1, "http://A.Example.NET/en/1?x#y", LINK.format("http://bad.org/") + LINK.format("/local")),
    (2, "https://a.example.net/de/1", LINK.format("//Hub.com/x")),
    (3, "http://shop.net", None),
    (4, "http://shop.net/x", LINK.format("https://hub.com")),
    (5, "http://hub.com/a", LINK.format("http://shop.net/y") + LINK.format("http://spam.net/")),
    (6, "http://hub.com/a", LINK.format("http://shop.net/y")),
    (7, "http://spam.net/z", "<a href='http://hub.com/'>"),
    (8, None, "<a href=http://hub.com>"),
    (9, "no scheme", ""),
    (10, "http://x.example.com/de/1", ""),
    (11, "http://x.example.com/en/1", ""),
    (12, "http://b.org/fr/", LINK.format("http://x.example.com/")),
    (13, "http://b.org/fr", ""),
    (14, "http://notnet/en/://q", ""),
    (15, "http://org/fr/x", ""),
    (16, "ftp://feeder.com", LINK.format("http://spam.net/") + LINK.format("http://shop.net/")),
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] + [len(tail)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = None
    for verdict, rule in URL_RULES:
        own, begin = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + begin):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return best or (None, None)


def test_pages(spark, ws):
    df = spark.createDataFrame([(*p, "clash", 1.0) for p in PAGES], "page_id long, url string, html string, host string, trust double")
    got = {r.page_id: r for r in urls.judge(df, URL_RULES, ws, THRESHOLD).collect()}
    assert len(got) == len(PAGES)
    hosts, edges = {}, {}
    for i, u, html in PAGES:
        host, path = plain(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, plain_rule(host, path)[0])
        hosts.setdefault(host, []).append(plain_rule(host, path)[1])
        for part in (html or "").split("href=")[1:] if host else ():
            target = part.strip("\"'").split('"')[0].split("'")[0].split(">")[0]
            target = "http:" + target if target.startswith("//") else target
            to = plain(target)[0] if "://" in target else host
            edges[host, to] = edges.get((host, to), 0) + 1
    names = sorted({*hosts, *(h for e in edges for h in e)})
    at = {h: k for k, h in enumerate(names)}
    m = np.zeros((len(names),) * 2)
    for (a, b), n in edges.items():
        m[at[a], at[b]] = n
    forward = m / np.maximum(m.sum(1, keepdims=True), 1)
    backward = m.T / np.maximum(m.T.sum(1, keepdims=True), 1)
    seed = lambda v: np.array([np.mean([x == v for x in hosts.get(h, [None])]) for h in names])
    trust, distrust = seed("allow"), seed("block")
    t, d, led = trust, distrust, np.zeros(len(names))
    outside = m - np.diag(np.diag(m))
    outward = outside / np.maximum(outside.sum(1, keepdims=True), 1)
    for _ in range(urls.ROUNDS):
        led = urls.DAMPING * outward @ (distrust + (1 - distrust) * led)
        t = (1 - urls.DAMPING) * trust + urls.DAMPING * forward.T @ t
        d = (1 - urls.DAMPING) * distrust + urls.DAMPING * backward.T @ d
    for i, u, _ in PAGES:
        host, path = plain(u)
        if host in at:
            assert abs((got[i].trust or 0) - t[at[host]]) < 1e-9 and abs((got[i].distrust or 0) - d[at[host]]) < 1e-9
        bad = d[at[host]] >= THRESHOLD and d[at[host]] > t[at[host]]
        bad = bad or (led[at[host]] >= urls.LED and led[at[host]] > t[at[host]])
        assert got[i].verdict == (plain_rule(host, path)[1] or ("block" if bad else "allow"))
    assert {got[i].verdict for i in (5, 16)} == {"block"}  # they link to blocked hosts


def test_empty(spark, ws):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(df, URL_RULES, ws).count() == 0


def test_many_feeders_of_one_blocked_host(spark, ws):
    """At the production value: a verdict does not depend on how many hosts link to a blocked one."""
    pages, want = [(0, "http://spam.net/", "")], {0: "block"}
    for at, k in enumerate((1, 2, 10)):
        for own in (0, 6):
            for i in range(k):
                name = f"f{at}o{own}n{i}.com"
                to = LINK.format(f"http://bad{at}{own}.net/x") + LINK.format("/own") * own
                want[len(pages)] = "block"
                pages.append((len(pages), f"http://{name}/", to))
    want[len(pages)] = "block"  # leads to a feeder
    pages.append((len(pages), "http://second.com/", LINK.format("http://f2o6n3.com/")))
    want[len(pages)] = "allow"  # one link of three
    pages.append((len(pages), "http://mixed.com/", "".join(LINK.format(f"http://{h}/") for h in ("spam.net", "fine.com", "good.com"))))
    for h in ("bad00", "bad06", "bad10", "bad16", "bad20", "bad26"):
        want[len(pages)] = "block"
        pages.append((len(pages), f"http://{h}.net/x", None))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in urls.judge(df, URL_RULES, ws).collect()} == want
    con = duckdb.connect()
    columns = {c: [p[k] for p in pages] for k, c in enumerate(("page_id", "url", "html"))}
    con.register("pages", pa.table(columns))
    sql = oracle_sql()["op2_url_filter"]
    assert dict(con.sql(f"SELECT page_id, verdict FROM ({sql})").fetchall()) == want
