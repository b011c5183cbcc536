import pytest
from pyspark.sql import functions as F

from keelson.llm import urls
from keelson.llm.queries import RULES
from tests.llm import plain

URLS = [
    None,
    "",
    "no scheme here",
    "://",
    "http://",
    "http://Example.COM",
    "http://example.com/en/1",
    "http://EXAMPLE.com/en/1?x=/fr/",
    "https://www.example.com/en/2#top",
    "https://a.www.example.com/en/",
    "https://m.example.com/de/3",
    "https://notexample.com/en/3",
    "http://x.net/es/1",
    "http://net/fr/",
    "http://x.net/en/1",
    "http://xnet/es/1",
    "http://x.org?u=http://y.net/es/",
    "http://x.org#a://b/c",
    "ftp://é.ORG/ü\nx/y",
    "http://Ä.com/a",
]


def by_hand(url):
    host, path = plain.url_parts(url)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_parts_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    for r in urls.ruled(df, RULES).collect():
        assert (r.host, r.path, r.rule, r.ruled) == by_hand(r.url), r.url


def score(pages, damping=0.85):
    """Trust and distrust of every host by plain iteration; hosts that rules judge keep their shares."""
    import re

    own: dict = {}
    links: dict = {}
    for url, html in pages:
        host, _, _, verdict = by_hand(url)
        if host:
            own.setdefault(host, []).append(verdict)
        for link in re.findall(urls.HREF, html or ""):
            to = plain.url_parts(link if "://" in link else "x:" + link)[0]
            if host and to and to != host:
                links[host, to] = links.get((host, to), 0) + 1
    hosts = set(own) | {h for e in links for h in e}
    share = lambda h, v: sum(x == v for x in own.get(h, [])) / len(own[h]) if h in own else 0.0
    seed = {h: (share(h, "allow"), share(h, "block")) for h in hosts}
    out, into = {}, {}
    for (a, b), n in links.items():
        out[a], into[b] = out.get(a, 0) + n, into.get(b, 0) + n
    now = dict(seed)
    for _ in range(200):
        nxt = {h: [0.0, 0.0] for h in seed}
        for (a, b), n in links.items():
            nxt[b][0] += damping * now[a][0] * n / out[a]
            nxt[a][1] += damping * now[b][1] * n / into[b]
        now = {h: seed[h] if any(seed[h]) else tuple(s) for h, s in nxt.items()}
    return now


PAGES = [
    ("http://bad.net/es/1", '<a href="http://friend.org/x">x</a>'),
    ("http://bad.net/fr/2", ""),
    ("http://friend.org/", '<a class=k href=http://bad.net/es/1>a</a> <A HREF=\'//BAD.net/q\'>b</A> <a href="/local">c</a>'),
    ("http://far.org/", '<a href="http://friend.org/">x</a>'),
    ("http://fine.org/", '<a href="http://good.com/">x</a><a href="http://bad.net/">x</a>'),
    ("http://good.com/", '<a href="http://fine.org/">x</a>'),
    ("http://mixed.net/es/1", None),
    ("http://mixed.net/en/1", None),
    ("http://mixed.net/en/2", None),
    ("http://bad.net/en/9", '<a href="http://bad.net/es/1">self</a>'),
    (None, '<a href="http://bad.net/">x</a>'),
]


def test_propagation_equals_plain_iteration(spark):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(PAGES)], "page_id long, url string, html string").withColumn("host", F.lit("own"))
    want = score(PAGES)
    share = lambda v: F.avg(F.when(F.col("ruled") == v, 1.0).otherwise(0.0))
    seeds = urls.ruled(df, RULES).where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    got = {r.host: (r.trust, r.distrust) for r in urls.propagate(seeds, urls.host_links(df), tolerance=1e-7).collect()}
    assert set(got) == set(want)
    for h in want:
        assert got[h] == pytest.approx(want[h], abs=1e-4), h
    blocked: dict = {}
    for threshold in (0.5, 0.3):
        rows = urls.url_filter(df, RULES, threshold=threshold).orderBy("page_id").collect()
        assert len(rows) == len(PAGES)
        for r, (u, _) in zip(rows, PAGES, strict=True):
            host, path, rule, verdict = by_hand(u)
            t, d = want.get(host, (0, 0))
            assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or ("block" if d >= threshold and d > t else "allow"))
        blocked[threshold] = {r.host for r in rows if r.rule is None and r.verdict == "block"}
    assert blocked[0.5] < blocked[0.3] and "friend.org" in blocked[0.3]
    assert "bad.net" in blocked[0.5] and not {"fine.org", "mixed.net", ""} & blocked[0.5]


def test_small_shares_of_many_hosts_add_up(spark):
    n = 1000
    seeds = spark.createDataFrame([("bad", 0.0, 1.0)], "host string, trust double, distrust double")
    pairs = [(f"h{i}", "bad", 1) for i in range(n)] + [("hub", f"h{i}", 1) for i in range(n)]
    scores = urls.propagate(seeds, spark.createDataFrame(pairs, "src string, dst string, n long").coalesce(2))
    assert scores.where("host = 'hub'").first().distrust == pytest.approx(0.85 * 0.85)


def test_a_long_chain_is_followed_to_its_end(spark):
    """Behind many blocked hosts, every host of a chain gets its score, however far."""
    n, length = 20_000, 63
    seeds = spark.range(n).select(F.format_string("b%d", "id").alias("host"), F.lit(0.0).alias("trust"), F.lit(1.0).alias("distrust"))
    to_blocked = spark.range(n).select(F.lit("c0").alias("src"), F.format_string("b%d", "id").alias("dst"), F.lit(1).cast("long").alias("n"))
    chain = spark.range(1, length).select(F.format_string("c%d", "id").alias("src"), F.format_string("c%d", F.col("id") - 1).alias("dst"), F.lit(1).cast("long").alias("n"))
    got = {r.host: r.distrust for r in urls.propagate(seeds, to_blocked.union(chain)).where("host like 'c%'").collect()}
    assert got == {f"c{k}": pytest.approx(n * 0.85 ** (k + 1), abs=1e-3) for k in range(length)}
    assert got[f"c{length - 1}"] > 0.5


def test_a_judged_host_keeps_its_own_share(spark):
    """Links between a blocked host and others cannot lift it, nor links from it a friend."""
    seeds = spark.createDataFrame([("bad", 0.0, 0.7), ("good", 1.0, 0.0)], "host string, trust double, distrust double")
    pairs = [("good", "friend", 1), ("friend", "bad", 1), ("bad", "friend", 1), ("good", "bad", 1)]
    got = {r.host: (r.trust, r.distrust) for r in urls.propagate(seeds, spark.createDataFrame(pairs, "src string, dst string, n long")).collect()}
    assert got["bad"] == (0.0, 0.7) and got["good"] == (1.0, 0.0)
    assert got["friend"] == (pytest.approx(0.425), pytest.approx(0.85 * 0.7 / 2))


def test_of_equally_long_rules_the_first_decides(spark):
    rules = [urls.Rule("allow", "com", "/ab/"), urls.Rule("block", "b.com", "/a"), urls.Rule("block", "net", "/es/"), urls.Rule("allow", "net", "/es/")]
    df = spark.createDataFrame([(1, "http://a.b.com/ab/x"), (2, "http://x.net/es/"), (3, "http://b.com/ax")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.ruled) for r in urls.ruled(df, rules).collect()}
    assert len(rules[0].text) == 7 and len(rules[1].text) == 7
    assert got == {1: ("com/ab/", "allow"), 2: ("net/es/", "block"), 3: ("b.com/a", "block")}


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.url_filter(df, RULES).isEmpty()
