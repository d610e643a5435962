import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from changeflow.llm import link_trust as lt
from changeflow.llm.common import table


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def rule_of(host, path):
    fits = [r for r in lt.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def plain(rows):
    """The whole judgement with dictionaries."""
    links = defaultdict(Counter)
    pages = defaultdict(Counter)
    for _, url, html in rows:
        host, path = split(url)
        if not host:
            continue
        rule = rule_of(host, path)
        pages[host][rule.verdict if rule else None] += 1
        for other in {m.lower() for m in re.findall(r"(?i)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)", html or "")}:
            if other != host:
                links[host][other] += 1
    for host in [o for c in list(links.values()) for o in c]:
        if host not in pages:
            rule = rule_of(host, "/")
            pages[host][rule.verdict if rule else None] += 1
    seeds = {}
    for host, n in pages.items():
        if n[lt.BLOCK] >= 0.5 * sum(n.values()):
            seeds[host] = lt.DISTRUST
        elif n[lt.ALLOW] >= 0.5 * sum(n.values()):
            seeds[host] = lt.TRUST
    steps = {lt.TRUST: defaultdict(dict), lt.DISTRUST: defaultdict(dict)}
    incoming = defaultdict(Counter)
    for a, c in links.items():
        for b, n in c.items():
            incoming[b][a] = n
            steps[lt.TRUST][a][b] = n / sum(c.values())
    for b, c in incoming.items():
        for a, n in c.items():
            steps[lt.DISTRUST][b][a] = n / sum(c.values())
    ranks = {}
    for kind, step in steps.items():
        rank = {h: 0.15 for h, k in seeds.items() if k == kind}
        for _ in range(200):
            new = Counter({h: 0.15 for h, k in seeds.items() if k == kind})
            for a, x in rank.items():
                for b, p in step[a].items():
                    new[b] += 0.85 * p * x
            rank = new
        ranks[kind] = rank
    out = []
    for i, url, _ in rows:
        host, path = split(url)
        rule = rule_of(host, path)
        t, d = ranks[lt.TRUST].get(host, 0.0), ranks[lt.DISTRUST].get(host, 0.0)
        verdict = rule.verdict if rule else lt.BLOCK if d > t and d >= lt.LEAST_DISTRUST else lt.ALLOW
        out.append((i, host, path, rule.text if rule else None, verdict, round(t, 4), round(d, 4)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    hosts = [f"h{n}.org" for n in range(12)] + ["good.com", "www.example.com", "bad.net", "spam.net", "X.Example.COM"]
    rows = []
    for i in range(150):
        host = rng.choice(hosts + ["h1.org"] * 9)
        path = rng.choice(["/fr/x", "/es/", "/fr/1"]) if host in ("bad.net", "spam.net") else rng.choice(["/en/1", "/", "", "/fr", "/a/b"])
        targets = [rng.choice(hosts if host != "h2.org" else ["bad.net", "spam.net"]) for _ in range(rng.randint(0, 4))]
        html = "".join(f'<a href="http{rng.choice(["", "s"])}://{t}/p?x">x</a> <a HREF = \'//{t.upper()}#y\'>' for t in targets) + '<a href="/rel">'
        rows.append((i, f"https://{host}{path}{rng.choice(['', '?q=1', '#z'])}", html))
    rows += [(200, None, None), (201, "no scheme", ""), (202, "http://", "x"), (203, "a://b://c", None), (3, rows[3][1], rows[3][2]), (None, "http://new.org?x/y", "")]
    rows.append((204, "http://only.links.com/\nline", '<a href="http://never.seen.net/fr/">'))
    return rows


def test_equals_a_plain_version(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("verdict", F.lit(1))
    got = sorted(((*r[:5], round(r["trust"], 4), round(r["distrust"], 4)) for r in lt.judge(df).collect()), key=str)
    want = plain(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5:] for g in got] == [pytest.approx(w[5:], abs=1.1e-4) for w in want]
    assert {w[4] for w in want if w[3] is None} == {lt.ALLOW, lt.BLOCK}


def test_longest_rule_wins(spark):
    cases = {
        "http://a.com/x": "com/", "http://example.com/en/1": "example.com/en/", "http://www.example.com/en/1": "www.example.com/en/",
        "http://m.www.EXAMPLE.com/en/": "www.example.com/en/", "http://xexample.com/en/": "com/", "http://b.net/es/": "net/es/", "http://b.net/de/": None,
        "http://com": None, "http://com/": "com/",
    }
    df = spark.createDataFrame(list(cases.items()), "url string, want string")
    rows = df.select("want", lt.matching_rule(lt.host_of(F.col("url")), lt.path_of(F.col("url")), lt.RULES)["rule"].alias("got")).collect()
    assert all(r["want"] == r["got"] for r in rows)


def test_empty_table_and_no_python(spark, sf_dir):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert lt.judge(df).count() == 0
    judged = lt.judge(table(spark, sf_dir, "pages"))
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert judged.count() == table(spark, sf_dir, "pages").count()


@pytest.mark.parametrize("linkers", [1, 1000])
def test_verdicts_do_not_depend_on_how_many_link_to_a_blocked_host(spark, linkers):
    bad = '<a href="http://bad.net/es/">'
    wide = bad + "".join(f'<a href="http://n{n}.org/">' for n in range(99))
    rows = [(f"http://h{n}.org/", bad) for n in range(linkers)] + [("http://bad.net/es/", "")]
    rows += [(f"http://hot.org/{n}", bad) for n in range(3 * linkers)] + [("http://wide.org/", wide), ("http://behind.org/", '<a href="http://h0.org/">')]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = {r["host"]: r["verdict"] for r in lt.judge(df).collect()}
    assert got == {host: lt.ALLOW if host == "wide.org" else lt.BLOCK for host in got}
    assert len(got) == linkers + 4
