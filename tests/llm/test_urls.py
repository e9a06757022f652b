"""URL parts, rules and reputations against plain Python, and the SQL on odd inputs."""

from __future__ import annotations

import duckdb
import pytest

from parcelflow.llm import urls

PAGES = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"

URLS = [
    None, "", "no scheme/en/5", "http://Example.COM/en/1", "https://www.example.com/en/2.html?x=/fr/", "ftp://a.b.example.com/en/3/",
    "http://example.com", "http://example.com?x", "http://x.net/es/4#y", "http://net/fr/", "http://notnet/es/", "http://com/", "://h/p",
    "http://xcom/a", "http://évil.example.org/É/6", "http://a.example.com/EN/1", "http://a/b://c/d", "http://h\n/x\ny?z", "http://www.example.com/en", "http://1.2.3.4/99999999999999999999",
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    cut = min(ends, default=len(rest))
    path = rest[cut:]
    ends = [path.find(c) for c in "?#" if c in path]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, path[: min(ends, default=len(path))]


def plain_rule(host, path):
    fit = [(h, p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda r: len(r[0] + r[1]), default=None)


def both(spark, pages, labels):
    p, l_ = spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS)
    got = urls.page_verdicts(p.selectExpr("*", "'clash' as host", "'clash' as rule").repartition(3), l_).collect()
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str)
    con = duckdb.connect()
    con.register("p", p.toPandas())
    con.register("l", l_.toPandas())
    con.execute("create table pages as select cast(page_id as bigint) page_id, cast(url as varchar) url from p")
    con.execute("create table labels as select cast(doc_id as bigint) doc_id, cast(quality as int) quality, cast(toxic as int) toxic from l")
    want = con.execute(f"select page_id, host, path, rule, verdict from ({urls.verdict_sql()})").fetchall()
    assert got == sorted(want, key=str)
    return got


def test_parts_and_rules(spark):
    pages = [(i, u, "") for i, u in enumerate(URLS)] + [(None, URLS[3], None), (3, URLS[3], "")]
    got = both(spark, pages, [(1, 1, 0), (None, 0, 1), (2, None, None)])
    want = []
    for i, u, _ in pages:
        host, path = plain(u)
        rule = plain_rule(host, path)
        want.append((i, host, path, rule and rule[0] + rule[1], rule[2] if rule else "allow"))
    assert got == sorted(want, key=str)


def test_reputation_blocks_bad_hosts_and_shrinks_thin_evidence(spark):
    pages, labels, n = [], [], 0
    for host, good, bad in (("spam.farm.org", 1, 60), ("fine.org", 60, 2), *[(f"ok{k}.org", 30, 1) for k in range(8)], ("one.thin.org", 0, 1), ("b.farm.org", 2, 30), ("new.farm.org", 0, 0)):
        for k in range(good + bad + 1):
            pages.append((n, f"http://{host}/a/{n}.html", ""))
            if k < good + bad:
                labels.append((n, int(k < good), n % 2 if k >= good else 0))
            n += 1
    labels += [(0, 1, 0), (5, 1, 1)]
    verdicts = {}
    for _, host, _, rule, verdict in both(spark, pages, labels):
        assert rule is None and verdicts.setdefault(host, verdict) == verdict
    assert verdicts["spam.farm.org"] == verdicts["b.farm.org"] == "block"
    assert verdicts["fine.org"] == verdicts["one.thin.org"] == "allow"
    shares = {r.host: r.share for r in urls.reputations(
        urls.labelled_pages(spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS))).collect()}
    assert shares["fine.org"] < shares["one.thin.org"] < shares["new.farm.org"] < shares["spam.farm.org"]


def test_hosts_domains_and_suffixes_flip_verdicts(spark):
    def judged(*hosts):
        pages, labels = [], []
        for host, good, bad in hosts:
            for k in range(good + bad + 1):
                pages.append((len(pages), f"http://{host}/a/{len(pages)}.html", ""))
                if k < good + bad:
                    labels.append((len(pages) - 1, int(k < good), None))
        verdict = {host: v for _, host, _, _, v in both(spark, pages, labels)}
        assert {v for *_, v in both(spark, pages, [])} == {"allow"}
        return {h for h, v in verdict.items() if v == "block"}

    fine = [(f"h{k}.ok{k}.org", 20, 1) for k in range(30)]
    by_host = judged(*fine, ("evil.ok1.org", 2, 40), ("good.bad.org", 60, 0), ("b.bad.org", 0, 30), ("c.bad.org", 1, 30))
    assert by_host == {"evil.ok1.org", "b.bad.org", "c.bad.org"}
    spam = [(f"h{k}.spam.info", 1, 12) for k in range(30)]
    by_domain = judged(*fine, *spam, ("new.spam.info", 0, 0), ("new.ok1.org", 0, 0), ("new.unknown.org", 0, 0))
    assert by_domain == {h for h, *_ in spam} | {"new.spam.info"}
    junk = [(f"h{k}.d{k}.junk", 4, 16) for k in range(30)]
    by_suffix = judged(*fine, *junk, ("new.unknown.junk", 0, 0), ("d2.junk", 0, 0), ("new.unknown.org", 0, 0), ("x.other", 0, 0))
    assert by_suffix == {h for h, *_ in junk} | {"new.unknown.junk", "d2.junk"}


def test_the_mark_follows_the_base_rate(spark):
    pages = [(i, f"http://h{i % 50}.x{i % 50}.org/{i}", "") for i in range(3000)]
    labels = [(i, 1, int(i % 50 == 7 and i % 3 == 0)) for i in range(3000)]  # one host a third bad, the rest clean
    assert {h for _, h, _, _, v in both(spark, pages, labels) if v == "block"} == {"h7.x7.org"}
    even = [(i, 1, int(i % 3 == 0)) for i in range(3000)]  # all hosts a third bad
    assert {v for *_, v in both(spark, pages, even)} == {"allow"}
    long_url = "http://h.org/" + "a/" * 200_000 + "1"
    assert both(spark, [(1, long_url, "")], [(1, 0, 1)])[0][2] == long_url[len("http://h.org") :]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 0, 0), (2, 0, 1)]])
def test_few_labels_and_empty_pages(spark, labels):
    pages = [(1, "http://a.b/x/1", ""), (2, "http://a.b/x/2", ""), (3, "http://c.d/x/3", "")]
    both(spark, pages, labels)
    assert both(spark, [], labels) == []
