"""URL rules and host reputation against SQL, a brute-force posterior and edge rows."""

import pytest

from qirtas.llm import url_reputation as ur
from tests.llm.sql import assert_same

PAGES = "page_id long, url string, host string, verdict string, pages int"


def judged(spark, urls, outcomes=(), **options):
    pages = spark.createDataFrame([(i, u, "clash", "x", 0) for i, u in urls], PAGES)
    labels = spark.createDataFrame(list(outcomes), "page_id long, good int")
    return [tuple(r) for r in ur.judge(pages, labels, **options).collect()]


def test_query(spark, small):
    assert_same(ur.op1_url_reputation(spark, small), ur.SQL, small)


def test_rules_and_parts(spark):
    urls = [
        (1, "HTTP://A.Example.NET/en/X?q#f"), (2, "x://example.net"), (3, "x://b.net/EN/"), (4, "//none/"),
        (5, None), (6, "http://notexample.com/de/"), (7, "http://u.EXAMPLE.com/de/?x://b.net/"), (8, "http://É.org/fr/a#/b"),
        (9, "http:///p?x"), (None, "http://net/"),
    ]
    got = {r[0]: r[1:] for r in judged(spark, urls)}
    assert got == {
        1: ("a.example.net", "/en/X", "example.net/en/", "allow"),
        2: ("example.net", "", None, "allow"),
        3: ("b.net", "/EN/", "net/", "block"),
        4: ("", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("notexample.com", "/de/", None, "allow"),
        7: ("u.example.com", "/de/", "example.com/de/", "block"),
        8: ("É.org", "/fr/a", "org/fr/", "allow"),
        9: ("", "/p", None, "allow"),
        None: ("net", "/", "net/", "block"),
    }


def test_bad_hosts_are_blocked_and_little_evidence_is_not(spark):
    urls, outcomes = [], []
    for host, good, bad in [("a.fine.com", 30, 0), ("b.fine.com", 28, 1), ("bad.shop.com", 0, 40), ("new.fine.com", 0, 0), ("one.two.other.co.uk", 0, 1), ("two.other.co.uk", 9, 0)]:
        for k in range(max(good + bad, 1)):
            urls.append((len(urls), f"http://{host}/{k}"))
            if k < good + bad:
                outcomes.append((urls[-1][0], int(k < good)))
    urls += urls[:1]
    verdicts = {r[1]: r[4] for r in judged(spark, urls, [*outcomes, (0, None), (None, 1)])}
    assert verdicts == {"a.fine.com": "allow", "b.fine.com": "allow", "bad.shop.com": "block", "new.fine.com": "allow", "one.two.other.co.uk": "allow", "two.other.co.uk": "allow"}
    assert len(judged(spark, urls, outcomes)) == len(urls)


def test_registered_domains(spark):
    hosts = ["a.b.example.com", "example.com", "com", "a.b.co.uk", "co.uk", "x.xco.uk", "", "a..com"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = df.select(ur.F.regexp_extract("host", ur.DOMAIN, 1), ur.F.regexp_extract("host", ur.SUFFIX, 1)).collect()
    assert [tuple(r) for r in got][:6] == [("example.com", "com"), ("example.com", "com"), ("com", "com"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("xco.uk", "uk")]


def test_ports_users_and_addresses(spark):
    hosts = ["me@a.example.com:8080", "example.com:", "10.1.2.3", "10.1.2.3:80", "[::1]:443", "[::1]", "u:p@x.co.uk"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string").withColumn("domain", ur.domain_of("host"))
    got = [tuple(r) for r in df.select("domain", ur.suffix_of("domain")).collect()]
    address = lambda a: (a, a)
    assert got == [("example.com", "com"), ("example.com", "com"), address("10.1.2.3"), address("10.1.2.3"), address("[::1]"), address("[::1]"), ("x.co.uk", "co.uk")]


def test_hosts_alike_with_a_share_of_three_quarters(spark):
    """Nothing tells the hosts apart: none is blocked for lack of evidence, one with a lot of it is."""
    urls, outcomes = [], []
    for host, n in [(f"h{k}.d{k % 7}.com", 20) for k in range(60)] + [("new.d1.com", 0), ("new.other.org", 0), ("large.d2.com", 2000)]:
        for k in range(max(n, 1)):
            urls.append((len(urls), f"http://{host}/{k}"))
            if n:
                outcomes.append((urls[-1][0], int(k % 4 != 0)))
    verdicts = {r[1]: r[4] for r in judged(spark, urls, outcomes)}
    assert {h for h, v in verdicts.items() if v == "block"} == {"large.d2.com"}


def test_prior_strength_recovers_the_spread(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(0, float(rng.binomial(40, p)), 40.0) for p in rng.beta(6, 4, 3000)]
    df = spark.createDataFrame(rows, "root int, good double, n double")
    assert ur.prior_strength(df, "root").first()[0] == pytest.approx(10, rel=0.15)


def test_empty(spark):
    assert judged(spark, []) == []
