import random
import re

from appraise.llm import urlfilter


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[2:] if fit else (None, "allow")))


URLS = [None, "", "no scheme", "http://", "https://Example.COM", "https://example.com/", "https://example.com/en/x?y#z", "HTTP://WWW.Example.com/en/", "ftp://a.net/es/1",
        "http://net/es/", "http://xnet/es/", "http://a.net?/es/", "http://a.net#x", "http://a.b.c.d.e.f.g.net/fr/", "x://y://z.com/", "http://com/", "http://.com/",
        "http://a.com./", "http://example.com:80/en/", "http://" + "a." * 3000 + "com/" + "p/" * 9000, "http://é.com/en/\n/x"]


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id long, url string, host string, rule string")
    return urlfilter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))


def test_rules_of_the_query(spark):
    urls = [*enumerate(URLS), (3, URLS[6]), (3, URLS[6]), (None, URLS[5])]
    got = [tuple(r) for r in judged(spark, urls, urlfilter.RULES).collect()]
    assert sorted(got, key=repr) == sorted([(i, *brute(u, urlfilter.RULES)) for i, u in urls], key=repr)


def test_many_rules_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "BROADCAST_RULES", 10)
    rng = random.Random(6)
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in (
        (f"{rng.choice('abc')}.h{rng.randrange(300)}.org", "/" + "x" * rng.randrange(4)) for _ in range(400))}.values())
    urls = [(i, f"http://{rng.choice('abcd')}.{rng.choice('abc')}.h{rng.randrange(400)}.org/{'x' * rng.randrange(5)}/q") for i in range(500)]
    got = [tuple(r) for r in judged(spark, urls, rules).collect()]
    assert sorted(got) == sorted((i, *brute(u, rules)) for i, u in urls) if all(r[3] for r in got) else \
        sorted(got, key=repr) == sorted([(i, *brute(u, rules)) for i, u in urls], key=repr)


def test_odd_lists(spark):
    assert judged(spark, [], urlfilter.RULES).count() == 0
    assert [r.verdict for r in judged(spark, [(1, "http://a.com/")], []).collect()] == ["allow"]
    both = [("A.com", "/", "allow"), ("a.com", "/", "block"), (None, "/", "block"), ("a.com", None, "block")]
    assert [tuple(r) for r in judged(spark, [(1, "http://a.com/")], both).collect()] == [(1, "a.com", "/", "a.com/", "block")]
