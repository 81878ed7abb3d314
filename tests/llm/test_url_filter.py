"""URL rules against brute force over odd code points, the last one among them."""

import random
import re

from pressmill.llm import url_filter

ODD = ["\U0010ffff", "\uffff", "\x01", "\x02", "\x00", "é", "\U0001f600", "a", "b", ".", "/", "\x7f", "\ufffd", "A"]


def split(url):
    rest = url.partition("://")[2] if url is not None and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def verdict(url, rules):
    host, path = split(url)
    fits = [(len(h) + len(p), len(h), h + p, action) for action, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def test_last_code_point_lies_inside_the_intervals(spark):
    urls = ["http://a.net/\U0010ffffx", "http://\U0010ffffa.net/", "http://\U0010ffff.net/", "http://.net/\U0010ffff\U0010ffff", "http://net.\U0010ffff/", "http://net/\U0010ffff", "http://b.a.net/\uffff"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rules_frame(spark)).collect()}
    assert got == {i: verdict(u, url_filter.RULES) for i, u in enumerate(urls)} and sum(v == "block" for _, v in got.values()) == 6


def test_random_urls_and_rules(spark):
    r = random.Random(31)
    text = lambda n: "".join(r.choice(ODD) for _ in range(r.randint(0, n)))
    rules = {(h, p): ("allow", h, p) for h, p in ((re.sub("[/A]", "", text(4)), "/" + text(3)) for _ in range(40)) if h}
    rules = list((rules | {("net", ""): ("block", "net", ""), ("a.net", "/"): ("allow", "a.net", "/"), ("\U0010ffff.net", "/\U0010ffff"): ("block", "\U0010ffff.net", "/\U0010ffff")}).values())
    urls = []
    for _ in range(1500):
        _, h, p = r.choice(rules)
        urls.append("http://" + r.choice(["", "", text(3) + ".", text(3)]) + h + r.choice(["", text(2), p, p + text(3), "/" + text(2)]) + r.choice(["", "?q", "#\U0010ffff"]))
    urls += [None, "", "://", "x://\U0010ffff" * 3, "http://" + "\U0010ffff." * 500 + "net/" + "\U0010ffff" * 20_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(5)
    rows = url_filter.judge(pages, url_filter.rules_frame(spark, rules)).collect()
    assert len(rows) == len(urls)
    for row in rows:
        assert (row.host, row.path) == split(urls[row.page_id])
        want = verdict(urls[row.page_id], rules)
        assert (row.rule, row.verdict) == want, (urls[row.page_id][:80], want)
