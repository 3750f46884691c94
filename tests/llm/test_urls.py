import hashlib
import math
import re
from collections import defaultdict

import pytest

from carestrata.llm import urls
from carestrata.llm.queries import URL_RULES, llm_queries

FOLDER = "/root/testdata/sf0.001"


def brute_parts(url):
    url = url or ""
    if "://" not in url:
        return "", "", url
    rest = url.split("://", 1)[1]
    raw = re.match("[^/?#]*", rest).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    return host, re.match("[^?#]*", rest[len(raw) :]).group(), host + rest[len(raw) :]


def brute_rule(host, path, rules):
    fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute_verdicts(addresses, rules, order=5):
    rows = []
    for url in addresses:
        host, path, text = brute_parts(url)
        verdict, rule = brute_rule(host, path, rules)
        rows.append((host, path, rule, verdict, text))
    texts = {(t, v) for *_, v, t in rows}
    marked = lambda t: "\x02" * order + t + "\x03"
    counts = {v: defaultdict(lambda: defaultdict(int)) for v in ("allow", "block")}
    calibrates = lambda t: hashlib.md5(t.encode()).hexdigest() < "4"
    for text, verdict in texts:
        if verdict and not calibrates(text):
            m = marked(text)
            for i in range(order, len(m)):
                for n in range(order + 1):
                    counts[verdict][m[i - n : i]][m[i]] += 1

    def chance(verdict, context, char):
        p = 1.0 / 256
        for n in range(order + 1):
            after = counts[verdict].get(context[order - n :])
            if after:
                p = (after.get(char, 0) + len(after) * p) / (sum(after.values()) + len(after))
        return p

    def cell(text):
        m, total = marked(text), 0
        for i in range(order, len(m)):
            ratio = math.log(chance("block", m[i - order : i], m[i])) - math.log(chance("allow", m[i - order : i], m[i]))
            total += math.floor(1000000 * ratio + 0.5)
        return max(-2048, min(2048, math.floor(float(total * 64) / float((len(text) + 1) * 1000000))))

    known = [(cell(t), v) for t, v in texts if v and calibrates(t)]
    sides = {v: [c for c, w in known if w == v] for v in ("allow", "block")}
    cut = 1
    if sides["allow"] and sides["block"]:
        right = lambda c: sum(x >= c for x in sides["block"]) * len(sides["allow"]) + sum(x < c for x in sides["allow"]) * len(sides["block"])
        cut = max({1, *(c + d for c, _ in known for d in (0, 1))}, key=lambda c: (right(c), -abs(2 * c - 1), c))
    return [(h, p, r, v or ("block" if cell(t) >= cut else "allow")) for h, p, r, v, t in rows], sides


def judged(df, rules, key="page_id"):
    return {r[key]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judged_urls(df, rules).collect()}


def test_query_equals_brute_force(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    expected, _ = brute_verdicts([r["url"] for r in pages], URL_RULES)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in llm_queries()["op12_markov_url_filter"](spark, FOLDER).collect()}
    assert [got[r["page_id"]] for r in pages] == expected


ODD = [
    None, "", "no scheme/en/", "://", "http://", "http:///en/x", "HTTP://WWW.Example.COM/en/a?b=http://x", "http://example.com", "http://example.com?/en/",
    "http://example.com#/en/", "http://badexample.com/en/", "http://a.net/es/", "http://net/fr/1", "http://a.net/es", "x://é.com/ü/𝒳#😀", "a://b://c.net/es/",
    "http://\nexample.com/en/\n", "http://ÄB.com/A", "\x02://\x03.net/es/",
]


def test_odd_urls_equal_brute_force(spark):
    """Nulls, missing and doubled parts, other scripts, repeated rows, one very long URL, clashing columns."""
    many = [f"http://{h}.{d}/{w}/{i * 7919 % 1000}" for i in range(60) for h, d, w in [("ab", "com", "de"), ("cd", "net", "es"), ("ef", "org", "fr"), ("x", "example.com", "en")]]
    addresses = [*ODD, *ODD, *many, "http://long.org/" + "ab/" * 4_000]
    rows = [(i, u, "t", "k", 3, "v") for i, u in enumerate(addresses)]
    df = spark.createDataFrame(rows, "page_id long, url string, text string, key string, cell int, verdict string").repartition(5)
    expected, sides = brute_verdicts(addresses, URL_RULES)
    assert sides["allow"] and sides["block"]
    got = judged(df, URL_RULES)
    assert [got[i] for i in range(len(addresses))] == expected
    none = spark.createDataFrame([(None, "http://q.org/"), (None, "http://q.org/"), (None, None)], "page_id long, url string")
    assert urls.judged_urls(none, URL_RULES).count() == 3
    assert urls.judged_urls(df.limit(0), URL_RULES).count() == 0


@pytest.mark.parametrize("rules", [[], [("allow", "com", "/")]])
def test_without_examples_of_both_kinds(spark, rules):
    addresses = ["http://a.com/x", "http://b.org/y", None]
    df = spark.createDataFrame(list(enumerate(addresses)), "page_id long, url string")
    expected, _ = brute_verdicts(addresses, rules)
    assert [judged(df, rules)[i] for i in range(3)] == expected


def test_models_tell_unseen_urls_apart(spark):
    """Hosts without a rule that look like the blocked ones are blocked, the others stay."""
    known = [f"http://shop{i}.net/es/cheap-pills-{i}" for i in range(200)] + [f"http://lib{i}.com/books/reading-{i}" for i in range(200)]
    new = [f"http://other{i}.org/es/cheap-pills-{i}" for i in range(20)] + [f"http://other{i}.org/books/reading-{i}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(known + new)), "page_id long, url string")
    got = judged(df, URL_RULES)
    assert [got[400 + i][3] for i in range(40)] == ["block"] * 20 + ["allow"] * 20
