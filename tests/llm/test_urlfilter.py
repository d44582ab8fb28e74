"""URL filter against brute force."""

import re

import numpy as np
import pytest

from lapse.llm import urlfilter


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules):
    host, path = parts(url)
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    *_, rule, action = max(fits)
    return host, path, rule, action


def urls():
    rng = np.random.default_rng(1)
    hosts = ["example.org", "a.example.org", "b.a.example.org", "notexample.org", "org", "x.com", "com", "example.com", "EXAMPLE.Org",
             "x.net", "", "..", "a..org", "org:80", "u@example.org"]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12", "/en/2", "/fr/", "/fr/x/y", "/de/", "/de/q", "//", "/é", "/fr/a#b", "/de/?u=/fr/"]
    out = [f"http://{h}{p}" for h in hosts for p in paths]
    out += [None, "", "no scheme", "http:/x", "a://b://c/d", "https://x.org?q=/es/", "http://x.org#/es/", "http://x\n.org/\n/a",
            "http://" + "a." * 300 + "org/es/", "http://example.org/" + "y" * 5000]
    return out + [out[i] for i in rng.integers(0, len(out), 50)]


FIXED = urlfilter.RULES
NESTED = [("org", "/", "allow"), ("org", "/es/", "block"), ("example.org", "/", "block"), ("example.org", "/e", "allow"),
          ("example.org", "/en/", "block"), ("example.org", "/en/1", "allow"), ("a.example.org", "/en/12", "block"),
          ("com", "", "block"), ("x.com", "/fr/x", "allow"), ("net", "/zzz", "block"), ("", "/", "block"), ("a", "/", "block")]


@pytest.mark.parametrize("rules", [FIXED, NESTED])
def test_matches_brute_force(spark, rules):
    pages = spark.createDataFrame(list(enumerate(urls())), "page_id long, url string").selectExpr("*", "1 AS verdict", "2 AS rule", "3 AS won", "4 AS host")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge_urls(pages, table).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls())}


def test_many_rules(spark):
    rng = np.random.default_rng(4)
    rules = sorted({(f"h{rng.integers(0, 6)}.org", "/" + "ab"[rng.integers(0, 2)] * int(rng.integers(0, 7)) + "c" * int(rng.integers(0, 3)),
                     "block" if rng.random() < 0.5 else "allow") for _ in range(150)})
    unique = {}
    for h, p, a in rules:
        unique[h, p] = max(a, unique.get((h, p), a))
    pages = [f"http://s.h{rng.integers(0, 7)}.org/" + "".join(rng.choice(list("abc"), rng.integers(0, 9))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    table = spark.createDataFrame(rules + [("x", None, "block"), (None, "/", "block")], "host string, path string, action string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge_urls(df, table).collect()}
    assert got == {i: brute(u, [(h, p, a) for (h, p), a in unique.items()]) for i, u in enumerate(pages)}


def test_empty_sides(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    table = spark.createDataFrame(FIXED, "host string, path string, action string")
    none = urlfilter.judge_urls(df, table.where("host = 'q'")).collect()
    assert [(r["rule"], r["verdict"]) for r in none] == [(None, "allow")]
    assert urlfilter.judge_urls(df.where("page_id > 1"), table).count() == 0


def test_deep_nesting_is_carried_between_range_partitions(spark):
    """Rules nested 60 deep over one host; far more keys than rules, so most range partitions push nothing."""
    rules = [("org", "/" + "a" * n, "block" if n % 2 else "allow") for n in range(60)]
    rules += [("b.org", "/a", "allow"), ("org", "/é\U0010ffff", "block"), ("org", "", "block"), ("org", "/zz", "allow")]
    rng = np.random.default_rng(5)
    pages = ["http://x.b.org/" + "a" * int(rng.integers(0, 70)) + "".join(rng.choice(list("abz"), 4)) for _ in range(1500)]
    pages += ["http://org/é\U0010ffff", "http://org/é\U0010ffff\U0010ffff", "http://org/é", "http://org/ê", "http://org", "http://b.org/a"]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge_urls(df, table).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(pages)}


def test_sweep_has_no_join_of_rules_by_prefix(spark):
    """Rows of the sweep: one per key, a start and an end per rule, however deep the rules nest."""
    table = spark.createDataFrame([("org", "/" + "a" * n, "block") for n in range(50)], "host string, path string, action string")
    assert urlfilter._intervals(table).count() == 100
