"""URL rules and the quality cascade against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom.llm import quality, url_rules

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("WWW.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("org", "/a", "block"), ("x.org", "/", "allow"), ("x.org", "/", "block"), (None, "/", "block"), ("y.org", None, "block"),
]
URLS = [
    None, "", "no scheme.com/en/", "https://example.com", "https://example.com/en/", "HTTP://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/",
    "ftp://a.www.example.com/en/q", "https://notexample.com/en/", "https://a.net/es/", "https://net/es/", "://net/es/x", "https://a.net/fr/",
    "https://x.org/abc", "https://q.x.org/abc", "https://z.org/abc", "https://z.org", "https://z.org?/a", "https://y.org/", "https://com", "https:///en/",
    "https://a.com/b://c.net/es/", "https://example.com/en/\nnew", "https://..com/", "https://" + "a." * 300 + "net/es/" + "p" * 5000,
]


def verdict(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found.group(1), found.group(2)) if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [
        (len(h) + len(p), len(h), v, h.lower() + p) for h, p, v in RULES
        if h and p is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[2] if best else "other"


@pytest.mark.parametrize("hot, broadcast", [(1 / 1000, 200_000), (1.0, 200_000), (1 / 5, 0)])
def test_verdicts_equal_trying_every_rule(spark, monkeypatch, hot, broadcast):
    monkeypatch.setattr(url_rules, "HOT", hot)
    monkeypatch.setattr(url_rules, "BROADCAST_RULES", broadcast)
    rows = [(i, u, "h", "w", True) for i, u in enumerate(URLS + URLS[:3] * 9 + [URLS[4]] * 30)]
    urls = spark.createDataFrame(rows, "page_id int, url string, host string, won_host string, hot boolean").repartition(3)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_rules.url_verdicts(urls, rules, default="other")
    assert got.columns == [*urls.columns, "path", "rule", "verdict"]
    found = {r["page_id"]: r for r in got.collect()}
    assert len(found) == len(rows) == got.count()
    for i, url, *_ in rows:
        assert (found[i]["host"], found[i]["path"], found[i]["rule"], found[i]["verdict"]) == verdict(url), url
        assert found[i]["won_host"] == "w" and found[i]["hot"]


def test_urls_without_rules_and_no_urls(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    urls = spark.createDataFrame([(u,) for u in URLS[:5]], "url string")
    assert {r["verdict"] for r in url_rules.url_verdicts(urls, rules.limit(0)).collect()} == {"allow"}
    assert url_rules.url_verdicts(urls.limit(0), rules).count() == 0


def counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    n, m = len(words), max(len(words), 1)
    chars = sum(map(len, words))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    repeated = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(hit) > 50 * n
    bare = sum(not any(c.isalpha() for c in w) for w in words)
    kept = not failed and 2 * m <= chars <= 20 * m and symbols <= m and 2 * bare <= m and 10 * repeated <= m
    return n, chars, symbols, repeated, len(hit), failed, kept


def texts():
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 9)))
    some = lambda n: [word() for _ in range(n)]
    out = [None, "", " \n\t\x0b", "one", "a b c a b c", "\n\n", "x " * 60, "1 2 3 " * 30]
    for n in (49, 50, 80, 120):
        out += [" ".join(some(n)), "\n".join(some(n)), " ".join(some(n) + ["#" * 200]), " ".join(some(n) + ["#"] * (n // 2)),
                " ".join(str(i) for i in range(n)) + " " + " ".join(some(n // 2)), " ".join(w * 9 for w in some(n)),
                "\n".join((some(5) + ["same line"]) * 2 + some(n)), " ".join(some(n // 2) * 2)]
    return out + [out[8]] * 3


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_verdicts_equal_plain_counts(spark):
    rows = [(i % 9, t, "own", 5) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id int, text string, words string, n_words int").repartition(3)
    got = quality.judge(docs).withColumnRenamed("words", "kept_column").collect()
    assert sorted((str(r["text"]), *(r[n] for n in NAMES)) for r in got) == sorted((str(t), *counts(t)) for t in texts())
    assert {r["kept_column"] for r in got} == {"own"}


def test_no_rows_have_no_verdicts(spark):
    assert quality.judge(spark.createDataFrame([], "text string")).count() == 0
    few = spark.createDataFrame([(None,), ("",)], "text string")
    assert [r["kept"] for r in quality.judge(few).collect()] == [False, False]


def test_rules_are_estimated_on_rows_that_reach_them(spark, monkeypatch):
    monkeypatch.setattr(quality, "COPIES", 3)
    long = " ".join(f"word{i}" for i in range(60))
    sample = quality.base_counts(spark.createDataFrame([(long,), (long + " #" * 40,), ("#",), ("#",)], "text string"))
    rules = {"symbols": F.col("n_symbols") > 30, "never": F.lit(False), "slow": F.length(F.sha2(F.repeat("text", 2000), 256)) < 0}
    found = {name: (cost, share) for name, cost, share in quality.estimate(sample, rules)}
    assert {name: share for name, (_, share) in found.items()} == {"symbols": 0.5, "never": 0.0, "slow": 0.0}
    assert quality.by_yield([("dear", 9.0, 0.9), ("cheap", 0.1, 0.5), ("b", 0.0, 0.0), ("a", 5.0, 0.0)]) == ["cheap", "dear", "a", "b"]


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_TEXT", 10)
    docs = spark.createDataFrame([("x" * 50, i) for i in range(40)], "text string, i int").repartition(4)
    rows = quality.sampled(docs, rows=7).collect()
    assert len(rows) == 7 and {len(r["text"]) for r in rows} == {10}
