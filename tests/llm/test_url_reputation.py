"""Rules, reputations and verdicts of the URL filter against plain Python."""

import random
import re
from collections import Counter
from math import sqrt

import pytest
from pyspark.sql import functions as F

from eddy.llm import url_filter

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    rest = rest[:min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    at = rest.find("/") if "/" in rest else len(rest)
    return rest[:at].translate(UPPER), rest[at:]


def ruled(host, path):
    fits = [(len(h) + len(p), verdict, h + p) for verdict, h, p in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def levels(host):
    labels = re.sub(r":[0-9]*$", "", host).split(".")
    two = ".".join(labels[-2:])
    if two in url_filter.DOUBLE_SUFFIXES:
        return two, ".".join(labels[-3:])
    return labels[-1], two


def posteriors(counts, prior):
    """``{key: (alpha, beta)}`` from ``{key: (n, bad)}`` and ``prior(key)``, the mean
    and worth of the level above."""
    seen = [(n, bad, prior(k)[0]) for k, (n, bad) in counts.items() if n]
    s = sum(n * (bad / n - m) ** 2 for n, bad, m in seen)
    v, nv = sum(m * (1 - m) for _, _, m in seen), sum(n * m * (1 - m) for n, _, m in seen)
    size = url_filter.STRENGTH
    if v and nv > v:
        rho = (s - v) / (nv - v)
        size = url_filter.MOST if rho <= 0 else min(url_filter.MOST, max(url_filter.LEAST, 1 / rho - 1))
    out = {}
    for k, (n, bad) in counts.items():
        m, worth = prior(k)
        w = 1 / (1 / size + 1 / worth)
        out[k] = (w * m + bad, w * (1 - m) + n - bad)
    return out


def judged(urls, outcomes=None):
    """Rows ``(host, path, rule, verdict, bad_rate, bad_bound)`` of the urls."""
    rows = [(*parts(u), *ruled(*parts(u))) for u in urls]
    if outcomes is None:
        outcomes = [None if v is None else int(v == "block") for _, _, v, _ in rows]
    tallies = [Counter(), Counter(), Counter()]
    bads = [Counter(), Counter(), Counter()]
    for (host, *_), o in zip(rows, outcomes):
        suffix, domain = levels(host)
        for tally, bad, k in zip(tallies, bads, (suffix, (suffix, domain), (suffix, domain, host))):
            tally[k] += o is not None
            bad[k] += o or 0
    n, bad = sum(o is not None for o in outcomes), sum(o or 0 for o in outcomes)
    own = {None: (bad + 0.5, n - bad + 0.5)}
    for depth, (tally, bad) in enumerate(zip(tallies, bads)):
        above, up = own, (lambda k: None) if depth == 0 else (lambda k: k[0]) if depth == 1 else (lambda k: k[:2])
        own = posteriors({k: (tally[k], bad[k]) for k in tally}, lambda k: (above[up(k)][0] / sum(above[up(k)]), sum(above[up(k)])))
    out = []
    for host, path, verdict, rule in rows:
        a, b = own[(*levels(host), host)]
        m = a / (a + b)
        low = m - url_filter.Z * sqrt(m * (1 - m) / (a + b + 1))
        out.append((host, path, rule, verdict or ("block" if low > url_filter.MAX_BAD else "allow"), m, low))
    return out


def same(got, want):
    assert len(got) == len(want)
    for r, w in zip(sorted(got, key=lambda r: r.page_id), want):
        assert tuple(r)[1:5] == w[:4]
        assert tuple(r)[5:7] == pytest.approx(w[4:], abs=1e-9)


def test_rules_as_outcomes(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = sorted((r.page_id, r.url) for r in pages.select("page_id", "url").collect())
    same(url_filter.judge_urls(pages).collect(), judged([u for _, u in rows]))


def test_labels_as_outcomes(spark):
    """Hosts of many and few labelled pages, ports, double suffixes, NULL urls, ties,
    a very long url, and columns whose names clash."""
    r = random.Random(4)
    hosts = [f"{h}.site{k}.{s}" for k in range(6) for h in ("a", "b", "WWW") for s in ("org", "co.uk", "de:8080", "net")] + ["org", "co.uk", "x"]
    rows = []
    for i in range(900):
        host = "bad.site0.org" if i % 3 == 0 else r.choice(hosts)
        worse = 0.95 if host.startswith(("bad", "b.")) else 0.1
        url = r.choice(["http", "https"]) + f"://{host}{r.choice(['', '/es/1', '/x?q=/es/', '#f', '/?'])}"
        rows.append((i, url, r.choice([None, int(r.random() < worse)]), "x", 1, "x"))
    rows += [(900, None, 1, "x", 1, "x"), (901, "no url", None, "x", 1, "x"), (902, "http://long.org/" + "y" * 200_000, 1, "x", 1, "x"), (903, None, 1, "x", 1, "x")]
    d = spark.createDataFrame(rows, "page_id long, url string, bad_label int, host string, n int, rule string")
    got = url_filter.judge_urls(d, outcome=F.col("bad_label")).collect()
    want = judged([x[1] for x in rows], [x[2] for x in rows])
    same(got, want)
    assert {w[3] for w in want if w[2] is None} == {"allow", "block"}
