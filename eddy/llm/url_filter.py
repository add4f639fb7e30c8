"""URL filter with rules and an empirical-Bayes host reputation (operator 7).

Rules come first: a rule ``(verdict, host, path)`` fits its host and all
subdomains if the url's path starts with the rule's; the longest fitting rule
(host plus path, in characters) decides.

Pages without a rule are judged by the reputation of their host. Labelled
outcomes (1 bad, 0 good; by default the verdicts of the rules) are counted per
host, registered domain and suffix. Each level is a beta-binomial whose prior
mean is the posterior mean of the level above and whose strength is fitted to
the spread of rates on that level by the method of moments, but is worth no more
than the counts the level above rests on:

    host <- registered domain <- suffix <- all pages

A host without outcomes has its domain's reputation, and so on. A page is
blocked when the lower posterior bound (mean minus ``z`` standard deviations) of
its host's bad rate exceeds ``max_bad``; little evidence never blocks.

Everything is DataFrame aggregation: three groupings with partial aggregation,
so a host with a third of all pages leaves every task as one row, then joins of
the pages with one row per host (AQE splits a hot host). The driver reads three
pairs of numbers, the strengths. The registered domain is the last two labels of
the host (three if the last two form one of ``double_suffixes``), the suffix
the rest.

Edge cases: a NULL url, or one without ``://``, has empty host and path, no
rule, and the reputation of the empty host. Repeated rows are judged alike and
each count. With no labelled page every verdict without a rule is ``allow``. An
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: the rules of the contract: verdict, host, path
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: suffixes of two labels that are registered under
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")
MAX_BAD = 0.5
Z = 2.0
#: prior strength where the rates give none, and its limits
STRENGTH, LEAST, MOST = 2.0, 0.1, 1000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_replace(F.split(url, "://", 2).getItem(1), "(?s)[?#].*", "")
    host = F.regexp_replace(rest, "(?s)/.*", "")
    path = F.substr(rest, F.length(host) + 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, low).otherwise(""), F.when(has, path).otherwise("")


def longest_rule(rules) -> Column:
    """Struct ``(verdict, rule)`` of the longest rule that fits, or NULL."""
    fits = []
    for verdict, host, path in rules:
        ok = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        one = F.struct(F.lit(len(host) + len(path)).alias("n"), F.lit(verdict).alias("verdict"), F.lit(host + path).alias("rule"))
        fits.append(F.when(ok, one))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,verdict:string,rule:string>")


def host_levels(double_suffixes) -> dict[str, Column]:
    labels = F.split(F.regexp_replace("host", ":[0-9]*$", ""), "\\.")
    n = F.size(labels)
    last2 = F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), F.lit(2)), ".")
    last3 = F.array_join(F.slice(labels, F.greatest(n - 2, F.lit(1)), F.lit(3)), ".")
    two = last2.isin(list(double_suffixes)) if double_suffixes else F.lit(False)
    return {"domain": F.when(two, last3).otherwise(last2),
            "suffix": F.when(two, last2).otherwise(F.element_at(labels, -1))}


def strength(level: DataFrame) -> float:
    """Prior strength of a beta-binomial over ``(n, bad, m)`` rows, ``m`` the
    prior mean of the row, by moments: with rates p of groups of n, the spread
    E[n (p - m)^2] lies between m(1-m) (no spread) and n m(1-m)."""
    r = level.agg(F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), 2)).alias("s"),
                  F.sum(F.col("m") * (1 - F.col("m"))).alias("v"),
                  F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("nv")).first()
    if not r["v"] or r["s"] is None or r["nv"] <= r["v"]:
        return STRENGTH
    rho = (r["s"] - r["v"]) / (r["nv"] - r["v"])  # intra-group correlation
    return MOST if rho <= 0 else min(MOST, max(LEAST, 1 / rho - 1))


def reputations(outcomes: DataFrame, double_suffixes=DOUBLE_SUFFIXES) -> DataFrame:
    """``host, alpha, beta`` for every host of ``outcomes`` (``host``, ``bad``:
    1, 0 or NULL where the page has no label)."""
    known = F.col("bad").isNotNull()
    hosts = (outcomes.groupBy("host").agg(F.sum(F.when(known, 1).otherwise(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
             .select("*", *[c.alias(k) for k, c in host_levels(double_suffixes).items()]))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1)

    def shrunk(level, m, known):
        """Posterior counts of each row around its prior mean ``m``; the prior
        is worth no more than ``known``, the counts that mean rests on."""
        level = level.withColumn("m", m)
        s = 1 / (F.lit(1 / strength(level.where("n > 0"))) + 1 / known)
        a, b = s * F.col("m") + F.col("bad"), s * (1 - F.col("m")) + F.col("n") - F.col("bad")
        return level.withColumn("alpha", a).withColumn("beta", b)

    above = [(F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("above"), (F.col("alpha") + F.col("beta")).alias("known")]
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = shrunk(hosts.groupBy("suffix").agg(*sums), F.lit(mean), F.lit(float((total["n"] or 0) + 1)))
    domains = hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes.select("suffix", *above), "suffix")
    domains = shrunk(domains, F.col("above"), F.col("known")).select("suffix", "domain", *above)
    own = hosts.join(domains, ["suffix", "domain"])
    return shrunk(own, F.col("above"), F.col("known")).select("host", "alpha", "beta")


def judge_urls(pages: DataFrame, *, rules=RULES, outcome: Column | None = None, max_bad: float = MAX_BAD,
               z: float = Z, double_suffixes=DOUBLE_SUFFIXES, id_col="page_id", url_col="url") -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_rate, bad_bound`` of every row;
    the last two are the posterior mean and lower bound of the host's bad rate.
    ``outcome`` gives labelled pages 1 (bad) or 0 (good), others NULL; without
    it the rules' verdicts are the labels."""
    host, path = url_parts(F.col(url_col))
    cols = [F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")]
    if outcome is not None:
        cols.append(outcome.cast("int").alias("bad"))
    d = pages.select(*cols).withColumn("best", longest_rule(rules))
    if outcome is None:
        d = d.withColumn("bad", F.when(F.col("best").isNotNull(), (F.col("best.verdict") == "block").cast("int")))
    rep = reputations(d.select("host", "bad"), double_suffixes)
    n = F.col("alpha") + F.col("beta")
    mean = F.col("alpha") / n
    bound = mean - F.lit(z) * F.sqrt(mean * (1 - mean) / (n + 1))
    rep = rep.select("host", mean.alias("bad_rate"), bound.alias("bad_bound"))
    j = d.join(rep, "host")
    method = F.when(F.col("bad_bound") > max_bad, "block").otherwise("allow")
    return j.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.verdict"), method).alias("verdict"), "bad_rate", "bad_bound")
