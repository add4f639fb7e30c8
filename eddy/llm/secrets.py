"""Secret scans over a trigram inverted index (operator 5).

DataFrame and SQL functions only. From every rule's regular expression a Boolean
query over trigrams that each match must contain is derived (:mod:`.trigrams`): an
OR of ANDs. A rule without a mandatory trigram (a plain class run) has no query and
scans fully.

1. Index: one row ``(trigram, document)`` for each trigram of any query that
   occurs in the lower-cased text.
2. Query: postings are joined to the queries' terms; a document is a candidate
   for a rule if, for some AND, it has a posting for every term.
3. Verify: the rule's regular expression runs over the whole text of its
   candidates (of every document for a full-scan rule). The spans come from the
   matches and the pieces between them, so positions are exact code points.

Documents travel through the index by a digest of (id, text), 16 bytes; equal
rows share it, and are joined back by it. The postings of a frequent trigram are
many short rows, grouped by document and never by trigram, so no list is built
in one task. The text is shuffled once, to meet its candidate rules.

Edge cases: NULL text counts as empty and has no spans; NULL ids and repeated
rows keep their own output rows; texts of any length are scanned whole;
overlapping spans of different kinds are all kept. An empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_column
from .trigrams import trigram_query

#: matches whose positions are summed as one list; lists of lists above that
SPAN_BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern`` of
    which ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    def query(self) -> list[list[str]]:
        """OR of ANDs of mandatory trigrams; empty if the rule has none."""
        return trigram_query(self.pattern)


#: the rules of the contract, in the order of the contract (fixed values)
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # a match of [0-9a-f]+ with 32 or more characters is a whole run of that length
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: further kinds of secrets by their published forms (fixed values)
MORE = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("login", r"://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@"),
)
RULES = BASE + MORE


def candidates(rows: DataFrame, rules) -> DataFrame:
    """``(key, rules)``: for each document the indexed rules that may match."""
    spark = rows.sparkSession
    terms = [(r.kind, f"{r.kind}{n}", t, len(ts)) for r in rules for n, ts in enumerate(r.query()) for t in ts]
    grams = sorted({t for _, _, t, _ in terms})
    low = rows.select("key", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    postings = low.select("key", F.explode(found).alias("trigram"))
    # the queries are a fixed parameter of a few dozen rows
    queries = F.broadcast(spark.createDataFrame(terms, "kind string, part string, trigram string, need int"))
    hits = (postings.join(queries, "trigram").groupBy("key", "kind", "part", "need")
            .agg(F.countDistinct("trigram").alias("n")).where("n = need"))
    return hits.groupBy("key").agg(F.collect_set("kind").alias("rules"))


def bound(value: Column, make) -> Column:
    """``make(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), make), 1)


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of ``(start, rule number, end)`` of the rule's matches: code points, end
    exclusive. Match i starts behind the pieces before it and the matches before it;
    positions are summed inside blocks of ``SPAN_BLOCK`` matches and over the blocks,
    so that no list is copied for every match of a long text."""
    def lengths(group):
        return F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)), lambda x: F.length(x).cast("long"))

    pieces = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x).cast("long"))
    steps = bound(lengths(0), lambda m: F.arrays_zip(F.slice(pieces, 1, F.size(m)).alias("p"), m.alias("m"), (lengths(rule.group) if rule.group else m).alias("g")))

    def step(acc, x):
        start = acc["at"] + x["p"]
        one = F.array(F.struct(start.alias("s"), (start + x["m"]).alias("e"), x["g"].alias("n")))
        return F.struct((start + x["m"]).alias("at"), F.concat(acc["out"], one).alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint,n:bigint>>").alias("out"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def blocks(all_steps):
        at = F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / SPAN_BLOCK).cast("int"))
        return F.transform(at, lambda b: F.aggregate(F.slice(all_steps, b * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)), zero, step))

    def moved(parts):
        before = F.aggregate(parts, start, lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                             lambda acc: acc["out"])
        return F.flatten(F.transform(F.arrays_zip(parts.alias("part"), before.alias("by")), lambda z: F.transform(
            F.filter(z["part"]["out"], lambda x: x["n"] >= rule.least),
            lambda x: F.struct((x["s"] + z["by"]).alias("s"), F.lit(order).alias("k"), (x["e"] + z["by"]).alias("e")))))

    none = F.array().cast(NO_SPANS)
    return bound(steps, lambda m: F.when(F.size(m) == 0, none).otherwise(bound(blocks(m), moved)))


NO_SPANS = "array<struct<s:bigint,k:int,e:bigint>>"


def find_secrets(docs: DataFrame, *, rules=RULES, id_col="doc_id", text_col="text") -> DataFrame:
    """``id`` and ``found``: the array of spans ``(s, k, e)`` of every row, by
    start and then rule, ``k`` being the number of the rule."""
    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    rows = rows.withColumn("key", F.unhex(F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("-")).cast("binary"),
                                                         F.lit(":").cast("binary"), F.col("text").cast("binary")))))
    cand = candidates(rows, rules)
    j = rows.join(cand, "key", "left")
    parts = []
    for i, r in enumerate(rules):
        may = F.array_contains("rules", r.kind) if r.query() else F.col("text").rlike(r.pattern)
        parts.append(F.when(may, spans(F.col("text"), r, i)).otherwise(F.array().cast(NO_SPANS)))
    return j.select("id", F.array_sort(F.concat(*parts)).alias("found"))


def joined(found: Column, rules) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row; the
    counts and the hash are of the kinds in ``BASE``, ``spans`` has all."""
    f = find_secrets(docs, id_col=id_col, text_col=text_col)

    def count(k):
        return F.size(F.filter("found", lambda x: x["k"] == k)).cast("long")

    base = F.filter("found", lambda x: x["k"] < len(BASE))
    return f.select(F.col("id").alias("doc_id"), *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
                    F.sha2(joined(base, BASE).cast("binary"), 256).alias("base_sha256"), joined(F.col("found"), RULES).alias("spans"))
