"""Mixing sources to target weights by weighted fair queueing (operator 9).

DataFrame and SQL functions only. Every document gets a size in words; every
source gets a target: sources in code point order (NULL last) weigh 3, 1, 2,
repeating, and share 150 % of all words; no target exceeds twice its source's
words, the excess goes to the others by weight until none is above (one water
level: the target is the smaller of ``limit * size`` and ``level * weight``).

A source's documents queue in a shuffled order (by a hash of id and text, so
reruns agree), once per pass, at most ``limit`` passes. The virtual finish time
of an entry is its source's words up to and including it, divided by the
source's target: a source whose queue is served at its fair share reaches 1 when
it has given its target. All entries are ordered by finish time and cut where
their words reach the total budget. Each source ends within one document of its
target.

Scale: the text is read once, by the word count and the hash; the rest moves
rows of a few numbers. Running totals are two-level. A source is cut into hash
ranges of about ``per_range`` rows by its own row count, so a source with a
third of all rows is spread like any other; only one row per range meets in a
window over its source. The global order is a range partition on finish time
(entries of every source lie evenly on it); only the range in which the budget
runs out is sorted. The driver reads that range's number and the first entry
that no longer fits.

Edge cases: NULL and empty texts have size 0 and are never taken; a source
without words has target 0; NULL sources form one source; NULL ids are
ordinary values; repeated rows are queued one by one; an empty table gives no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, parts_for, stored, sums_before, text_column

#: rows that one hash range or one finish-time range holds on average
PER_RANGE = 4096
#: bits of the shuffling hash: the first 15 hex digits of an MD5
HASH_BITS = 60
#: finish-time ranges up to time 1; above it the ranges widen geometrically
MAX_RANGES = 65536


def shuffle_key(id_col: str, text: Column) -> Column:
    """A number below 2^60 that depends on id and text only."""
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), F.md5(text)))
    return F.conv(F.substring(key, 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, row_key: Column) -> DataFrame:
    text = text_column(text_col)
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.regexp_count(text, F.lit(WORD_RE)).cast("long").alias("size"),
                       shuffle_key(id_col, text).alias("h"), row_key.alias("rk"))


def source_targets(rows: DataFrame, weights, share: float, limit: int) -> DataFrame:
    """One row per source: ``source, srank, n, source_size, target``. The driver
    reads the sums of sizes and weights, and the water level."""
    src = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).withColumn("one", F.lit(1).cast("long"))
    src = sums_before(src, [F.col("source").asc_nulls_last()], ["one"], "mix-sources")
    srank = (F.col("before_one") + 1).cast("long")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("before_one"), F.lit(len(weights))) + 1).cast("int"))
    cap = (F.col("source_size") * limit).cast("double")
    src = src.select("source", "source_size", "n", srank.alias("srank"), w.alias("w"), cap.alias("cap"), (cap / w).alias("fill"))
    src = sums_before(src, ["fill", "srank"], ["cap", "w"], "mix-levels")
    total = src.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    left = F.lit(float((total["size"] or 0) * share)) - F.col("before_cap")
    src = src.withColumn("own_level", left / (F.lit(float(total["w"] or 0)) - F.col("before_w")))
    fits = src.where(F.col("own_level") * F.col("w") <= F.col("cap"))
    level = fits.agg(F.min_by("own_level", F.struct("fill", "srank"))).first()[0]
    target = F.col("cap") if level is None else F.least("cap", F.lit(level) * F.col("w"))
    return src.select("source", "srank", "n", "source_size", target.alias("target"))


def queued(rows: DataFrame, src: DataFrame, per_range: int) -> DataFrame:
    """``rows`` with their source's numbers and ``cum``: the source's words up
    to and including the row, in shuffled order."""
    s = src.withColumnRenamed("source", "s_source")
    d = rows.join(s, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    ranges = F.ceil(F.col("n") / F.lit(per_range))
    d = d.withColumn("hr", F.floor(F.col("h") / F.lit(float(1 << HASH_BITS)) * ranges))
    inside = (Window.partitionBy("srank", "hr").orderBy("h", "id", "size", "rk")
              .rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("run", F.sum("size").over(inside))
    sums = d.groupBy("srank", "hr").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("srank").orderBy("hr").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("srank", "hr", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    return d.join(sums, ["srank", "hr"]).withColumn("cum", F.col("run") + F.col("offset")).drop("run", "offset", "hr")


def finish(turn: int) -> Column:
    """Virtual finish time of the entry in pass ``turn`` (from 0); NULL in a source
    without words."""
    return F.try_divide(F.col("cum") + F.col("source_size") * turn, F.col("target"))


def time_range(f: Column, ranges: int) -> Column:
    flat = F.floor(f * ranges)
    return F.when(f < 1, flat).otherwise(F.floor((F.log2(f) + 1) * ranges))


def first_left_out(queue: DataFrame, budget: float, limit: int, per_range: int):
    """Key ``(finish, srank, turn, cum)`` of the first entry that does not fit
    into ``budget`` any more, or None."""
    entries = reduce(DataFrame.union, [
        queue.where("size > 0 and target > 0").select(finish(t).alias("f"), "srank", F.lit(t).alias("turn"), "cum", "size")
        for t in range(limit)])
    n = queue.count() * limit
    ranges = min(MAX_RANGES, parts_for(queue.sparkSession, n, per_range))
    entries = entries.withColumn("fr", time_range(F.col("f"), ranges))
    sums = entries.groupBy("fr").agg(F.sum("size").alias("words"))
    total = F.sum("words").over(Window.orderBy("fr").rowsBetween(Window.unboundedPreceding, 0))
    cut = (sums.withColumn("total", total).where(F.col("total") > budget)
           .orderBy("fr").select("fr", (F.col("total") - F.col("words")).alias("offset")).first())
    if cut is None:
        return None
    inside = (Window.partitionBy("fr").orderBy("f", "srank", "turn", "cum")
              .rowsBetween(Window.unboundedPreceding, 0))
    late = (entries.where(F.col("fr") == cut["fr"])
            .withColumn("total", F.sum("size").over(inside) + F.lit(cut["offset"]))
            .where(F.col("total") > budget))
    return late.agg(F.min(F.struct("f", "srank", "turn", "cum")).alias("k")).first()["k"]


def before(key, turn: int) -> Column:
    """Whether the row's entry in pass ``turn`` comes before ``key``."""
    cols = [finish(turn), F.col("srank"), F.lit(turn), F.col("cum")]
    out = F.lit(False)
    for c, v in reversed(list(zip(cols, key))):
        out = (c < F.lit(v)) | ((c == F.lit(v)) & out)
    return out


def fair_queue(docs: DataFrame, *, weights=(3, 1, 2), share: float = 1.5, limit: int = 2,
               id_col="doc_id", text_col="text", source_col="source",
               per_range: int = PER_RANGE, row_key: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id, h, rk, source, size, source_size, target,
    passes`` (how often the mix takes the whole document, 0 to ``limit``) and
    ``start`` (its first finish time). ``share`` may not exceed ``limit``."""
    if not 0 < share <= limit:
        raise ValueError("share must lie in (0, limit]")
    rows = stored(sized(docs, id_col, text_col, source_col, F.lit(0).cast("long") if row_key is None else row_key), "mix-sizes")
    queue = stored(queued(rows, source_targets(rows, weights, share, limit), per_range), "mix-queue")
    budget = (rows.agg(F.sum("size")).first()[0] or 0) * share
    key = first_left_out(queue, budget, limit, per_range)
    live = (F.col("size") > 0) & (F.col("target") > 0)
    passes = reduce(Column.__add__, [
        F.when(live & (F.lit(True) if key is None else before(key, t)), 1).otherwise(0)
        for t in range(limit)])
    return queue.select("id", "h", "rk", "source", "size", "source_size", "target",
                        passes.alias("passes"), F.when(live, finish(0)).alias("start"))


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (words, repeats counted)."""
    q = fair_queue(docs, **options)
    return q.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * F.col("passes")).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken. Rows are told
    apart by a hash of all their columns; wholly equal ones are interchangeable, so
    one of them stands for all that the mix takes of them."""
    whole = F.xxhash64(*[F.col(c) for c in docs.columns])
    key = lambda i, h, rk: F.struct(i.alias("i"), h.alias("h"), rk.alias("rk")).alias("_mix_key")
    taken = (fair_queue(docs, id_col=id_col, text_col=text_col, row_key=whole, **options)
             .where("passes > 0").groupBy("id", "h", "rk").agg(F.sum("passes").cast("int").alias("passes"))
             .select(key(F.col("id"), F.col("h"), F.col("rk")), "passes"))
    keyed = docs.select(F.struct("*").alias("row"), key(F.col(id_col), shuffle_key(id_col, text_column(text_col)), whole))
    once = keyed.dropDuplicates(["_mix_key"])
    return (once.join(taken, "_mix_key")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("passes"))).alias("_pass")).select("row.*"))


ORACLE = r"""
WITH r AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS srank FROM r GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][((srank - 1) % 3 + 1)::INT] AS w, (2 * source_size)::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0))
              / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS own
      FROM w WINDOW b AS (ORDER BY cap / w, srank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, srank, source_size,
             least(cap, (SELECT arg_min(own, cap / w) FROM l WHERE own * w <= cap) * w) AS target FROM l),
q AS (SELECT r.doc_id, r.size, r.h, t.source_size, t.target, t.srank,
             (sum(r.size) OVER (PARTITION BY t.srank ORDER BY r.h, r.doc_id, r.size ROWS UNBOUNDED PRECEDING))::BIGINT AS cum,
             row_number() OVER () AS rn
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
e AS (SELECT rn, size, srank, k AS turn, cum, (cum + source_size * k) / target AS f
      FROM q, (VALUES (0), (1)) v(k) WHERE size > 0),
g AS (SELECT rn, size, sum(size) OVER (ORDER BY f, srank, turn, cum ROWS UNBOUNDED PRECEDING) AS total FROM e),
x AS (SELECT rn, sum(size) AS taken FROM g WHERE total <= (SELECT 1.5 * sum(size) FROM r) GROUP BY rn)
SELECT q.doc_id, q.size::BIGINT AS size, q.source_size, q.target, coalesce(x.taken, 0)::BIGINT AS taken
FROM q LEFT JOIN x USING (rn)
"""
