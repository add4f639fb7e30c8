"""Batch queries over the driver's ``events`` table, one per operator of the
inventory, each with its DuckDB oracle.

Mapping of the reference's record onto ``events``: id = user_id,
timestamp = ts, temperature = value, arrival tie-break = event_id.
Parameters are scaled to the table (30 days, ~1 event per user and 5 hours
at sf0.01): threshold 100, tumbling 1 day, sliding 1 day / 6 hours, session
gap 12 hours, interval join +-3 hours, rise interval 1 day, join sides
purchase (left) and error (right)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import alert_text, strictly_above
from ..functions.fixed import ALERT_RISING, ALERT_ROSE, ALERT_SENSOR, COGROUP_HEADER_LEFT, COGROUP_HEADER_RIGHT, COGROUP_ITEM_SEP
from ..operators import aggregate, alarms, eventtime, joins, partition, rolling, route, transform, windows
from ..session import scratch_path
from ..sources import tables, text
from .catalog import ORACLE_SQL, register

THRESHOLD = 100.0
TUMBLE = "1 day"
SLIDE = "6 hours"
GAP = "12 hours"
LOWER, UPPER = "-3 hours", "3 hours"
RISE = "1 day"
TIMER_DELAY = "2 seconds"
LATE_DELAY = "1 day"
SCAN_BUCKET = "1 day"     # time bucket of the two-level keyed scans
VALUE_BUCKET = 50.0       # value range of the two-level in-window sort
LEFT_TYPE, RIGHT_TYPE = "purchase", "error"
PREFIX = "1"
# deterministic made-up arrival order for the out-of-order operators
ARRIVAL_SQL = "(event_id * 7919) % 10007"

K, TS, V, EID = "user_id", "ts", "value", "event_id"


def parts(spark) -> int:
    """Partitions of the explicit redistributions: the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ev(spark: SparkSession, d: str) -> DataFrame:
    return tables.events(spark, d)


# SQL fragments shared by the oracles
LINE_SQL = ("concat_ws(',', user_id::varchar, (epoch_us(ts) // 1000000)::varchar, "
            "value::decimal(10,2)::varchar)")
HIGH_SQL = f"(NOT isnan(value) AND value > {THRESHOLD})"


# ---------------------------------------------------------------- sources
@register("scan_lines", f"SELECT {LINE_SQL} AS value FROM events")
def q_scan_lines(spark, d):
    """Lines rendered by Spark from events, written as a text file into
    the shared checkpoint folder, read back with the text source."""
    path = scratch_path(spark, "lines")
    text.write_lines(text.render_reading_lines(ev(spark, d)), path)
    return text.scan_text(spark, path)


@register("parse_readings", """
SELECT event_id, user_id::varchar AS id, epoch_us(ts) // 1000000 AS timestamp,
       value::decimal(10,2)::double AS temperature FROM events""")
def q_parse_readings(spark, d):
    """S3."""
    lines = text.render_reading_lines(ev(spark, d), extra=[EID])
    return text.parse_readings(lines, keep=[EID])


@register("parse_pairs", """
SELECT event_id, user_id::varchar AS k, event_type AS v FROM events""")
def q_parse_pairs(spark, d):
    """S4."""
    lines = text.render_pair_lines(ev(spark, d), extra=[EID])
    return text.parse_pairs(lines, keep=[EID])


@register("explode_fields", f"""
SELECT event_id, unnest(string_split({LINE_SQL}, ',')) AS field FROM events""")
def q_explode_fields(spark, d):
    """P1."""
    return transform.explode_fields(text.render_reading_lines(ev(spark, d), extra=[EID]),
                                    keep=[EID])


@register("filter_prefix", f"""
SELECT {LINE_SQL} AS value FROM events WHERE starts_with({LINE_SQL}, '{PREFIX}')""")
def q_filter_prefix(spark, d):
    """P2."""
    return transform.filter_prefix(text.render_reading_lines(ev(spark, d)), "value", PREFIX)


@register("project_pair", """
SELECT user_id::varchar AS id, value::decimal(10,2)::double AS temperature FROM events""")
def q_project_pair(spark, d):
    """P3 on parsed readings."""
    r = text.parse_readings(text.render_reading_lines(ev(spark, d)))
    return transform.project(r, "id", "temperature")


@register("project_len", """
SELECT user_id::varchar AS id, length(user_id::varchar)::bigint AS id_length FROM events""")
def q_project_len(spark, d):
    """P4."""
    r = text.parse_readings(text.render_reading_lines(ev(spark, d)))
    return transform.with_length(r, "id")


@register("partition_tag")
def q_partition_tag(spark, d):
    """P5 (rows-only: partition indexes depend on the cluster)."""
    return partition.tag_partition_index(partition.shuffle(ev(spark, d), parts(spark), seed=7), K)


# ---------------------------------------------------------------- routing
def _tagged(spark, d):
    return route.split_tags(ev(spark, d).select(EID, K, V), V, THRESHOLD)


TAG_SQL = (f"SELECT event_id, user_id, value, CASE WHEN {HIGH_SQL} THEN 'high' "
           "ELSE 'low' END AS tag FROM events")


@register("split_tags", TAG_SQL)
def q_split_tags(spark, d):
    """M1."""
    return _tagged(spark, d)


@register("select_high", f"SELECT * FROM ({TAG_SQL}) WHERE tag = 'high'")
def q_select_high(spark, d):
    """M2."""
    return route.select_tags(_tagged(spark, d), "high")


@register("select_low", f"SELECT * FROM ({TAG_SQL}) WHERE tag = 'low'")
def q_select_low(spark, d):
    """M2."""
    return route.select_tags(_tagged(spark, d), "low")


@register("select_all", f"SELECT * FROM ({TAG_SQL}) WHERE tag IN ('high', 'low')")
def q_select_all(spark, d):
    """M3."""
    return route.select_tags(_tagged(spark, d), "high", "low")


@register("connect_comap", f"""
SELECT user_id, value, 'high temp warning' AS status FROM events WHERE {HIGH_SQL}
UNION ALL
SELECT user_id, NULL::double AS value, 'normal' AS status FROM events WHERE NOT {HIGH_SQL}""")
def q_connect_comap(spark, d):
    """M4."""
    t = _tagged(spark, d)
    return route.connect_comap(route.select_tags(t, "high"), route.select_tags(t, "low"), K, V)


@register("union_all", f"""
SELECT * FROM ({TAG_SQL}) WHERE tag = 'high'
UNION ALL SELECT * FROM ({TAG_SQL}) WHERE tag = 'low'
UNION ALL SELECT * FROM ({TAG_SQL})""")
def q_union_all(spark, d):
    """M5: high.union(low, all) -> every row twice."""
    t = _tagged(spark, d)
    return route.union_all(route.select_tags(t, "high"), route.select_tags(t, "low"),
                           route.select_tags(t, "high", "low"))


@register("side_output_main", f"SELECT event_id, user_id, value FROM events WHERE {HIGH_SQL}")
def q_side_main(spark, d):
    """M6 main output."""
    e = ev(spark, d).select(EID, K, V)
    return route.side_output(e, strictly_above(V, THRESHOLD))[0]


@register("side_output_low",
          f"SELECT event_id, user_id, value FROM events WHERE NOT {HIGH_SQL}")
def q_side_low(spark, d):
    """M6 side output."""
    e = ev(spark, d).select(EID, K, V)
    return route.side_output(e, strictly_above(V, THRESHOLD))[1]


@register("labelled_sink", f"""
SELECT 'high' AS stream, event_id, user_id, value FROM events WHERE {HIGH_SQL}
UNION ALL SELECT 'low', event_id, user_id, value FROM events WHERE NOT {HIGH_SQL}
UNION ALL SELECT 'all', event_id, user_id, value FROM events""")
def q_labelled_sink(spark, d):
    """print("high") / print("low") / print("all") into one labelled table."""
    t = _tagged(spark, d)
    cols = [EID, K, V]
    return route.union_all(
        text.labelled(route.select_tags(t, "high").select(*cols), "high"),
        text.labelled(route.select_tags(t, "low").select(*cols), "low"),
        text.labelled(route.select_tags(t, "high", "low").select(*cols), "all"))


# ---------------------------------------------------------------- partitioning
@register("part_shuffle", "SELECT event_id, user_id, value FROM events")
def q_part_shuffle(spark, d):
    """Same bag of rows after a random redistribution."""
    return partition.shuffle(ev(spark, d).select(EID, K, V), parts(spark), seed=7)


@register("part_key", "SELECT DISTINCT user_id, 1::bigint AS n_partitions FROM events")
def q_part_key(spark, d):
    """D2 invariant: every key lands in exactly one partition."""
    p = partition.with_partition_id(partition.by_key(ev(spark, d).select(K), parts(spark), K))
    return p.groupBy(K).agg(F.countDistinct("part").cast("bigint").alias("n_partitions"))


@register("part_global", """
SELECT 1::bigint AS n_partitions, count(*) AS n_rows
FROM (SELECT DISTINCT date_trunc('day', ts), event_type FROM events)""")
def q_part_global(spark, d):
    """D3 invariant: one partition holds everything. ``global()`` funnels all
    rows through one task, so it is applied to a bounded report (daily counts
    per event type), never to the raw table."""
    daily = ev(spark, d).groupBy(F.date_trunc("day", TS).alias("day"), "event_type").count()
    p = partition.with_partition_id(partition.to_global(daily))
    return p.agg(F.countDistinct("part").cast("bigint").alias("n_partitions"),
                 F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- rolling / keyed state
RUN = "PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@register("rolling_max", f"""
SELECT event_id, user_id, min(ts) OVER (PARTITION BY user_id) AS ts,
       max(value) OVER ({RUN}) AS value FROM events""")
def q_rolling_max(spark, d):
    """Keyed.max(value) -- ts stays that of the key's first record."""
    return rolling.rolling_max(ev(spark, d), K, TS, V, tiebreak=[EID], bucket=SCAN_BUCKET,
                               mode="max", keep=[EID])


@register("rolling_max_by", f"""
SELECT event_id, user_id, make_timestamp(-m.n) AS ts, m.v AS value FROM (
  SELECT event_id, user_id,
         max({{'v': value, 'n': -epoch_us(ts), 'e': -event_id}}) OVER ({RUN}) AS m
  FROM events)""")
def q_rolling_max_by(spark, d):
    """R2: keyed.maxBy(value) -- the record of the maximum, first one on ties."""
    return rolling.rolling_max(ev(spark, d), K, TS, V, tiebreak=[EID], bucket=SCAN_BUCKET,
                               mode="max_by", keep=[EID])


@register("rolling_reduce", f"""
SELECT event_id, user_id, ts, max(value) OVER ({RUN}) AS value FROM events""")
def q_rolling_reduce(spark, d):
    """reduce(acc, new) = (id, new.ts, max(acc.value, new.value))."""
    return rolling.rolling_max(ev(spark, d), K, TS, V, tiebreak=[EID], bucket=SCAN_BUCKET,
                               mode="reduce", keep=[EID])


@register("running_count_keyed", f"""
SELECT event_id, user_id, count(*) OVER ({RUN}) AS cnt FROM events""")
def q_running_count_keyed(spark, d):
    """K3 (initial 0: the n-th row of a key emits n)."""
    return rolling.running_count(ev(spark, d), K, TS, tiebreak=[EID], bucket=SCAN_BUCKET,
                                 keep=[EID])


@register("running_count_global", """
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS cnt FROM events""")
def q_running_count_global(spark, d):
    """K1: operator-state count over the whole stream in event-time order."""
    return rolling.running_count_global(ev(spark, d).select(EID, TS), [TS, EID], keep=[EID])


@register("running_history", f"""
SELECT event_id, user_id, (count(*) OVER ({RUN})) - 1 AS n_before, event_id::varchar AS item,
       coalesce(array_to_string(list(event_id::varchar) OVER (
           PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ','), '') AS history
FROM events""")
def q_running_history(spark, d):
    """K4: list state read before append; every row's whole list, and the item it
    appends."""
    e = ev(spark, d).withColumn("item", F.col(EID).cast("string"))
    h = rolling.running_history(e, K, TS, "item", depth=None, tiebreak=[EID], bucket=SCAN_BUCKET,
                                keep=[EID, "item"])
    return h.select(EID, K, "n_before", "item", F.array_join("history", ",").alias("history"))


# ---------------------------------------------------------------- user functions
class Spread(aggregate.Aggregate):
    """Rows, mean, smallest and largest value, and the event type seen most (of ties
    the first by name)."""

    output = "n long, mean double, low double, high double, most string"

    def create(self):
        return 0, 0, float("inf"), float("-inf"), {}

    def add(self, acc, row):
        return self.merge(acc, (1, round(row.value * 100), row.value, row.value, {row.event_type: 1}))

    def merge(self, a, b):
        types = dict(a[4])
        for t, n in b[4].items():
            types[t] = types.get(t, 0) + n
        return a[0] + b[0], a[1] + b[1], min(a[2], b[2]), max(a[3], b[3]), types

    def result(self, acc):
        return acc[0], acc[1] / acc[0] / 100, acc[2], acc[3], min(acc[4], key=lambda t: (-acc[4][t], t))


@register("user_aggregate", f"""
WITH e AS (SELECT *, time_bucket(INTERVAL '{TUMBLE}', ts) AS window_start FROM events),
t AS (SELECT user_id, window_start, event_type, count(*) AS k FROM e GROUP BY ALL),
m AS (SELECT user_id, window_start, arg_min(event_type, (-k, event_type)) AS most FROM t GROUP BY ALL)
SELECT user_id, window_start, window_start + INTERVAL '{TUMBLE}' AS window_end, count(*) AS n,
       sum(round(value * 100)::BIGINT)::BIGINT / count(*) / 100 AS mean, min(value) AS low, max(value) AS high, any_value(most) AS most
FROM e JOIN m USING (user_id, window_start) GROUP BY user_id, window_start""")
def q_user_aggregate(spark, d):
    """U4: a user aggregate function (create, add, merge, result) per window."""
    return aggregate.window_aggregate(ev(spark, d).select(K, TS, V, "event_type"), K, TS, TUMBLE, Spread())


def collatz(event_id, event_type):
    """Odd numbers on an event id's way to 1, none for views: a loop whose length
    only running it tells."""
    n, step = int(event_id), 0
    while event_type != "view" and n > 1:
        if n % 2:
            yield step, n
        n, step = (3 * n + 1 if n % 2 else n // 2), step + 1


@register("user_flat_map", """
WITH RECURSIVE c AS (SELECT event_id, event_id AS n, 0::BIGINT AS step FROM events WHERE event_type <> 'view' AND event_id > 1
                     UNION ALL SELECT event_id, CASE WHEN n % 2 = 1 THEN 3 * n + 1 ELSE n // 2 END, step + 1 FROM c WHERE n > 2 OR n % 2 = 1 AND n > 1)
SELECT event_id, step, n FROM c WHERE n % 2 = 1 AND n > 1""")
def q_user_flat_map(spark, d):
    """A user function that gives none, one or many rows."""
    return aggregate.flat_map(ev(spark, d), collatz, "step long, n long", EID, "event_type", keep=[EID])


class Jump(aggregate.KeyedFlatMap):
    """The reference's keyed flatMap: both values when they differ by ``by`` or more."""

    output = "event_id long, last_value double, value double"

    def __init__(self, by: float):
        self.by = by

    def apply(self, row, state):
        hit = state is not None and abs(row.value - state) >= self.by
        return ([(int(row.event_id), state, row.value)] if hit else []), row.value


@register("keyed_flat_map", f"""
SELECT event_id, 'user_' || user_id AS user, last_value, value FROM (
  SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_value FROM events)
WHERE abs(value - last_value) >= {THRESHOLD}""")
def q_keyed_flat_map(spark, d):
    """A user flatMap with keyed state, one key spread over several ranges."""
    e = ev(spark, d).select(F.concat(F.lit("user_"), F.col(K).cast("string")).alias("user"), TS, EID, V)
    return aggregate.keyed_flat_map(e, "user", TS, Jump(THRESHOLD), tiebreak=EID)


@register("attribute_map", """
SELECT user_id, event_type, value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def q_attribute_map(spark, d):
    """K6: per-key map state, latest value per attribute (event_type)."""
    return rolling.attribute_map(ev(spark, d), K, "event_type", V, TS, tiebreak=[EID])


@register("attribute_map_remove", f"""
SELECT user_id, event_type, value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND NOT (NOT isnan(value) AND value > {THRESHOLD})""")
def q_attribute_map_remove(spark, d):
    """K6 with removal: a value above the threshold removes its attribute, a later
    one puts it back."""
    return rolling.attribute_map(ev(spark, d), K, "event_type", V, TS, tiebreak=[EID],
                                 delete_when=F.coalesce(strictly_above(V, THRESHOLD), F.lit(False)))


# ---------------------------------------------------------------- alarms and timers
@register("jump_alarm", f"""
SELECT event_id, user_id, last_value, value FROM (
  SELECT event_id, user_id, value,
         lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_value
  FROM events)
WHERE last_value IS NOT NULL AND NOT isnan(value) AND NOT isnan(last_value)
  AND abs(value - last_value) >= {THRESHOLD}""")
def q_jump_alarm(spark, d):
    """K5."""
    return alarms.jump_alarm(ev(spark, d), K, TS, V, THRESHOLD, tiebreak=[EID],
                             bucket=SCAN_BUCKET, keep=[EID])


@register("delayed_timer", f"""
SELECT DISTINCT user_id, ts + INTERVAL '{TIMER_DELAY}' AS fire_ts FROM events""")
def q_delayed_timer(spark, d):
    """A1."""
    return alarms.delayed_timer(ev(spark, d), K, TS, TIMER_DELAY)


RISE_US = 86_400_000_000


@register("rise_alarm", f"""
WITH RECURSIVE r AS (
  SELECT user_id, epoch_us(ts) AS t, value AS v,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
s(user_id, rn, last, timer, fired) AS (
  SELECT DISTINCT user_id, 0::bigint, NULL::double, NULL::bigint, NULL::bigint FROM r
  UNION ALL
  SELECT s.user_id, r.rn, r.v,
         CASE WHEN (s.last IS NULL OR r.v > s.last)
                   AND (s.timer IS NULL OR r.t > s.timer) THEN r.t + {RISE_US}
              WHEN s.timer IS NULL OR r.t > s.timer THEN NULL
              WHEN r.v < s.last THEN NULL
              ELSE s.timer END,
         CASE WHEN s.timer IS NOT NULL AND r.t > s.timer THEN s.timer END
  FROM s JOIN r ON r.user_id = s.user_id AND r.rn = s.rn + 1),
fin AS (
  SELECT user_id, timer FROM (
    SELECT user_id, timer, row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) AS k
    FROM s) WHERE k = 1 AND timer IS NOT NULL)
SELECT user_id, alarm_ts,
       '{ALERT_SENSOR}' || user_id::varchar || '{ALERT_RISING}{RISE_US // 1_000_000}{ALERT_ROSE}'
         AS message
FROM (SELECT user_id, make_timestamp(fired) AS alarm_ts FROM s WHERE fired IS NOT NULL
      UNION ALL
      SELECT user_id, make_timestamp(timer) AS alarm_ts FROM fin)""")
def q_rise_alarm(spark, d):
    """A2: value did not fall for RISE after a rise (+ P11 alert text)."""
    a = alarms.rise_alarm(ev(spark, d), K, TS, V, RISE, tiebreak=[EID], bucket=SCAN_BUCKET)
    return a.withColumn("message", alert_text(K, RISE_US // 1_000_000))


# ---------------------------------------------------------------- windows
@register("tumbling_count", f"""
SELECT user_id, time_bucket(INTERVAL '{TUMBLE}', ts) AS window_start,
       time_bucket(INTERVAL '{TUMBLE}', ts) + INTERVAL '{TUMBLE}' AS window_end,
       count(*) AS cnt
FROM events GROUP BY ALL""")
def q_tumbling_count(spark, d):
    """W1 (+W6 incremental aggregate)."""
    return windows.tumbling_count(ev(spark, d), K, TS, TUMBLE)


@register("sliding_count", f"""
SELECT user_id, ws AS window_start, ws + INTERVAL '{TUMBLE}' AS window_end, count(*) AS cnt
FROM (SELECT user_id, ts,
             time_bucket(INTERVAL '{SLIDE}', ts) - k * INTERVAL '{SLIDE}' AS ws
      FROM events, range(0, 4) AS r(k))
WHERE ws + INTERVAL '{TUMBLE}' > ts
GROUP BY ALL""")
def q_sliding_count(spark, d):
    """W2."""
    return windows.sliding_count(ev(spark, d), K, TS, TUMBLE, SLIDE)


SESSIONS_SQL = f"""
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '{GAP}' AS session_end,
       count(*) AS cnt
FROM (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
      FROM (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                               >= ts - INTERVAL '{GAP}' THEN 0 ELSE 1 END AS nw
            FROM events))
GROUP BY user_id, sid"""


@register("session_count", SESSIONS_SQL)
def q_session_count(spark, d):
    """W3."""
    return windows.session_count(ev(spark, d), K, TS, GAP)


@register("window_sum_min_max", f"""
SELECT user_id, time_bucket(INTERVAL '{TUMBLE}', ts) AS window_start,
       time_bucket(INTERVAL '{TUMBLE}', ts) + INTERVAL '{TUMBLE}' AS window_end,
       count(*) AS cnt, round(sum(value), 2) AS sum_value,
       min(value) AS min_value, max(value) AS max_value
FROM events GROUP BY ALL""")
def q_window_sum_min_max(spark, d):
    """W7."""
    return windows.window_sum_min_max(ev(spark, d), K, TS, TUMBLE, V)


@register("window_median", f"""
SELECT user_id, time_bucket(INTERVAL '{TUMBLE}', ts) AS window_start,
       time_bucket(INTERVAL '{TUMBLE}', ts) + INTERVAL '{TUMBLE}' AS window_end,
       round(median(value), 3) AS median_value
FROM events GROUP BY ALL""")
def q_window_median(spark, d):
    """W8."""
    return windows.window_median(ev(spark, d), K, TS, TUMBLE, V)


@register("window_sorted", f"""
SELECT user_id, time_bucket(INTERVAL '{TUMBLE}', ts) AS window_start,
       time_bucket(INTERVAL '{TUMBLE}', ts) + INTERVAL '{TUMBLE}' AS window_end,
       event_id, value,
       row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL '{TUMBLE}', ts)
                          ORDER BY value, ts, event_id) AS rank
FROM events""")
def q_window_sorted(spark, d):
    """W9."""
    return windows.window_sorted(ev(spark, d), K, TS, TUMBLE, V, tiebreak=[EID], keep=[EID],
                                 value_bucket=VALUE_BUCKET)


# ---------------------------------------------------------------- joins
def _sides(spark, d):
    e = ev(spark, d).select(EID, K, TS, "event_type",
                            F.col(V).cast("decimal(10,2)").cast("string").alias("v"))
    return (e.filter(F.col("event_type") == LEFT_TYPE),
            e.filter(F.col("event_type") == RIGHT_TYPE))


SIDES_SQL = f"""
l AS (SELECT event_id, user_id, ts, value::decimal(10,2)::varchar AS v FROM events
      WHERE event_type = '{LEFT_TYPE}'),
r AS (SELECT event_id, user_id, ts, value::decimal(10,2)::varchar AS v FROM events
      WHERE event_type = '{RIGHT_TYPE}')"""


@register("tumbling_window_join", f"""
WITH {SIDES_SQL}
SELECT l.user_id, time_bucket(INTERVAL '{TUMBLE}', l.ts) AS window_start,
       l.ts AS l_ts, r.ts AS r_ts, l.event_id AS l_event_id, r.event_id AS r_event_id,
       l.v || ' ' || r.v AS joined
FROM l JOIN r ON l.user_id = r.user_id
 AND time_bucket(INTERVAL '{TUMBLE}', l.ts) = time_bucket(INTERVAL '{TUMBLE}', r.ts)""")
def q_tumbling_window_join(spark, d):
    """J1."""
    l, r = _sides(spark, d)
    return joins.tumbling_window_join(l, r, K, TS, TUMBLE, [EID, "v"], [EID, "v"],
                                      text=("v", "v")).drop("l_v", "r_v")


@register("interval_join", f"""
WITH {SIDES_SQL}
SELECT l.user_id, l.ts AS l_ts, r.ts AS r_ts, l.event_id AS l_event_id,
       r.event_id AS r_event_id, l.v || ' ' || r.v AS joined
FROM l JOIN r ON l.user_id = r.user_id
 AND r.ts BETWEEN l.ts - INTERVAL '3 hours' AND l.ts + INTERVAL '3 hours'""")
def q_interval_join(spark, d):
    """J2 (bucketed band join)."""
    l, r = _sides(spark, d)
    return joins.interval_join(l, r, K, TS, LOWER, UPPER, [EID, "v"], [EID, "v"],
                               text=("v", "v")).drop("l_v", "r_v")


def _block_sql(side_filter: str) -> str:
    return (f"coalesce(string_agg(user_id::varchar || '=>' || v || chr(10), '' "
            f"ORDER BY ts, event_id) FILTER (WHERE {side_filter}), '')")


@register("cogroup_session", f"""
WITH {SIDES_SQL},
u AS (SELECT *, 1 AS side FROM l UNION ALL SELECT *, 2 AS side FROM r),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
      FROM (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                               >= ts - INTERVAL '{GAP}' THEN 0 ELSE 1 END AS nw FROM u))
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '{GAP}' AS session_end,
       count(*) FILTER (WHERE side = 1) AS n_left, count(*) FILTER (WHERE side = 2) AS n_right,
       'input stream 1: ' || chr(10) || {_block_sql('side = 1')}
       || 'input stream 2: ' || chr(10) || {_block_sql('side = 2')} AS text
FROM g GROUP BY user_id, sid""")
def q_cogroup_session(spark, d):
    """J3."""
    l, r = _sides(spark, d)
    return joins.cogroup_session(l, r, K, TS, GAP, "v", tiebreak=[EID])


@register("tumbling_join_per_arrival", f"""
WITH {SIDES_SQL},
p AS (SELECT l.user_id, time_bucket(INTERVAL '{TUMBLE}', l.ts) AS w,
             l.event_id AS l_event_id, r.event_id AS r_event_id,
             greatest({{'t': l.ts, 'i': l.event_id}}, {{'t': r.ts, 'i': r.event_id}}) AS done
      FROM l JOIN r ON l.user_id = r.user_id
       AND time_bucket(INTERVAL '{TUMBLE}', l.ts) = time_bucket(INTERVAL '{TUMBLE}', r.ts)),
a AS (SELECT user_id, time_bucket(INTERVAL '{TUMBLE}', ts) AS w, event_id AS arrival_id,
             {{'t': ts, 'i': event_id}} AS ao FROM (SELECT * FROM l UNION ALL SELECT * FROM r))
SELECT p.user_id, p.w AS window_start, a.arrival_id, p.l_event_id, p.r_event_id
FROM p JOIN a ON p.user_id = a.user_id AND p.w = a.w AND a.ao >= p.done""")
def q_tumbling_join_per_arrival(spark, d):
    """Count trigger 1 on the tumbling window join."""
    l, r = _sides(spark, d)
    return joins.tumbling_join_per_arrival(l, r, K, TS, TUMBLE, EID)


@register("cogroup_per_arrival", f"""
WITH {SIDES_SQL},
u AS (SELECT *, 1 AS side FROM l UNION ALL SELECT *, 2 AS side FROM r),
g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_id
      FROM (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                               >= ts - INTERVAL '{GAP}' THEN 0 ELSE 1 END AS nw FROM u))
SELECT user_id, session_id, event_id AS arrival_id, side::bigint AS side,
       'input stream 1: ' || chr(10) || coalesce(string_agg(
            CASE WHEN side = 1 THEN user_id::varchar || '=>' || v || chr(10) END, '')
            OVER w, '')
       || 'input stream 2: ' || chr(10) || coalesce(string_agg(
            CASE WHEN side = 2 THEN user_id::varchar || '=>' || v || chr(10) END, '')
            OVER w, '') AS text
FROM g
WINDOW w AS (PARTITION BY user_id, session_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_cogroup_per_arrival(spark, d):
    """Count trigger 1 on the session cogroup."""
    l, r = _sides(spark, d)
    return joins.cogroup_per_arrival(l, r, K, TS, GAP, "v", EID, bucket=SCAN_BUCKET)


# ---------------------------------------------------------------- event time
def _arrival(spark, d):
    e = ev(spark, d).select(EID, K, TS)
    return e.withColumn("arrival", F.expr(ARRIVAL_SQL))


ARR_RUN = "PARTITION BY user_id ORDER BY {a}, event_id".format(a=ARRIVAL_SQL)


@register("monotone_ts", f"""
SELECT event_id, user_id, ts,
       max(ts) OVER ({ARR_RUN} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS monotone_ts
FROM events""")
def q_monotone_ts(spark, d):
    """E3 with a made-up arrival order (event time would hide it)."""
    a = _arrival(spark, d)
    return eventtime.monotone_ts(a, K, TS, ["arrival", EID],
                                 bucket_col=F.floor(F.col("arrival") / 1000)
                                 ).select(EID, K, TS, "monotone_ts")


@register("late_events", f"""
SELECT event_id, user_id, ts, watermark FROM (
  SELECT event_id, user_id, ts,
         max(ts) OVER ({ARR_RUN} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - INTERVAL '{LATE_DELAY}' AS watermark
  FROM events)
WHERE watermark IS NOT NULL AND ts <= watermark""")
def q_late_events(spark, d):
    """Rows at or below the per-key watermark of their arrival."""
    a = _arrival(spark, d)
    return eventtime.late_events(a, K, TS, ["arrival", EID], LATE_DELAY,
                                 bucket_col=F.floor(F.col("arrival") / 1000)
                                 ).select(EID, K, TS, "watermark")


@register("ingest_stamp")
def q_ingest_stamp(spark, d):
    """E5 (rows-only: the stamp is wall-clock time)."""
    return eventtime.ingest_stamp(ev(spark, d).select(EID, K, TS))



# ---------------------------------------------------------------- user functions
def _reduce_max(acc, new):
    """The reference's ReduceFunction: newest timestamp, largest value."""
    return (new[0], max(acc[1], new[1]))


@register("rolling_reduce_udf", f"""
SELECT event_id, user_id, ts, max(value) OVER ({RUN}) AS value FROM events""")
def q_rolling_reduce_udf(spark, d):
    """R3 written as a user reduce function (Python), evaluated by the
    two-level keyed scan."""
    from ..operators.udf import keyed_reduce
    e = ev(spark, d).select(EID, K, TS, V)
    return keyed_reduce(e, K, TS, [TS, V], _reduce_max, tiebreak=[EID], bucket=SCAN_BUCKET,
                        keep=[EID])


def _cogroup_text(left, right):
    """The reference's CoGroupFunction: both sides' items as one text block."""
    def block(title, rows):
        return title + "".join(f"{r.user_id}{COGROUP_ITEM_SEP}{r.v}\n" for r in rows)
    rows = left + right
    yield (rows[0].user_id, min((r.ts for r in rows if r.ts is not None), default=None), len(left), len(right),
           block(COGROUP_HEADER_LEFT, left) + block(COGROUP_HEADER_RIGHT, right))


@register("cogroup_session_udf", """
SELECT user_id, session_start, n_left, n_right, text FROM (""" + ORACLE_SQL["cogroup_session"] + ")")
def q_cogroup_session_udf(spark, d):
    """U8: J3 written as a user CoGroupFunction per (key, session)."""
    from ..operators.udf import cogroup_apply
    l, r = _sides(spark, d)
    return cogroup_apply(l.drop("event_type"), r.drop("event_type"), K, TS, GAP, _cogroup_text,
                         "user_id bigint, session_start timestamp_ntz, n_left bigint, "
                         "n_right bigint, text string", tiebreak=EID, bucket=SCAN_BUCKET)


# Functions of this module run inside Spark tasks: ship them by value so
# executors need no copy of this package on their Python path.
__import__("pyspark").cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])
