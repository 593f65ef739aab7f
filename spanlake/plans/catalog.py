"""Registered queries over the driver's tables, each with its SQL equivalent.

They run the library's operators on the given tables: events stands for a session log (session: user_id % 10, client: user_id,
arrival: ts), orders and lineitem for traces and spans.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.functions import expr
from spanlake.operators import joins, quality, ranges, windows
from spanlake.plans import consumers, curated, export, gold
from spanlake.plans.typed import TRACE_LINE, rule, unpivoted
from spanlake.sources import landing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DAY, HOUR, QUARTER = 86_400_000, 3_600_000, 900_000
#: Facts of the queries: a dimension with two versions, declared members, an allowlist.
CHANGE = "2024-01-15 00:00:00"
KINDS = {"view": "browse", "click": "browse", "error": "fault", "purchase": "deal", "signup": "deal"}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "SHIPPING")
RUN_TYPES = ("view", "click", "error")

#: SQL that the oracles share: events as a session log.
LOG = "SELECT event_id, user_id, user_id % 10 AS session_id, epoch_us(ts) // 1000 AS srv, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
RUNS = f"""log AS ({LOG}), flagged AS (
    SELECT *, event_type IN ('view', 'click', 'error') AS in_run, lead(srv) OVER w AS next_srv, lead(event_type) OVER w AS next_type,
        lag(event_type IN ('view', 'click', 'error')) OVER w AS was FROM log WINDOW w AS (PARTITION BY user_id ORDER BY srv, event_id)
), runs AS (
    SELECT *, sum(CASE WHEN in_run AND NOT coalesce(was, false) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY srv, event_id ROWS UNBOUNDED PRECEDING) AS run_seq FROM flagged
), run_rows AS (SELECT * FROM runs WHERE in_run)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long").alias("k")
    return table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("user_id") % 10).alias("session_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("srv"), "event_type", "value", k)


def run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["user_id"]
    rows = log(spark, sf_dir).withColumn("in_run", F.col("event_type").isin(*RUN_TYPES))
    rows = windows.with_next(rows, "event_type", by, "srv", "next_type", "event_id").withColumn("held_ms", windows.held_time("srv", by, "event_id"))
    return windows.islands_by_flag(rows, "in_run", by, "srv", "run_seq", "event_id")


# windows


@query(f"""WITH log AS ({LOG}), c AS (SELECT *, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY srv ROWS UNBOUNDED PRECEDING) AS INTEGER) AS hellos,
    min(srv) OVER (PARTITION BY session_id, user_id) AS first_srv FROM log)
SELECT event_id, hellos, CAST(dense_rank() OVER (PARTITION BY session_id ORDER BY first_srv) AS INTEGER) AS page_load_seq, hellos = 0 AS precedes_first_hello FROM c""")
def page_load_rank(spark, sf_dir):
    rows = ranges.running_count(log(spark, sf_dir), F.col("event_type") == "signup", ["session_id"], "srv", out="hellos")
    ranked = ranges.rank_by_first_seen(rows, ["session_id"], "user_id", "srv", "page_load_seq")
    return ranked.select("event_id", "hellos", "page_load_seq", (F.col("hellos") == 0).alias("precedes_first_hello"))


GAPS = f"""log AS ({LOG}), o AS (SELECT user_id, srv, lag(srv) OVER w AS prev_srv, event_type, lag(event_type) OVER w AS prev_event_type FROM log WINDOW w AS (PARTITION BY user_id ORDER BY srv)),
gaps AS (SELECT *, (srv - prev_srv) / 1000.0 AS gap_s FROM o WHERE srv - prev_srv > {DAY})"""


def _gaps(spark, sf_dir):
    found = windows.gaps(log(spark, sf_dir).select("user_id", "srv", "event_type"), ["user_id"], "srv", DAY, ["event_type"])
    return found.withColumn("gap_s", expr.seconds(F.col("srv") - F.col("prev_srv")))


@query(f"WITH {GAPS} SELECT user_id, prev_srv, srv, gap_s, prev_event_type, event_type FROM gaps")
def arrival_gaps(spark, sf_dir):
    return _gaps(spark, sf_dir).select("user_id", "prev_srv", "srv", "gap_s", "prev_event_type", "event_type")


@query(f"""WITH {GAPS}, told AS (SELECT *, CASE WHEN prev_event_type = 'error' AND event_type = 'error' AND gap_s BETWEEN 86400 AND 172800 THEN 'hidden tab, browser limited the timer to once a minute'
    WHEN prev_event_type = 'error' OR event_type = 'error' THEN 'tab hidden, machine likely asleep' ELSE 'VISIBLE THROUGHOUT, not explained by throttling' END AS explanation FROM gaps)
SELECT explanation, count(*) AS gaps, CAST(round(min(gap_s)) AS BIGINT) AS shortest_s, CAST(round(max(gap_s)) AS BIGINT) AS longest_s, CAST(round(sum(srv - prev_srv) / 1000) AS BIGINT) AS total_s FROM told GROUP BY explanation""")
def gap_explained(spark, sf_dir):
    why = curated.explanation(F.col("prev_event_type"), F.col("event_type"), F.col("gap_s"), "error", 86_400, 172_800)
    whole = lambda c: F.round(c).cast("long")
    return _gaps(spark, sf_dir).groupBy(why.alias("explanation")).agg(F.count("*").alias("gaps"), whole(F.min("gap_s")).alias("shortest_s"), whole(F.max("gap_s")).alias("longest_s"), whole(F.sum(F.col("srv") - F.col("prev_srv")) / 1000).alias("total_s"))


@query(f"WITH {RUNS} SELECT event_id, user_id, CAST(run_seq AS INTEGER) AS run_seq, coalesce(next_srv - srv, 0) AS held_ms FROM run_rows")
def run_segments(spark, sf_dir):
    return run_rows(spark, sf_dir).select("event_id", "user_id", "run_seq", "held_ms")


@query(f"""WITH {RUNS} SELECT user_id, CAST(run_seq AS INTEGER) AS run_seq, count(*) AS rows_in_run, min(srv) AS started_srv, max(srv) AS ended_srv, arg_min(event_type, srv) AS first_type, arg_max(event_type, srv) AS last_type,
    count(DISTINCT event_type) AS types, max(k) AS k_max, CAST(sum(CASE WHEN event_type <> 'error' THEN coalesce(next_srv - srv, 0) ELSE 0 END) AS BIGINT) AS active_ms, arg_min(value, srv) AS value_first, arg_max(value, srv) AS value_last,
    CASE coalesce(arg_max(coalesce(next_type, '-'), srv), '-') WHEN 'purchase' THEN 'won' WHEN 'signup' THEN 'left to menu' ELSE 'unresolved' END AS outcome
FROM run_rows GROUP BY user_id, run_seq""")
def run_facts(spark, sf_dir):
    srv, after = F.col("srv"), F.max_by("next_type", F.col("srv"))
    outcome = F.when(after == "purchase", "won").when(after == "signup", "left to menu").otherwise("unresolved")
    return run_rows(spark, sf_dir).groupBy("user_id", "run_seq").agg(
        F.count("*").alias("rows_in_run"), F.min(srv).alias("started_srv"), F.max(srv).alias("ended_srv"), expr.first_by(F.col("event_type"), srv).alias("first_type"), expr.last_by(F.col("event_type"), srv).alias("last_type"),
        F.countDistinct("event_type").alias("types"), F.max("k").alias("k_max"), F.sum(F.when(F.col("event_type") != "error", F.col("held_ms")).otherwise(0)).alias("active_ms"),
        expr.first_by(F.col("value"), srv).alias("value_first"), expr.last_by(F.col("value"), srv).alias("value_last"), outcome.alias("outcome"),
    )


@query(f"""WITH {RUNS}, bounds AS (SELECT user_id, run_seq, max(srv) AS ended FROM run_rows GROUP BY ALL)
SELECT b.user_id, CAST(b.run_seq AS INTEGER) AS run_seq, coalesce((SELECT arg_min(l.event_type, l.srv) FROM log l WHERE l.user_id = b.user_id AND l.srv > b.ended), 'nothing') AS after_it FROM bounds b""")
def first_after(spark, sf_dir):
    return run_rows(spark, sf_dir).groupBy("user_id", "run_seq").agg(F.coalesce(F.max_by("next_type", "srv"), F.lit("nothing")).alias("after_it"))


@query(f"""WITH log AS ({LOG}), p AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY srv) AS before FROM log WHERE event_type <> 'signup'),
n AS (SELECT *, sum(CASE WHEN before IS DISTINCT FROM event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY srv ROWS UNBOUNDED PRECEDING) AS block FROM p)
SELECT user_id, CAST(block AS INTEGER) AS block, max(event_type) AS event_type, count(*) AS n, max(k) - min(k) AS k_during FROM n GROUP BY user_id, block""")
def value_islands(spark, sf_dir):
    blocks = windows.islands_by_value(log(spark, sf_dir).where("event_type <> 'signup'"), "event_type", ["user_id"], "srv", "block")
    return blocks.groupBy("user_id", "block").agg(F.max("event_type").alias("event_type"), F.count("*").alias("n"), (F.max("k") - F.min("k")).alias("k_during"))


def _groups_sql(gap: int, where: str = "") -> str:
    return f"""WITH log AS ({LOG} {where}), g AS (SELECT *, CASE WHEN srv - lag(srv) OVER w > {gap} OR lag(srv) OVER w IS NULL THEN 1 ELSE 0 END AS opens FROM log WINDOW w AS (PARTITION BY user_id ORDER BY srv)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY srv ROWS UNBOUNDED PRECEDING) AS group_id FROM g)
SELECT user_id, CAST(group_id AS INTEGER) AS group_id, count(*) AS n, max(srv) - min(srv) AS span_ms, min(srv) AS started FROM n GROUP BY user_id, group_id"""


def _groups(rows: DataFrame, gap: int) -> DataFrame:
    grouped = windows.gap_groups(rows, ["user_id"], "srv", gap, "group_id")
    return grouped.groupBy("user_id", "group_id").agg(F.count("*").alias("n"), (F.max("srv") - F.min("srv")).alias("span_ms"), F.min("srv").alias("started"))


@query(_groups_sql(HOUR))
def gap_groups_1h(spark, sf_dir):
    return _groups(log(spark, sf_dir), HOUR)


@query(_groups_sql(DAY, "WHERE event_type = 'purchase'"))
def gap_groups_1d(spark, sf_dir):
    return _groups(log(spark, sf_dir).where("event_type = 'purchase'"), DAY)


@query(f"""WITH log AS ({LOG} WHERE event_type IN ('view', 'click')), o AS (SELECT *, lag(event_type) OVER w AS before, lag(srv) OVER w AS was_at FROM log WINDOW w AS (PARTITION BY user_id ORDER BY srv)),
n AS (SELECT *, sum(CASE WHEN before = event_type AND srv - was_at <= {DAY} THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY srv ROWS UNBOUNDED PRECEDING) AS band FROM o)
SELECT user_id, CAST(band AS INTEGER) AS band, max(event_type) AS phase, min(srv) AS started, max(srv) AS ended, count(*) AS pulses FROM n GROUP BY user_id, band""")
def phase_bands(spark, sf_dir):
    phase = F.when(F.col("event_type").isin("view", "click"), F.col("event_type"))
    return consumers.phase_bands(log(spark, sf_dir), phase, ["user_id"], "srv", DAY)


# joins over time


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as a dimension with history, derived from the table: each type changes its class at CHANGE."""
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("member")).distinct()
    label = F.lit(None).cast("string")
    for k, v in KINDS.items():
        label = F.when(F.col("member") == k, v).otherwise(label)
    old = types.select("member", F.lit("any").alias("label"), F.lit("2000-01-01 00:00:00").cast("timestamp").alias("valid_from"), F.lit(CHANGE).cast("timestamp").alias("valid_to"))
    new = types.select("member", label.alias("label"), F.lit(CHANGE).cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    return windows.version_sequence(old.unionByName(new), ["member"])


VERSIONS = f"""versions AS (SELECT member, label, valid_from, valid_to, CAST(row_number() OVER (PARTITION BY member ORDER BY valid_from) AS INTEGER) AS version_seq, valid_to IS NULL AS is_current FROM (
    SELECT DISTINCT event_type AS member, 'any' AS label, TIMESTAMP '2000-01-01' AS valid_from, TIMESTAMP '{CHANGE}' AS valid_to FROM events
    UNION ALL SELECT DISTINCT event_type, CASE event_type WHEN 'view' THEN 'browse' WHEN 'click' THEN 'browse' WHEN 'error' THEN 'fault' ELSE 'deal' END, TIMESTAMP '{CHANGE}', NULL FROM events))"""


@query(f"WITH {VERSIONS} SELECT e.event_id, v.label, v.version_seq FROM events e JOIN versions v ON v.member = e.event_type AND e.ts >= v.valid_from AND (v.valid_to IS NULL OR e.ts < v.valid_to)")
def as_of_dim(spark, sf_dir):
    facts, dim = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts")), versions(spark, sf_dir)
    return joins.as_of(facts, dim, facts["event_type"] == dim["member"], facts["ts"]).select("event_id", "label", "version_seq")


@query(f"WITH {VERSIONS} SELECT member, label, version_seq, is_current, CASE WHEN is_current THEN 'in force' ELSE 'superseded' END AS status FROM versions")
def dim_history(spark, sf_dir):
    return gold.history(versions(spark, sf_dir)).select("member", "label", "version_seq", "is_current", "status")


@query(f"""WITH {RUNS}, b AS (SELECT user_id, run_seq, session_id, min(srv) AS s0, max(srv) AS s1 FROM run_rows WHERE event_type = 'error' GROUP BY ALL)
SELECT b.user_id AS run_user, CAST(b.run_seq AS INTEGER) AS run_seq, count(*) AS n, count(DISTINCT l.user_id) AS users FROM log l JOIN b ON l.session_id = b.session_id AND l.srv BETWEEN b.s0 - {QUARTER} AND b.s1 + {QUARTER} GROUP BY ALL""")
def interval_events(spark, sf_dir):
    bounds = run_rows(spark, sf_dir).where("event_type = 'error'").groupBy(F.col("user_id").alias("run_user"), "run_seq", "session_id").agg(F.min("srv").alias("s0"), F.max("srv").alias("s1"))
    found = joins.counted_within(log(spark, sf_dir), bounds, ["session_id"], "srv", "user_id", "s0", "s1", QUARTER)
    return found.select("run_user", "run_seq", "n", F.col("members").alias("users"))  # a user has one session


# contract


def _faults() -> Column:
    rule = lambda bad, relation, reason, detail: F.when(bad, F.struct(F.lit(relation).alias("relation"), F.lit(reason).alias("reason"), detail.alias("detail")))
    return F.filter(
        F.array(
            rule(F.col("hellos") == 0, "landed", "orphan_record_no_hello", F.lit("record precedes the first hello")),
            rule(~F.col("event_type").isin("view", "click", "purchase", "signup"), "pulses", "type_not_in_contract", F.concat(F.lit("type="), "event_type")),
            rule(F.col("k") > 90, "beats", "k_over_cap", F.concat(F.lit("k="), F.col("k").cast("string"))),
        ),
        lambda r: r.isNotNull(),
    )


HELLOS = f"log AS ({LOG}), landed AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY srv ROWS UNBOUNDED PRECEDING) AS hellos FROM log)"


def _counted(spark, sf_dir):
    return ranges.running_count(log(spark, sf_dir), F.col("event_type") == "signup", ["session_id"], "srv", out="hellos")


@query(f"""WITH {HELLOS} SELECT event_id, 'landed' AS relation, 'orphan_record_no_hello' AS reason, 'record precedes the first hello' AS detail FROM landed WHERE hellos = 0
UNION ALL SELECT event_id, 'pulses', 'type_not_in_contract', 'type=' || event_type FROM landed WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup')
UNION ALL SELECT event_id, 'beats', 'k_over_cap', 'k=' || k FROM landed WHERE k > 90""")
def contract_quarantine(spark, sf_dir):
    return _counted(spark, sf_dir).select("event_id", F.inline(_faults()))


@query(f"""WITH {HELLOS} SELECT count(*) AS landed_records, count(*) FILTER (hellos > 0) AS clean_records, count(*) FILTER (hellos = 0) AS quarantined_records,
    count(*) FILTER (hellos = 0) + count(*) FILTER (event_type = 'error') + count(*) FILTER (k > 90) AS quarantine_rows_all, true AS reconciles FROM landed""")
def reconciliation(spark, sf_dir):
    bad = F.col("hellos") == 0
    out = _counted(spark, sf_dir).agg(F.count("*").alias("landed_records"), F.count_if(~bad).alias("clean_records"), F.count_if(bad).alias("quarantined_records"), F.sum(F.size(_faults())).alias("quarantine_rows_all"))
    return out.withColumn("reconciles", F.col("clean_records") + F.col("quarantined_records") == F.col("landed_records"))


@query("SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey HAVING count(*) > 10")
def lines_over_cap(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines")).where("lines > 10")


@query(f"""WITH docs AS (SELECT unnest({list(SEGMENTS)!r}) AS m), used AS (SELECT DISTINCT c_mktsegment AS m FROM customer WHERE c_mktsegment IS NOT NULL)
SELECT 'segment' AS dimension, (SELECT count(*) FROM docs) AS documented, (SELECT count(*) FROM used) AS exercised, (SELECT string_agg(m, ', ' ORDER BY m) FROM docs WHERE m NOT IN (SELECT m FROM used)) AS never_seen""")
def dimension_coverage(spark, sf_dir):
    docs = spark.createDataFrame([(s,) for s in SEGMENTS], "segment string")
    return consumers.listed(curated.coverage("segment", docs, "segment", table(spark, sf_dir, "customer"), "c_mktsegment"), "never_seen")


@query("SELECT * FROM (SELECT event_type AS member, 'declared only' AS side FROM (SELECT unnest(['view', 'click', 'purchase', 'signup', 'refund']) AS event_type) EXCEPT SELECT event_type, 'declared only' FROM events) UNION ALL (SELECT event_type, 'data only' FROM events EXCEPT SELECT unnest(['view', 'click', 'purchase', 'signup', 'refund']), 'data only')")
def contract_drift(spark, sf_dir):
    declared = spark.createDataFrame([(x,) for x in ("view", "click", "purchase", "signup", "refund")], "member string")
    found = quality.drift(declared, table(spark, sf_dir, "events").select(F.col("event_type").alias("member")), ["member"])
    return found.select("member", F.when(F.col("only_in") == "left", "declared only").otherwise("data only").alias("side"))


# aggregates


@query("""SELECT l_returnflag, count(*) AS samples, round(quantile_cont(l_extendedprice, 0.5), 5) AS p50, round(quantile_cont(l_extendedprice, 0.95), 5) AS p95, max(l_extendedprice) AS largest FROM lineitem GROUP BY l_returnflag""")
def latency_percentiles(spark, sf_dir):
    return curated.percentiles(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice", digits=5)


@query("""SELECT o_orderstatus, count(*) AS records, min(d) AS skew_min, round(avg(d), 3) AS skew_mean, max(d) AS skew_max, round(stddev_pop(d), 3) AS skew_stddev
FROM (SELECT o_orderstatus, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY o_orderstatus""")
def skew_stats(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    days = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("d", F.datediff("l_shipdate", "o_orderdate"))
    return days.groupBy("o_orderstatus").agg(F.count("*").alias("records"), F.min("d").cast("long").alias("skew_min"), F.round(F.avg("d"), 3).alias("skew_mean"), F.max("d").cast("long").alias("skew_max"), F.round(F.stddev_pop("d"), 3).alias("skew_stddev"))


@query("""SELECT CAST(sum(n) AS BIGINT) AS events_received, CAST(sum(e) AS BIGINT) AS ids_expected, CAST(sum(e) - sum(d) AS BIGINT) AS events_lost_by_id_gap
FROM (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linenumber) AS d, max(l_linenumber) - min(l_linenumber) + 1 AS e FROM lineitem GROUP BY l_orderkey)""")
def loss_accounting(spark, sf_dir):
    return curated.id_gaps(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query(f"""WITH log AS ({LOG}) SELECT user_id, max(k) AS k_max, min(value) AS value_min, arg_min(value, srv) AS value_first, arg_max(value, srv) AS value_last, arg_max(event_type, srv) AS final_type, count(DISTINCT event_type) AS types,
    CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 AND count(*) FILTER (event_type = 'error') = 0 THEN 'clean' WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'clean bye, with incidents' ELSE 'abnormal end, no bye' END AS outcome FROM log GROUP BY user_id""")
def session_summary(spark, sf_dir):
    srv, bought, failed = F.col("srv"), F.count_if(F.col("event_type") == "purchase") > 0, F.count_if(F.col("event_type") == "error") > 0
    outcome = F.when(bought & ~failed, "clean").when(bought, "clean bye, with incidents").otherwise("abnormal end, no bye")
    return log(spark, sf_dir).groupBy("user_id").agg(F.max("k").alias("k_max"), F.min("value").alias("value_min"), expr.first_by(F.col("value"), srv).alias("value_first"), expr.last_by(F.col("value"), srv).alias("value_last"), expr.last_by(F.col("event_type"), srv).alias("final_type"), F.countDistinct("event_type").alias("types"), outcome.alias("outcome"))


@query(f"""WITH log AS ({LOG}), i AS (SELECT user_id, srv, 'error' AS event, 'k=' || k AS detail FROM log WHERE event_type = 'error' UNION ALL SELECT user_id, srv, 'deal', 'k=' || k FROM log WHERE event_type = 'purchase')
SELECT user_id, srv, event, detail, (srv - lag(srv) OVER (PARTITION BY user_id ORDER BY srv)) / 1000.0 AS s_since_previous FROM i""")
def incident_timeline(spark, sf_dir):
    rows = log(spark, sf_dir).where(F.col("event_type").isin("error", "purchase")).select("user_id", "srv", F.when(F.col("event_type") == "error", "error").otherwise("deal").alias("event"), F.concat(F.lit("k="), F.col("k").cast("string")).alias("detail"))
    return rows.withColumn("s_since_previous", curated.since_previous(rows, ["user_id"], "srv"))


@query(f"""WITH log AS ({LOG}) SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(*) FILTER (event_type = 'error') AS errors FROM log GROUP BY user_id""")
def session_context(spark, sf_dir):
    out = log(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return consumers.listed(out, "types", ",")


@query("""SELECT coalesce(c_mktsegment, 'every segment') AS dimension, CAST(count(DISTINCT c_nationkey) AS INTEGER) AS members, CAST(count(DISTINCT c_nationkey) FILTER (c_acctbal > 0) AS INTEGER) AS members_in_force, CAST(count(*) AS INTEGER) AS versions,
    CAST(count(*) FILTER (NOT c_acctbal > 0) AS INTEGER) AS superseded FROM customer GROUP BY GROUPING SETS ((c_mktsegment), ())""")
def governance_rollup(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("dimension"), F.col("c_nationkey").alias("member_key"), F.lit(1).alias("version_seq"), F.col("c_acctbal").alias("valid_from"), (F.col("c_acctbal") > 0).alias("is_current"))
    out = gold.governance(rows).select("dimension", "members", "members_in_force", "versions", "superseded")
    return out.withColumn("dimension", F.when(F.col("dimension") == "every dimension", "every segment").otherwise(F.col("dimension")))


SPEND = "spend AS (SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY o_custkey)"


def _spend(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))


@query(f"WITH {SPEND} SELECT o_custkey, orders, cents, CAST(rank() OVER (ORDER BY orders DESC, cents) AS INTEGER) AS rank_by_orders FROM spend")
def scorecard(spark, sf_dir):
    return gold.global_rank(_spend(spark, sf_dir), [("orders", True), ("cents", False)], "rank_by_orders", 8)


@query(f"WITH {SPEND} SELECT o_custkey, orders, cents FROM spend ORDER BY cents DESC, o_custkey LIMIT 10")
def top_customers(spark, sf_dir):
    return consumers.top(_spend(spark, sf_dir), 10, F.desc("cents"), F.asc("o_custkey"))


FUNNEL = ("signup", "view", "click", "purchase", "refund")


@query("".join(f"{' UNION ALL ' if i else ''}SELECT '{s}' AS step, {i + 1} AS step_seq, CAST(count(DISTINCT CASE WHEN event_type = '{s}' THEN user_id END) AS INTEGER) AS users FROM events" for i, s in enumerate(FUNNEL)))
def funnel(spark, sf_dir):
    return gold.funnel(table(spark, sf_dir, "events"), "user_id", [(s, F.col("event_type") == s) for s in FUNNEL], "users")


@query(f"""WITH f AS ({ORACLES["funnel"]}) SELECT step, step_seq, users, round(100.0 * users / first_value(users) OVER w, 1) AS pct_of_first, round(100.0 * users / nullif(lag(users) OVER w, 0), 1) AS pct_of_previous FROM f WINDOW w AS (ORDER BY step_seq)""")
def funnel_percent(spark, sf_dir):
    return consumers.funnel_percent(funnel(spark, sf_dir), "users")


@query("SELECT o_orderstatus, count(*) AS n, count(*) FILTER (o_orderpriority LIKE '1%') AS urgent, count(*) FILTER (o_totalprice > 100000) AS large FROM orders GROUP BY o_orderstatus")
def outcome_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderpriority").startswith("1")).alias("urgent"), F.count_if(F.col("o_totalprice") > 100000).alias("large"))


@query("""SELECT p_partkey, p_brand AS description, count(l_orderkey) AS lines, CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS quantity, coalesce(max(l_quantity), 0) AS most
FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_brand""")
def usage_left_join(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("description"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_quantity")
    return gold.usage(parts, lines, "p_partkey", lines=F.count("l_orderkey"), quantity=F.coalesce(F.sum("l_quantity"), F.lit(0)).cast("long"), most=F.coalesce(F.max("l_quantity"), F.lit(0.0)))


@query("""SELECT o_orderkey, max_line AS counter, n AS events, n - max_line AS events_minus_counter, n = max_line AS agrees FROM (SELECT l_orderkey AS o_orderkey, max(l_linenumber) AS max_line, count(*) AS n FROM lineitem GROUP BY l_orderkey)""")
def counter_reconciliation(spark, sf_dir):
    facts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("run_id")).agg(F.max("l_linenumber").alias("kills"), F.count("*").alias("kill_events"), F.lit("x").alias("character_key"), F.lit(1).alias("maps_visited"))
    return gold.kill_reconciliation(facts).select(F.col("run_id").alias("o_orderkey"), F.col("counter_kills").alias("counter"), F.col("event_kills").alias("events"), "events_minus_counter", "agrees")


COMBAT = f"""log AS ({LOG}), held AS (SELECT *, coalesce(lead(srv) OVER (PARTITION BY user_id ORDER BY srv) - srv, 0) AS held FROM log),
c AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS deals, CAST(sum(held) FILTER (event_type = 'click') AS BIGINT) AS active_ms FROM held GROUP BY user_id)"""


def _combat(spark, sf_dir):
    kind = F.col("event_type")
    rows = log(spark, sf_dir).withColumn("held", windows.held_time("srv", ["user_id"]))
    return rows.groupBy("user_id").agg(F.count_if(kind == "view").alias("views"), F.count_if(kind == "error").alias("errors"), F.count_if(kind == "purchase").alias("deals"), F.sum(F.when(kind == "click", F.col("held"))).alias("active_ms"))


@query(f"WITH {COMBAT} SELECT user_id, views, errors, deals, active_ms, round(CAST(deals AS DOUBLE) / nullif(views, 0), 6) AS deals_per_view, round(deals * 86400000.0 / nullif(active_ms, 0), 6) AS deals_per_day FROM c")
def combat_profile(spark, sf_dir):
    return _combat(spark, sf_dir).withColumns({"deals_per_view": F.round(expr.ratio(F.col("deals"), F.col("views")), 6), "deals_per_day": F.round(expr.ratio(F.col("deals") * 86400000.0, F.col("active_ms")), 6)})


@query(f"WITH {COMBAT} SELECT user_id AS character_key, views AS shots, errors AS misses, CASE WHEN errors > 0 THEN round(CAST(errors AS DOUBLE) / nullif(views, 0), 4) END AS miss_rate FROM c")
def miss_rate(spark, sf_dir):
    return consumers.miss_rate(_combat(spark, sf_dir).select(F.col("user_id").alias("character_key"), F.col("views").alias("shots"), F.col("errors").alias("misses")))


@query(f"""WITH b AS ({_groups_sql(HOUR)}), s AS ({_groups_sql(6 * HOUR)}), u AS (SELECT 'burst' AS kind, n FROM b UNION ALL SELECT 'streak', n FROM s)
SELECT kind, count(*) AS groups, count(*) FILTER (n > 1) AS multi, CAST(sum(n) AS BIGINT) AS kills, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS kills_in_multi, round(coalesce(sum(n) FILTER (n > 1), 0) / CAST(sum(n) AS DOUBLE), 4) AS share FROM u GROUP BY kind""")
def burst_shares(spark, sf_dir):
    rows = log(spark, sf_dir)
    return consumers.burst_shares(_groups(rows, HOUR).withColumnRenamed("n", "kills"), _groups(rows, 6 * HOUR).withColumnRenamed("n", "kills"))


@query(f"WITH b AS ({_groups_sql(HOUR)}) SELECT n AS size, count(*) AS bursts, CAST(sum(n) AS BIGINT) AS kills FROM b GROUP BY n")
def kills_by_burst_size(spark, sf_dir):
    return consumers.kills_by_burst_size(_groups(log(spark, sf_dir), HOUR).withColumnRenamed("n", "kills"))


# shapes, texts, ids


@query("SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def nested_shred(spark, sf_dir):
    packed = log(spark, sf_dir).groupBy("user_id", F.floor(F.col("srv") / DAY).alias("day")).agg(F.collect_list(F.struct("event_id", "k")).alias("events"))
    return packed.select("user_id", F.explode("events").alias("e")).select("e.event_id", "user_id", "e.k")


@query("SELECT p_partkey, 'price' AS name, p_retailprice AS value FROM part UNION ALL SELECT p_partkey, 'size', CAST(p_size AS DOUBLE) FROM part")
def struct_unpivot(spark, sf_dir):
    members = {"price": {"value": F.col("p_retailprice")}, "size": {"value": F.col("p_size").cast("double")}}
    return unpivoted(table(spark, sf_dir, "part"), ["p_partkey"], members, "name")


@query("SELECT l_orderkey, l_linenumber, 's' || l_linestatus AS span, l_quantity AS ms, CAST(l_partkey AS DOUBLE) AS ms_max, CAST(l_suppkey AS BIGINT) AS fill FROM lineitem")
def text_metric_parse(spark, sf_dir):
    text = F.concat(F.lit("s"), "l_linestatus", F.lit("   "), F.col("l_quantity").cast("string"), F.lit("ms   max "), F.col("l_partkey").cast("string"), F.lit("     "), F.col("l_suppkey").cast("string"), F.lit(" fill    0 img   0.00Mpx"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("line"))
    part = lambda i: F.regexp_extract("line", TRACE_LINE, i)
    return rows.select("l_orderkey", "l_linenumber", part(1).alias("span"), part(2).cast("double").alias("ms"), part(3).cast("double").alias("ms_max"), part(4).cast("long").alias("fill"))


ORIGIN = "SELECT page_id, url, coalesce(regexp_extract(url, '^(https?://[^/]+)', 1), '') AS origin FROM pages"
#: The allowlist: origins of sites whose number is even, derived from the table.
EVEN = "even AS (SELECT DISTINCT coalesce(regexp_extract(url, '^(https?://[^/]+)', 1), '') AS origin FROM pages WHERE page_id % 2 = 0)"


def _pages(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "url", expr.origin_of(F.col("url")).alias("origin"))
    return rows, rows.where("page_id % 2 = 0").select("origin").distinct()


@query(f"WITH o AS ({ORIGIN}), {EVEN} SELECT page_id, CASE WHEN e.origin IS NULL THEN 'unlisted' ELSE 'public' END AS origin_kind, e.origin AS shown FROM o LEFT JOIN even e ON e.origin = o.origin")
def origin_class(spark, sf_dir):
    rows, listed = _pages(spark, sf_dir)
    joined = rows.join(listed.withColumn("listed", F.lit(True)), "origin", "left")
    return joined.select("page_id", F.when(F.col("listed"), "public").otherwise("unlisted").alias("origin_kind"), F.when(F.col("listed"), F.col("origin")).alias("shown"))


#: Origins that stay in free text.
KEPT = ("https://site0.example", "https://site1.example.com", "http://localhost")


@query(f"""WITH o AS ({ORIGIN}) SELECT page_id, CASE WHEN origin = '' THEN 'see ' || url || ' ok' WHEN origin IN {KEPT!r} THEN 'see ' || url || ' ok' ELSE 'see ' || replace(url, origin, 'http://masked.invalid') || ' ok' END AS text FROM o""")
def mask_origins(spark, sf_dir):
    text = F.concat(F.lit("see "), "url", F.lit(" ok"))
    return table(spark, sf_dir, "pages").select("page_id", expr.mask_origins(text, KEPT).alias("text"))


AGENTS = ("Mozilla/5.0 Chrome/126.0 Safari/537.36 Edg/126.0", "Mozilla/5.0 Chrome/126.0 Safari/537.36", "Mozilla/5.0 Firefox/127.0", "Safari", "curl/8", "Mozilla/5.0 Chrome/1 OPR/9")


@query("SELECT event_id, CASE user_id % 6 WHEN 0 THEN 'Edge' WHEN 1 THEN 'Chrome' WHEN 2 THEN 'Firefox' WHEN 3 THEN 'Safari' WHEN 4 THEN 'Other' ELSE 'Opera' END AS family FROM events")
def browser_family(spark, sf_dir):
    agent = F.element_at(F.array(*[F.lit(a) for a in AGENTS]), (F.col("user_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", expr.browser_family(agent).alias("family"))


@query("SELECT o_orderkey, substr(sha256(o_orderkey || chr(31) || o_custkey || chr(31) || 'None'), 1, 32) AS trace_id FROM orders")
def hex_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", expr.hex_id(F.col("o_orderkey"), F.col("o_custkey"), F.lit(None).cast("string"), size=16).alias("trace_id"))


@query("SELECT event_id, CAST(epoch_us(ts) // 1000 * 1000000 AS VARCHAR) AS nanos FROM events")
def nanos(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", expr.nanos(F.unix_millis(F.col("ts").cast("timestamp"))).alias("nanos"))


@query("""WITH s AS (SELECT substr(sha256('o' || l_orderkey), 1, 32) AS trace_id, l_linenumber AS n, l_quantity AS ms FROM lineitem), r AS (SELECT trace_id, count(*) AS n, sum(CAST(ms AS BIGINT)) AS ms FROM s GROUP BY trace_id)
SELECT substr(sha256(trace_id || chr(31) || 'root'), 1, 16) AS span_id, CAST(NULL AS VARCHAR) AS parent_id, CAST(n AS BIGINT) AS sections, CAST(ms AS BIGINT) AS ms FROM r
UNION ALL SELECT substr(sha256(trace_id || chr(31) || n), 1, 16), substr(sha256(trace_id || chr(31) || 'root'), 1, 16), NULL, CAST(ms AS BIGINT) FROM s""")
def span_tree(spark, sf_dir):
    spans = table(spark, sf_dir, "lineitem").select(expr.hex_id(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")), size=16).alias("trace_id"), "l_linenumber", F.col("l_quantity").cast("long").alias("ms"))
    root = expr.hex_id(F.col("trace_id"), F.lit("root"), size=8)
    roots = spans.groupBy("trace_id").agg(F.count("*").alias("sections"), F.sum("ms").alias("ms")).select(root.alias("span_id"), F.lit(None).cast("string").alias("parent_id"), "sections", "ms")
    return roots.unionByName(spans.select(expr.hex_id(F.col("trace_id"), F.col("l_linenumber"), size=8).alias("span_id"), root.alias("parent_id"), F.lit(None).cast("long").alias("sections"), "ms"))


# data quality


@query(f"""WITH {RUNS}, b AS (SELECT session_id, user_id, run_seq, min(srv) AS s0, max(srv) AS s1 FROM run_rows GROUP BY ALL), m AS (SELECT *, max(s1) OVER (PARTITION BY session_id ORDER BY s0, s1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_end FROM b)
SELECT session_id, user_id, CAST(run_seq AS INTEGER) AS run_seq, s0, latest_end FROM m WHERE s0 <= latest_end""")
def overlap_check(spark, sf_dir):
    bounds = run_rows(spark, sf_dir).groupBy("session_id", "user_id", "run_seq").agg(F.min("srv").alias("s0"), F.max("srv").alias("s1"))
    return quality.overlapping_intervals(bounds, ["session_id"], "s0", "s1").select("session_id", "user_id", "run_seq", "s0", "latest_end")


@query("SELECT event_type AS member, TIMESTAMP '2000-01-01' AS valid_from, 'overlaps the next version' AS problem FROM events WHERE event_type = 'click' GROUP BY event_type")
def scd_check(spark, sf_dir):
    """The dimension with one version of one member made to overlap: the check finds it and nothing else."""
    broken = versions(spark, sf_dir).withColumn("valid_to", F.when((F.col("member") == "click") & (F.col("version_seq") == 1), F.expr("TIMESTAMP '2024-06-01 00:00:00'")).otherwise(F.col("valid_to")))
    return quality.bad_history(broken, ["member"]).withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def key_unique(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"SELECT event_id, CAST(0 AS BIGINT) AS versions FROM events WHERE ts < TIMESTAMP '{CHANGE}'")
def asof_coverage(spark, sf_dir):
    """Against the later versions alone: facts before the change find none."""
    facts = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    later = versions(spark, sf_dir).where("version_seq = 2")
    return quality.coverage_faults(facts, later, ["event_id"], facts["event_type"] == later["member"], facts["ts"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def orphan_lines(spark, sf_dir):
    closed = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return quality.orphans(table(spark, sf_dir, "lineitem"), closed, ["l_orderkey"]).select("l_orderkey", "l_linenumber")


@query("SELECT p_partkey FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size < 5 AND p_retailprice > 1500)")
def anti_not_null(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return joins.not_in(parts, parts.where("p_size < 5 AND p_retailprice > 1500").select("p_brand").distinct(), "p_brand", "p_brand").select("p_partkey")


@query("""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, parts, whole FROM (SELECT o_orderkey, n AS parts, CAST(m AS BIGINT) AS whole FROM (SELECT l_orderkey AS o_orderkey, count(*) AS n, max(l_linenumber) AS m FROM lineitem GROUP BY l_orderkey)) WHERE parts <> whole""")
def conservation(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    parts = lines.select(F.col("l_orderkey").alias("o_orderkey"), F.lit(1).cast("long").alias("one"))
    whole = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linenumber").cast("long").alias("most"))
    return quality.conservation(parts, whole, ["o_orderkey"], "one", "most")


# export


@query("""SELECT o_orderkey, '[{"key":"order.id","value":{"intValue":"' || o_orderkey || '"}},' || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '{"key":"status","value":{"stringValue":"' || o_orderstatus || '"}},' END
    || '{"key":"large","value":{"boolValue":' || CASE WHEN o_totalprice > 100000 THEN 'true' ELSE 'false' END || '}}]' AS attributes FROM orders""")
def attribute_lists(spark, sf_dir):
    made = expr.attributes(order__id=(F.col("o_orderkey"), "int"), status=(F.nullif(F.col("o_orderstatus"), F.lit("F")), "string"), large=(F.col("o_totalprice") > 100000, "bool"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(made).alias("attributes"))


@query("""SELECT count(*) AS records, CAST(sum(strlen('{"id":' || event_id || ',"kind":"' || event_type || '"}') + 1) AS BIGINT) AS bytes, true AS all_fit FROM events""")
def export_batches(spark, sf_dir):
    """Every record is in one batch, and no batch exceeds the limit; the bytes count a separator for each record."""
    rows = log(spark, sf_dir).select(F.col("srv").alias("at_ms"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("json"))
    sized = export.batched(rows, most=20_000).groupBy("batch").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    return sized.agg(F.sum("n").alias("records"), F.sum("b").alias("bytes"), (F.max("b") <= 20_001).alias("all_fit"))


BATCH, WRAP = 20_000, 40


@query(f"""WITH RECURSIVE r AS (SELECT doc_id, strlen(text) + 1 AS bytes, row_number() OVER w AS i, CAST(sum(strlen(text) + 1) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM documents WHERE text IS NOT NULL WINDOW w AS (ORDER BY doc_id, text)),
s AS (SELECT CAST(1 AS BIGINT) AS i, CAST(0 AS BIGINT) AS batch UNION ALL
    SELECT (SELECT coalesce(min(n.i), (SELECT max(i) + 1 FROM r)) FROM r n WHERE n.i > s.i AND n.upto - (b.upto - b.bytes) > {BATCH - WRAP + 1}), s.batch + 1 FROM s JOIN r b ON b.i = s.i),
e AS (SELECT i, batch, lead(i) OVER (ORDER BY batch) AS until FROM s WHERE i IN (SELECT i FROM r))
SELECT batch, count(*) AS records, CAST(sum(bytes) - 1 + {WRAP} AS BIGINT) AS bytes, min(doc_id) AS first_id, sum(bytes) - 1 + {WRAP} <= {BATCH} OR count(*) = 1 AS fits FROM r JOIN e ON r.i >= e.i AND (e.until IS NULL OR r.i < e.until) GROUP BY batch""")
def export_next_fit(spark, sf_dir):
    """Texts as records, from a few bytes to far over the limit: each batch is as long as fits, and only a text that is too long by itself exceeds it."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("at_ms"), F.col("text").alias("json"))
    size = F.sum("bytes") - 1 + WRAP
    return export.batched(rows, BATCH, WRAP).groupBy("batch").agg(F.count("*").alias("records"), size.alias("bytes"), F.min("at_ms").alias("first_id"), ((size <= BATCH) | (F.count("*") == 1)).alias("fits"))


@query("SELECT event_id FROM events WHERE epoch_us(ts) // 1000 > (SELECT max(epoch_us(ts) // 1000) FROM events WHERE event_type = 'signup' AND event_id % 2 = 0)")
def after_high_water(spark, sf_dir):
    """What a second export sends, when the first one had sent everything up to the last even signup."""
    rows = log(spark, sf_dir).withColumn("at_ms", F.col("srv"))
    mark = export.high_water(rows.where("event_type = 'signup' AND event_id % 2 = 0"))
    return export.after(rows, mark).select("event_id")


@query("SELECT count(*) - count(DISTINCT sha256(l_orderkey || chr(31) || l_linenumber)) AS collisions FROM lineitem")
def span_collisions(spark, sf_dir):
    """Lines as child spans of their order; a line number that an order holds twice gives one id twice."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("session_id"), F.lit(1).alias("page_load_seq"), F.lit(0).cast("long").alias("srv"), F.lit("line").alias("origin"), F.lit(None).cast("long").alias("event_id"), F.col("l_linenumber").cast("string").alias("span"), F.col("l_quantity").alias("ms"), F.col("l_tax").alias("ms_max"), F.lit(1).cast("long").alias("frames"))
    return export.span_collisions(export.otlp_spans(lines))


@query("SELECT substr(sha256('client.error' || chr(31) || user_id || chr(31) || '1' || chr(31) || ('k=' || json_extract_string(props, '$.k'))), 1, 32) AS id, 'com.spanlake.client.error' AS type, user_id || '#1' AS subject, 'k=' || json_extract_string(props, '$.k') AS message FROM events WHERE event_type = 'error'")
def cloud_event_envelopes(spark, sf_dir):
    errors = log(spark, sf_dir).where("event_type = 'error'").select(F.col("user_id").cast("string").alias("session_id"), F.lit(1).alias("page_load_seq"), F.timestamp_millis("srv").alias("arrived"), F.concat(F.lit("k="), F.col("k").cast("string")).alias("msg"), F.lit(None).cast("string").alias("top_frame"), F.lit(None).cast("string").alias("top_location"))
    part = lambda path: F.get_json_object("json", path)
    return export.error_events(errors).select(part("$.id").alias("id"), part("$.type").alias("type"), part("$.subject").alias("subject"), part("$.data.message").alias("message"))


@query("SELECT event_id, 'required_field_missing' AS reason, 'error.k' AS detail FROM events WHERE event_type = 'error' AND json_extract_string(props, '$.k') IS NULL UNION ALL SELECT event_id, 'kind_not_in_contract', 'kind=' || event_type FROM events WHERE event_type NOT IN ('view', 'click', 'error', 'purchase')")
def strict_rules(spark, sf_dir):
    """The opt-in rules: declared kinds, and fields that a kind must have."""
    kind = F.col("event_type")
    rules = [
        rule((kind == "error") & F.col("k").isNull(), "landed_fields", "required_field_missing", F.lit("error.k")),
        rule(~kind.isin("view", "click", "error", "purchase"), "landed_fields", "kind_not_in_contract", F.concat(F.lit("kind="), kind)),
    ]
    found = F.filter(F.array(*rules), lambda r: r.isNotNull())
    return log(spark, sf_dir).select("event_id", F.inline(found)).drop("relation")


# sequences, ranks and histories over ranges

ONE = f"log AS ({LOG}), one AS (SELECT *, min(srv) OVER (PARTITION BY user_id) AS first_srv, lag(srv) OVER w AS prev_srv, lag(event_type) OVER w AS prev_type FROM log WINDOW w AS (ORDER BY srv, event_id))"


@query(f"""WITH {ONE}, n AS (SELECT event_id, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER w AS hellos, dense_rank() OVER (ORDER BY first_srv) AS page_load_seq, prev_srv, prev_type,
    sum(CASE WHEN event_type = 'error' AND coalesce(prev_type, '-') <> 'error' THEN 1 ELSE 0 END) OVER w AS island, sum(CASE WHEN prev_srv IS NULL OR srv - prev_srv > {60_000} THEN 1 ELSE 0 END) OVER w AS gap_group FROM one WINDOW w AS (ORDER BY srv, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, CAST(hellos AS BIGINT) AS hellos, CAST(page_load_seq AS INTEGER) AS page_load_seq, prev_srv, prev_type, CAST(island AS BIGINT) AS island, CAST(gap_group AS BIGINT) AS gap_group FROM n""")
def one_session_scan(spark, sf_dir):
    """All events as one session: hellos so far, page loads by first arrival, the event before, runs of errors and groups by gaps, over 40 ranges."""
    dealt = ranges.deal(log(spark, sf_dir).withColumn("session", F.lit(0)), ["session"], "srv", "event_id", parts=40)
    seen = dealt.scan(hellos=ranges.total(F.when(F.col("event_type") == "signup", 1).otherwise(0)), prev_srv=ranges.before(F.col("srv")), prev_type=ranges.before(F.col("event_type")))
    error = F.col("event_type") == "error"
    opens = seen.with_columns(
        island_opens=F.when(error & (F.coalesce("prev_type", F.lit("-")) != "error"), 1).otherwise(0),
        group_opens=F.when(F.col("prev_srv").isNull() | (F.col("srv") - F.col("prev_srv") > 60_000), 1).otherwise(0),
    )
    numbered = opens.scan(island=ranges.total(F.col("island_opens")), gap_group=ranges.total(F.col("group_opens"))).rows()
    ranked = ranges.rank_by_first_seen(numbered, ["session"], "user_id", "srv", "page_load_seq", parts=40)
    return ranked.select("event_id", "hellos", "page_load_seq", "prev_srv", "prev_type", "island", "gap_group")


@query("""WITH m AS (SELECT o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders), b AS (SELECT *, max(cents) OVER (ORDER BY o_orderkey DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_after FROM m)
SELECT o_orderkey, o_custkey, cents, best_after FROM b WHERE cents < best_after""")
def rank_inversions(spark, sf_dir):
    """Orders by their number: those that a later one surpasses, with the largest later total."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return quality.rank_inversions(rows, "o_orderkey", "cents")


@query(f"""WITH log AS ({LOG}), v AS (SELECT user_id, event_id AS deal_id, k AS deal_k, srv AS valid_from, lead(srv) OVER (PARTITION BY user_id ORDER BY srv) AS valid_to FROM log WHERE event_type = 'purchase')
SELECT l.event_id, v.deal_id, v.deal_k, l.srv - v.valid_from AS age_ms FROM log l LEFT JOIN v ON v.user_id = l.user_id AND l.srv >= v.valid_from AND (v.valid_to IS NULL OR l.srv < v.valid_to)""")
def as_of_history(spark, sf_dir):
    """Every event with its user's last purchase: a history with a version for each purchase, joined in one order and not by pairs."""
    rows = log(spark, sf_dir)
    deals = rows.where("event_type = 'purchase'").select(F.col("user_id").alias("buyer"), F.col("event_id").alias("deal_id"), F.col("k").alias("deal_k"), F.col("srv").alias("valid_from"))
    versions_ = deals.withColumn("valid_to", F.lead("valid_from").over(windows.ordered(["buyer"], "valid_from")))
    found = joins.as_of_sorted(rows, versions_, ("user_id", "buyer"), "srv", how="left")
    return found.select("event_id", "deal_id", "deal_k", (F.col("srv") - F.col("valid_from")).alias("age_ms"))


@query("""SELECT n_regionkey, count(*) AS samples, round(quantile_cont(b, 0.01), 4) AS p0, round(quantile_cont(b, 0.5), 4) AS p1, round(quantile_cont(b, 0.999), 4) AS p2, max(b) AS largest
FROM (SELECT n_regionkey, CASE WHEN c_custkey % 7 > 0 THEN c_acctbal END AS b FROM customer JOIN nation ON c_nationkey = n_nationkey) WHERE b IS NOT NULL GROUP BY n_regionkey""")
def order_statistics(spark, sf_dir):
    """Balances by region, nulls among them: three shares from one selection."""
    people = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = people.select("n_regionkey", F.when(F.col("c_custkey") % 7 > 0, F.col("c_acctbal")).alias("b"))
    found = ranges.exact_percentiles(rows, ["n_regionkey"], "b", [0.01, 0.5, 0.999], parts=16)
    return found.select("n_regionkey", "samples", *[F.round(f"p{i}", 4).alias(f"p{i}") for i in range(3)], "largest")


# landing and evidence

LINE_BYTES = 150


def _line() -> Column:
    """A record as a line of text, with fields that the contract lacks and a text of k two-byte letters."""
    return F.concat(F.lit('{"kind":"beat","srv":'), F.col("srv").cast("string"), F.lit(',"msg":"'), F.expr("repeat('é', CAST(k AS INT))"), F.lit('","pulse":{"kills":'), F.col("k").cast("string"), F.lit(',"mood":"'), F.col("event_type"), F.lit('"},"more":{"id":'), F.col("event_id").cast("string"), F.lit("}}"))


@query(f"""WITH log AS ({LOG}), l AS (SELECT event_id, srv, k, event_type, '{{"kind":"beat","srv":' || srv || ',"msg":"' || repeat('é', k) || '","pulse":{{"kills":' || k || ',"mood":"' || event_type || '"}},"more":{{"id":' || event_id || '}}}}' AS line FROM log WHERE k IS NOT NULL)
SELECT event_id, srv, k AS kills, event_type AS mood, strlen(line) AS line_size, CASE WHEN strlen(line) > {LINE_BYTES} THEN md5(line) END AS too_long FROM l""")
def line_landing(spark, sf_dir):
    """Events written as lines of text and landed by one scan: sizes in bytes as read, lines over the limit with their text, unknown fields at two depths."""
    folder = f"{ranges.shared_dir(spark)}/spanlake/lines-{uuid.uuid4().hex}"
    log(spark, sf_dir).where("k IS NOT NULL").select(_line()).write.text(folder)
    records = landing.read_lines(spark, folder, line_bytes=LINE_BYTES, keep=True)
    told = landing.with_unknown(records, landing.unknown_fields(records))
    return told.select(F.col("unknown_more.id").alias("event_id"), "srv", F.col("pulse.kills").alias("kills"), F.col("unknown_pulse.mood").alias("mood"), F.col("line_size").cast("long").alias("line_size"), F.md5(landing.MALFORMED).alias("too_long"))


@query("""WITH a AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY ALL), b AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)
SELECT 'same' AS compared, count(*) AS rows, true AS equal, count(*) - count(nullif(n % 2, 0)) AS nulls FROM a UNION ALL SELECT 'one cell changed', count(*), false, count(*) - count(nullif(n % 2, 0)) FROM a
UNION ALL SELECT 'one row twice for another', count(*), false, count(*) - count(nullif(n % 2, 0)) + (SELECT CASE WHEN x.n % 2 = 0 THEN 1 ELSE 0 END - CASE WHEN y.n % 2 = 0 THEN 1 ELSE 0 END FROM (SELECT n FROM a ORDER BY k DESC LIMIT 1) x, (SELECT n FROM a ORDER BY k LIMIT 1) y) FROM a""")
def content_digest(spark, sf_dir):
    """Lines of each order in three copies against the relation itself: dealt anew, with one cell changed, and with the first order replaced by the last."""
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    rows = counts.select("k", "n", F.nullif(F.col("n") % 2, F.lit(0)).alias("odd"))
    ends = counts.agg(F.min("k").alias("lo"), F.max("k").alias("hi"))  # a row
    at = rows.crossJoin(F.broadcast(ends))
    changed = at.withColumn("n", F.when(F.col("k") == F.col("lo"), F.col("n") + 100).otherwise(F.col("n"))).select(*rows.columns)
    twice = at.where(F.col("k") != F.col("lo")).withColumn("copies", F.when(F.col("k") == F.col("hi"), 2).otherwise(1)).select(*rows.columns, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*rows.columns)
    out, whole = None, quality.digest(rows).select(F.struct("*").alias("whole"))
    for name, other in (("same", rows.repartition(7, "n")), ("one cell changed", changed), ("one row twice for another", twice)):
        one = quality.digest(other).select(F.struct("*").alias("d")).crossJoin(whole)  # a row each
        told = one.select(F.lit(name).alias("compared"), F.col("d.rows").alias("rows"), (F.col("d") == F.col("whole")).alias("equal"), F.col("d.nulls")[2].alias("nulls"))
        out = told if out is None else out.unionByName(told)
    return out
