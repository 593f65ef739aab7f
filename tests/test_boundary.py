"""Sanitizing, publishing, loading, exporting and streaming."""

import json
import random

import pytest
from pyspark.sql import functions as F
from wire import T0, alarm, beat, bye, err, event, hello, pulse, trace_event, write_log, write_reference

from spanlake.functions import expr
from spanlake.operators import joins, quality, windows
from spanlake.plans import export, gold, lake, publish, sanitize
from spanlake.sources import landing
from spanlake.streaming import live


def column(spark, make, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(make(F.col("v"))).collect()]


def test_browser_families_are_idempotent(spark):
    agents = ["Mozilla/5.0 Chrome/126 Safari/537 Edg/126", "Mozilla/5.0 Chrome/1 OPR/9", "Firefox/127", "Mozilla/5.0 Chrome/126 Safari/5", "Mozilla/5.0 Version/17 Safari/605", "curl/8", None]
    once = column(spark, expr.browser_family, *agents)
    assert once == ["Edge", "Opera", "Firefox", "Chrome", "Safari", "Other", None]
    assert column(spark, expr.browser_family, *once) == once


def test_masks_keep_only_whole_listed_origins(spark):
    texts = ["at http://localhost/x:1", "http://localhost.evil.example/y", "see https://a.example/b and http://localhost'", "none", None]
    got = column(spark, lambda c: expr.mask_origins(c, ["http://localhost"]), *texts)
    assert got == ["at http://localhost/x:1", "http://masked.invalid/y", "see http://masked.invalid/b and http://localhost'", "none", None]
    assert column(spark, lambda c: expr.mask_origins(c, []), "http://q/z") == ["http://masked.invalid/z"]
    assert column(spark, expr.scrub_origins, "https://a.example:81/b") == ["http://localhost/b"]


@pytest.fixture(scope="module")
def capture(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("capture")
    secret = "https://inner.example"
    records = [
        hello(T0, href="http://localhost:8090/play", ua="Mozilla/5.0 Chrome/126 Safari/5"), beat(T0 + 1000, pulse("menu")), beat(T0 + 2000, events=[event(1, T0 + 2000, f"went to {secret}/x", url=f"{secret}/y"), trace_event(2, T0 + 2000)]),
        err(T0 + 3000, msg=f"failed at {secret}/z", stack=f"at {secret}/f.ts:1:2"), alarm(T0 + 4000), bye(T0 + 5000),
    ]
    reference = landing.read_reference(spark, write_reference(root / "ref"))
    raw = landing.read_wire(spark, write_log(root / "in", records))
    return root, reference, raw, secret


def test_sanitize_job_masks_at_any_depth_and_counts(spark, capture):
    root, reference, raw, secret = capture
    listed, open_ = sanitize.origins(reference.origins), sanitize.origins(reference.origins, publishable=True)
    assert sanitize.sanitize_job(spark, raw, str(root / "live"), open_, listed) == 6
    text = "\n".join(r.value for r in spark.read.text(str(root / "live")).collect())
    assert secret not in text and "http://localhost:8090/play" in text and '"ua":"Chrome"' in text
    assert sanitize.sanitize_job(spark, raw, str(root / "hard"), open_) == 6
    assert "8090" not in "\n".join(r.value for r in spark.read.text(str(root / "hard")).collect())


def test_gate_names_every_problem_once(spark):
    lines = spark.createDataFrame([('{"msg":"https://x.example/a https://x.example/b /home/me","ua":"curl/8"}',), ('{"ua":"Chrome"}',), ("",), ('{"p":"C:\\\\\\\\dir"}',)], "value string")
    got = sorted(r.problem for r in sanitize.violations(lines, ["http://localhost"]).collect())
    assert got == ["Unix home path", "Windows drive path", "un-trimmed ua curl/8", "unlisted origin https://x.example"]


def test_publish_load_and_evidence(spark, capture, monkeypatch):
    root, reference, raw, secret = capture
    made = lake.build(spark, raw, reference)
    chosen = {n: made[n] for n in ("sessions", "session_summary", "spans", "session_context", "quarantine")}
    publish.publish(chosen, str(root / "out"))
    shown = publish.published(spark, str(root / "out"))
    assert sorted(shown) == sorted(chosen)
    assert "href" not in shown["sessions"].columns and shown["sessions"].first().origin is None  # may not be published
    assert quality.values_with(shown["sessions"], ["8090"]).count() == 0 and quality.values_with(made["sessions"], ["8090"]).count() == 1
    tables = publish.catalog(spark, str(root / "out"))
    assert {r.table_name for r in tables.collect()} == set(chosen)
    assert spark.sql("SELECT count(*) FROM spans").first()[0] == 8
    url, props = f"jdbc:derby:memory:t{abs(hash(str(root)))};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    assert publish.load(spark, str(root / "out"), url, props) == sorted(chosen)
    # A load that fails on the way leaves the tables that are there.
    publish.published(spark, str(root / "out"))["spans"].limit(3).write.parquet(str(root / "less" / "sessions"))
    numbers = iter(range(9))
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(publish, "digest", lambda rows: quality.digest(rows).withColumn("rows", F.lit(next(numbers))))  # no two agree
        publish.load(spark, str(root / "less"), url, props)
    assert spark.read.jdbc(url, "sessions", properties=props).count() == 1 and len(spark.read.jdbc(url, "sessions", properties=props).columns) > 10
    assert publish.load(spark, str(root / "out"), url, props) == sorted(chosen)
    proof = publish.evidence(spark, chosen, str(root / "out"), url, props).collect()
    changed = chosen | {"spans": chosen["spans"].withColumn("ms", F.when(F.col("span") == "hud", F.col("ms") + 1e-9).otherwise(F.col("ms")))}
    assert {r.relation for r in publish.evidence(spark, changed, str(root / "out"), url, props).collect() if r.verdict == "differ"} == {"spans"}
    assert {r.verdict for r in proof} == {"match"} and {r.relation: r.is_empty for r in proof}["quarantine"] is True
    made.release()


def test_exports_follow_their_formats(spark, capture):
    root, reference, raw, _ = capture
    made = lake.build(spark, raw, reference)
    logs = export.otlp_logs(made["error_report"], made["incident_timeline"], made["quarantine"])
    records = [json.loads(r[0]) for r in logs.select(F.to_json("record")).collect()]
    assert sorted(r["severityNumber"] for r in records) == [13, 17, 17] and all(isinstance(r["timeUnixNano"], str) for r in records)
    spans = export.otlp_spans(made["spans"])
    found = [json.loads(r[0]) for r in spans.select(F.to_json("record")).collect()]
    assert len(found) == 10 and all(len(r["traceId"]) == 32 and len(r["spanId"]) == 16 for r in found)
    assert sum("parentSpanId" not in r for r in found) == 2 and {r.get("parentSpanId") for r in found} - {None} <= {r["spanId"] for r in found}
    assert export.span_collisions(spans).first()[0] == 0
    metrics = export.otlp_metrics(made["loss_accounting"], made["contract_reconciliation"], made["alarms_by_class"], made["frame_time_by_span"], T0)
    assert metrics.count() == 8
    events = [json.loads(r.json) for r in export.cloud_events(made["session_summary"], made["error_report"], made["alarms_by_class"]).collect()]
    assert {e["type"] for e in events} == {"com.spanlake.session.completed", "com.spanlake.client.error", "com.spanlake.alarm.summary"}
    assert all(e["specversion"] == "1.0" and "data" in e and None not in e.values() for e in events)
    bodies = export.payloads(spans, "traces", most=2_400).collect()
    assert sum(b.records for b in bodies) == 10 and len(bodies) > 1
    assert all(len(b.payload) <= 2_400 and json.loads(b.payload)["resourceSpans"][0]["scopeSpans"][0]["spans"] for b in bodies)
    assert export.after(spans, export.high_water(spans)).count() == 0 and export.after(spans, None).count() == 10
    made.release()


def test_hex_ids_separate_their_parts(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "x")], "p string, q string")
    ids = [r[0] for r in df.select(expr.hex_id(F.col("p"), F.col("q"), size=8)).collect()]
    assert len(set(ids)) == 3 and all(len(x) == 16 for x in ids)
    import hashlib

    assert ids[2] == hashlib.sha256(b"None\x1fx").digest()[:8].hex()


def test_stream_lands_new_files_once_and_splits(spark, tmp_path):
    reference = landing.read_reference(spark, write_reference(tmp_path / "ref"))
    folder = write_log(tmp_path / "in", [hello(T0), beat(T0 + 1, pulse("flying")), "{broken"], "session-2026-08-30T10-00-00Z")
    for extra in (0, 1):
        if extra:
            write_log(tmp_path / "in", [hello(T0 + 10)], "session-2026-08-31T10-00-00Z")
        live.land_live(live.read_live(spark, folder), str(tmp_path / "raw"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 4
    live.split_live(live.read_live(spark, folder), reference, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "good")).count() == 3
    assert sorted(r.reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == ["malformed_json", "srv_missing", "state_not_in_contract"]


def test_live_bursts_agree_with_batch(spark, tmp_path):
    times = [0, 40, 90, 200, 251, 10_000_000]
    rows = spark.createDataFrame([("r", "c", "CROW_KILLED", T0 + t) for t in times], "run_id string, character_key string, message string, ts long")
    batch = sorted((r.started_ts, r.kills) for r in gold.kill_groups(rows, 50).collect())
    rows.select("run_id", F.col("ts").alias("at")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("run_id string, at long").parquet(str(tmp_path / "in"))
    live.live_bursts(stream, "run_id", "at", 50).writeStream.format("memory").queryName("bursts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.started, r.n) for r in spark.table("bursts").collect())
    assert got == [b for b in batch if b[0] < T0 + 10_000_000]  # the last group is still open


def test_windows_edges(spark):
    df = spark.createDataFrame([("a", 1, "x", True), ("a", 2, "x", True), ("a", 3, None, False), ("a", 4, None, True), ("a", None, "y", True)], "g string, t long, v string, f boolean")
    runs = windows.islands_by_flag(df, "f", ["g"], "t", "n").orderBy(F.asc_nulls_last("t")).collect()
    assert [(r.t, r.n) for r in runs] == [(1, 1), (2, 1), (4, 2), (None, 2)]
    blocks = windows.islands_by_value(df, "v", ["g"], "t", "n").orderBy(F.asc_nulls_last("t")).collect()
    assert [r.n for r in blocks] == [1, 1, 2, 2, 3]
    groups = windows.gap_groups(df.where("t IS NOT NULL"), ["g"], "t", 1, "n").collect()
    assert {r.n for r in groups} == {1}


def test_joins_over_time(spark):
    points = spark.createDataFrame([("k", 5), ("k", 15), ("k", 30), ("j", 5)], "k string, t long")
    spans = spark.createDataFrame([("k", "A", 6, 14), ("k", "B", 29, 100)], "k string, name string, s long, e long")
    plain = sorted((r.t, r.name) for r in joins.within(points, spans, ["k"], "t", "s", "e", 1).collect())
    assert plain == [(5, "A"), (15, "A"), (30, "B")]
    assert sorted((r.t, r.name) for r in joins.within_buckets(points, spans, ["k"], "t", "s", "e", 7, 1).collect()) == plain
    some = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    assert [r.x for r in joins.not_in(some, spark.createDataFrame([("a",), (None,)], "m string"), "x", "m").collect()] == ["b"]


def test_global_rank_is_sql_rank(spark):
    df = spark.createDataFrame([(i, i % 7, float(i % 3) if i % 5 else None) for i in range(200)], "id long, a long, b double")
    df.createOrReplaceTempView("ranked_rows")
    want = {r.id: r.r for r in spark.sql("SELECT id, rank() OVER (ORDER BY a DESC NULLS LAST, b ASC NULLS LAST) AS r FROM ranked_rows").collect()}
    got = {r.id: r.r for r in gold.global_rank(df, [("a", True), ("b", False)], "r", 5).collect()}
    assert got == want


def test_quality_checks_find_what_is_wrong_and_only_that(spark):
    good = spark.createDataFrame([("a", 1, 5), ("a", 5, None), ("b", 1, None)], "k string, valid_from long, valid_to long")
    assert quality.bad_history(good, ["k"]).count() == 0
    bad = spark.createDataFrame([("a", 1, 6), ("a", 5, None), ("b", 3, 2), ("c", 1, None), ("c", 2, None)], "k string, valid_from long, valid_to long")
    assert sorted((r.k, r.problem) for r in quality.bad_history(bad, ["k"]).collect()) == [("a", "overlaps the next version"), ("b", "ends before it begins"), ("c", "overlaps the next version")]
    assert [r.k for r in quality.bad_history(good, ["k"], F.lit(0)).collect()] == ["a", "b"]
    ranks = spark.createDataFrame([(1, 9), (2, 5), (3, 7)], "r int, s int")
    assert [r.r for r in quality.rank_inversions(ranks, "r", "s").collect()] == [2]
    assert quality.insane_runs(spark.createDataFrame([(1, 2.0, 5, 4, 1.0), (1, 2.0, 4, 5, 1.0)], "kills long, duration_s double, started_srv long, ended_srv long, sim_active_s double")).count() == 1


def test_rank_inversions_over_ranges(spark):
    from spanlake.operators import quality

    rng = random.Random(4)
    rows = [(i, rng.randrange(50)) for i in range(300)]
    best, want = None, set()
    for rank, score in reversed(rows):
        best = score if best is None else max(best, score)
        if score < best:
            want.add((rank, score, best))
    got = quality.rank_inversions(spark.createDataFrame(rows, "place int, score int").repartition(7), "place", "score")
    assert {tuple(r) for r in got.collect()} == want and got.columns == ["place", "score", "best_after"]


def test_lines_are_measured_as_read_and_keep_what_is_unknown(spark, tmp_path):
    lines = ['{"kind":"beat","srv":1,"msg":"éé","more":{"deep":[{"a":1}]}}', '{ "srv": 2, "kind": "beat", "pulse": {"state": "menu", "mood": "good"} }', '{"kind":"beat","srv":"late"}', "no json", "   ", '{"kind":"bye","srv":3}']
    folder = write_log(tmp_path / "in", lines)
    size = [len(x.encode()) for x in lines if x.strip()]
    records = landing.read_lines(spark, folder, keep=True)
    assert [r.line_size for r in records.collect()] == size
    assert records._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    for most in (size[0] - 1, size[0], size[0] + 1):
        bad = {r.line_size for r in landing.read_lines(spark, folder, line_bytes=most).where("_corrupt_record IS NOT NULL").collect()}
        assert bad == {size[2], size[3]} | {n for n in size if n > most}
    assert [r._corrupt_record for r in landing.read_wire(spark, folder, line_bytes=size[0] - 1).orderBy("srv").collect() if r.srv == 1] == [lines[0]]
    landing.land(records, str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    fields = landing.unknown_fields(raw)
    assert fields.simpleString() == "struct<more:struct<deep:array<struct<a:bigint>>>,pulse:struct<mood:string>>"
    told = {r.srv: r for r in landing.with_unknown(raw, fields).where("kind = 'beat' AND srv IS NOT NULL").collect()}
    assert told[1].unknown_more.deep[0].a == 1 and told[2].unknown_pulse.mood == "good" and told[2].unknown_more is None
    assert landing.unknown_fields(landing.read_lines(spark, write_log(tmp_path / "none", []), keep=True)).fields == []
