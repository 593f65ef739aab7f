import json

import pytest
from pyspark.sql import functions as F
from wire import T0, alarm, beat, bye, err, event, hello, pulse, trace_event, write_log, write_reference

from spanlake.operators import quality
from spanlake.plans import lake, typed
from spanlake.sources import landing
from spanlake.sources.contract import CAPS, cap


def game(t=T0):
    """One load: menu, a run with a boss fight twice parted by a pulse without boss, death, then the menu."""
    s = lambda i: t + 1000 * i
    out = [hello(s(0))]
    out.append(beat(s(1), pulse("menu")))
    out.append(beat(s(2), pulse("playing", kills=0)))
    out.append(beat(s(3), pulse("playing", kills=2), [event(1, s(3) - 40, "CROW_KILLED"), event(2, s(3) - 10, "CROW_KILLED"), event(3, s(3), "WEAPON_FIRED")]))
    out.append(beat(s(4), pulse("boss_entrance", kills=2, boss="crowking")))
    out.append(beat(s(5), pulse("boss_fight", kills=3, boss="crowking", hp=4), [event(4, s(5), "SKELETON_KILLED"), trace_event(5, s(5))]))
    out.append(beat(s(6), pulse("playing", kills=3)))
    out.append(beat(s(7), pulse("boss_fight", kills=5, boss="crowking", hp=1)))
    out.append(alarm(s(8), p=pulse("boss_fight", kills=5, boss="crowking", hp=1)))
    out.append(beat(s(9), pulse("gameover", kills=5)))
    out.append(beat(s(50), pulse("menu"), vis="hidden"))
    out.append(err(s(51)))
    out.append(bye(s(52), [event(7, s(52), "BYE")]))
    return out


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    reference = landing.read_reference(spark, write_reference(root / "ref"))
    landing.land(landing.read_wire(spark, write_log(root / "in", game())), str(root / "raw"))
    made = lake.build(spark, landing.read_raw(spark, str(root / "raw")), reference)
    yield made, reference, root
    made.release()


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def built_from(spark, root, records, name="session-2026-08-30T10-00-00.000Z"):
    reference = landing.read_reference(spark, write_reference(root / "ref"))
    return lake.build(spark, landing.read_wire(spark, write_log(root / "in", records, name)), reference)


def test_every_relation_can_be_computed(built):
    made, _, _ = built
    for name, df in made.relations.items():
        assert df.count() >= 0, name


def test_run_and_outcome(built):
    run = built[0]["fact_run"].collect()
    assert len(run) == 1
    r = run[0]
    assert (r.run_seq, r.kills, r.kill_events, r.outcome, r.ended_on, r.hp_min, r.bosses_faced) == (1, 5, 3, "died", "gameover", 1, 1)
    assert (r.duration_s, r.sim_active_s) == (6.0, 6.0)  # the entrance holds 1 s outside the simulation; the last pulse 1 s after


def test_same_boss_parted_by_pulses_without_boss_is_one_encounter(built):
    assert rows(built[0]["fact_boss_encounter"], "boss_key", "kills_during", "outcome") == [("crowking", 3, "died")]


def test_bursts_and_streaks(built):
    assert rows(built[0]["kill_bursts"], "kills", "span_ms") == [(1, 0), (2, 30)]
    assert rows(built[0]["kill_streaks"], "kills") == [(1,), (2,)]


def test_gap_is_explained_by_the_hidden_tab(built):
    assert rows(built[0]["srv_gaps"], "gap_s", "prev_vis", "vis") == [(41.0, "visible", "hidden")]
    assert rows(built[0]["gap_explained"], "explanation", "gaps") == [("tab hidden, machine likely asleep", 1)]


def test_spans_from_alarm_and_text(built):
    assert rows(built[0]["spans"].groupBy("origin").count(), "origin", "count") == [("alarm_trace", 6), ("beat_trace", 2)]
    assert rows(built[0]["spans"].where("origin = 'beat_trace'"), "span", "ms", "ms_max", "frames") == [("hud", 0.02, 0.7, 120), ("sim", 0.01, 0.7, 120)]


def test_loss_counts_missing_ids(built):
    r = built[0]["loss_accounting"].first()
    assert (r.events_received, r.ids_expected, r.events_lost_by_id_gap) == (6, 7, 1)


def test_funnel_keeps_zero_steps(built):
    assert [tuple(r) for r in built[0]["run_funnel"].orderBy("step_seq").select("runs").collect()] == [(1,), (1,), (1,), (0,), (0,), (0,)]


def test_errors_name_frame_and_place(built):
    assert rows(built[0]["error_report"], "top_frame", "top_location") == [("Loop.tick", "loop.ts:67:30")]


def test_orphan_is_quarantined_and_counts_reconcile(spark, tmp_path):
    made = built_from(spark, tmp_path, [bye(T0), hello(T0 + 10), beat(T0 + 1000), bye(T0 + 2000)])
    assert rows(made["quarantine"], "relation", "reason") == [("landed", "orphan_record_no_hello")]
    r = made["contract_reconciliation"].first()
    assert (r.landed_records, r.clean_records, r.quarantined_records, r.reconciles) == (4, 3, 1, True)
    made.release()


def test_rules_report_and_keep(spark, tmp_path):
    many = [event(i, T0, "X") for i in range(401)]
    made = built_from(spark, tmp_path, [hello(T0, href="http://elsewhere.example/x"), beat(T0 + 1, pulse("flying")), beat(T0 + 2, pulse(None)), beat(T0 + 3, events=many), alarm(T0 + 4, "odd"), beat(T0 + 5, pulse(boss="nobody", mode="x", char="y"))])
    assert [x[0] for x in rows(made["quarantine"], "reason")] == sorted(["origin_not_in_reference", "state_not_in_contract", "events_per_beat_over_cap", "alarm_class_not_in_contract", "boss_not_in_contract", "mode_not_in_contract", "char_not_in_contract"])
    assert made["clean"].count() == 6
    made.release()


def test_null_srv_is_srv_missing_and_not_orphan(spark, tmp_path):
    records = [hello(T0), beat(T0 + 1000)]
    made = built_from(spark, tmp_path, [*records, {**beat(T0), "srv": None}])
    assert rows(made["quarantine"], "reason") == [("srv_missing",)]
    assert made["contract_reconciliation"].first().reconciles
    made.release()


def test_null_srv_without_hello_breaks_two_rules_and_counts_once(spark, tmp_path):
    made = built_from(spark, tmp_path, [{**beat(T0), "srv": None}])
    assert len(rows(made["quarantine"], "reason")) == 2
    r = made["contract_reconciliation"].first()
    assert (r.quarantined_records, r.reconciles) == (1, True)
    made.release()


def test_two_clients_interleave_in_one_file(spark, tmp_path):
    made = built_from(spark, tmp_path, [hello(T0, cid="a"), hello(T0 + 5, cid="b"), beat(T0 + 1000, cid="a"), beat(T0 + 1005, cid="b")])
    assert rows(made["clean"], "client_id", "kind", "page_load_seq") == [("a", "beat", 1), ("a", "hello", 1), ("b", "beat", 2), ("b", "hello", 2)]
    made.release()


def test_old_and_new_format_in_one_file(spark, tmp_path):
    made = built_from(spark, tmp_path, [hello(T0), beat(T0 + 1000), hello(T0 + 10_000, cid="cid-m1x2y3-ab12cd34"), beat(T0 + 11_000, cid="cid-m1x2y3-ab12cd34")])
    assert rows(made["sessions"], "page_load_seq", "has_native_client_id") == [(1, False), (2, True)]
    made.release()


def test_unknown_field_is_kept_and_malformed_line_is_quarantined(spark, tmp_path):
    made = built_from(spark, tmp_path, [hello(T0), {**beat(T0 + 1), "novel": {"x": 1}}, "{broken"])
    assert "novel" in made["clean"].columns
    assert ("malformed_json",) in rows(made["quarantine"], "reason")
    assert made["contract_reconciliation"].first().reconciles
    made.release()


def test_opt_in_rules(spark, tmp_path):
    reference = landing.read_reference(spark, write_reference(tmp_path / "ref"))
    raw = landing.read_wire(spark, write_log(tmp_path / "in", [hello(T0), {**beat(T0 + 1), "raf": None, "vis": "ajar"}]))
    found = typed.quarantine(typed.landed(raw), reference, strict=True)
    assert rows(found, "reason", "detail") == [("required_field_missing", "beat.raf"), ("visibility_not_in_contract", "vis=ajar")]


def test_state_reclassified_before_or_after_the_facts(spark, tmp_path):
    base = "menu,false,false,n,2026-07-19T22:24:09Z,"
    for change, runs in (("2026-08-01T00:00:00Z", 0), ("2027-01-01T00:00:00Z", 1)):
        states = [base, f"playing,true,true,n,2026-07-19T22:24:09Z,{change}", f"playing,false,false,n,{change},"]
        reference = landing.read_reference(spark, write_reference(tmp_path / f"ref{runs}", states))
        raw = landing.read_wire(spark, write_log(tmp_path / "in", [hello(T0), beat(T0 + 1, pulse("menu")), beat(T0 + 1000), beat(T0 + 2000)]))
        made = lake.build(spark, raw, reference)
        assert made["fact_run"].count() == runs
        assert quality.bad_history(made["dim_app_state"], ["state_key"]).count() == 0
        made.release()


def test_raw_layer_reads_back_by_partition(built, spark):
    raw = landing.read_raw(spark, str(built[2] / "raw"))
    assert dict(raw.dtypes)["session_id"] == "string" and raw.count() == 13
    assert rows(raw.select("session_id").distinct(), "session_id") == [("2026-08-30T10-00-00.000Z",)]


def test_newest_session_is_the_last_name_and_an_empty_source_raises(spark):
    two = spark.createDataFrame([("a", 1), ("b", 0)], "session_id string, srv long")
    assert rows(landing.newest_session(two), "session_id") == [("b",)]
    with pytest.raises(ValueError):
        landing.newest_session(two.limit(0))


def test_a_missing_or_ambiguous_cap_raises():
    assert cap("events_per_beat") == 400
    with pytest.raises(LookupError):
        cap("nothing")
    with pytest.raises(LookupError):
        cap("events_per_beat", (*CAPS, ("events_per_beat", 500, "2027-01-01T00:00:00Z", None)))


def test_pure_text_of_context(built):
    r = built[0]["session_context"].first()
    assert (r.alarm_classes, r.error_messages) == (["no-frames"], ["boom"])
    assert json.loads(built[0]["session_context"].select(F.to_json(F.struct("*"))).first()[0])["errors"] == 1
