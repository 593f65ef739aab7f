"""Dimensions with history, runs, encounters, and the metrics over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.functions.expr import first_by, instant, last_by, ratio, seconds
from spanlake.operators import ranges, windows
from spanlake.operators.joins import as_of, within_dyadic
from spanlake.sources.landing import Reference

LOAD = ["session_id", "page_load_seq"]
SLACK_MS = 1_500
#: Event names.
KILLS = ("CROW_KILLED", "SKELETON_KILLED")
SHOTS = ("WEAPON_FIRED", "ICE_BOLT_FIRED")
#: What the state after a run or a fight says about its end.
RUN_ENDS = {"gameover": "died", "win": "won", "menu": "left to menu"}
FIGHT_ENDS = {"talents": "progressed", "chooser": "progressed", "stage_intro": "progressed", "gameover": "died", "win": "won"}
FUNNEL = (("started a run", None), ("reached the boss entrance", ("boss_entrance",)), ("fought the boss", ("boss_fight",)), ("reached a reward screen", ("chooser", "talents")), ("entered a second stage", ("stage_intro",)), ("won", ("win",)))


def _told(value: Column, table: dict[str, str], otherwise: str) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in table.items():
        out = out.when(value == k, v)
    return out.otherwise(otherwise)


# dimensions


def dim_app_state(reference: Reference) -> DataFrame:
    rows = windows.version_sequence(reference.states, ["state"])
    return rows.select(F.col("state").alias("state_key"), "is_run_state", "in_run", F.col("note").alias("description"), "version_seq", "valid_from", "valid_to", "is_current")


def dim_member(reference: Reference) -> DataFrame:
    part = lambda rows, name, key: rows.select(F.lit(name).alias("dimension"), F.col(key).alias("member_key"), F.col("note").alias("description"), "valid_from", "valid_to")
    rows = part(reference.characters, "character", "char").unionByName(part(reference.bosses, "boss", "boss"))
    return windows.version_sequence(rows, ["dimension", "member_key"])


def dim_current(members: DataFrame, dimension: str, key: str) -> DataFrame:
    return members.where((F.col("dimension") == dimension) & F.col("is_current")).select(F.col("member_key").alias(key), "description")


def dim_contract_cap(caps: DataFrame) -> DataFrame:
    return windows.version_sequence(caps, ["cap_key"])


def history(versions: DataFrame) -> DataFrame:
    return versions.withColumn("status", F.when(F.col("is_current"), "in force").otherwise("superseded"))


def governance(versions: DataFrame) -> DataFrame:
    """Per dimension and in total, from one scan: versions has dimension, member_key, version_seq, valid_from, is_current."""
    member = F.col("member_key")
    rolled = versions.groupingSets([[F.col("dimension")], []], F.col("dimension")).agg(
        F.grouping("dimension").cast("int").alias("is_total"), F.countDistinct(member).cast("int").alias("members"),
        F.countDistinct(F.when(F.col("is_current"), member)).cast("int").alias("members_in_force"), F.count("*").cast("int").alias("versions"),
        F.count_if(~F.col("is_current")).cast("int").alias("superseded"), F.max("version_seq").alias("deepest_history"), F.min("valid_from").alias("first_valid_from"), F.max("valid_from").alias("last_change"),
    )
    return rolled.withColumn("dimension", F.coalesce("dimension", F.lit("every dimension"))).drop("is_total")


def reference_governance(members: DataFrame, states: DataFrame, caps: DataFrame) -> DataFrame:
    part = lambda rows, name, key: rows.select(F.lit(name).alias("dimension"), F.col(key).alias("member_key"), "version_seq", "valid_from", "is_current")
    rows = members.select("dimension", "member_key", "version_seq", "valid_from", "is_current").unionByName(part(states, "app state", "state_key")).unionByName(part(caps, "contract cap", "cap_key"))
    return governance(rows)


# runs


def labelled(pulses: DataFrame, states: DataFrame) -> DataFrame:
    """Pulses with the state version in force when they arrived, how long they held and the state after them.

    The state after comes from all pulses, the time held from those that found a version: a pulse of an
    unknown state lends its time to the one before."""
    after = windows.with_next(pulses, "state", LOAD, "srv", "next_state")
    versions = states.select("state_key", "in_run", "is_run_state", "valid_from", "valid_to")
    joined = as_of(after, versions, F.col("state") == F.col("state_key"), instant("srv"))
    return joined.withColumn("held_s", seconds(windows.held_time("srv", LOAD)))


def run_pulse(pulses: DataFrame, states: DataFrame) -> DataFrame:
    """Pulses within runs: a run begins where the state enters the run states, within one page load."""
    runs = windows.islands_by_flag(labelled(pulses, states), "in_run", LOAD, "srv", "run_seq")
    run_id = F.concat("session_id", F.lit("#"), "page_load_seq", F.lit("/"), "run_seq")
    return runs.select(
        run_id.alias("run_id"), *LOAD, "run_seq", "client_id", "srv", "state", F.col("char").alias("character_key"), F.col("mode").alias("mode_key"), "map",
        F.col("boss").alias("boss_key"), "kills", "hp", "in_run", "is_run_state", "held_s", "next_state",
    )


def run_events(events: DataFrame, pulses: DataFrame) -> DataFrame:
    runs = pulses.groupBy("run_id", *LOAD, "character_key").agg(F.min("srv").alias("s0"), F.max("srv").alias("s1"))
    found = within_dyadic(events.select(*LOAD, "message", F.col("timestamp").alias("ts")), runs, LOAD, "ts", "s0", "s1", SLACK_MS)
    return found.select("run_id", "character_key", "message", "ts")


def run_kill_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("message").isin(*KILLS))


def active_s() -> Column:
    return F.round(F.sum(F.when(F.col("is_run_state"), F.col("held_s")).otherwise(0.0)), 1)


def fact_run(pulses: DataFrame, kill_events: DataFrame) -> DataFrame:
    srv = F.col("srv")
    first, last = lambda c: first_by(F.col(c), srv), lambda c: last_by(F.col(c), srv)
    runs = pulses.groupBy("run_id", *LOAD, "run_seq", "client_id").agg(
        first("character_key").alias("character_key"), first("mode_key").alias("mode_key"), F.countDistinct("map").alias("maps_visited"), first("map").alias("first_map"), last("map").alias("last_map"),
        F.min(srv).alias("started_srv"), F.max(srv).alias("ended_srv"), F.round(seconds(F.max(srv) - F.min(srv)), 1).alias("duration_s"), active_s().alias("sim_active_s"),
        F.max("kills").alias("kills"), first("hp").alias("hp_first"), F.min("hp").alias("hp_min"), last("hp").alias("hp_last"),
        F.countDistinct("state").alias("states_visited"), F.countDistinct("boss_key").alias("bosses_faced"), F.max_by("next_state", srv).alias("__after"),
    )
    counted = kill_events.groupBy("run_id").agg(F.count("*").cast("int").alias("kill_events"))
    out = runs.join(counted, "run_id", "left")
    after = F.col("__after")
    named = {"kill_events": F.coalesce("kill_events", F.lit(0)), "ended_on": F.coalesce(after, F.lit("no further state")), "outcome": _told(after, RUN_ENDS, "unresolved, page load ended first")}
    return out.withColumns(named).drop("__after")


def fact_boss_encounter(pulses: DataFrame) -> DataFrame:
    """Blocks of pulses against one boss. Pulses without a boss are left out first, so two fights with the same boss
    that only such pulses part are one encounter."""
    blocks = windows.islands_by_value(pulses.where("boss_key IS NOT NULL"), "boss_key", ["run_id"], "srv", "encounter_seq")
    srv = F.col("srv")
    found = blocks.groupBy("run_id", "encounter_seq").agg(
        *[F.first(c).alias(c) for c in LOAD], F.first("boss_key").alias("boss_key"), first_by(F.col("character_key"), srv).alias("character_key"), F.min(srv).alias("started_srv"), F.max(srv).alias("ended_srv"),
        F.round(seconds(F.max(srv) - F.min(srv)), 1).alias("duration_s"), active_s().alias("sim_active_s"), (F.max("kills") - F.min("kills")).alias("kills_during"), F.min("hp").alias("hp_min"),
        F.max_by("next_state", srv).alias("__after"),
    )
    after = F.col("__after")
    return found.select(
        F.concat("run_id", F.lit("/b"), "encounter_seq").alias("encounter_id"), "run_id", *LOAD, "boss_key", "character_key", "started_srv", "ended_srv", "duration_s", "sim_active_s", "kills_during", "hp_min",
        F.coalesce(after, F.lit("no further state")).alias("next_state"), _told(after, FIGHT_ENDS, "unresolved").alias("outcome"),
    )


# metrics


def game_summary(runs: DataFrame, pulses: DataFrame) -> DataFrame:
    r1 = lambda c: F.round(c, 1)
    out = runs.agg(
        F.count("*").alias("runs"), F.countDistinct("character_key").alias("characters_played"), r1(F.sum("duration_s")).alias("total_wall_s"), r1(F.sum("sim_active_s")).alias("total_sim_s"),
        r1(F.avg("duration_s")).alias("avg_run_wall_s"), r1(F.avg("sim_active_s")).alias("avg_run_sim_s"), F.max("duration_s").alias("max_run_wall_s"), F.min("kills").alias("min_kills"), F.max("kills").alias("max_kills"), r1(F.avg("kills")).alias("avg_kills"),
    )
    return out.crossJoin(pulses.agg(F.countDistinct("map").alias("maps_played")))  # a row each


def usage(members: DataFrame, facts: DataFrame, key: str, **measures: Column) -> DataFrame:
    """Measures of each member, also of those that no fact names."""
    return members.join(facts, key, "left").groupBy(key, "description").agg(*[c.alias(n) for n, c in measures.items()])


def character_usage(members: DataFrame, runs: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(c, F.lit(0))
    return usage(members, runs.select("character_key", "run_id", "sim_active_s", "kills"), "character_key", runs=F.count("run_id"), sim_active_s=F.round(zero(F.sum("sim_active_s")), 1), best_kills=zero(F.max("kills")), avg_kills=F.round(zero(F.avg("kills")), 1))


def boss_encounters_by_kind(members: DataFrame, encounters: DataFrame) -> DataFrame:
    counted = {o: F.count_if(F.col("outcome") == o) for o in ("progressed", "died", "won", "unresolved")}
    return usage(members, encounters.select("boss_key", "encounter_id", "outcome", "sim_active_s"), "boss_key", encounters=F.count("encounter_id"), **counted, sim_active_s=F.round(F.coalesce(F.sum("sim_active_s"), F.lit(0.0)), 1))


def run_outcomes(runs: DataFrame) -> DataFrame:
    return runs.groupBy("outcome").agg(F.count("*").alias("runs"), F.round(F.avg("duration_s"), 1).alias("avg_wall_s"), F.round(F.avg("sim_active_s"), 1).alias("avg_sim_s"), F.max("kills").alias("best_kills"))


def global_rank(rows: DataFrame, order: list[tuple[str, bool]], out: str = "rank", parts: int | None = None) -> DataFrame:
    """SQL's rank() over all rows without one task that sorts them all. order: (column, descending).

    The distinct order values are dealt by ranges with how often each occurs; the rows before a value are counted from range to range."""
    names = [c for c, _ in order]
    values = rows.groupBy(*[F.col(c).alias(f"__{c}") for c in names]).agg(F.count("*").alias("__n"))
    counted = ranges.deal(values, [], *[(f"__{c}", down) for c, down in order], parts=parts).scan(__before=ranges.total(F.col("__n"), inclusive=False)).rows()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names]
    return rows.join(counted, same).select(*rows.columns, (F.col("__before") + 1).cast("int").alias(out))


def run_scorecard(runs: DataFrame, pulses: DataFrame) -> DataFrame:
    """Each run's rank, rate and marks: how long into it a kill, 50 kills and a boss fight first came, and the most kills that one pulse added."""
    srv, kills = F.col("srv"), F.col("kills")
    into = lambda reached: F.round(seconds(F.min(F.when(reached, srv)) - F.min(srv)), 1)
    before = F.coalesce(F.lag("kills").over(windows.ordered(["run_id"], "srv")), F.lit(0))
    progress = pulses.withColumn("__gain", kills - before).groupBy("run_id").agg(
        into(kills >= 1).alias("t_first_kill_s"), into(kills >= 50).alias("t_50_kills_s"), into(F.col("state") == "boss_fight").alias("t_boss_s"), F.max("__gain").alias("max_kills_one_beat"), (F.max("hp") - F.min("hp")).alias("hp_lost"),
    )
    rate = F.round(ratio(kills * 60.0, F.col("sim_active_s")), 1).alias("kills_per_min")
    shown = ("character_key", "first_map", "maps_visited", "outcome", "kills", "kill_events", "duration_s", "sim_active_s")
    return global_rank(runs, [("kills", True), ("sim_active_s", False)], "rank_by_kills").join(progress, "run_id").select("rank_by_kills", "run_id", *shown, rate, "t_first_kill_s", "t_50_kills_s", "t_boss_s", "max_kills_one_beat", "hp_lost")


def kill_groups(kill_events: DataFrame, gap_ms: int) -> DataFrame:
    grouped = windows.gap_groups(kill_events, ["run_id"], "ts", gap_ms, "group_id")
    return grouped.groupBy("run_id", "character_key", "group_id").agg(F.count("*").cast("int").alias("kills"), (F.max("ts") - F.min("ts")).alias("span_ms"), F.min("ts").alias("started_ts"))


def kill_bursts(kill_events: DataFrame) -> DataFrame:
    return kill_groups(kill_events, 50)


def kill_streaks(kill_events: DataFrame) -> DataFrame:
    return kill_groups(kill_events, 1_000)


def kill_reconciliation(runs: DataFrame) -> DataFrame:
    diff = F.col("kill_events") - F.col("kills")
    return runs.select("run_id", "character_key", "maps_visited", F.col("kills").alias("counter_kills"), F.col("kill_events").alias("event_kills"), diff.alias("events_minus_counter"), (diff == 0).alias("agrees"))


def funnel(rows: DataFrame, who: str, steps: list[tuple[str, Column | None]], out: str) -> DataFrame:
    """Distinct members that reached each step, zeros too, in one pass."""
    counts = rows.agg(*[F.countDistinct(F.col(who) if c is None else F.when(c, F.col(who))).cast("int").alias(f"s{i}") for i, (_, c) in enumerate(steps)])
    each = F.array(*[F.struct(F.lit(n).alias("step"), F.lit(i + 1).alias("step_seq"), F.col(f"s{i}").alias(out)) for i, (n, _) in enumerate(steps)])
    return counts.select(F.inline(each))


def run_funnel(pulses: DataFrame) -> DataFrame:
    return funnel(pulses, "run_id", [(n, None if s is None else F.col("state").isin(*s)) for n, s in FUNNEL], "runs")


def character_combat(events: DataFrame, runs: DataFrame) -> DataFrame:
    of = lambda *names: F.count_if(F.col("message").isin(*names)).cast("int")
    counted = events.groupBy("character_key").agg(of(*SHOTS).alias("shots"), of("ARROW_MISS").alias("misses"), of(*KILLS).alias("kills"), of("PLAYER_HIT").alias("hits_taken"), of("PICKUP_TAKEN").alias("pickups"), of("BOSS_HIT").alias("boss_hits"))
    played = runs.groupBy("character_key").agg(F.sum("sim_active_s").alias("sim_s"), F.count("*").cast("int").alias("runs"))
    per_min = lambda c, n: F.round(ratio(F.col(c) * 60.0, F.col("sim_s")), n)
    return counted.join(played, "character_key").select(
        "character_key", "runs", "sim_s", "shots", "misses", "kills", F.round(ratio(F.col("kills"), F.col("shots")), 2).alias("kills_per_shot"), per_min("kills", 1).alias("kills_per_min"),
        "hits_taken", per_min("hits_taken", 2).alias("hits_taken_per_min"), "pickups", "boss_hits",
    )
