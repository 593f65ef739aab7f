"""All relations of the lake from its raw records, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from spanlake.plans import consumers, curated, gold, typed
from spanlake.sources.contract import caps_table
from spanlake.sources.landing import Reference, current

#: Relations that are published, in this order.
PUBLISHED = (
    "session_summary", "sessions", "frame_time_by_span", "spans", "alarms_by_class", "clock_skew", "srv_gaps", "gap_explained", "loss_accounting",
    "dimension_coverage", "error_report", "session_context", "quarantine", "incident_timeline", "contract_reconciliation", "warehouse_manifest",
    "fact_run", "fact_boss_encounter", "game_summary", "character_usage", "boss_encounters_by_kind", "run_outcomes", "contract_cap_history",
    "app_state_history", "reference_history", "reference_governance", "run_pulse", "run_scorecard", "run_kill_events", "kill_bursts", "kill_streaks",
    "kill_reconciliation", "run_funnel", "character_combat",
)
#: The layer of each relation that is not gold.
LAYERS = {"sessions": "typed", "spans": "typed", "quarantine": "typed", "contract_reconciliation": "typed"} | dict.fromkeys(PUBLISHED[:1] + PUBLISHED[2:3] + PUBLISHED[4:12] + PUBLISHED[13:14] + PUBLISHED[15:16], "curated")


@dataclass
class Lake:
    """relations by name; `held` are those kept in memory or on disk while a job uses them several times."""

    relations: dict[str, DataFrame]
    held: list[DataFrame] = field(default_factory=list)

    def __getitem__(self, name: str) -> DataFrame:
        return self.relations[name]

    def published(self) -> dict[str, DataFrame]:
        return {name: self.relations[name] for name in PUBLISHED}

    def release(self) -> None:
        for rows in self.held:
            rows.unpersist()


def build(spark: SparkSession, raw: DataFrame, reference: Reference, caps: DataFrame | None = None, strict: bool = False) -> Lake:
    """Every relation. Landed records and run pulses feed many plans and are persisted (memory, then disk)."""
    caps = caps_table(spark) if caps is None else caps
    r: dict[str, DataFrame] = {}
    r["landed"] = typed.landed(raw).persist()
    r["quarantine"] = typed.quarantine(r["landed"], reference, strict)
    clean = r["clean"] = typed.clean(r["landed"])
    r["contract_reconciliation"] = typed.reconciliation(r["landed"], r["quarantine"])
    r["quarantine_summary"] = typed.quarantine_summary(r["quarantine"])
    r["sessions"] = typed.sessions(clean, reference)
    for name in ("beats", "pulses", "events", "alarms", "blockers", "errors", "spans"):
        r[name] = getattr(typed, name)(clean)
    r["session_summary"] = curated.session_summary(r["sessions"], r["pulses"])
    r["frame_time_by_span"] = curated.frame_time_by_span(r["spans"])
    r["alarms_by_class"] = curated.alarms_by_class(r["alarms"], r["blockers"], r["pulses"])
    r["clock_skew"] = curated.clock_skew(clean, r["sessions"])
    r["srv_gaps"] = curated.srv_gaps(clean)
    r["gap_explained"] = curated.gap_explained(r["srv_gaps"])
    r["loss_accounting"] = curated.loss_accounting(r["events"], r["beats"])
    documented = {"state": current(reference.states), "mode": reference.modes, "char": current(reference.characters), "boss": current(reference.bosses)}
    r["dimension_coverage"] = curated.dimension_coverage(r["pulses"], documented)
    r["error_report"] = curated.error_report(r["errors"])
    r["session_context"] = curated.session_context(r["session_summary"], r["alarms"], r["errors"])
    r["incident_timeline"] = curated.incident_timeline(clean)
    r["warehouse_manifest"] = curated.warehouse_manifest(clean, r["alarms_by_class"], r["error_report"], r["srv_gaps"], r["frame_time_by_span"])
    states = r["dim_app_state"] = gold.dim_app_state(reference)
    members = r["dim_member"] = gold.dim_member(reference)
    caps = r["dim_contract_cap"] = gold.dim_contract_cap(caps)
    r["dim_character"], r["dim_boss"] = gold.dim_current(members, "character", "character_key"), gold.dim_current(members, "boss", "boss_key")
    r["app_state_history"], r["reference_history"], r["contract_cap_history"] = gold.history(states), gold.history(members), gold.history(caps)
    r["reference_governance"] = gold.reference_governance(members, states, caps)
    pulses = gold.run_pulse(r["pulses"], states).persist()
    r["run_pulse"] = pulses.drop("next_state")
    r["run_events"] = gold.run_events(r["events"], pulses)
    kills = r["run_kill_events"] = gold.run_kill_events(r["run_events"])
    runs = r["fact_run"] = gold.fact_run(pulses, kills)
    r["fact_boss_encounter"] = gold.fact_boss_encounter(pulses)
    r["game_summary"] = gold.game_summary(runs, pulses)
    r["character_usage"] = gold.character_usage(r["dim_character"], runs)
    r["boss_encounters_by_kind"] = gold.boss_encounters_by_kind(r["dim_boss"], r["fact_boss_encounter"])
    r["run_outcomes"] = gold.run_outcomes(runs)
    r["run_scorecard"] = gold.run_scorecard(runs, pulses)
    r["kill_bursts"], r["kill_streaks"] = gold.kill_bursts(kills), gold.kill_streaks(kills)
    r["kill_reconciliation"] = gold.kill_reconciliation(runs)
    r["run_funnel"] = gold.run_funnel(pulses)
    r["character_combat"] = gold.character_combat(r["run_events"], runs)
    r["leaders"] = consumers.leaders(r["run_scorecard"])
    r["replay"] = consumers.replay(pulses)
    r["burst_shares"] = consumers.burst_shares(r["kill_bursts"], r["kill_streaks"])
    r["kills_by_burst_size"] = consumers.kills_by_burst_size(r["kill_bursts"])
    r["bursts_by_character"] = consumers.bursts_by_character(r["kill_bursts"])
    r["agreement"] = consumers.agreement(r["kill_reconciliation"])
    r["funnel_percent"] = consumers.funnel_percent(r["run_funnel"])
    r["miss_rate"] = consumers.miss_rate(r["character_combat"])
    r["boss_totals"] = consumers.boss_totals(r["boss_encounters_by_kind"])
    return Lake(r, [r["landed"], pulses])
