"""Builders of small session logs and reference files."""

import json
from pathlib import Path

T0 = 1788100000000


def pulse(state="playing", **more):
    base = dict(state=state, mode="brawl", map="harbour", char="archer", t=2.5, lastTs=4, live=True, held=0, hp=12, kills=0, crows=0, skels=0, soldiers=0, arrows=0, boss=None)
    return base | more


def event(id, at, message, source="EventBus", **data):
    return {"id": id, "level": "debug", "timestamp": at, "source": source, "message": message, "data": data, "code": None}


def hello(at, href="http://localhost/", ua="Chrome", cid=None):
    return with_cid({"kind": "hello", "srv": at, "wall": at - 2, "href": href, "ua": ua, "dpr": 1}, cid)


def beat(at, p=None, events=(), vis="visible", cid=None, **more):
    return with_cid({"kind": "beat", "srv": at, "wall": at - 3, "perf": 1, "raf": 1, "vis": vis, "pulse": p or pulse(), "events": list(events), "dropped": 0} | more, cid)


def bye(at, events=(), cid=None):
    return with_cid({"kind": "bye", "srv": at, "wall": at - 1, "events": list(events)}, cid)


def err(at, msg="boom", stack="Error: boom\n    at Loop.tick (http://localhost/src/sim/loop.ts:67:30)", cid=None):
    return with_cid({"kind": "err", "srv": at, "wall": at, "msg": msg, "stack": stack, "events": []}, cid)


def alarm(at, klass="no-frames", cid=None, p=None):
    section = {"ms": 0.5, "msMax": 1.5, "fillRect": 0, "drawImage": 0, "fill": 0, "stroke": 0, "px": 0}
    blockers = {"frozen": 0, "charging": False, "dashing": 0, "buried": False, "snipeKeyHeld": False, "snipeKeyName": "Shift", "heldKeys": ["a", "b"], "x": 1, "y": 2, "state": "playing", "char": "archer", "map": "forest"}
    trace = {"level": "time", "frames": 119, "spans": {s: section for s in ("sim", "tiles", "fog", "bodies", "vignette", "hud")}}
    return with_cid({"kind": "alarm", "class": klass, "srv": at, "wall": at, "perf": 1, "pulse": p or pulse(), "blockers": blockers, "trace": trace, "events": []}, cid)


def with_cid(record, cid):
    return record | ({"cid": cid} if cid else {})


def trace_event(id, at, frames=120, lines=None):
    rows = lines if lines is not None else [f"{s:<10} 0.0{i}ms   max 0.70     0 fill    0 img   0.00Mpx" for i, s in enumerate(("sim", "hud"), 1)]
    return {"id": id, "level": "debug", "timestamp": at, "source": "trace", "message": f"{frames} frames", "data": {"map": "forest", "rows": rows}, "code": None}


def write_log(folder, records, name="session-2026-08-30T10-00-00.000Z"):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / f"{name}.jsonl").write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
    return str(folder)


STATES = {"menu": (False, False), "charselect": (False, False), "playing": (True, True), "stage_intro": (False, True), "boss_entrance": (False, True), "boss_fight": (True, True), "paused": (False, True), "chooser": (False, True), "talents": (False, True), "gameover": (False, False), "win": (False, False)}


def write_reference(folder, states=None):
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    since = "2026-07-19T22:24:09Z,"
    rows = states or [f"{s},{str(a).lower()},{str(b).lower()},note,{since}" for s, (a, b) in STATES.items()]
    (folder / "app_states.csv").write_text("\n".join(["state,is_run_state,in_run,note,valid_from,valid_to", *rows]) + "\n")
    (folder / "characters.csv").write_text("\n".join(["char,note,valid_from,valid_to", *[f"{c},n,{since}" for c in ("archer", "wizard")]]) + "\n")
    (folder / "boss_kinds.csv").write_text("\n".join(["boss,note,valid_from,valid_to", *[f"{c},n,{since}" for c in ("crowking", "minotaur")]]) + "\n")
    (folder / "modes.csv").write_text("mode,note\nbrawl,a\nwaves,b\n")
    (folder / "origins.csv").write_text("origin,kind,may_publish,note\nhttp://localhost,local,true,a\nhttp://localhost:8090,local,false,b\nhttp://masked.invalid,masked,true,c\n")
    return str(folder)
