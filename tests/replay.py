"""Row-by-row replays of the reference's loops (the specification the set
forms are checked against).  Rows are dicts: k (key or None), v (data),
seq (batch order); stored rows add occ, active, created, updated."""

from __future__ import annotations


def _new(row, occ, ts, active=True):
    return dict(k=row["k"], v=row["v"], seq=row["seq"], occ=occ, active=active,
                created=ts, updated=ts)


def scd2(state, batch, ts):
    state = [dict(r) for r in state]
    m = dict(total=0, new=0, upd=0, unch=0, occ=0)
    for row in sorted(batch, key=lambda r: r["seq"]):
        m["total"] += 1
        k = row["k"]
        if k is not None:
            act = next((s for s in state if s["k"] == k and s["active"]), None)
            if act is not None:
                act["updated"] = ts
                if act["v"] == row["v"]:
                    m["unch"] += 1
                    continue
                act["active"] = False
                m["upd"] += 1
        occ = 1 if k is None else max([s["occ"] for s in state if s["k"] == k], default=0) + 1
        state.append(_new(row, occ, ts))
        m["new" if occ == 1 else "occ"] += 1
    return state, m


def version_set(state, batch, ts, roster=False):
    state = [dict(r) for r in state]
    m = dict(total=0, new=0, upd=0, unch=0, occ=0)
    if roster:
        for s in state:
            if s["active"]:
                s["active"] = False
                s["updated"] = ts
    for row in sorted(batch, key=lambda r: r["seq"]):
        m["total"] += 1
        k = row["k"]
        found = None
        if k is not None:
            for s in sorted((s for s in state if s["k"] == k), key=lambda s: s["occ"]):
                if s["v"] == row["v"]:
                    found = s
                    break
        if found is not None:
            found["updated"] = ts
            if roster:
                found["active"] = True
            m["unch"] += 1
            continue
        occ = 1 if k is None else max([s["occ"] for s in state if s["k"] == k], default=0) + 1
        state.append(_new(row, occ, ts, active=True if roster else None))
        m["new" if occ == 1 else "occ"] += 1
    if roster:
        m["deact"] = sum(1 for s in state if not s["active"])
    return state, m


def scd1(state, batch, ts):
    state = [dict(r) for r in state]
    m = dict(total=0, new=0, upd=0, unch=0, occ=0)
    for row in sorted(batch, key=lambda r: r["seq"]):
        m["total"] += 1
        k = row["k"]
        if k is not None:
            act = next((s for s in state if s["k"] == k and s["active"]), None)
            if act is not None:
                act["updated"] = ts
                if act["v"] == row["v"]:
                    m["unch"] += 1
                else:
                    act["v"], act["seq"] = row["v"], row["seq"]
                    m["upd"] += 1
                continue
        occ = 1 if k is None else max([s["occ"] for s in state if s["k"] == k], default=0) + 1
        state.append(_new(row, occ, ts))
        m["new" if occ == 1 else "occ"] += 1
    return state, m
