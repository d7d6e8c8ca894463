"""The state of the change detection. Runs in Python workers and imports nothing of this library."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEY = ["trip_id", "stop_id"]
STATE = ["schedule_relationship", "arrival_delay", "arrival_time", "departure_delay", "departure_time"]
ORDER = ["poll", "entity_pos", "entity_id", "stop_pos"]
FIELDS = ["betriebstag", "trip_id", "stop_id", "stop_sequence", *STATE, "observed_at"]
REPORT_TYPES = {"stop_sequence": "Int32", "arrival_delay": "Int32", "departure_delay": "Int32"} | {
    c: "Int64" for c in ("arrival_time", "departure_time", "observed_at", "emission")
}



class Changes(StatefulProcessor):
    """Change detection of one key, right for any order in which its polls arrive.

    The state holds the sightings of the newest polls in poll order, each with the number under which it was
    emitted, if it was. New rows are put in their places; then a row that differs from its
    predecessor and was not emitted is emitted, and one that was emitted but no longer differs is withdrawn
    under the same number. A row that is delivered again is recognised by its place. A row older than everything that is
    remembered cannot be placed; it is emitted rather than lost.
    """

    FIELDS = FIELDS

    def __init__(self, max_idle: int, late_polls: int, ttl_ms: int):
        self.max_idle, self.late_polls, self.ttl_ms = max_idle, late_polls, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seen", "seen string", ttlDurationMs=self.ttl_ms)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        seen = json.loads(held[0]) if held else {"next": None, "cut": False, "rows": []}
        found = pd.concat(list(rows))[[*ORDER, *self.FIELDS]].astype(object)
        fresh = [[None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in row] for row in found.itertuples(index=False, name=None)]
        out = pd.DataFrame(self.step(seen, fresh), columns=[*self.FIELDS, "emission", "withdrawn"])
        self.state.update((json.dumps(seen),))
        if len(out):
            for name, kind in REPORT_TYPES.items():
                out[name] = out[name].astype(kind)
            yield out

    def step(self, seen: dict, fresh: list[list]) -> list[list]:
        """Puts rows (order, report fields) into the state and returns what to emit and withdraw."""
        n, states = len(ORDER), [len(ORDER) + self.FIELDS.index(c) for c in STATE]
        rows, out = seen["rows"], []
        places = {tuple(r[:n]) for r, _ in rows}
        oldest = min(places, default=None) if seen["cut"] else None
        if seen["next"] is None:
            # numbers of a key that was forgotten and comes back do not meet its earlier ones
            seen["next"] = min(r[0] for r in fresh) << 24
        for row in sorted(fresh, key=lambda r: r[:n]):
            place = tuple(row[:n])
            if place in places:
                continue
            if oldest is not None and place < oldest:
                out.append([*row[n:], seen["next"], False])
                seen["next"] += 1
                continue
            places.add(place)
            rows.append([row, None])
        rows.sort(key=lambda r: r[0][:n])
        before = None
        for k, item in enumerate(rows):
            row, number = item
            changed = before is None or row[0] - before[0] > self.max_idle or any(row[c] != before[c] for c in states)
            if seen["cut"] and k == 0:
                changed = number is not None  # decided when its predecessor was still known
            if changed and number is None:
                item[1] = seen["next"]
                seen["next"] += 1
                out.append([*row[n:], item[1], False])
            elif not changed and number is not None:
                out.append([*row[n:], number, True])
                item[1] = None
            before = row
        keep = next(k for k, (row, _) in enumerate(rows) if row[0] >= before[0] - self.late_polls)
        if keep > 1:
            del rows[: keep - 1]
            seen["cut"] = True
        return out
