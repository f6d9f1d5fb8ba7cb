"""Timelines and as-of lookups against plain Python."""

from __future__ import annotations

import datetime as dt
import random

from schoolyard.operators import as_of, versions

DAY = dt.timedelta(days=1)
START = dt.date(2024, 1, 1)
SNAPSHOT = "who string, day date, last date, state string, id string"


def plain_versions(rows):
    """Versions by walking each entity's days in order."""
    found = []
    for who in sorted({r[0] for r in rows if r[0] is not None}):
        own = [r for r in rows if r[0] == who and r[1] is not None and (r[2] is None or r[2] >= r[1])]
        daily = {}
        for _, day, last, state, ident in sorted(own, key=lambda r: r[4]):
            daily[day] = (state, last + DAY if last else None)
        days = sorted(daily)
        open_one = None
        for i, day in enumerate(days):
            state, end = daily[day]
            nexts = days[i + 1] if i + 1 < len(days) else None
            until = min((x for x in (nexts, end) if x), default=None)
            if open_one and open_one[2] == state and open_one[4] == day:
                open_one[4] = until
                continue
            open_one = [who, (open_one[1] + 1 if open_one else 1), state, day, until]
            found.append(open_one)
    return [tuple(v) for v in found]


def drawn(seed: int):
    draw = random.Random(seed)
    rows = []
    for i in range(400):
        day = START + draw.randrange(200) * DAY
        last = draw.choice([None, day + draw.randrange(-3, 60) * DAY])
        rows.append((draw.choice(["a", "b", "c", "d", None]), day, last, draw.choice(["x", "y", None]), f"i{i:03}"))
    return rows + [("e", None, None, "x", "j1"), ("f", START, None, None, "j2")]


def test_versions_equal_a_walk_over_the_days(spark):
    for seed in range(3):
        rows = drawn(seed)
        got = versions(spark.createDataFrame(rows, SNAPSHOT).repartition(5), "who", "day", ["state"], "id", ends="last")
        assert sorted(
            (r.who, r.version, r.state, r.valid_from, r.valid_to) for r in got.collect()
        ).__repr__() == sorted(plain_versions(rows), key=lambda v: v[:2]).__repr__()


def test_changes_ties_gaps_and_open_ends(spark):
    d = [START + i * DAY for i in range(20)]
    rows = [
        ("a", d[0], None, "x", "1"), ("a", d[0], None, "y", "2"),  # a tie: the higher id counts
        ("a", d[3], None, "y", "3"),  # no change
        ("a", d[5], d[7], "z", "4"),  # ends
        ("a", d[10], None, "z", "5"),  # the same state after a gap is a version of its own
    ]
    got = versions(spark.createDataFrame(rows, SNAPSHOT), "who", "day", ["state"], "id", ends="last")
    assert [tuple(r)[1:] for r in got.orderBy("version").collect()] == [
        (1, "y", d[0], d[5], False), (2, "z", d[5], d[8], False), (3, "z", d[10], None, True)
    ]
    assert versions(got.limit(0).withColumnsRenamed({"valid_from": "day", "valid_to": "last"}), "who", "day", ["state"], "version").count() == 0


def test_as_of_picks_the_version_valid_on_the_day(spark):
    rows = drawn(7)
    timeline = plain_versions(rows)
    draw = random.Random(8)
    facts = [
        (i, draw.choice(["a", "b", "c", "d", "e", "f", "g", None]), draw.choice([None, START + draw.randrange(-40, 500) * DAY]))
        for i in range(600)
    ]
    frame = versions(spark.createDataFrame(rows, SNAPSHOT), "who", "day", ["state"], "id", ends="last")
    got = as_of(spark.createDataFrame(facts, "n int, who string, on date"), "who", "on", frame, ["state"], ["n"])
    want = []
    for n, who, on in facts:
        held = [v for v in timeline if v[0] == who and on and v[3] <= on and (v[4] is None or on < v[4])]
        want.append((n, who, on, held[0][2] if held else None, held[0][3] if held else None))
    assert sorted(tuple(r) for r in got.collect()).__repr__() == sorted(want, key=lambda r: r[0]).__repr__()
