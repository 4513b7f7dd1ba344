"""Status intervals against plain Python on small and random event lists."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import defaultdict

import pytest

from loomline.operators import intervals

SCHEMA = "id bigint, machine string, status string, timestamp timestamp_ntz"
DAY = dt.timedelta(days=1)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def by_hand(events):
    """(date, machine) -> [running, stopped, changeover, disconnected, shutdown] seconds."""
    per_machine = defaultdict(list)
    for event_id, machine, status, ts in events:
        if None not in (machine, status, ts):
            per_machine[machine].append((ts, event_id, status))
    result = defaultdict(lambda: [0] * 5)
    names = list(intervals.STATUSES)

    def sec(x):
        return math.floor((x - dt.datetime(1970, 1, 1)) / dt.timedelta(seconds=1))

    for machine, rows in per_machine.items():
        rows.sort(key=lambda r: r[:2])
        for i, (start, _, status) in enumerate(rows):
            midnight = start.replace(hour=0, minute=0, second=0, microsecond=0)
            end = rows[i + 1][0] if i + 1 < len(rows) else midnight + DAY
            if end <= start:
                continue
            while midnight < end:
                a, b = max(start, midnight), min(end, midnight + DAY)
                off = 0
                if midnight.isoweekday() == 7:
                    off = max(0, sec(b) - max(sec(a), sec(midnight) + 19_800))
                elif midnight.isoweekday() == 1:
                    off = max(0, min(sec(b), sec(midnight) + 23_400) - sec(a))
                cell = result[(midnight.date(), machine)]
                if status in names:
                    cell[names.index(status)] += sec(b) - sec(a) - off
                cell[4] += off
                midnight += DAY
    return dict(result)


def fact(spark, events, **options):
    df = intervals.machine_status_daily_fact(spark.createDataFrame(events, SCHEMA), **options)
    return {(r["date"], r["machine"]): [round(h * 3600, 3) for h in r[2:]] for r in df.collect()}


EDGES = [
    (1, "A", "running", at("2024-01-05 10:00:00")), (2, "A", "stopped", at("2024-01-05 10:00:00")),
    (3, "A", "running", at("2024-01-06 00:00:00")), (4, "A", "changeover", at("2024-01-06 23:59:59.900000")),
    (5, "A", "disconnected", at("2024-01-09 01:00:00.100000")), (6, "B", "running", at("2024-01-07 04:00:00")),
    (7, "C", "running", at("2024-01-02 00:00:00.900000")), (8, "C", "stopped", at("2024-01-02 00:00:01.100000")),
    (9, "D", None, at("2024-01-02 03:00:00")), (10, "D", "idle", at("2024-01-08 01:00:00")), (11, None, "running", at("2024-01-02")),
]


def test_edge_events(spark):
    got = fact(spark, EDGES)
    assert got == by_hand(EDGES)
    assert got[(dt.date(2024, 1, 2), "C")][0] == 1  # boundaries crossed, not elapsed time
    assert (dt.date(2024, 1, 2), "D") not in got


@pytest.mark.parametrize("bucket", [60, 3_600, 86_400])
def test_random_events_for_every_bucket_width(spark, bucket):
    rng = random.Random(bucket)
    start = at("2023-12-28 00:00:00")
    events = [
        (i, rng.choice("ABC"), rng.choice([*intervals.STATUSES, "idle", None]), start + dt.timedelta(microseconds=rng.randrange(20 * 86_400) * 1_000_000 + rng.choice([0, 0, 250_000])))
        for i in range(400)
    ]
    assert fact(spark, events, bucket_seconds=bucket) == by_hand(events)


def test_row_level_path_gives_the_same_fact(spark):
    df = spark.createDataFrame(EDGES, SCHEMA)
    hours = intervals.status_hours(intervals.split_by_day(intervals.status_intervals(df)))
    slow = {tuple(r[:2]): [round(h, 9) for h in r[2:]] for r in intervals.pivot_status_hours(hours).collect()}
    fast = {tuple(r[:2]): [round(h, 9) for h in r[2:]] for r in intervals.machine_status_daily_fact(df).collect()}
    assert slow == fast


def test_one_machine_is_not_one_task(spark):
    """The wide shuffle is by machine and bucket, never by machine alone before the summary."""
    plan = intervals.machine_status_daily_fact(spark.createDataFrame(EDGES, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "bucket" in exchanges[-1] and len(exchanges) == 2


def test_bucket_must_divide_a_day(spark):
    with pytest.raises(ValueError):
        intervals.machine_status_daily_fact(spark.createDataFrame(EDGES, SCHEMA), bucket_seconds=7_000)
