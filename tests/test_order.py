"""De-duplication and continuity, against their definitions, on logs with hot keys and any choice of slices."""

import random

import pytest
from conftest import reading, typed_log
from pyspark.sql import functions as F

from tallywire.operators.continuity import classify_continuity, ordering_report, partition_spread
from tallywire.operators.dedup import mark_duplicates
from tallywire.operators.running import running
from tallywire.operators.skew import hot_keys, slice_number, splitters, with_slices
from tallywire.session import stage


def defined(readings, seen=(), last=None):
    """Status and missing of every record, each worked out by itself from the records before it."""
    first = {}
    for at, r in enumerate(readings):
        first.setdefault(r["eventId"], at)
    counts = [first[r["eventId"]] == at and r["eventId"] not in seen for at, r in enumerate(readings)]

    def judged(at):
        own = readings[at]
        if not counts[at]:
            return "duplicate", 0.0
        earlier = [r["sequence"] for r, c in zip(readings[:at], counts) if c and r["sensorId"] == own["sensorId"]]
        highest = max([0, (last or {}).get(own["sensorId"], 0), *earlier])
        step = own["sequence"] - highest
        if highest == 0 or step in (0, 1):
            return "accepted", 0.0
        return ("gap", float(step - 1)) if step > 1 else ("out_of_order", 0.0)

    return [judged(at) for at in range(len(readings))]


def random_log(seed, size=400):
    """A third of the records from one sensor, a third from one id."""
    rng = random.Random(seed)
    out = []
    for _ in range(size):
        sensor = "s0" if rng.random() < 1 / 3 else f"s{rng.randrange(1, 8)}"
        event = "again" if rng.random() < 1 / 3 else f"e{rng.randrange(size)}"
        out.append(reading(sensor, rng.randrange(-2, 60), eventId=event))
    return out


def statuses(df):
    return [(r.status, r.missing) for r in df.orderBy("partition", "offset").collect()]


@pytest.mark.parametrize("seed, rows", [(0, 16), (1, 50), (2, 10**6), (3, 1)])
def test_against_definition(spark, seed, rows):
    readings = random_log(seed)
    placed = classify_continuity(mark_duplicates(typed_log(spark, readings)), slice_rows=rows)
    assert statuses(placed) == defined(readings)


@pytest.mark.parametrize("rows", [16, 10**6])
def test_continues_from_earlier_batches(spark, rows):
    readings = random_log(9)
    seen, last = ["again", "e7", "e11", "e250"], {"s0": 30, "s3": 10, "unknown": 4}
    log = typed_log(spark, readings)
    ids = spark.createDataFrame([(i,) for i in seen], "event_id string")
    states = spark.createDataFrame([(k, float(v)) for k, v in last.items()] + [("s1", None)], "sensor_id string, last_sequence double")
    marked = mark_duplicates(log, seen=lambda asked: asked.join(ids, "event_id", "left_semi"))
    placed = classify_continuity(marked, last=states, slice_rows=rows)
    assert statuses(placed) == defined(readings, seen=seen, last=last)


def test_null_ids_and_null_sensors(spark):
    rows = [(None, None, 0, 1.0), (None, None, 1, 5.0), ("a", None, 2, 4.0), ("a", "s", 3, 9.0), (None, "s", 4, 3.0)]
    log = spark.createDataFrame(rows, "event_id string, sensor_id string, offset bigint, sequence double")
    placed = classify_continuity(mark_duplicates(log, ("offset",)), ("offset",))
    # Rows without an id are no duplicates of each other; rows without a sensor are a sensor of their own.
    assert [r.status for r in placed.orderBy("offset").collect()] == ["accepted", "gap", "out_of_order", "duplicate", "accepted"]


def test_plan_before_labelling_has_no_single_partition(spark):
    log = typed_log(spark, random_log(1))
    plan = classify_continuity(mark_duplicates(log))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_key_of_two_columns(spark):
    rows = [("s", "r1", 0, 1.0), ("s", "r2", 1, 7.0), ("s", "r1", 2, 2.0), ("s", None, 3, 1.0), ("s", "r2", 4, 6.0), ("s", None, 5, 4.0)]
    log = spark.createDataFrame(rows, "sensor_id string, run string, offset bigint, sequence double")
    placed = classify_continuity(log, ("offset",), key=("sensor_id", "run")).orderBy("offset").collect()
    assert [r.status for r in placed] == ["accepted", "accepted", "accepted", "accepted", "out_of_order", "gap"]


ORDERS = [("ts", "offset"), ("place", "offset"), ("place", "ts", "offset"), ("offset",), ("nothing", "offset")]


def hot_log(spark, seed=5, size=300):
    """A third of the rows at one time, a third under one text, half of them of one key."""
    rng = random.Random(seed)
    rows = []
    for offset in range(size):
        second = 100 if rng.random() < 1 / 3 else rng.randrange(20_000)
        place = "same" if rng.random() < 1 / 3 else rng.choice(["é", "a", "Z", None]) and f"{rng.choice('aZé')}{rng.randrange(90)}"
        rows.append(("k" if offset % 2 else f"k{offset % 7}", second, place, offset, float(rng.randrange(50))))
    df = spark.createDataFrame(rows, "key string, second bigint, place string, offset bigint, value double")
    return rows, df.withColumns({"ts": F.timestamp_seconds("second"), "nothing": F.lit(None).cast("string")}).repartition(3)


def sort_key(order):
    def key(row):
        held = {"ts": row[1], "place": (row[2] is not None, (row[2] or "").encode()), "offset": row[3], "nothing": 0}
        return tuple(held[c] for c in order)

    return key


@pytest.mark.parametrize("how", ["max", "sum"])
@pytest.mark.parametrize("order", ORDERS)
def test_running_under_any_order(spark, how, order):
    """Hot keys are cut by time, by text, by what comes after a hot value, and also where the first column is all null."""
    rows, df = hot_log(spark)
    got = running(df, "before", how, F.col("value"), "key", order, slice_rows=10)
    want, totals = {}, {}
    for key, _, _, offset, value in sorted(rows, key=sort_key(order)):
        want[offset] = totals.get(key)
        totals[key] = value if key not in totals else (max(totals[key], value) if how == "max" else totals[key] + value)
    assert {r.offset: r.before for r in got.collect()} == want


@pytest.mark.parametrize("order", ORDERS)
def test_slices_are_bounded(spark, order):
    """No slice of a hot key is much longer than asked for, and the table of slices is short."""
    rows, df = hot_log(spark, size=2000)
    hot = hot_keys(df, "key", 200)
    assert [tuple(r) for r in hot.collect()] == [("k", 1000), ("k0", 286), ("k2", 286), ("k4", 286), ("k6", 286)][: hot.count()]
    sliced = with_slices(df, hot, "key", order, 200, stage)
    cut = sliced.where("_slice IS NOT NULL")
    sizes = cut.groupBy("key", "_slice").count().collect()
    assert max(r["count"] for r in sizes) <= 400 and len(sizes) < 30
    assert {r.key for r in sliced.where("_slice IS NULL").select("key").distinct().collect()}.isdisjoint({r.key for r in sizes})
    # Numbers never decrease along the order.
    places = sorted((sort_key(order)((r.key, r.second, r.place, r.offset)), r._slice) for r in cut.where("key = 'k'").collect())
    assert [n for _, n in places] == sorted(n for _, n in places)


def test_slice_number(spark):
    df = spark.createDataFrame([(b, v) for b in ([], [3], [3, 5, 9], list(range(0, 100, 3)), None) for v in (-1, 0, 3, 4, 9, 98, 200)], "b array<int>, v int")
    for r in df.withColumn("n", slice_number(F.col("b"), F.col("v"))).collect():
        assert r.n == sum(x <= r.v for x in r.b or [])


def test_bounds_come_from_a_sample(spark):
    rows, df = hot_log(spark, size=2000)
    bounds = splitters(df, hot_keys(df, "key", 500), "key", ("place", "offset"), 500).collect()
    assert [r.key for r in bounds] == ["k"] and 1 <= len(bounds[0]._bounds) <= 4


def test_gap_then_late(spark):
    placed = classify_continuity(typed_log(spark, [reading(sequence=1), reading(sequence=4), reading(sequence=2)]))
    assert statuses(placed) == [("accepted", 0.0), ("gap", 2.0), ("out_of_order", 0.0)]


def test_ordering_report_and_spread(spark):
    rows = [("s", 0, 0, 1.0), ("s", 1, 0, 2.0), ("s", 0, 1, 3.0), ("t", 0, 2, 1.0), ("s", 1, 1, 4.0)]
    log = spark.createDataFrame(rows, "sensor_id string, partition int, offset bigint, sequence double")
    log = log.withColumn("published", F.col("sequence").cast("long"))
    report = ordering_report(log, {"published": ("published", "partition"), "read": ("partition", "offset")})
    got = {r.arrival_order: (r.readings, r.out_of_order, r.gaps, r.missing) for r in report.collect()}
    assert got == {"published": (5, 0, 0, 0.0), "read": (5, 1, 1, 1.0)}
    assert [tuple(r) for r in partition_spread(log).collect()] == [("s", 2)]
