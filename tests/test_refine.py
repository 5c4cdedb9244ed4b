"""Derived tables, changed-group refresh and restatement on hand-made frames."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import NOON, as_set
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.functions import bucket, epoch_seconds, percent, seconds_between
from lineside.operators import analyst, cdc, refine, refresh


def at(minute, second=0, micro=0):
    return datetime(2026, 1, 1, 12, minute, second, micro)


@pytest.fixture
def live(frame):
    schema = S.T.StructType(S.SOURCE_ROW.fields + S.fields(IS_SCRAP=S.INT).fields)

    def build(*rows):
        return frame(schema, *[
            {S.KEY: k, "LINE": line, "EVENT_TS": ts, "STATUS": "FAIL" if code else "PASS", "DEFECT_CODE": code,
             "IS_SCRAP": int(code is not None)} for k, line, ts, code in rows])
    return build


@pytest.fixture
def readings(frame):
    def build(*rows):
        return frame(S.TELEMETRY, *[
            dict(zip(("STATION_ID", "LINE", "METRIC", "VALUE", "EVENT_TS"), r)) for r in rows])
    return build


def test_bucket_edges(frame):
    times = [at(4, 59, 999999), at(5), datetime(1969, 12, 31, 23, 58), None, datetime(1, 1, 1, 0, 7)]
    rows = frame(S.fields(t=S.NTZ), *[{"t": t} for t in times])
    got = {r.t: r.b for r in rows.select("t", bucket("t").alias("b")).collect()}
    assert got == {times[0]: at(0), times[1]: at(5), times[2]: datetime(1969, 12, 31, 23, 55), None: None,
                   times[4]: datetime(1, 1, 1, 0, 5)}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_bucket_does_not_depend_on_the_session_zone(spark, frame, zone):
    """02:30 on this date does not exist in New York."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        t = datetime(2026, 3, 8, 2, 33)
        row = frame(S.fields(t=S.NTZ), {"t": t}).select(bucket("t"), epoch_seconds("t")).first()
        assert row[0] == datetime(2026, 3, 8, 2, 30)
        assert row[1] == int((t - datetime(1970, 1, 1)).total_seconds())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_seconds_between_counts_boundaries(frame):
    rows = frame(S.fields(a=S.NTZ, b=S.NTZ), {"a": at(0, 0, 900000), "b": at(0, 1, 100000)})
    assert rows.select(seconds_between("a", "b")).first()[0] == 1


def test_percent_rounds_half_up_and_passes_over_empty(frame):
    rows = frame(S.fields(u=S.LONG, s=S.LONG), {"u": 1600, "s": 900}, {"u": 3, "s": 1}, {"u": 0, "s": 0},
                 {"u": 80000, "s": 79999})
    got = [r[0] for r in rows.select(percent(F.col("u"), F.col("s"))).collect()]
    assert got == [Decimal("43.75"), Decimal("66.67"), None, Decimal("0.00")]


def test_active_drops_deleted_and_undecided_rows(frame):
    rows = frame(S.INSPECTIONS, *[
        {S.KEY: k, "STATUS": s, "_deleted": d}
        for k, s, d in (("a", "FAIL", False), ("b", "PASS", True), ("c", "PASS", None), ("d", None, False))])
    out = refine.active(rows)
    assert {(r[S.KEY], r.IS_SCRAP) for r in out.collect()} == {("a", 1), ("d", 0)}
    assert not set(S.BOOKKEEPING) & set(out.columns)


def test_health_counts_every_reading_and_keeps_a_null_bucket(readings):
    out = refine.station_health(readings(
        ("s", "PAINT", "booth_temp", 1.1, at(1)), ("s", "PAINT", "booth_temp", 2.2, at(2)),
        ("s", "PAINT", "booth_temp", None, at(3)), ("s", "PAINT", "booth_temp", 7.0, None)))
    rows = {r.BUCKET: r for r in out.collect()}
    assert (rows[at(0)].READINGS, rows[at(0)].AVG_VALUE, rows[at(0)].MAX_VALUE) == (3, pytest.approx(1.65), 2.2)
    assert rows[None].AVG_VALUE == 7.0


def test_health_with_unfit_readings_falls_back_to_the_plain_average(readings):
    out = refine.station_health(readings(
        ("s", "PAINT", "m", 1e300, at(1)), ("s", "PAINT", "m", 3e300, at(2)), ("s", "PAINT", "n", float("nan"), at(1))))
    rows = {r.METRIC: r.AVG_VALUE for r in out.collect()}
    assert rows["m"] == 2e300 and rows["n"] != rows["n"]


def test_health_parts_add_up_in_any_split(readings):
    rows = [("s", "PAINT", "m", v / 7, at(i % 10)) for i, v in enumerate(range(60))]
    whole = refine.station_health(readings(*rows))
    parts = [refine.health_parts(readings(*rows[i::3])) for i in range(3)]
    added = refine.health_table(refine.add_health(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    # The order of a sum of doubles may show in the last bit.
    near = [x.withColumn("AVG_VALUE", F.round("AVG_VALUE", 9)) for x in (whole, added)]
    assert as_set(near[0]) == as_set(near[1])


def test_yield_keeps_lines_without_humidity_and_does_not_multiply_units(live, readings):
    rows = live(("a", "PAINT", at(1), None), ("b", "PAINT", at(2), "PAINT_RUN"), ("c", "WELD", at(1), None))
    health = refine.station_health(readings(
        ("s1", "PAINT", S.HUMIDITY, 40.0, at(1)), ("s2", "PAINT", S.HUMIDITY, 60.0, at(2)),
        ("s1", "PAINT", "booth_temp", 99.0, at(2))))
    out = {r.LINE: r for r in refine.yield_by_line(rows, health).collect()}
    assert (out["PAINT"].UNITS, out["PAINT"].SCRAP_UNITS) == (2, 1)
    assert (out["PAINT"].FIRST_PASS_YIELD_PCT, out["PAINT"].AVG_BOOTH_HUMIDITY) == (Decimal("50.00"), 50.0)
    assert out["WELD"].AVG_BOOTH_HUMIDITY is None


def test_defects_and_top_value(live):
    counts = refine.defect_counts(live(
        ("a", "PAINT", at(1), None), ("b", "PAINT", at(2), None), ("c", "PAINT", at(2), "B"),
        ("d", "PAINT", at(3), "A")))
    assert {(r.DEFECT_CODE, r.N) for r in counts.collect()} == {("NONE", 2), ("B", 1), ("A", 1)}
    assert refine.top_value(counts).first().TOP_DEFECT_CODE == "NONE"
    assert refine.top_value(counts, exclude="NONE").first().TOP_DEFECT_CODE == "A"


def test_refresh_by_changed_group_handles_moved_and_vanished_groups(live, readings):
    old = live(("a", "PAINT", at(1), None), ("b", "PAINT", at(1), "X"), ("c", "WELD", at(1), None),
               ("d", "WELD", at(11), None))
    new = live(("a", "PAINT", at(6), None), ("b", "PAINT", at(1), None), ("d", "WELD", at(11), None),
               ("e", "WELD", None, "Y"))
    health = refine.station_health(readings())

    def build(rows):
        return refine.yield_by_line(rows, health)

    groups = {"LINE": F.col("LINE"), "BUCKET": bucket("EVENT_TS")}
    rows = refresh.changes(old, new, S.KEY)
    touched = refresh.changed_groups(rows, groups)
    gold = refresh.refresh(build(old), new, touched, groups, build)
    assert as_set(gold) == as_set(build(new))
    assert touched.count() == 4  # paint 12:00 and 12:05, weld 12:00 and weld without a time
    parts = refresh.add_parts(refine.yield_parts(old), refine.yield_parts(rows), refine.YIELD_KEYS,
                              ["UNITS", "SCRAP_UNITS"], "UNITS")
    assert as_set(refine.yield_table(parts, health)) == as_set(build(new))


def test_correction_of_a_closed_bucket_raises_its_yield(live, readings):
    old = live(("a", "PAINT", at(1), "PAINT_RUN"), ("b", "PAINT", at(2), None), ("c", "PAINT", at(20), None))
    new = live(("a", "PAINT", at(1), None), ("b", "PAINT", at(2), None), ("c", "PAINT", at(20), None))
    health = refine.station_health(readings())
    versions = [refine.yield_by_line(v, health) for v in (old, new)]
    rows = refresh.restated(*versions, ["LINE", "BUCKET"], ["SCRAP_UNITS", "FIRST_PASS_YIELD_PCT"]).collect()
    assert len(rows) == 1
    assert (rows[0].BUCKET, rows[0].CHANGE_SCRAP_UNITS, rows[0].CHANGE) == (at(0), -1, "restated")
    assert rows[0].CHANGE_FIRST_PASS_YIELD_PCT == Decimal("50.00")


def test_restated_reports_added_and_removed_groups(live, readings):
    health = refine.station_health(readings())
    versions = [refine.yield_by_line(live(("a", "PAINT", t, None)), health) for t in (NOON, NOON + timedelta(hours=1))]
    kinds = {(r.BUCKET, r.CHANGE) for r in
             refresh.restated(*versions, ["LINE", "BUCKET"], ["UNITS"]).collect()}
    assert kinds == {(NOON, "removed"), (NOON + timedelta(hours=1), "added")}


def test_average_keeps_small_readings(frame):
    readings = frame(S.TELEMETRY, *[
        {"STATION_ID": "s", "LINE": "PAINT", "METRIC": "m", "EVENT_TS": NOON, "VALUE": 4e-7} for _ in range(2)])
    assert refine.station_health(readings).first()["AVG_VALUE"] == 4e-7


# ---- every gate of the journal, incidents, nearest earlier bucket ----

def test_gate_values_are_those_of_folding_each_prefix(spark, journal):
    at = [NOON + timedelta(minutes=5 * i) for i in range(3)]
    steps = [  # gate, key, kind, bucket, status
        (0, "a", S.INSERT, 0, "PASS"), (0, "b", S.INSERT, 0, "FAIL"), (0, "a", S.UPDATE, 1, "PASS"),
        (1, "a", S.UPDATE, 0, "FAIL"), (1, "c", S.DELETE, 0, "PASS"), (2, "b", S.DELETE, 0, "PASS"),
        (2, "b", S.INSERT, 2, "PASS"), (4, "b", S.UPDATE, 2, "PASS"), (5, "a", S.DELETE, 0, "PASS"), (5, "c", S.INSERT, 1, "FAIL"),
    ]
    feed = [(key, kind, gate * 10, i, {"LINE": "PAINT", "STATUS": status, "EVENT_TS": at[b], S.KEY: key})
            for i, (gate, key, kind, b, status) in enumerate(steps)]
    events = journal(*feed)
    values = refresh.gate_values(events, F.floor(F.col(S.MOST) / 10))
    got = {(r.BUCKET, r.GATE): (r.UNITS, r.SCRAP_UNITS) for r in values.collect()}
    want, before = {}, {}
    for gate in range(6):
        held = cdc.settled(events.where(F.col(S.MOST) <= gate * 10), NOON)
        now = {r.BUCKET: (r.UNITS, r.SCRAP_UNITS) for r in refine.yield_parts(refine.active(held)).collect()}
        for b in {*before, *now}:
            if before.get(b, (0, 0)) != now.get(b, (0, 0)):
                want[b, gate] = now.get(b, (0, 0))
        before = now
    assert got == want
    told = {r.BUCKET: (r.FIRST_GATE, r.LAST_GATE, r.RESTATED, r.LAST_UNITS, r.REMOVED) for r in refresh.restatements(values).collect()}
    assert told[at[0]] == (0, 5, 3, 0, True)


def _gold(spark, rows):
    return spark.createDataFrame(rows, "LINE string, BUCKET timestamp_ntz, UNITS int, FIRST_PASS_YIELD_PCT decimal(5,2), AVG_BOOTH_HUMIDITY double")


def test_each_incident_has_its_own_start_end_and_order(spark):
    def b(i):
        return NOON + timedelta(minutes=5 * i)

    def row(i, pct, humidity):
        return ("PAINT", b(i), 10, Decimal(pct), humidity)

    gold = _gold(spark, [row(0, "99", 70.0), row(1, "99", 50.0), row(2, "80", 50.0), row(3, "99", 50.0), row(4, "99", 50.0),
                         row(5, "70", 50.0), row(6, "99", 80.0), ("WELD", b(6), 1, None, None)])
    counts = spark.createDataFrame([("PAINT", b(1), "PAINT_RUN", 3), ("PAINT", b(3), "NONE", 9), ("PAINT", b(20), "PAINT_RUN", 1)],
                                   "LINE string, BUCKET timestamp_ntz, DEFECT_CODE string, N int")
    rows = {r.INCIDENT: r for r in analyst.incidents(gold, counts).collect()}
    assert len(rows) == 3
    assert (rows[1].STARTED_AT, rows[1].ENDED_AT, rows[1].BUCKETS) == (b(0), b(3), 3)
    assert (rows[1].DEFECTS_AFTER_SECS, rows[1].YIELD_AFTER_SECS, rows[1].ORDER_HOLDS) == (300, 600, True)
    assert (rows[2].STARTED_AT, rows[2].HUMIDITY_AT, rows[2].YIELD_AT, rows[2].ORDER_HOLDS) == (b(5), b(6), b(5), False)
    assert (rows[3].STARTED_AT, rows[3].YIELD_AT) == (b(20), None)  # defects without a row of yield
    assert len(analyst.incidents(gold, counts, quiet=2).collect()) == 2


@pytest.mark.parametrize("back,tolerance", [(5, 0), (10, 5), (20, 60), (7, 13)])
def test_nearest_earlier_bucket_by_brute_force(spark, back, tolerance):
    rng = random.Random(back)
    rows = [(line, NOON + timedelta(minutes=5 * i), i, Decimal(i % 100), None) for line in ("A", "B") for i in range(60) if rng.random() < 0.4]
    gold = _gold(spark, rows + [("A", None, 1, None, None)])
    got = {(r.LINE, r.BUCKET): (r.THEN_BUCKET, r.THEN_UNITS) for r in analyst.yield_compare_nearest(gold, back, tolerance).collect()}
    want = {("A", None): (None, None)}
    for line, at, *_ in rows:
        span = (at - timedelta(minutes=back + tolerance), at - timedelta(minutes=back))
        found = [(b, n) for l2, b, n, *_ in rows if l2 == line and span[0] <= b <= span[1]]
        want[line, at] = max(found) if found else (None, None)
    assert got == want
