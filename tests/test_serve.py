"""Serving queries, metric layer and analyst questions on hand-made gold tables."""

from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import NOON, as_set

from lineside import schemas as S
from lineside.operators import analyst, metrics, serve
from lineside.streaming.pipeline import DEFECTS, YIELD


def at(minute):
    return NOON + timedelta(minutes=minute)


@pytest.fixture
def gold(frame):
    """Rows of (line, minute, units, scrap, humidity)."""
    def build(*rows):
        return frame(YIELD, *[
            {"LINE": line, "BUCKET": at(m), "UNITS": u, "SCRAP_UNITS": s, "AVG_BOOTH_HUMIDITY": h,
             "FIRST_PASS_YIELD_PCT": Decimal(100 * (u - s)).quantize(Decimal("0.01")) / u}
            for line, m, u, s, h in rows])
    return build


@pytest.fixture
def counts(frame):
    def build(*rows):
        return frame(DEFECTS, *[
            {"LINE": line, "BUCKET": at(m), "DEFECT_CODE": code, "N": n} for line, m, code, n in rows])
    return build


def test_recent_yield_and_series(gold):
    table = gold(*[("PAINT", 5 * i, 10, 1, 44.44) for i in range(20)])
    recent = serve.recent_yield(table).collect()
    assert len(recent) == 12 and recent[0].BUCKET == at(95) and recent[0].HUMIDITY == 44.4
    series = serve.yield_series(table, at(96))
    assert series.columns[0] == "line" and dict(series.dtypes)["first_pass_yield_pct"] == "double"
    assert series.count() == 12


def test_top_defects_leaves_out_passing_scans_and_old_buckets(counts):
    table = counts(("PAINT", 0, "A", 9), ("PAINT", 50, "NONE", 90), ("PAINT", 50, "B", 1), ("PAINT", 55, "B", 2),
                   ("WELD", 55, "C", 3))
    rows = [(r.LINE, r.DEFECT_CODE, r.N) for r in serve.top_defects(table, at(60)).collect()]
    assert rows == [("PAINT", "B", 3), ("WELD", "C", 3)]


def test_kpi_shows_a_line_without_data(gold):
    series = serve.yield_series(gold(("PAINT", 0, 10, 0, None), ("PAINT", 5, 10, 2, 50.0), ("WELD", 5, 10, 0, None)), at(6))
    rows = {r.line: (r.yield_pct, r.units, r.is_low) for r in serve.kpi_latest(series).collect()}
    assert rows == {"WELD": (100.0, 10, False), "PAINT": (80.0, 10, True), "ASSEMBLY": (None, None, None)}
    stacked = serve.series_long(series)
    assert {(r.bucket, r.series) for r in stacked.where("series = 'booth_humidity'").collect()} == {
        (at(5), "booth_humidity")}
    assert stacked.count() == 4


def test_gold_lag_is_the_worst_of_the_newest(frame):
    log = frame(
        S.fields(name=S.STRING, state=S.STRING, data_timestamp=S.NTZ),
        {"name": "a", "state": "SUCCEEDED", "data_timestamp": at(0)},
        {"name": "a", "state": "SUCCEEDED", "data_timestamp": at(8)},
        {"name": "b", "state": "SUCCEEDED", "data_timestamp": at(9)},
        {"name": "b", "state": "FAILED", "data_timestamp": at(10)})
    assert serve.gold_lag(log, at(10), ["a", "b"]).first().lag_secs == 120
    assert serve.gold_lag(log, at(10), ["c"]).first().lag_secs is None


@pytest.mark.parametrize("modes, expected", [
    ([("steady", 0), (" incident ", 1)], "INCIDENT"), ([("x", 0), ("", 1)], "STEADY"), ([("x", 0), (None, 1)], "STEADY")])
def test_latest_row_wins(frame, modes, expected):
    table = frame(S.CONTROL, *[{"MODE": m, "UPDATED_AT": at(t)} for m, t in modes])
    assert serve.latest_row_wins(table).first().MODE == expected


def test_insert_if_absent(frame):
    schema = S.fields(k=S.STRING, v=S.STRING)
    held, new = frame(schema, {"k": "a", "v": "old"}), frame(schema, {"k": "a", "v": "new"}, {"k": "b", "v": "new"})
    assert as_set(serve.insert_if_absent(held, new, ["k"])) == ["('a', 'old')", "('b', 'new')"]
    assert serve.insert_if_absent(held, new).count() == 1
    assert serve.insert_if_absent(held.limit(0), new).count() == 2


def test_committed_offset(frame):
    rows = frame(S.fields(c=S.STRING, p=S.LONG), {"c": "x", "p": 9}, {"c": "x", "p": 10}, {"c": "y", "p": 1})
    assert {tuple(r) for r in serve.committed_offset(rows, "c", "p").collect()} == {("x", 10, 2), ("y", 1, 1)}


# --- metric layer ---------------------------------------------------------------------------------

@pytest.fixture
def frames(gold, counts, frame):
    health = S.fields(STATION_ID=S.STRING, LINE=S.STRING, METRIC=S.STRING, BUCKET=S.NTZ, READINGS=S.INT,
                      AVG_VALUE=S.DOUBLE, MAX_VALUE=S.DOUBLE)
    return {
        "yield": gold(("PAINT", 0, 20, 10, 44.0), ("PAINT", 5, 200, 0, None), ("WELD", 0, 5, 1, None)),
        "defects": counts(("PAINT", 0, "A", 6), ("PAINT", 0, "B", 4), ("PAINT", 5, "NONE", 200), ("WELD", 0, "C", 1)),
        "stations": frame(
            health,
            {"STATION_ID": "s", "LINE": "PAINT", "METRIC": "m", "BUCKET": at(0), "AVG_VALUE": 1.0, "MAX_VALUE": 5.0},
            {"STATION_ID": "s", "LINE": "PAINT", "METRIC": "m", "BUCKET": at(5), "AVG_VALUE": 3.0, "MAX_VALUE": 4.0},
            {"STATION_ID": "t", "LINE": "WELD", "METRIC": "m", "BUCKET": at(50), "AVG_VALUE": 9.0, "MAX_VALUE": 9.0}),
    }


def test_weighted_yield_is_not_the_mean_of_percentages(frames):
    row = metrics.metric_query(metrics.PLANT, frames, ["line"], ["avg_yield_pct"], {"line": lambda c: c == "PAINT"})
    assert row.first().avg_yield_pct == Decimal("95.45")


def test_metrics_of_several_tables_do_not_multiply(frames):
    out = metrics.metric_query(
        metrics.PLANT, frames, ["Line"], ["units produced", "Number of Defects", "peak_reading", "yield.avg_humidity"])
    rows = {r.line: (r.total_units, r.defect_count, r.peak_reading, r.avg_humidity) for r in out.collect()}
    # The station whose bucket has no yield row is kept under no line.
    assert rows == {"PAINT": (220, 210, 5.0, 44.0), "WELD": (5, 1, None, None), None: (None, None, 9.0, None)}


def test_filter_reaches_through_the_hub(frames):
    rows = [(r.defect_code, r.defect_count) for r in metrics.defect_drivers_question(frames).collect()]
    assert rows == [("A", 6), ("B", 4)]


def test_questions_one_and_three(frames):
    rows = [tuple(r) for r in metrics.yield_by_line_question(frames).collect()]
    assert rows == [("PAINT", Decimal("95.45"), 220, 10), ("WELD", Decimal("80.00"), 5, 1)]
    rows = [tuple(r) for r in metrics.yield_humidity_question(frames, n=1).collect()]
    assert rows == [("PAINT", at(5), Decimal("100.00"), None)]


def test_metrics_without_dimensions_and_unreachable_names(frames):
    total = metrics.metric_query(metrics.PLANT, frames, [], ["volume", "defect count"]).first()
    assert tuple(total) == (225, 211)
    with pytest.raises(ValueError, match="no path"):
        metrics.metric_query(metrics.PLANT, frames, ["defect_code"], ["total_units"])
    with pytest.raises(ValueError, match="unknown metric"):
        metrics.metric_query(metrics.PLANT, frames, ["line"], ["profit"])


# --- analyst questions ----------------------------------------------------------------------------

def test_latest_buckets_leave_out_the_open_one(gold):
    table = gold(*[("PAINT", 5 * i, 10, 0, None) for i in range(6)], ("WELD", 20, 10, 0, None))
    rows = {(r.LINE, r.BUCKET) for r in analyst.latest_buckets(table, at(27), 2).collect()}
    assert rows == {("PAINT", at(20)), ("WELD", at(20)), ("PAINT", at(15))}


def test_line_health_limits(gold):
    table = gold(("A", 0, 100, 6, None), ("B", 0, 100, 7, None), ("C", 0, 100, 10, None), ("D", 0, 100, 11, None),
                 ("E", 0, 100, 20, None))
    rows = {r.LINE: (r.STATE, r.IS_LOW) for r in analyst.line_health(table).collect()}
    assert rows == {"A": ("healthy", False), "B": ("watch", False), "C": ("watch", False), "D": ("problem", False),
                    "E": ("problem", True)}


def test_humidity_alerts(gold):
    rows = analyst.humidity_alerts(gold(("P", 0, 1, 0, 60.0), ("P", 5, 1, 0, 60.1), ("W", 0, 1, 0, None))).collect()
    assert sorted(r.HUMIDITY_STATE for r in rows) == ["abnormal", "normal"]


def test_defect_share(counts):
    rows = analyst.defect_share(counts(("P", 0, "A", 1), ("P", 5, "A", 1), ("P", 0, "B", 1), ("P", 0, "NONE", 9))).collect()
    assert {(r.DEFECT_CODE, r.SHARE_PCT, r.RANK) for r in rows} == {
        ("A", Decimal("66.67"), 1), ("B", Decimal("33.33"), 2)}


@pytest.mark.parametrize("humid, low, holds", [(3, 5, True), (5, 3, False)])
def test_cause_comes_before_effect(gold, counts, humid, low, holds):
    table = gold(*[("PAINT", 5 * i, 100, 20 if i >= low else 0, 70.0 if i >= humid else 44.0) for i in range(8)])
    row = analyst.cause_order(table, counts(("PAINT", 20, "PAINT_RUN", 5), ("PAINT", 0, "NONE", 99))).first()
    assert row.ORDER_HOLDS is holds
    assert (row.HUMIDITY_AT, row.YIELD_AT) == (at(5 * humid), at(5 * low))
    assert row.YIELD_AFTER_SECS == (low - humid) * 300


def test_yield_compare(gold):
    table = gold(("P", 0, 10, 0, None), ("P", 20, 10, 5, None))
    rows = analyst.yield_compare(table, 20, at(20)).collect()
    assert [(r.NOW_PCT, r.THEN_PCT, r.CHANGE_PCT) for r in rows] == [
        (Decimal("50.00"), Decimal("100.00"), Decimal("-50.00"))]


def test_control_compare(gold):
    table = gold(*[(line, m, 100, 30 if (line, m) == ("PAINT", 60) else 4, None)
                   for line in S.LINES for m in (0, 60)])
    rows = {r.LINE: r for r in analyst.control_compare(table, at(30)).collect()}
    assert (rows["PAINT"].DROP_PCT, rows["PAINT"].OTHERS_DROP_PCT, rows["PAINT"].EXCESS_DROP_PCT) == (
        Decimal("26.00"), 0.0, 26.0)
    assert rows["WELD"].OTHERS_DROP_PCT == 13.0


def test_dimensions_without_metrics_and_order_by_a_synonym(frames):
    codes = metrics.metric_query(metrics.PLANT, frames, ["line", "defect"], [])
    wanted = frames["defects"].select("LINE", "DEFECT_CODE").distinct().count()
    assert codes.columns == ["line", "defect_code"] and codes.count() == wanted
    out = metrics.metric_query(metrics.PLANT, frames, ["line"], ["total_units"], order=[("volume", True)])
    units = [r.total_units for r in out.collect()]
    assert units == sorted(units, reverse=True) and units
