"""Checks and journal inspection on frames that break the rules."""

from datetime import timedelta

import pytest
from conftest import NOON, by_key
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.operators import cdc, checks
from lineside.operators import journal as inspect
from lineside.sources import tables


def test_inventory_matches_a_journal_by_prefix(spark, journal):
    built = checks.built_objects({
        ("RAW", "QUALITY_INSPECTIONS_JOURNAL_17_3"): journal(("a", S.INSERT, 1, 1, {})),
        ("ANALYTICS", "QUALITY_INSPECTIONS"): journal(),
        ("ANALYTICS", "PLANT_FLOOR"): None})
    rows = {r.object_name: (r.status, r.approx_rows) for r in checks.pipeline_inventory(spark, built).collect()}
    assert rows["QUALITY_INSPECTIONS_JOURNAL"] == ("built", 1)
    assert rows["QUALITY_INSPECTIONS"] == ("-- NOT YET --", None)
    assert rows["PLANT_FLOOR"] == ("built", None) and len(rows) == len(checks.EXPECTED)


def test_column_contract_reports_missing_and_wrong_types(spark, frame):
    contract = (("T", "A", "NUMBER"), ("T", "B", "NUMBER"), ("T", "C", "TEXT"))
    table = frame(S.fields(A=S.INT, B=S.BOOLEAN), {"A": 1, "B": True}, {"A": None, "B": False})
    rows = [(r.column_name, r.actual_type, r.verdict, r.null_rows)
            for r in checks.column_contract(spark, {"T": table}, contract).collect()]
    assert rows == [("B", "BOOLEAN", "-- WRONG TYPE --", 0), ("C", "-- absent --", "-- MISSING COLUMN --", None),
                    ("A", "NUMBER", "ok", 1)]


def test_grain_and_reference_checks(frame):
    schema = S.fields(LINE=S.STRING, BUCKET=S.NTZ)
    many = frame(schema, {"LINE": "a", "BUCKET": NOON}, {"LINE": "a", "BUCKET": NOON}, {"LINE": "b"}, {"LINE": "c"})
    one = frame(schema, {"LINE": "a", "BUCKET": NOON}, {"LINE": "c"})
    grain = checks.grain_check({"M": many}, {"M": ("LINE", "BUCKET")}).first()
    assert (grain.ROWS, grain.KEYS, grain.REPEATED_KEYS) == (4, 3, 1)
    lost = checks.reference_check({"l": (many, one, ("LINE", "BUCKET"))}).first()
    assert (lost.MISSING_KEYS, lost.MISSING_ROWS) == (1, 1)


def test_domain_rules(journal):
    events = journal(
        ("S-0123456789ab", S.INSERT, 1, 1, {}), ("S-xyz", S.UPDATE, 1, 2, {}), ("S-0123456789ab", "Marker", None, 3, {}))
    events = events.unionByName(
        journal(("S-0123456789ab", S.DELETE, 1, 4, {})).withColumn("PAYLOAD__LINE", F.lit("PAINT")))
    broken = {r.RULE: (r.CHECKED_ROWS, r.BROKEN_ROWS) for r in
              checks.broken_rules(events, checks.journal_rules()).collect()}
    assert broken == {"key_shape": (4, 1), "event_type": (4, 1), "positions_present": (4, 1),
                      "payload_empty_iff_delete": (4, 1)}


def test_inspection_and_telemetry_rules(frame):
    rows = frame(S.SOURCE_ROW, {"LINE": "PAINT", "STATUS": "PASS"}, {"LINE": "X", "STATUS": "PASS", "DEFECT_CODE": "d"},
                 {"LINE": "WELD"})
    broken = {r.RULE: r.BROKEN_ROWS for r in checks.broken_rules(rows, checks.inspection_rules()).collect()}
    assert broken == {"line_domain": 1, "status_domain": 1, "code_empty_iff_pass": 2}
    readings = frame(S.TELEMETRY, *[{"LINE": "WELD", "METRIC": "torque_nm", "VALUE": v}
                                    for v in (1.0, None, float("nan"), float("inf"))])
    broken = {r.RULE: r.BROKEN_ROWS for r in checks.broken_rules(readings, checks.telemetry_rules()).collect()}
    assert broken["value_finite"] == 3


def test_preflight_stops_on_a_failed_check(spark):
    good = checks.preflight(spark, {"one": F.lit(True), "two": F.lit(True)})
    assert checks.require(good).where("CHECK_NAME = 'ALL'").first().OK
    with pytest.raises(RuntimeError, match="two"):
        checks.require(checks.preflight(spark, {"one": F.lit(True), "two": F.lit(None).cast("boolean")}))


def test_table_growth(frame):
    schema = S.fields(t=S.NTZ)
    then = frame(schema, {"t": NOON})
    now = frame(schema, {"t": NOON}, {"t": NOON + timedelta(seconds=30)})
    earlier = checks.table_growth({"a": (then, "t"), "b": (then, "t")}, NOON)
    rows = {r.TABLE_NAME: (r.ROWS, r.AGE_SECS, r.GROWN, r.IS_CLIMBING) for r in checks.table_growth(
        {"a": (now, "t"), "b": (then, "t")}, NOON + timedelta(seconds=40), earlier).collect()}
    assert rows == {"a": (2, 10, 1, True), "b": (1, 40, 0, False)}


def test_refresh_status_shows_the_newest_mode(frame):
    schema = S.fields(name=S.STRING, started_at=S.NTZ, batch_id=S.LONG, mode=S.STRING, state=S.STRING, reason=S.STRING)
    log = frame(
        schema,
        {"name": "g", "started_at": NOON, "batch_id": 1, "mode": "INCREMENTAL", "state": "SUCCEEDED", "reason": ""},
        {"name": "g", "started_at": NOON + timedelta(minutes=1), "batch_id": 2, "mode": "FULL", "state": "SUCCEEDED",
         "reason": "MODE is not supported"},
        {"name": "h", "started_at": NOON, "batch_id": 1, "mode": "INCREMENTAL", "state": "SUCCEEDED", "reason": ""})
    rows = {r["name"]: (r.refresh_mode, r.downgrade_reason, r.refreshes) for r in checks.refresh_status(log).collect()}
    assert rows == {"g": ("FULL", "MODE is not supported", 2), "h": ("INCREMENTAL", None, 1)}


def test_journal_inspection(journal):
    events = journal(*[(f"k{i}", S.INSERT, i // 5, i, {}) for i in range(30)])
    tail = inspect.journal_tail(events, 3).collect()
    assert [(r.txn_lsn, r.msg_lsn) for r in tail] == [(5, 29), (5, 28), (5, 27)]
    mix = inspect.event_mix(events.unionByName(journal(("k0", S.DELETE, 9, 99, {})))).collect()
    assert [tuple(r) for r in mix] == [(S.INSERT, 30), (S.DELETE, 1)]
    held = cdc.settled(events.where("LEAST_SIGNIFICANT_POSITION < 20"), NOON)
    assert tuple(inspect.merge_backlog(events, held, (3, 19)).first()) == (30, 20, 10, True)
    assert inspect.merge_backlog(events, held, (5, 29)).first().stream_has_pending is False
    # A later transaction waits even where its second number starts anew.
    assert inspect.merge_backlog(events, held, (4, 99)).first().stream_has_pending is True
    assert inspect.merge_backlog(events.limit(0), held, (5, 29)).first().stream_has_pending is False


def test_metadata_is_a_string_until_it_is_parsed(frame):
    rows = frame(S.JOURNAL, *[{S.PK: str(i), S.LEAST: i, "EVENT_TYPE": S.INSERT, "METADATA": m} for i, m in enumerate(
        ['{"offset_token": "7"}', "not json", None])])
    got = {r[S.LEAST]: (r.what_it_really_is, r.unparsed_token, r.offset_token)
           for r in inspect.journal_metadata(rows).collect()}
    assert got[0] == ("STRING", None, "7") and got[1] == ("STRING", None, None) and got[2][2] is None


def test_deleted_and_rewritten_rows(frame):
    later = NOON + timedelta(minutes=1)
    rows = frame(S.INSPECTIONS, *[
        {S.KEY: k, "_deleted": d, "_inserted_at": NOON, "_updated_at": u}
        for k, d, u in (("a", True, later), ("b", False, later), ("c", False, NOON))])
    assert set(by_key(inspect.deleted_rows(rows))) == {"a"}
    assert set(by_key(inspect.rewritten_rows(rows))) == {"b"}


def test_merge_audit(frame):
    schema = S.fields(start_time=S.NTZ, query_type=S.STRING, rows_produced=S.LONG, elapsed_ms=S.LONG,
                      warehouse_name=S.STRING, query_tag=S.STRING)
    rows = frame(schema, *[
        {"start_time": NOON + timedelta(minutes=i), "query_type": "MERGE", "rows_produced": 122, "elapsed_ms": 1450 + i,
         "query_tag": '{"application":"CDC_MERGE","operation":"op","strategy":"full"}' if i % 2 else None}
        for i in range(40)])
    out = inspect.merge_audit(rows, "CDC_MERGE").collect()
    assert len(out) == 10 and out[0].fired_at == "12:39:00" and str(out[0].merge_seconds) == "1.5"
    assert (out[0].connector_operation, out[0].merge_strategy) == ("op", "full")


def test_json_lines_keep_null_fields_and_milliseconds(spark, journal, tmp_path):
    import json
    events = journal(("a", S.DELETE, 1, 2, {}))
    tables.export_json_lines(events, str(tmp_path / "out"))
    row = json.loads(spark.read.text(str(tmp_path / "out")).first()[0])
    assert row["PAYLOAD__STATUS"] is None and row["SEEN_AT"] == "2026-01-01T12:00:00.000"
    assert list(row) == S.JOURNAL.names


def test_operations_shape(frame):
    schema = S.T.StructType(S.SOURCE_ROW.fields + S.fields(OP=S.STRING).fields)
    rows = frame(schema, *[{S.KEY: k, "STATUS": "PASS", "OP": k} for k in S.DATA_EVENTS])
    out = by_key(tables.as_operations(rows, "OP"))
    assert [(out[k]["op"], out[k]["STATUS"]) for k in S.DATA_EVENTS] == [
        ("INSERT", "PASS"), ("UPDATE", "PASS"), ("DELETE(soft)", None)]
