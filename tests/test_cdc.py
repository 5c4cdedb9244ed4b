"""Folding and merging a change feed: one hand-made frame per rule."""

import itertools
from datetime import datetime, timedelta

import pytest
from conftest import NOON, as_set, by_key
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lineside import schemas as S
from lineside.operators import cdc

LATER = NOON + timedelta(minutes=1)


def fold(*batches, **options):
    target = cdc.empty_target(batches[0][0])
    return cdc.merge_batches(target, batches, **options)


def test_encode_shapes(frame):
    rows = frame(
        S.T.StructType(S.SOURCE_ROW.fields + S.fields(OLD=S.STRING, OP=S.STRING, M=S.LONG, L=S.LONG).fields),
        {"INSPECTION_ID": "a", "STATUS": "PASS", "OLD": "a", "OP": S.INSERT, "M": 1, "L": 2},
        {"INSPECTION_ID": "b2", "STATUS": "FAIL", "OLD": "b", "OP": S.UPDATE, "M": 1, "L": 3},
        {"INSPECTION_ID": "c", "STATUS": "FAIL", "OLD": "c", "OP": S.DELETE, "M": 1, "L": 4})
    out = by_key(cdc.encode(rows, "OP", "M", "L", NOON, old_key="OLD"), S.PK)
    assert out["a"]["PAYLOAD__STATUS"] == "PASS" and out["a"]["METADATA"] == '{"offset_token":"2"}'
    assert out["b"]["PAYLOAD__INSPECTION_ID"] == "b2"
    assert all(out["c"][S.payload(c)] is None for c in S.SOURCE_COLUMNS)
    assert out["c"]["SEEN_AT"] == NOON


def test_newest_event_wins_inside_a_batch(journal):
    events = journal(
        ("a", S.INSERT, 1, 1, {"STATUS": "FAIL"}),
        ("a", S.UPDATE, 1, 2, {"STATUS": "PASS"}),
        ("b", S.UPDATE, 9, 1, {"STATUS": "FAIL"}),
        ("b", S.INSERT, 2, 8, {"STATUS": "PASS"}))
    out = by_key(fold((events, NOON)))
    assert (out["a"]["STATUS"], out["b"]["STATUS"]) == ("PASS", "FAIL")


def test_insert_then_delete_in_one_batch_leaves_only_the_key(journal):
    events = journal(("a", S.INSERT, 1, 1, {}), ("a", S.DELETE, 1, 2, {}))
    row = by_key(fold((events, NOON)))["a"]
    assert row["_deleted"] and row["STATUS"] is None and row["EVENT_TS"] is None


def test_insert_then_delete_in_two_batches_keeps_the_payload(journal):
    row = by_key(fold(
        (journal(("a", S.INSERT, 1, 1, {})), NOON), (journal(("a", S.DELETE, 2, 1, {})), LATER)))["a"]
    assert row["_deleted"] and row["STATUS"] == "PASS"
    assert (row["_inserted_at"], row["_updated_at"]) == (NOON, LATER)


def test_insert_after_delete_revives(journal):
    row = by_key(fold(
        (journal(("a", S.DELETE, 1, 1, {})), NOON), (journal(("a", S.INSERT, 2, 1, {"STATUS": "FAIL"})), LATER)))["a"]
    assert not row["_deleted"] and row["STATUS"] == "FAIL" and row["_inserted_at"] == NOON


def test_update_of_unseen_key_inserts_a_live_row(journal):
    row = by_key(fold((journal(("a", S.UPDATE, 1, 1, {"STATUS": "FAIL"})), NOON)))["a"]
    assert not row["_deleted"] and row["STATUS"] == "FAIL"


def test_update_may_rewrite_the_key_in_place(journal):
    out = by_key(fold(
        (journal(("a", S.INSERT, 1, 1, {})), NOON), (journal(("a", S.UPDATE, 2, 1, {S.KEY: "z"})), LATER)))
    assert set(out) == {"z"} and out["z"]["_inserted_at"] == NOON


def test_split_key_change_leaves_old_key_deleted(journal):
    events = cdc.split_key_changes(journal(("a", S.UPDATE, 2, 1, {S.KEY: "z"}), ("b", S.UPDATE, 2, 2, {})))
    out = by_key(fold((journal(("a", S.INSERT, 1, 1, {})), NOON), (events, LATER)))
    assert out["a"]["_deleted"] and not out["z"]["_deleted"] and not out["b"]["_deleted"]


def test_other_event_types_are_ignored(journal):
    events = journal(("a", S.INSERT, 1, 1, {}), ("a", "SchemaChangedRows", 2, 1, {"STATUS": "FAIL"}))
    assert by_key(fold((events, NOON)))["a"]["STATUS"] == "PASS"


def test_empty_batch_changes_nothing(journal):
    first = journal(("a", S.INSERT, 1, 1, {}))
    assert as_set(fold((first, NOON), (first.limit(0), LATER))) == as_set(fold((first, NOON)))


@pytest.mark.parametrize("guard, status", [(False, "FAIL"), (True, "PASS")])
def test_older_position_in_a_later_batch(spark, journal, frame, guard, status):
    new = journal(("a", S.INSERT, 5, 1, {"STATUS": "PASS"}))
    old = journal(("a", S.UPDATE, 4, 9, {"STATUS": "FAIL"}), ("b", S.INSERT, 1, 1, {}))
    extra = S.fields(_most=S.LONG, _least=S.LONG).fields if guard else []
    target = frame(S.T.StructType(S.INSPECTIONS.fields + extra))
    out = by_key(cdc.merge_batches(target, [(new, NOON), (old, LATER)], guard=guard))
    assert out["a"]["STATUS"] == status and not out["b"]["_deleted"]
    assert out["a"]["_updated_at"] == (NOON if guard else LATER)


@pytest.mark.parametrize("guard", [False, True])
def test_held_and_unmet_rows_make_up_the_merge(journal, frame, guard):
    extra = S.fields(_most=S.LONG, _least=S.LONG).fields if guard else []
    target = frame(
        S.T.StructType(S.INSPECTIONS.fields + extra),
        *[{S.KEY: k, "STATUS": "PASS", "_inserted_at": NOON, "_updated_at": NOON, "_deleted": k == "c",
           "_most": 5, "_least": 5} for k in "abcd"])
    newest = cdc.newest_rows(journal(
        ("a", S.DELETE, 6, 1, {}), ("b", S.UPDATE, 6, 2, {S.KEY: "b2", "STATUS": "FAIL"}),
        ("c", S.INSERT, 4, 3, {}), ("x", S.INSERT, 6, 4, {}), ("y", S.DELETE, 6, 5, {})))
    out = by_key(cdc.apply_newest(target, newest, LATER, guard=guard, batch=None))
    assert set(out) == {"a", "b2", "c", "d", "x", "y"}
    assert {k for k, r in out.items() if r["_deleted"]} == ({"a", "c", "y"} if guard else {"a", "y"})


def test_settled_equals_merge_into_nothing(journal):
    events = journal(("a", S.INSERT, 1, 1, {}), ("b", S.DELETE, 1, 2, {}), ("c", S.UPDATE, 1, 3, {S.KEY: "c2"}))
    assert as_set(cdc.settled(events, NOON)) == as_set(fold((events, NOON)))


def test_direct_apply(frame):
    target = frame(S.INSPECTIONS, *[
        {S.KEY: k, "STATUS": "FAIL", "SKU": "old", "_inserted_at": NOON, "_updated_at": NOON, "_deleted": k == "gone"}
        for k in ("live", "gone", "voided", "still")])
    schema = S.T.StructType(S.SOURCE_ROW.fields + S.fields(OP=S.STRING, AT=S.LONG).fields)
    rows = frame(
        schema,
        {S.KEY: "live", "OP": S.UPDATE, "AT": 1, "STATUS": "PASS", "SKU": "new"},
        {S.KEY: "gone", "OP": S.UPDATE, "AT": 2, "STATUS": "PASS"},
        {S.KEY: "voided", "OP": S.UPDATE, "AT": 3, "STATUS": "PASS"},
        {S.KEY: "voided", "OP": S.DELETE, "AT": 4},
        {S.KEY: "voided", "OP": S.UPDATE, "AT": 5, "STATUS": "LATE"},
        {S.KEY: "new", "OP": S.INSERT, "AT": 6, "STATUS": "FAIL", "SKU": "s"},
        {S.KEY: "new", "OP": S.UPDATE, "AT": 7, "STATUS": "PASS", "SKU": "ignored"},
        {S.KEY: "absent", "OP": S.UPDATE, "AT": 8, "STATUS": "PASS"},
        {S.KEY: "absent2", "OP": S.DELETE, "AT": 9})
    out = by_key(cdc.direct_apply(target, rows, "OP", ["AT"], LATER))
    assert set(out) == {"live", "gone", "voided", "still", "new"}
    assert (out["live"]["STATUS"], out["live"]["SKU"], out["live"]["_updated_at"]) == ("PASS", "old", LATER)
    assert (out["gone"]["STATUS"], out["gone"]["_deleted"], out["gone"]["_updated_at"]) == ("FAIL", True, NOON)
    assert (out["voided"]["STATUS"], out["voided"]["_deleted"]) == ("PASS", True)
    assert (out["new"]["STATUS"], out["new"]["SKU"], out["new"]["_deleted"]) == ("PASS", "s", False)
    assert out["still"]["_updated_at"] == NOON


def test_ties_on_position_are_settled_the_same_way_in_any_order(journal):
    a, b = ("a", S.UPDATE, 1, 1, {"STATUS": "PASS"}), ("a", S.UPDATE, 1, 1, {"STATUS": "FAIL"})
    results = {tuple(as_set(cdc.latest_per_key(journal(*e).repartition(2)))) for e in ((a, b), (b, a))}
    assert len(results) == 1


def test_hot_key_is_reduced_before_the_shuffle(journal):
    plan = cdc.latest_per_key(journal(("a", S.INSERT, 1, 1, {})))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_merge_into_a_catalog_table_resolves(spark, journal):
    """No table format with row-level changes is installed; the statement must get as far as that."""
    spark.sql("DROP TABLE IF EXISTS merge_target")
    cdc.empty_target(journal(("a", S.INSERT, 1, 1, {}))).write.saveAsTable("merge_target")
    with pytest.raises((AnalysisException, Exception)) as error:
        cdc.merge_into_table(cdc.newest_rows(journal(("a", S.INSERT, 1, 1, {}))), "merge_target", F.lit(datetime(2026, 1, 1)))
    assert "MERGE" in str(error.value).upper() and "UNRESOLVED" not in str(error.value)
    spark.sql("DROP TABLE merge_target")


@pytest.mark.parametrize("width", [None, 1, 2, 3])
def test_a_tick_settles_as_its_events_do_one_after_the_other(spark, width):
    """All sequences of up to five events: each key is one sequence."""
    kinds = {"I": S.INSERT, "U": S.UPDATE, "D": S.DELETE}
    sequences = ["".join(q) for n in range(1, 6) for q in itertools.product("IUD", repeat=n)]
    fields = [c for c in S.SOURCE_COLUMNS if c not in (S.KEY, "STATUS")]
    data = [(q, i, kinds[k], f"{k}{i}") for q in sequences for i, k in enumerate(q)]
    rows = spark.createDataFrame(data, "INSPECTION_ID string, AT long, OP string, STATUS string").selectExpr(
        "*", *[f"CAST(NULL AS {'timestamp_ntz' if c.endswith('_TS') else 'string'}) AS {c}" for c in fields])
    got = {r[S.KEY]: (r["_ins"] and r["_ins"]["row"]["STATUS"], r["_void"] is not None, r["_upd"] and r["_upd"]["row"]["STATUS"])
           for r in cdc.settle(rows, "OP", ["AT"], width).collect()}
    want = {}
    for q in sequences:
        inserted, voided, update = None, False, None
        for i, k in enumerate(q):
            if k == "I":
                inserted, voided, update = f"I{i}", False, None
            elif k == "D":
                voided = True
            elif not voided:
                update = f"U{i}"
        want[q] = (inserted, voided, update)
    assert got == want


def test_a_tick_is_shuffled_once(spark):
    rows = spark.createDataFrame([], "INSPECTION_ID string, AT long, OP string, STATUS string").selectExpr("*", *[
        f"CAST(NULL AS {'timestamp_ntz' if c.endswith('_TS') else 'string'}) AS {c}" for c in S.SOURCE_COLUMNS if c not in (S.KEY, "STATUS")])
    text = cdc.settle(rows, "OP", ["AT"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
