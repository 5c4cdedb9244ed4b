from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from lineside import schemas as S  # noqa: E402
from lineside.session import build_session, local_rows  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
NOON = datetime(2026, 1, 1, 12, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[*]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A frame of a schema from dicts; missing fields are NULL."""
    def build(schema, *rows):
        return local_rows(spark, [tuple(r.get(f) for f in schema.names) for r in rows], schema)
    return build


@pytest.fixture
def journal(frame):
    """Change events from (key, type, most, least, fields) tuples; a delete carries no payload."""
    def build(*events):
        rows = []
        for key, kind, most, least, values in events:
            row = {S.PK: key, "EVENT_TYPE": kind, S.MOST: most, S.LEAST: least, "SEEN_AT": NOON}
            if kind != S.DELETE:
                full = {S.KEY: key, "LINE": "PAINT", "STATUS": "PASS", "EVENT_TS": NOON, "UPDATED_TS": NOON, **values}
                row.update({S.payload(c): v for c, v in full.items()})
            rows.append(row)
        return frame(S.JOURNAL, *rows)
    return build


def by_key(df, key=S.KEY):
    return {r[key]: r.asDict() for r in df.collect()}


def as_set(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))
