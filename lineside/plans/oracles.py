"""The same questions as plain SQL over the ``events`` table, to check the queries against."""

from __future__ import annotations

from lineside import schemas as S
from lineside.plans.compared import rounded_sql

I, U, D = S.INSERT, S.UPDATE, S.DELETE
PK, MOST, LEAST = S.PK, S.MOST, S.LEAST
HOUR, DAY = 60, 1440


def _list(*columns: str, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in columns)


def _pct(units: str, scrap: str) -> str:
    """Percentage rounded half up, in whole numbers."""
    return (f"CAST(((20000 * ({units} - {scrap}) + {units}) // (2 * nullif({units}, 0))) AS DOUBLE) / 100")


def _yield_pct(units: str, scrap: str) -> str:
    return f"CAST({_pct(units, scrap)} AS DECIMAL(5,2))"


def _bucket(ts: str, width: int) -> str:
    return f"time_bucket(INTERVAL '{width} minutes', {ts}, TIMESTAMP '1970-01-01')"


def _average(x: str) -> str:
    """Plain average."""
    return f"avg({x})"


def _journal(rekey: bool = False) -> str:
    moved = "event_type = 'view' AND event_id % 50 = 0"
    new_id = f"CASE WHEN {moved} THEN concat(old_id, '-r', event_id) ELSE old_id END" if rekey else "old_id"
    payload = _list(*[f"CASE WHEN OP <> '{D}' THEN {c} END AS PAYLOAD__{c}" for c in S.SOURCE_COLUMNS])
    return f"""
keyed AS (SELECT *, concat('S-', user_id * 8 + event_id % 8) AS old_id FROM events),
inspections AS (
  SELECT old_id AS OLD_ID, {new_id} AS INSPECTION_ID, concat('F-', event_id) AS UNIT_ID,
    CASE user_id % 3 WHEN 0 THEN 'WELD' WHEN 1 THEN 'PAINT' ELSE 'ASSEMBLY' END AS LINE,
    CASE event_id % 4 WHEN 0 THEN 'FRAME-RD-54' WHEN 1 THEN 'FRAME-RD-56' WHEN 2 THEN 'FRAME-MTB-17'
      ELSE 'FRAME-GRV-55' END AS SKU,
    CASE WHEN value >= 100 THEN 'FAIL' ELSE 'PASS' END AS STATUS,
    CASE WHEN value >= 100 THEN CASE
      WHEN user_id % 3 = 0 AND event_id % 2 = 0 THEN 'WELD_POROSITY'
      WHEN user_id % 3 = 0 THEN 'WELD_MISALIGN'
      WHEN user_id % 3 = 1 AND event_id % 2 = 0 THEN 'PAINT_RUN'
      WHEN user_id % 3 = 1 THEN 'PAINT_ORANGE_PEEL'
      WHEN event_id % 2 = 0 THEN 'ASSY_TORQUE' ELSE 'ASSY_MISSING_PART' END END AS DEFECT_CODE,
    CASE user_id % 3 WHEN 0 THEN 'ST-WELD-01' WHEN 1 THEN 'ST-PAINT-01' ELSE 'ST-ASSY-01' END AS STATION_ID,
    concat('OP-', lpad(CAST(event_id % 12 + 1 AS VARCHAR), 2, '0')) AS OPERATOR_ID,
    ts AS EVENT_TS, ts AS UPDATED_TS,
    CASE WHEN event_type = 'error' THEN '{D}' WHEN event_type IN ('signup', 'purchase') THEN '{I}'
      WHEN event_type IN ('view', 'click') THEN '{U}' END AS OP,
    (event_id - event_id % 10 + 10) * 1000 AS MOST,
    (event_id - event_id % 10 + 10) * 1000 + event_id % 10 + 1 AS LEAST
  FROM keyed),
journal AS (
  SELECT OLD_ID AS {PK}, {payload}, LEAST AS {LEAST}, MOST AS {MOST}, OP AS EVENT_TYPE,
    EVENT_TS AS SEEN_AT, concat('{{"offset_token":"', LEAST, '"}}') AS METADATA
  FROM inspections)"""


_SPLIT = f"""
feed AS (
  SELECT * FROM journal WHERE NOT (EVENT_TYPE = '{U}' AND {PK} <> PAYLOAD__INSPECTION_ID)
  UNION ALL
  SELECT {PK}, {_list(*['NULL' for _ in S.SOURCE_COLUMNS])}, {LEAST}, {MOST}, '{D}', SEEN_AT, METADATA
  FROM journal WHERE EVENT_TYPE = '{U}' AND {PK} <> PAYLOAD__INSPECTION_ID
  UNION ALL
  SELECT PAYLOAD__INSPECTION_ID, {_list(*S.SOURCE_COLUMNS, prefix='PAYLOAD__')}, {LEAST}, {MOST}, '{I}', SEEN_AT,
    METADATA
  FROM journal WHERE EVENT_TYPE = '{U}' AND {PK} <> PAYLOAD__INSPECTION_ID)"""


def _winners(name: str, source: str) -> str:
    return f"""
{name} AS (SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {PK} ORDER BY {MOST} DESC, {LEAST} DESC) AS _rn
  FROM {source} WHERE EVENT_TYPE IN ('{I}', '{U}', '{D}')) WHERE _rn = 1)"""


def _settled(name: str, winners: str, source: str) -> str:
    payload = _list(*[f"PAYLOAD__{c} AS {c}" for c in S.SOURCE_COLUMNS if c != S.KEY])
    return f"""
{name} AS (
  SELECT CASE WHEN EVENT_TYPE = '{D}' THEN {PK} ELSE PAYLOAD__INSPECTION_ID END AS INSPECTION_ID, {payload},
    (SELECT max(SEEN_AT) FROM {source}) AS _inserted_at, (SELECT max(SEEN_AT) FROM {source}) AS _updated_at,
    EVENT_TYPE = '{D}' AS _deleted
  FROM {winners})"""


def _merged(name: str, target: str, winners: str, source: str) -> str:
    columns = _list(*[
        f"CASE WHEN s.{PK} IS NULL OR (t._m AND s.EVENT_TYPE = '{D}') THEN t.{c} "
        + (f"WHEN s.EVENT_TYPE = '{D}' THEN s.{PK} " if c == S.KEY else "")
        + f"ELSE s.PAYLOAD__{c} END AS {c}"
        for c in S.SOURCE_COLUMNS])
    now = f"(SELECT max(SEEN_AT) FROM {source})"
    return f"""
{name} AS (
  SELECT {columns},
    CASE WHEN t._m THEN t._inserted_at ELSE {now} END AS _inserted_at,
    CASE WHEN s.{PK} IS NULL THEN t._updated_at ELSE {now} END AS _updated_at,
    CASE WHEN s.{PK} IS NULL THEN t._deleted ELSE s.EVENT_TYPE = '{D}' END AS _deleted
  FROM (SELECT *, true AS _m FROM {target}) t FULL JOIN {winners} s ON t.INSPECTION_ID = s.{PK})"""


def _halves(feed: str = "journal") -> str:
    """Two batches, the state after each, and after both at once."""
    return ",".join([
        f"\ncut AS (SELECT (min({MOST}) + max({MOST})) // 2 AS pos FROM {feed})",
        f"\nfirst_half AS (SELECT * FROM {feed} WHERE {MOST} <= (SELECT pos FROM cut))",
        f"\nsecond_half AS (SELECT * FROM {feed} WHERE {MOST} > (SELECT pos FROM cut))",
        _winners("w1", "first_half"), _winners("w2", "second_half"), _winners("winners", feed),
        _settled("t1", "w1", "first_half"), _merged("t2", "t1", "w2", "second_half"),
        _settled("settled", "winners", feed),
    ])


def _live(name: str, state: str) -> str:
    return f"""
{name} AS (SELECT {_list(*S.SOURCE_COLUMNS)}, CAST(STATUS = 'FAIL' AS INTEGER) AS IS_SCRAP
  FROM {state} WHERE NOT _deleted)"""


_TELEMETRY = """
telemetry AS (
  SELECT concat(CASE event_id % 4 WHEN 0 THEN 'ST-WELD' WHEN 3 THEN 'ST-ASSY' ELSE 'ST-PAINT' END,
      '-0', user_id % 2 + 1) AS STATION_ID,
    CASE event_id % 4 WHEN 0 THEN 'WELD' WHEN 3 THEN 'ASSEMBLY' ELSE 'PAINT' END AS LINE,
    CASE event_id % 4 WHEN 0 THEN 'weld_current' WHEN 1 THEN 'booth_humidity' WHEN 2 THEN 'booth_temp'
      ELSE 'torque_nm' END AS METRIC,
    value AS VALUE, ts AS EVENT_TS
  FROM events)"""


def _health(width: int) -> str:
    return f"""
health AS (
  SELECT STATION_ID, LINE, METRIC, {_bucket('EVENT_TS', width)} AS BUCKET,
    CAST(count(*) AS INTEGER) AS READINGS,
    avg(VALUE) AS AVG_VALUE,
    max(VALUE) AS MAX_VALUE
  FROM telemetry GROUP BY 1, 2, 3, 4),
humidity AS (
  SELECT LINE, BUCKET, avg(AVG_VALUE) AS AVG_BOOTH_HUMIDITY
  FROM health WHERE METRIC = 'booth_humidity' GROUP BY 1, 2)"""


def _yields(width: int, name: str = "yields", live: str = "live") -> str:
    return f"""
{name} AS (
  SELECT p.LINE, p.BUCKET, CAST(u AS INTEGER) AS UNITS, CAST(sc AS INTEGER) AS SCRAP_UNITS,
    {_yield_pct('u', 'sc')} AS FIRST_PASS_YIELD_PCT, AVG_BOOTH_HUMIDITY
  FROM (SELECT LINE, {_bucket('EVENT_TS', width)} AS BUCKET, count(*) AS u, CAST(sum(IS_SCRAP) AS BIGINT) AS sc
        FROM {live} GROUP BY 1, 2) p
  LEFT JOIN humidity h ON h.LINE = p.LINE AND h.BUCKET = p.BUCKET)"""


def _defects(width: int) -> str:
    return f"""
defects AS (
  SELECT LINE, {_bucket('EVENT_TS', width)} AS BUCKET, coalesce(DEFECT_CODE, 'NONE') AS DEFECT_CODE,
    CAST(count(*) AS INTEGER) AS N
  FROM live GROUP BY 1, 2, 3)"""


def _feed(final: str, rekey: bool = False) -> str:
    return f"WITH {_journal(rekey)}\n{final}"


def _state(final: str, rekey: bool = False, split: bool = False) -> str:
    parts = [_journal(rekey)] + ([_SPLIT] if split else []) + [_halves("feed" if split else "journal")]
    return f"WITH {','.join(parts)}\n{final}"


def _readings(final: str, width: int = 5) -> str:
    return f"WITH {_TELEMETRY}, {_health(width)}\n{final}"


def _gold(final: str, width: int = 5, more: str = "") -> str:
    parts = [_journal(), _winners("winners", "journal"), _settled("settled", "winners", "journal"),
             _live("live", "settled"), _TELEMETRY, _health(width), _yields(width), _defects(width)]
    return f"WITH {','.join(parts)}{',' + more if more else ''}\n{final}"


_NOW = "(SELECT max(ts) FROM events)"
_SUMS = "CAST(sum(UNITS) AS BIGINT) AS total_units, CAST(sum(SCRAP_UNITS) AS BIGINT) AS total_scrap"
_WEIGHTED = f"{_yield_pct('CAST(sum(UNITS) AS BIGINT)', 'CAST(sum(SCRAP_UNITS) AS BIGINT)')} AS avg_yield_pct"
_SERIES = """
series AS (
  SELECT LINE AS line, BUCKET AS bucket, UNITS AS units, SCRAP_UNITS AS scrap_units,
    CAST(FIRST_PASS_YIELD_PCT AS DOUBLE) AS first_pass_yield_pct, AVG_BOOTH_HUMIDITY AS avg_booth_humidity
  FROM yields WHERE BUCKET >= {now} - INTERVAL '{back} minutes')"""
_VERSIONS = ",".join([
    _journal(), _halves(), _live("old_live", "t1"), _live("live", "t2"), _TELEMETRY])
_COMPLETE = """
recent AS (
  SELECT * FROM yields WHERE BUCKET IN (
    SELECT DISTINCT BUCKET FROM yields WHERE BUCKET + INTERVAL '{width} minutes' <= {now}
    ORDER BY BUCKET DESC LIMIT 3))"""
_INSPECTION_COLUMNS = _list(*S.SOURCE_COLUMNS, *S.BOOKKEEPING)


def _seconds(start: str, end: str) -> str:
    return f"date_diff('second', {start}, {end})"


def _compare(back: int) -> str:
    return f"""
SELECT n.LINE, n.BUCKET, n.UNITS AS NOW_UNITS, n.FIRST_PASS_YIELD_PCT AS NOW_PCT, t.UNITS AS THEN_UNITS,
  t.FIRST_PASS_YIELD_PCT AS THEN_PCT, n.FIRST_PASS_YIELD_PCT - t.FIRST_PASS_YIELD_PCT AS CHANGE_PCT
FROM yields n LEFT JOIN yields t ON t.LINE = n.LINE AND t.BUCKET + INTERVAL '{back} minutes' = n.BUCKET"""


def _repeats(table: str, source: str, keys: str) -> str:
    return f"""SELECT '{table}' AS TABLE_NAME, CAST(coalesce(sum(n), 0) AS BIGINT) AS "ROWS", count(*) AS KEYS,
  count(*) FILTER (WHERE n > 1) AS REPEATED_KEYS FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})"""


def _lost(name: str, many: str) -> str:
    return f"""SELECT '{name}' AS RELATIONSHIP, count(*) AS MISSING_KEYS,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS MISSING_ROWS
  FROM (SELECT LINE, BUCKET, count(*) AS n FROM {many} GROUP BY 1, 2) m
  WHERE NOT EXISTS (SELECT 1 FROM yields y WHERE y.LINE = m.LINE AND y.BUCKET = m.BUCKET)"""


def _rule(name: str, source: str, holds: str) -> str:
    return f"""SELECT '{name}' AS RULE, count(*) AS CHECKED_ROWS,
  count(*) FILTER (WHERE NOT coalesce({holds}, false)) AS BROKEN_ROWS FROM {source}"""


_PAYLOAD_EMPTY = " AND ".join(f"PAYLOAD__{c} IS NULL" for c in S.SOURCE_COLUMNS)
_JOURNAL_RULES = [
    ("key_shape", f"regexp_matches({PK}, '^S-[0-9]+$')"),
    ("event_type", f"EVENT_TYPE IN ('{I}', '{U}', '{D}')"),
    ("positions_present", f"{MOST} IS NOT NULL AND {LEAST} IS NOT NULL"),
    ("payload_empty_iff_delete", f"(EVENT_TYPE = '{D}') = ({_PAYLOAD_EMPTY})"),
]
_LINES = "LINE IN ('WELD', 'PAINT', 'ASSEMBLY')"
_OTHER_RULES = [
    ("line_domain", "live", _LINES),
    ("status_domain", "live", "STATUS IN ('PASS', 'FAIL')"),
    ("code_empty_iff_pass", "live", "(STATUS = 'PASS') = (DEFECT_CODE IS NULL)"),
    ("telemetry_line_domain", "telemetry", _LINES),
    ("metric_domain", "telemetry", "METRIC IN ('weld_current', 'booth_humidity', 'booth_temp', 'torque_nm')"),
    ("value_finite", "telemetry", "VALUE IS NOT NULL AND isfinite(VALUE)"),
]


def _direct() -> str:
    """A tick settled by running windows, then laid over the first half's state."""
    untouched = [c for c in S.SOURCE_COLUMNS if c not in (S.KEY, "STATUS", "DEFECT_CODE", "UPDATED_TS")]
    now = "(SELECT max(SEEN_AT) FROM second_half)"
    patched = _list(*[
        f"CASE WHEN u.INSPECTION_ID IS NOT NULL AND (i.INSPECTION_ID IS NOT NULL OR NOT t._deleted) THEN u.{c} "
        f"WHEN i.INSPECTION_ID IS NOT NULL THEN i.{c} ELSE t.{c} END AS {c}"
        for c in ("STATUS", "DEFECT_CODE", "UPDATED_TS")])
    return f"WITH {_journal()},{_halves()}," + f"""
tick AS (
  SELECT *, max(LEAST) FILTER (WHERE OP = '{I}') OVER (PARTITION BY INSPECTION_ID) AS ins_at
  FROM inspections WHERE MOST > (SELECT pos FROM cut)),
later AS (
  SELECT *, min(LEAST) FILTER (WHERE OP = '{D}') OVER (PARTITION BY INSPECTION_ID) AS void_at
  FROM tick WHERE OP <> '{I}' AND (ins_at IS NULL OR LEAST > ins_at)),
i AS (SELECT * FROM tick WHERE OP = '{I}' AND LEAST = ins_at),
v AS (SELECT DISTINCT INSPECTION_ID FROM later WHERE void_at IS NOT NULL),
u AS (SELECT * FROM later WHERE OP = '{U}' AND (void_at IS NULL OR LEAST < void_at)
  QUALIFY row_number() OVER (PARTITION BY INSPECTION_ID ORDER BY LEAST DESC) = 1)
SELECT coalesce(t.INSPECTION_ID, i.INSPECTION_ID) AS INSPECTION_ID,
  {_list(*[f"CASE WHEN i.INSPECTION_ID IS NOT NULL THEN i.{c} ELSE t.{c} END AS {c}" for c in untouched])},
  {patched},
  coalesce(t._inserted_at, {now}) AS _inserted_at,
  CASE WHEN i.INSPECTION_ID IS NOT NULL OR v.INSPECTION_ID IS NOT NULL
    OR (u.INSPECTION_ID IS NOT NULL AND NOT t._deleted) THEN {now} ELSE t._updated_at END AS _updated_at,
  CASE WHEN i.INSPECTION_ID IS NOT NULL THEN v.INSPECTION_ID IS NOT NULL
    ELSE t._deleted OR v.INSPECTION_ID IS NOT NULL END AS _deleted
FROM t1 t FULL JOIN i ON i.INSPECTION_ID = t.INSPECTION_ID
LEFT JOIN u ON u.INSPECTION_ID = coalesce(t.INSPECTION_ID, i.INSPECTION_ID)
LEFT JOIN v ON v.INSPECTION_ID = coalesce(t.INSPECTION_ID, i.INSPECTION_ID)"""


def _contract() -> str:
    sources = {"INSPECTIONS_ACTIVE": "live", "STATION_HEALTH": "health", "YIELD_BY_LINE_5MIN": "yields",
               "DEFECT_COUNTS_5MIN": "defects"}
    rows = []
    for table, column, kind in S.CONTRACT:
        absent = (table, column) == ("DEFECT_COUNTS_5MIN", "N")
        nulls = "CAST(NULL AS BIGINT)" if absent else (
            f"(SELECT count(*) FROM {sources[table]} WHERE {column} IS NULL)")
        actual, verdict = ("-- absent --", "-- MISSING COLUMN --") if absent else (kind, "ok")
        rows.append(f"SELECT '{table}' AS object_name, '{column}' AS column_name, '{kind}' AS expected_type, "
                    f"'{actual}' AS actual_type, '{verdict}' AS verdict, {nulls} AS null_rows")
    return _gold("\nUNION ALL ".join(rows))


def _inventory() -> str:
    counts = [
        (1, "Part 1", "QUALITY_INSPECTIONS", "table", "settled", "current state, kept by the merge"),
        (2, "Part 1", "STATION_TELEMETRY", "table", "telemetry", "readings of all stations"),
        (9, "Part 1", "SIMULATOR_CONTROL", "table", None, "control modes of the feeds"),
        (3, "Part 1", "QUALITY_INSPECTIONS_JOURNAL", "journal", "journal", "change events"),
        (4, "Part 3", "INSPECTIONS_ACTIVE", "derived", "live", "live inspections"),
        (5, "Part 3", "STATION_HEALTH", "derived", "health", "readings rolled up per 5 minutes"),
        (6, "Part 3", "YIELD_BY_LINE_5MIN", "derived", "yields", "yield joined with humidity"),
        (7, "Part 3", "DEFECT_COUNTS_5MIN", "derived", None, "counts per defect code"),
        (8, "Part 4", "PLANT_FLOOR", "metric view", "", "what questions are asked of"),
    ]
    rows = [
        f"SELECT {seq} AS seq, '{part}' AS part, '{name}' AS object_name, '{kind}' AS kind, "
        f"'{'-- NOT YET --' if source is None else 'built'}' AS status, "
        + (f"(SELECT count(*) FROM {source})" if source else "CAST(NULL AS BIGINT)")
        + f" AS approx_rows, '{what}' AS what_it_is"
        for seq, part, name, kind, source, what in counts]
    return _gold("\nUNION ALL ".join(rows))


def _growth() -> str:
    def row(name: str, source: str, at: str, earlier: str | None) -> str:
        held = f"(SELECT count(*) FROM {earlier})" if earlier else "CAST(NULL AS BIGINT)"
        return (
            f"""SELECT '{name}' AS TABLE_NAME, count(*) AS "ROWS", max({at}) AS NEWEST,
  {_seconds(f'max({at})', _NOW)} AS AGE_SECS, {held} AS EARLIER_ROWS,
  count(*) - coalesce({held}, 0) AS GROWN, count(*) - coalesce({held}, 0) > 0 AS IS_CLIMBING FROM {source}""")

    parts = [_journal(), _halves(), _TELEMETRY]
    return f"WITH {','.join(parts)}\n" + "\nUNION ALL ".join([
        row("JOURNAL", "journal", "SEEN_AT", "first_half"),
        row("QUALITY_INSPECTIONS", "settled", "EVENT_TS", "t1"),
        row("STATION_TELEMETRY", "telemetry", "EVENT_TS", None)])


def _json(source: str, columns: list[str]) -> str:
    """Rows as one JSON text each, NULL fields kept, times in milliseconds."""
    def value(c: str) -> str:
        return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%g')" if c.endswith(("_TS", "SEEN_AT")) else c

    pairs = _list(*[f"'{c}': {value(c)}" for c in columns])
    return f"SELECT CAST(to_json({{{pairs}}}) AS VARCHAR) AS value FROM {source}"


_OPERATIONS = f"""
operations AS (
  SELECT CASE OP WHEN '{I}' THEN 'INSERT' WHEN '{U}' THEN 'UPDATE' ELSE 'DELETE(soft)' END AS op, INSPECTION_ID,
    {_list(*[f"CASE WHEN OP <> '{D}' THEN {c} END AS {c}" for c in S.SOURCE_COLUMNS if c != S.KEY])}
  FROM inspections)"""

def _gates(final: str) -> str:
    """Every key's state after each gate that changed it, and from these each bucket's counts as of each gate."""
    return f"""WITH {_journal()},
version AS (
  SELECT {PK} AS k, {MOST} // 1000000 AS GATE, EVENT_TYPE, PAYLOAD__LINE AS LINE, {_bucket('PAYLOAD__EVENT_TS', HOUR)} AS BUCKET,
    CAST(PAYLOAD__STATUS = 'FAIL' AS INTEGER) AS sc
  FROM journal WHERE EVENT_TYPE IN ('{I}', '{U}', '{D}')
  QUALIFY row_number() OVER (PARTITION BY {PK}, {MOST} // 1000000 ORDER BY {MOST} DESC, {LEAST} DESC) = 1),
spell AS (
  SELECT *, lead(GATE) OVER (PARTITION BY k ORDER BY GATE) AS until FROM version),
edge AS (
  SELECT LINE, BUCKET, GATE, 1 AS u, sc AS s FROM spell WHERE EVENT_TYPE <> '{D}'
  UNION ALL SELECT LINE, BUCKET, until, -1, -sc FROM spell WHERE EVENT_TYPE <> '{D}' AND until IS NOT NULL),
moved AS (
  SELECT LINE, BUCKET, GATE, sum(u) AS u, sum(s) AS s FROM edge GROUP BY 1, 2, 3 HAVING sum(u) <> 0 OR sum(s) <> 0),
gate_value AS (
  SELECT LINE, BUCKET, GATE,
    CAST(sum(u) OVER w AS BIGINT) AS UNITS, CAST(sum(s) OVER w AS BIGINT) AS SCRAP_UNITS
  FROM moved WINDOW w AS (PARTITION BY LINE, BUCKET ORDER BY GATE))
{final}"""


_RAN = """
FROM (SELECT *, (event_id - low) // ((high - low) // 3 + 1) AS step
      FROM events, (SELECT min(event_id) AS low, max(event_id) AS high FROM events))"""
_REFRESHES = f"""
SELECT 'YIELD_BY_LINE_5MIN' AS name, count(DISTINCT step) AS succeeded, CAST(0 AS BIGINT) AS failed, max(ts) AS newest_data {_RAN}
UNION ALL
SELECT 'DEFECT_COUNTS_5MIN', count(DISTINCT step) FILTER (step < 2), count(DISTINCT step) FILTER (step = 2),
  max(ts) FILTER (step < 2) {_RAN}"""
_INCIDENTS = f"""
signal AS (
  SELECT coalesce(y.LINE, c.LINE) AS LINE, coalesce(y.BUCKET, c.BUCKET) AS BUCKET, coalesce(AVG_BOOTH_HUMIDITY > 60, false) AS h,
    coalesce(n >= 1, false) AS d, coalesce(FIRST_PASS_YIELD_PCT < 90, false) AS y
  FROM yields y FULL JOIN (
    SELECT LINE, BUCKET, sum(N) AS n FROM defects WHERE DEFECT_CODE <> 'NONE' GROUP BY 1, 2) c
    ON c.LINE = y.LINE AND c.BUCKET = y.BUCKET),
apart AS (
  SELECT *, coalesce(BUCKET - lag(BUCKET) OVER (PARTITION BY LINE ORDER BY BUCKET) > INTERVAL '10 minutes', true) AS begins
  FROM signal WHERE BUCKET IS NOT NULL AND (h OR d OR y)),
island AS (
  SELECT *, CAST(sum(CAST(begins AS INTEGER)) OVER (PARTITION BY LINE ORDER BY BUCKET) AS BIGINT) AS INCIDENT FROM apart),
incident AS (
  SELECT LINE, INCIDENT, min(BUCKET) AS STARTED_AT, max(BUCKET) + INTERVAL '5 minutes' AS ENDED_AT, count(*) AS BUCKETS,
    min(BUCKET) FILTER (h) AS HUMIDITY_AT, min(BUCKET) FILTER (d) AS DEFECTS_AT, min(BUCKET) FILTER (y) AS YIELD_AT
  FROM island GROUP BY 1, 2)"""

ORACLES: dict[str, str] = {
    # sources and sinks
    "journal_read": _feed("SELECT * FROM journal"),
    "telemetry_read": _readings("SELECT * FROM telemetry"),
    "telemetry_append_stream": _readings("SELECT * FROM telemetry"),
    "journal_append_stream": _feed("SELECT * FROM journal"),
    "journal_consume_once": _feed(f"""
SELECT EVENT_TYPE, count(*) AS CONSUMED, min({LEAST}) AS FIRST_POSITION, max({LEAST}) AS LAST_POSITION
FROM journal GROUP BY 1"""),
    "committed_offset": _feed(f"""
SELECT 'cdc_journal_1' AS channel, max({LEAST}) AS offset_token, count(*) AS rows_landed FROM journal
UNION ALL SELECT 'telemetry_1', max(event_id), count(*) FROM events"""),
    "open_table_read": _gold("SELECT LINE, BUCKET, UNITS, FIRST_PASS_YIELD_PCT FROM yields WHERE LINE = 'PAINT'"),
    "open_table_counts": _gold(
        "SELECT count(*) AS total_rows, count(*) FILTER (WHERE LINE = 'PAINT') AS filtered_rows FROM yields"),
    "export_json_lines": _feed(_json("journal", list(S.JOURNAL.names))),
    "export_operations": f"WITH {_journal()}, {_OPERATIONS}\n" + _json("operations", ["op", *S.SOURCE_COLUMNS]),
    "latest_row_wins": """
SELECT OWNER, upper(trim(coalesce(nullif(MODE, ''), 'STEADY'))) AS MODE
FROM (SELECT user_id AS OWNER, CASE WHEN event_type = 'click' THEN '' ELSE concat(' ', event_type, ' ') END AS MODE,
        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""",
    "latest_mode": """
SELECT upper(trim(coalesce(nullif(MODE, ''), 'STEADY'))) AS MODE
FROM (SELECT CASE WHEN event_type = 'click' THEN '' ELSE concat(' ', event_type, ' ') END AS MODE
      FROM events ORDER BY ts DESC LIMIT 1)""",
    "seed_if_empty": f"WITH {_journal()},{_halves()},{_settled('n', 'w2', 'second_half')}" + """
SELECT INSPECTION_ID, LINE, STATUS, EVENT_TS FROM t1
UNION ALL SELECT INSPECTION_ID, LINE, STATUS, EVENT_TS FROM n
WHERE NOT EXISTS (SELECT 1 FROM t1 WHERE t1.INSPECTION_ID = n.INSPECTION_ID)""",
    # change data
    "cdc_encode": _feed("SELECT * FROM journal", rekey=True),
    "cdc_event_filter": _feed(f"SELECT {PK}, EVENT_TYPE, {MOST}, {LEAST} FROM journal"),
    "cdc_latest_per_key": _state("SELECT * FROM winners"),
    "cdc_latest_per_key_stream": _state(
        f"SELECT {PK}, EVENT_TYPE, PAYLOAD__STATUS, PAYLOAD__EVENT_TS, {MOST}, {LEAST} FROM winners"),
    "cdc_merge_apply": _state(f"SELECT {_INSPECTION_COLUMNS} FROM t2"),
    "cdc_soft_delete": _state(f"SELECT {_INSPECTION_COLUMNS} FROM t2 WHERE _deleted AND _updated_at > _inserted_at"),
    "cdc_tombstone": _state(f"SELECT {_INSPECTION_COLUMNS} FROM t2 WHERE _deleted AND STATUS IS NULL"),
    "cdc_revive": _state(f"""SELECT {_INSPECTION_COLUMNS} FROM t2
WHERE NOT _deleted AND INSPECTION_ID IN (SELECT INSPECTION_ID FROM t1 WHERE _deleted)"""),
    "cdc_key_rewrite": _state(f"SELECT {_INSPECTION_COLUMNS} FROM t2", rekey=True),
    "cdc_key_split": _state(f"SELECT {_INSPECTION_COLUMNS} FROM t2", rekey=True, split=True),
    "cdc_position_guard": _state(f"""
SELECT coalesce(late.{PK}, early.{PK}) AS INSPECTION_ID,
  CASE WHEN late.{PK} IS NOT NULL THEN late.PAYLOAD__STATUS ELSE early.PAYLOAD__STATUS END AS STATUS,
  coalesce(late.EVENT_TYPE, early.EVENT_TYPE) = '{D}' AS _deleted,
  coalesce(late.{LEAST}, early.{LEAST}) AS _least
FROM w2 late FULL JOIN w1 early ON early.{PK} = late.{PK}"""),
    "cdc_merge_stream": _gold(f"SELECT {_list(*S.SOURCE_COLUMNS)}, IS_SCRAP FROM live"),
    "merge_log": _feed(f"""
SELECT step AS batch_id, n AS rows_affected, row_number() OVER (ORDER BY step) AS merges,
  CAST(sum(n) OVER (ORDER BY step) AS BIGINT) AS rows_total
FROM (SELECT (event_id - low) // ((high - low) // 3 + 1) AS step, count(DISTINCT old_id) AS n
      FROM keyed, (SELECT min(event_id) AS low, max(event_id) AS high FROM events)
      WHERE event_type IN ('error', 'signup', 'purchase', 'view', 'click') GROUP BY 1)"""),
    "snapshot_then_journal": f"WITH {_journal()},{_halves()},"
                             f"\nloaded AS (SELECT * FROM t1 WHERE NOT _deleted),"
                             f"{_merged('result', 'loaded', 'w2', 'second_half')}"
                             f"\nSELECT {_INSPECTION_COLUMNS} FROM result",
    "journal_prune": _state(f"SELECT {PK}, EVENT_TYPE, {MOST}, {LEAST} FROM second_half"),
    "direct_apply": _direct(),
    "journal_tail": _feed(f"""
SELECT EVENT_TYPE, {PK}, PAYLOAD__STATUS, PAYLOAD__DEFECT_CODE, {MOST} AS txn_lsn, {LEAST} AS msg_lsn, SEEN_AT
FROM journal ORDER BY {MOST} DESC, {LEAST} DESC LIMIT 20"""),
    "journal_metadata": _feed(f"""
SELECT {MOST}, {LEAST}, METADATA AS raw_variant, 'STRING' AS what_it_really_is, CAST(NULL AS VARCHAR) AS unparsed_token,
  CAST({LEAST} AS VARCHAR) AS offset_token FROM journal"""),
    "event_mix": _feed("SELECT EVENT_TYPE, count(*) AS n FROM journal GROUP BY 1 ORDER BY 2 DESC"),
    "merge_backlog": _state(f"""
SELECT (SELECT count(*) FROM journal WHERE EVENT_TYPE = '{I}') AS journal_inserts,
  (SELECT count(*) FROM t1) AS destination_rows,
  (SELECT count(*) FROM journal WHERE EVENT_TYPE = '{I}') - (SELECT count(*) FROM t1) AS awaiting_merge,
  EXISTS (SELECT 1 FROM journal WHERE ({MOST}, {LEAST}) > (
    SELECT ({MOST}, {LEAST}) FROM first_half ORDER BY {MOST} DESC, {LEAST} DESC LIMIT 1)) AS stream_has_pending"""),
    "deleted_rows": _state("""
SELECT INSPECTION_ID, LINE, STATUS, DEFECT_CODE, _deleted, _inserted_at, _updated_at FROM t2 WHERE _deleted"""),
    "rewritten_rows": _state("""
SELECT INSPECTION_ID, LINE, STATUS, DEFECT_CODE, _inserted_at, _updated_at FROM t2
WHERE _updated_at > _inserted_at AND NOT _deleted"""),
    "merge_audit": """
SELECT strftime(ts, '%H:%M:%S') AS fired_at, 'MERGE' AS query_type, event_id AS rows_affected,
  CAST((CAST(round(value * 100) AS BIGINT) + 50) // 100 / 10.0 AS DECIMAL(18,1)) AS merge_seconds,
  'WH' AS warehouse_name, 'cdc.signup' AS connector_operation, 'full_values' AS merge_strategy
FROM events WHERE event_type = 'signup' ORDER BY ts DESC, event_id DESC LIMIT 10""",
    "merge_audit_run": _feed(f"""
SELECT 'MERGE' AS query_type, count(DISTINCT old_id) AS rows_affected, concat('cdc.merge.', step) AS connector_operation,
  'full_values' AS merge_strategy, true AS timed
FROM (SELECT *, (event_id - low) // ((high - low) // 3 + 1) AS step
      FROM keyed, (SELECT min(event_id) AS low, max(event_id) AS high FROM events))
WHERE event_type IN ('error', 'signup', 'purchase', 'view', 'click') GROUP BY step"""),
    # derived tables
    "inspections_active": _gold(f"SELECT {_list(*S.SOURCE_COLUMNS)}, IS_SCRAP FROM live"),
    "station_health": _readings("SELECT * FROM health"),
    "station_health_stream": _readings("SELECT * FROM health"),
    "station_health_stateful": _readings("SELECT * FROM health"),
    "yield_by_line": _gold("SELECT * FROM yields"),
    "yield_by_line_hour": _gold("SELECT * FROM yields", HOUR),
    "defect_counts": _gold("SELECT * FROM defects"),
    "defect_counts_day": _gold("SELECT * FROM defects", DAY),
    "incremental_refresh": f"WITH {_VERSIONS},{_health(HOUR)},{_yields(HOUR)}\nSELECT * FROM yields",
    "incremental_refresh_groups": f"WITH {_VERSIONS},{_health(HOUR)},{_yields(HOUR)}\nSELECT * FROM yields",
    "gate_values": _gates("SELECT LINE, BUCKET, GATE, UNITS, SCRAP_UNITS FROM gate_value"),
    "restatements": _gates("""
SELECT LINE, BUCKET, min(GATE) AS FIRST_GATE, max(GATE) AS LAST_GATE, count(*) - 1 AS RESTATED,
  min_by(UNITS, GATE) AS FIRST_UNITS, max_by(UNITS, GATE) AS LAST_UNITS,
  min_by(SCRAP_UNITS, GATE) AS FIRST_SCRAP_UNITS, max_by(SCRAP_UNITS, GATE) AS LAST_SCRAP_UNITS,
  max_by(UNITS, GATE) = 0 AS REMOVED
FROM gate_value GROUP BY 1, 2"""),
    "incremental_refresh_delta": f"WITH {_VERSIONS},{_defects(HOUR)}\nSELECT * FROM defects",
    "restated_buckets": f"WITH {_VERSIONS},{_health(DAY)},{_yields(DAY, 'old_y', 'old_live')},{_yields(DAY, 'new_y')}" + """
SELECT coalesce(n.LINE, o.LINE) AS LINE, coalesce(n.BUCKET, o.BUCKET) AS BUCKET,
  o.UNITS AS OLD_UNITS, n.UNITS AS NEW_UNITS, o.SCRAP_UNITS AS OLD_SCRAP_UNITS, n.SCRAP_UNITS AS NEW_SCRAP_UNITS,
  o.FIRST_PASS_YIELD_PCT AS OLD_FIRST_PASS_YIELD_PCT, n.FIRST_PASS_YIELD_PCT AS NEW_FIRST_PASS_YIELD_PCT,
  n.UNITS - o.UNITS AS CHANGE_UNITS, n.SCRAP_UNITS - o.SCRAP_UNITS AS CHANGE_SCRAP_UNITS,
  n.FIRST_PASS_YIELD_PCT - o.FIRST_PASS_YIELD_PCT AS CHANGE_FIRST_PASS_YIELD_PCT,
  CASE WHEN o.LINE IS NULL THEN 'added' WHEN n.LINE IS NULL THEN 'removed' ELSE 'restated' END AS CHANGE
FROM old_y o FULL JOIN new_y n ON n.LINE = o.LINE AND n.BUCKET = o.BUCKET
WHERE o.UNITS IS DISTINCT FROM n.UNITS OR o.SCRAP_UNITS IS DISTINCT FROM n.SCRAP_UNITS""",
    "pipeline_stream": _gold("SELECT * FROM yields"),
    "pipeline_stream_defects": _gold("SELECT * FROM defects"),
    "top_defect_per_bucket": _gold("""
SELECT LINE, BUCKET, DEFECT_CODE AS TOP_DEFECT_CODE, N FROM (
  SELECT *, row_number() OVER (PARTITION BY LINE, BUCKET ORDER BY N DESC, DEFECT_CODE) AS rn FROM defects)
WHERE rn = 1"""),
    # serving
    "recent_yield": _gold("""
SELECT LINE, BUCKET, UNITS, SCRAP_UNITS, FIRST_PASS_YIELD_PCT, round(AVG_BOOTH_HUMIDITY, 1) AS HUMIDITY
FROM yields ORDER BY BUCKET DESC, LINE LIMIT 12"""),
    "top_defects": _gold(f"""
SELECT LINE, DEFECT_CODE, CAST(sum(N) AS BIGINT) AS N FROM defects
WHERE DEFECT_CODE <> 'NONE' AND BUCKET >= {_NOW} - INTERVAL '1440 minutes'
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5"""),
    "top_defects_day": _gold(f"""
SELECT LINE, DEFECT_CODE, CAST(sum(N) AS BIGINT) AS N FROM defects
WHERE DEFECT_CODE <> 'NONE' AND BUCKET >= {_NOW} - INTERVAL '1440 minutes' GROUP BY 1, 2"""),
    "yield_series": _gold("SELECT * FROM series", more=_SERIES.format(now=_NOW, back=60)),
    "yield_series_day": _gold("SELECT * FROM series", more=_SERIES.format(now=_NOW, back=DAY)),
    "kpi_latest": _gold("""
SELECT l.line, (SELECT max(bucket) FROM series) AS bucket, round(s.first_pass_yield_pct, 1) AS yield_pct,
  s.units, s.scrap_units, s.first_pass_yield_pct < 85 AS is_low
FROM (VALUES ('WELD'), ('PAINT'), ('ASSEMBLY')) l(line)
LEFT JOIN series s ON s.line = l.line AND s.bucket = (SELECT max(bucket) FROM series)""",
                        more=_SERIES.format(now=_NOW, back=60)),
    "series_long": _gold("""
SELECT bucket, line AS series, first_pass_yield_pct AS value FROM series
UNION ALL SELECT bucket, 'booth_humidity', avg_booth_humidity FROM series WHERE avg_booth_humidity IS NOT NULL""",
                         more=_SERIES.format(now=_NOW, back=DAY)),
    "gold_lag": f"""
SELECT max({_seconds('data_ts', _NOW)}) AS lag_secs FROM (
  SELECT user_id % 4 AS name, max(ts) AS data_ts FROM events
  WHERE event_type <> 'error' AND user_id % 4 IN (2, 3) GROUP BY 1)""",
    "refresh_report": f"SELECT *, {_seconds('newest_data', _NOW)} AS lag_secs FROM ({_REFRESHES})",
    "gold_lag_run": f"SELECT max({_seconds('newest_data', _NOW)}) AS lag_secs FROM ({_REFRESHES})",
    "metric_query": _gold(f"""
SELECT line, bucket, max(total_units) AS total_units, max(defect_count) AS defect_count,
  max(avg_reading) AS avg_reading, max(peak_reading) AS peak_reading
FROM (
  SELECT LINE AS line, BUCKET AS bucket, CAST(sum(UNITS) AS BIGINT) AS total_units, NULL AS defect_count,
    NULL AS avg_reading, NULL AS peak_reading FROM yields WHERE LINE <> 'WELD' GROUP BY 1, 2
  UNION ALL
  SELECT y.LINE, y.BUCKET, NULL, CAST(sum(N) AS BIGINT), NULL, NULL
  FROM defects x LEFT JOIN yields y ON y.LINE = x.LINE AND y.BUCKET = x.BUCKET WHERE y.LINE <> 'WELD' GROUP BY 1, 2
  UNION ALL
  SELECT y.LINE, y.BUCKET, NULL, NULL, {_average('AVG_VALUE')}, max(MAX_VALUE)
  FROM health x LEFT JOIN yields y ON y.LINE = x.LINE AND y.BUCKET = x.BUCKET WHERE y.LINE <> 'WELD' GROUP BY 1, 2)
GROUP BY 1, 2""", HOUR),
    "metrics_all": _gold(f"""
SELECT line, max(total_units) AS total_units, max(total_scrap) AS total_scrap, max(avg_yield_pct) AS avg_yield_pct,
  max(avg_humidity) AS avg_humidity, max(defect_count) AS defect_count,
  max(avg_reading) AS avg_reading, max(peak_reading) AS peak_reading
FROM (
  SELECT LINE AS line, {_SUMS}, {_WEIGHTED}, {_average('AVG_BOOTH_HUMIDITY')} AS avg_humidity, NULL AS defect_count,
    NULL AS avg_reading, NULL AS peak_reading FROM yields GROUP BY 1
  UNION ALL
  SELECT y.LINE, NULL, NULL, NULL, NULL, CAST(sum(N) AS BIGINT), NULL, NULL
  FROM defects x LEFT JOIN yields y ON y.LINE = x.LINE AND y.BUCKET = x.BUCKET GROUP BY 1
  UNION ALL
  SELECT y.LINE, NULL, NULL, NULL, NULL, NULL, {_average('AVG_VALUE')}, max(MAX_VALUE)
  FROM health x LEFT JOIN yields y ON y.LINE = x.LINE AND y.BUCKET = x.BUCKET GROUP BY 1)
GROUP BY 1"""),
    "metrics_by_station": _readings(f"""
SELECT STATION_ID AS station_id, METRIC AS metric, {_average('AVG_VALUE')} AS avg_reading,
  max(MAX_VALUE) AS peak_reading FROM health GROUP BY 1, 2"""),
    "weighted_yield": _gold(f"""
SELECT LINE AS line, {_WEIGHTED}, {_SUMS}, {_average('CAST(FIRST_PASS_YIELD_PCT AS DOUBLE)')} AS mean_of_pct
FROM yields GROUP BY 1""", HOUR),
    "q1_yield_by_line": _gold(f"SELECT LINE AS line, {_WEIGHTED}, {_SUMS} FROM yields GROUP BY 1 ORDER BY 1"),
    "q2_defect_drivers": _gold("""
SELECT x.DEFECT_CODE AS defect_code, CAST(sum(x.N) AS BIGINT) AS defect_count
FROM defects x LEFT JOIN yields y ON y.LINE = x.LINE AND y.BUCKET = x.BUCKET
WHERE y.LINE = 'PAINT' AND x.DEFECT_CODE <> 'NONE' GROUP BY 1"""),
    "q3_yield_vs_humidity": _gold(f"""
SELECT LINE AS line, BUCKET AS bucket, {_WEIGHTED}, {_average('AVG_BOOTH_HUMIDITY')} AS avg_humidity
FROM yields WHERE LINE = 'PAINT' GROUP BY 1, 2 ORDER BY 2 DESC LIMIT 6"""),
    # analyst questions
    "latest_buckets": _gold("SELECT * FROM recent", more=_COMPLETE.format(width=5, now=_NOW)),
    "line_health": _gold(f"""
SELECT LINE, min(BUCKET) AS FROM_BUCKET, max(BUCKET) AS TO_BUCKET, CAST(sum(UNITS) AS BIGINT) AS UNITS,
  {_yield_pct('CAST(sum(UNITS) AS BIGINT)', 'CAST(sum(SCRAP_UNITS) AS BIGINT)')} AS YIELD_PCT,
  CASE WHEN YIELD_PCT > 93 THEN 'healthy' WHEN YIELD_PCT < 90 THEN 'problem' ELSE 'watch' END AS STATE,
  YIELD_PCT < 85 AS IS_LOW
FROM recent GROUP BY 1""", DAY, more=_COMPLETE.format(width=DAY, now=_NOW)),
    "humidity_alerts": _gold("""
SELECT LINE, BUCKET, AVG_BOOTH_HUMIDITY, FIRST_PASS_YIELD_PCT,
  CASE WHEN AVG_BOOTH_HUMIDITY > 60 THEN 'abnormal' ELSE 'normal' END AS HUMIDITY_STATE
FROM yields WHERE AVG_BOOTH_HUMIDITY IS NOT NULL"""),
    "defect_share": _gold("""
SELECT LINE, DEFECT_CODE, n AS N,
  CAST(CAST(((20000 * n + total) // (2 * total)) AS DOUBLE) / 100 AS DECIMAL(5,2)) AS SHARE_PCT, "RANK"
FROM (SELECT LINE, DEFECT_CODE, CAST(sum(N) AS BIGINT) AS n,
        CAST(sum(sum(N)) OVER (PARTITION BY LINE) AS BIGINT) AS total,
        CAST(rank() OVER (PARTITION BY LINE ORDER BY sum(N) DESC) AS INTEGER) AS "RANK"
      FROM defects WHERE DEFECT_CODE <> 'NONE' GROUP BY 1, 2)"""),
    "cause_order": _gold(f"""
SELECT LINE, h AS HUMIDITY_AT, d AS DEFECTS_AT, y AS YIELD_AT, {_seconds('h', 'd')} AS DEFECTS_AFTER_SECS,
  {_seconds('h', 'y')} AS YIELD_AFTER_SECS, coalesce(h <= d AND d <= y, false) AS ORDER_HOLDS
FROM (SELECT LINE, min(BUCKET) FILTER (WHERE AVG_BOOTH_HUMIDITY > 60) AS h,
        min(BUCKET) FILTER (WHERE FIRST_PASS_YIELD_PCT < 90) AS y FROM yields GROUP BY 1)
LEFT JOIN (SELECT LINE, min(BUCKET) AS d FROM defects WHERE DEFECT_CODE <> 'NONE' AND N >= 1 GROUP BY 1) USING (LINE)
""", HOUR),
    "incidents": _gold(f"""
SELECT *, {_seconds('HUMIDITY_AT', 'DEFECTS_AT')} AS DEFECTS_AFTER_SECS, {_seconds('HUMIDITY_AT', 'YIELD_AT')} AS YIELD_AFTER_SECS,
  coalesce(HUMIDITY_AT <= DEFECTS_AT AND DEFECTS_AT <= YIELD_AT, false) AS ORDER_HOLDS FROM incident""", more=_INCIDENTS),
    "yield_compare_nearest": _gold("""
SELECT n.LINE, n.BUCKET, n.UNITS AS NOW_UNITS, n.FIRST_PASS_YIELD_PCT AS NOW_PCT, then_bucket AS THEN_BUCKET,
  then_units AS THEN_UNITS, then_pct AS THEN_PCT, n.FIRST_PASS_YIELD_PCT - then_pct AS CHANGE_PCT
FROM (
  SELECT n.*, CASE WHEN t.BUCKET >= n.BUCKET - INTERVAL '140 minutes' THEN t.UNITS END AS then_units,
    CASE WHEN t.BUCKET >= n.BUCKET - INTERVAL '140 minutes' THEN t.FIRST_PASS_YIELD_PCT END AS then_pct,
    CASE WHEN t.BUCKET >= n.BUCKET - INTERVAL '140 minutes' THEN t.BUCKET END AS then_bucket
  FROM yields n ASOF LEFT JOIN yields t ON t.LINE = n.LINE AND t.BUCKET <= n.BUCKET - INTERVAL '20 minutes') n"""),
    "yield_compare": _gold(_compare(20)),
    "yield_compare_day": _gold(_compare(DAY), HOUR),
    "control_compare": _gold(f"""
SELECT LINE, BEFORE_PCT, AFTER_PCT, DROP_PCT, round(others, 4) AS OTHERS_DROP_PCT,
  round(CAST(DROP_PCT AS DOUBLE) - others, 4) AS EXCESS_DROP_PCT
FROM (SELECT *, CAST((SELECT sum(DROP_PCT) FROM drops) - DROP_PCT AS DOUBLE)
        / ((SELECT count(DROP_PCT) FROM drops) - 1) AS others FROM drops)""",
                             more=f"""
sides AS (
  SELECT LINE, CAST(sum(UNITS) FILTER (WHERE BUCKET < since) AS BIGINT) AS bu,
    CAST(sum(SCRAP_UNITS) FILTER (WHERE BUCKET < since) AS BIGINT) AS bs,
    CAST(sum(UNITS) FILTER (WHERE BUCKET >= since) AS BIGINT) AS au,
    CAST(sum(SCRAP_UNITS) FILTER (WHERE BUCKET >= since) AS BIGINT) AS sc
  FROM (SELECT *, {_NOW} - INTERVAL '14400 minutes' AS since FROM yields) GROUP BY 1),
drops AS (
  SELECT LINE, {_yield_pct('bu', 'bs')} AS BEFORE_PCT, {_yield_pct('au', 'sc')} AS AFTER_PCT,
    {_yield_pct('bu', 'bs')} - {_yield_pct('au', 'sc')} AS DROP_PCT FROM sides)"""),
    # checks
    "pipeline_inventory": _inventory(),
    "column_contract": _contract(),
    "grain_check": _gold("\nUNION ALL ".join([
        _repeats("INSPECTIONS_ACTIVE", "live", "INSPECTION_ID"),
        _repeats("STATION_HEALTH", "health", "STATION_ID, LINE, METRIC, BUCKET"),
        _repeats("YIELD_BY_LINE_5MIN", "yields", "LINE, BUCKET"),
        _repeats("DEFECT_COUNTS_5MIN", "defects", "LINE, BUCKET, DEFECT_CODE"),
        _repeats("INSPECTIONS_BY_LINE", "live", "LINE, EVENT_TS")])),
    "reference_check": _gold(
        f"{_lost('defects_to_yield', 'defects')}\nUNION ALL {_lost('stations_to_yield', 'health')}"),
    "domain_rules": _gold("\nUNION ALL ".join(
        [_rule(name, "journal", holds) for name, holds in _JOURNAL_RULES]
        + [_rule(*rule) for rule in _OTHER_RULES])),
    "preflight": _gold("""
SELECT unnest(['grains_unique', 'defects_reach_yield', 'stations_reach_yield', 'journal_rules_hold', 'ALL'])
  AS CHECK_NAME, unnest([g, d, s, j, g AND d AND s AND j]) AS OK
FROM (SELECT
  (SELECT sum(REPEATED_KEYS) = 0 FROM grains) AS g,
  (SELECT MISSING_KEYS = 0 FROM lost WHERE RELATIONSHIP = 'defects_to_yield') AS d,
  (SELECT MISSING_KEYS = 0 FROM lost WHERE RELATIONSHIP = 'stations_to_yield') AS s,
  (SELECT sum(BROKEN_ROWS) = 0 FROM broken) AS j)""", more=f"""
grains AS ({_repeats('a', 'live', 'INSPECTION_ID')} UNION ALL
  {_repeats('b', 'health', 'STATION_ID, LINE, METRIC, BUCKET')} UNION ALL
  {_repeats('c', 'yields', 'LINE, BUCKET')} UNION ALL {_repeats('d', 'defects', 'LINE, BUCKET, DEFECT_CODE')}),
lost AS ({_lost('defects_to_yield', 'defects')} UNION ALL {_lost('stations_to_yield', 'health')}),
broken AS ({' UNION ALL '.join(_rule(name, 'journal', holds) for name, holds in _JOURNAL_RULES)})"""),
    "refresh_status": """
SELECT t.name, 'INCREMENTAL' AS refresh_mode, 'SUCCEEDED' AS last_state, CAST(NULL AS VARCHAR) AS downgrade_reason,
  count(DISTINCT (event_id - low) // ((high - low) // 2 + 1)) AS refreshes
FROM events, (SELECT min(event_id) AS low, max(event_id) AS high FROM events),
  (VALUES ('QUALITY_INSPECTIONS'), ('STATION_HEALTH'), ('YIELD_BY_LINE_5MIN'), ('DEFECT_COUNTS_5MIN')) t(name)
GROUP BY 1""",
    "table_growth": _growth(),
}
ORACLES = {name: rounded_sql(name, sql) for name, sql in ORACLES.items()}
