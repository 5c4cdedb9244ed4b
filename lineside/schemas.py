"""Table schemas, value domains and the column contract."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: names and domains that the change feed and the tables share ----
INSERT = "IncrementalInsertRows"
UPDATE = "IncrementalUpdateRows"
DELETE = "IncrementalDeleteRows"
DATA_EVENTS = (INSERT, UPDATE, DELETE)

LINES = ("WELD", "PAINT", "ASSEMBLY")
STATUSES = ("PASS", "FAIL")
METRICS = ("weld_current", "booth_humidity", "booth_temp", "torque_nm")
NO_DEFECT = "NONE"
HUMIDITY = "booth_humidity"

KEY = "INSPECTION_ID"
SOURCE_COLUMNS = (
    "INSPECTION_ID", "UNIT_ID", "LINE", "SKU", "STATUS", "DEFECT_CODE",
    "STATION_ID", "OPERATOR_ID", "EVENT_TS", "UPDATED_TS",
)
# ---- end of fixed values ----

PK = f"PRIMARY_KEY__{KEY}"
MOST, LEAST = "MOST_SIGNIFICANT_POSITION", "LEAST_SIGNIFICANT_POSITION"
POSITION = (MOST, LEAST)
BOOKKEEPING = ("_inserted_at", "_updated_at", "_deleted")

STRING, INT, LONG, DOUBLE, BOOLEAN, NTZ = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType())


def fields(**types: T.DataType) -> T.StructType:
    """A struct of nullable fields, named by the keywords."""
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def payload(column: str) -> str:
    return f"PAYLOAD__{column}"


def _source_type(column: str) -> T.DataType:
    return NTZ if column.endswith("_TS") else STRING


SOURCE_ROW = fields(**{c: _source_type(c) for c in SOURCE_COLUMNS})

JOURNAL = T.StructType(
    [T.StructField(PK, STRING, False)]
    + [T.StructField(payload(c), _source_type(c)) for c in SOURCE_COLUMNS]
    + [
        T.StructField(LEAST, LONG),
        T.StructField(MOST, LONG),
        T.StructField("EVENT_TYPE", STRING, False),
        T.StructField("SEEN_AT", NTZ),
        T.StructField("METADATA", STRING),
    ]
)

INSPECTIONS = T.StructType(
    SOURCE_ROW.fields + fields(_inserted_at=NTZ, _updated_at=NTZ, _deleted=BOOLEAN).fields)
TELEMETRY = fields(STATION_ID=STRING, LINE=STRING, METRIC=STRING, VALUE=DOUBLE, EVENT_TS=NTZ)
CONTROL = fields(MODE=STRING, UPDATED_AT=NTZ)

# Declared grain of each derived table.
GRAINS = {
    "INSPECTIONS_ACTIVE": (KEY,),
    "STATION_HEALTH": ("STATION_ID", "LINE", "METRIC", "BUCKET"),
    "YIELD_BY_LINE_5MIN": ("LINE", "BUCKET"),
    "DEFECT_COUNTS_5MIN": ("LINE", "BUCKET", "DEFECT_CODE"),
}

# Columns that readers of the derived tables address by name, with their type family.
CONTRACT = (
    ("INSPECTIONS_ACTIVE", "IS_SCRAP", "NUMBER"),
    ("INSPECTIONS_ACTIVE", "LINE", "TEXT"),
    ("INSPECTIONS_ACTIVE", "EVENT_TS", "TIMESTAMP_NTZ"),
    ("INSPECTIONS_ACTIVE", "DEFECT_CODE", "TEXT"),
    ("STATION_HEALTH", "STATION_ID", "TEXT"),
    ("STATION_HEALTH", "LINE", "TEXT"),
    ("STATION_HEALTH", "BUCKET", "TIMESTAMP_NTZ"),
    ("STATION_HEALTH", "AVG_VALUE", "FLOAT"),
    ("STATION_HEALTH", "MAX_VALUE", "FLOAT"),
    ("STATION_HEALTH", "METRIC", "TEXT"),
    ("YIELD_BY_LINE_5MIN", "LINE", "TEXT"),
    ("YIELD_BY_LINE_5MIN", "BUCKET", "TIMESTAMP_NTZ"),
    ("YIELD_BY_LINE_5MIN", "UNITS", "NUMBER"),
    ("YIELD_BY_LINE_5MIN", "SCRAP_UNITS", "NUMBER"),
    ("YIELD_BY_LINE_5MIN", "FIRST_PASS_YIELD_PCT", "NUMBER"),
    ("YIELD_BY_LINE_5MIN", "AVG_BOOTH_HUMIDITY", "FLOAT"),
    ("DEFECT_COUNTS_5MIN", "LINE", "TEXT"),
    ("DEFECT_COUNTS_5MIN", "BUCKET", "TIMESTAMP_NTZ"),
    ("DEFECT_COUNTS_5MIN", "N", "NUMBER"),
    ("DEFECT_COUNTS_5MIN", "DEFECT_CODE", "TEXT"),
)


def type_family(data_type: T.DataType) -> str:
    """Name a Spark type the way the column contract names it."""
    if isinstance(data_type, T.BooleanType):
        return "BOOLEAN"
    if isinstance(data_type, T.StringType):
        return "TEXT"
    if isinstance(data_type, T.TimestampNTZType):
        return "TIMESTAMP_NTZ"
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return "FLOAT"
    if isinstance(data_type, (T.IntegralType, T.DecimalType)):
        return "NUMBER"
    return data_type.simpleString().upper()
