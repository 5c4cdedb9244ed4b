"""Averages of registered queries that are compared with SQL: their last bit follows the order of the sum, so the results,
never the readings, are rounded to nine decimals here and in the SQL."""

AVERAGES = {
    **dict.fromkeys(("station_health", "station_health_stream", "station_health_stateful"), ["AVG_VALUE"]),
    **dict.fromkeys(("yield_by_line", "yield_by_line_hour", "incremental_refresh", "incremental_refresh_groups", "pipeline_stream",
                     "latest_buckets", "humidity_alerts"), ["AVG_BOOTH_HUMIDITY"]),
    **dict.fromkeys(("yield_series", "yield_series_day"), ["avg_booth_humidity"]),
    "series_long": ["value"],
    **dict.fromkeys(("metric_query", "metrics_by_station"), ["avg_reading"]),
    "metrics_all": ["avg_reading", "avg_humidity"],
    "q3_yield_vs_humidity": ["avg_humidity"],
    "weighted_yield": ["mean_of_pct"],
}
DECIMALS = 9


def rounded_sql(name: str, sql: str) -> str:
    if name not in AVERAGES:
        return sql
    columns = ", ".join(f"round({c}, {DECIMALS}) AS {c}" for c in AVERAGES[name])
    return f"SELECT * REPLACE ({columns}) FROM ({sql.strip()})"
