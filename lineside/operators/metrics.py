"""A metric layer: business names over the derived tables, each metric defined once.

A query names dimensions and metrics. Every metric aggregates on its own table; other tables are reached
only by the declared many-to-one relationships, so no join multiplies rows. Metrics of several tables are
aggregated apart and put side by side on the shared dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineside.functions import percent


@dataclass(frozen=True)
class Dimension:
    table: str
    column: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Metric:
    table: str
    build: Callable[[], Column]
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Relationship:
    many: str
    one: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class MetricView:
    tables: Mapping[str, tuple[str, ...]]  # name -> declared key
    relationships: Mapping[str, Relationship]
    dimensions: Mapping[str, Dimension]
    metrics: Mapping[str, Metric]
    table_synonyms: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def resolve(self, kind: str, name: str) -> str:
        """Canonical name for a name, a ``table.name`` or a synonym, in any case."""
        entries = {"dimension": self.dimensions, "metric": self.metrics}[kind]
        wanted = name.strip().lower()
        for canonical, entry in entries.items():
            if wanted in (canonical, f"{entry.table}.{canonical}", *entry.synonyms):
                return canonical
        raise ValueError(f"unknown {kind}: {name}")

    def hub_of(self, table: str, other: str) -> Relationship | None:
        """The relationship that leads from ``table`` to ``other``; None if they are the same."""
        if table == other:
            return None
        for link in self.relationships.values():
            if (link.many, link.one) == (table, other):
                return link
        raise ValueError(f"no path from {table} to {other}")


# The tables, relationships, names and synonyms of the plant-floor view.
PLANT = MetricView(
    tables={
        "yield": ("LINE", "BUCKET"),
        "defects": ("LINE", "BUCKET", "DEFECT_CODE"),
        "stations": ("STATION_ID", "METRIC", "BUCKET"),
    },
    table_synonyms={
        "yield": ("yield", "first pass yield", "production yield", "line output"),
        "defects": ("defects", "defect counts", "scrap reasons", "failure codes"),
        "stations": ("stations", "station health", "sensors", "telemetry", "machine metrics"),
    },
    relationships={
        "defects_to_yield": Relationship("defects", "yield", ("LINE", "BUCKET")),
        "stations_to_yield": Relationship("stations", "yield", ("LINE", "BUCKET")),
    },
    dimensions={
        "line": Dimension("yield", "LINE", ("production line", "work centre", "stage")),
        "bucket": Dimension("yield", "BUCKET", ("time", "interval", "five minute bucket", "when")),
        "defect_code": Dimension(
            "defects", "DEFECT_CODE", ("defect", "defect code", "failure reason", "scrap reason")),
        "station_id": Dimension("stations", "STATION_ID", ("station", "machine", "cell")),
        "metric": Dimension("stations", "METRIC", ("sensor", "measurement")),
    },
    metrics={
        "total_units": Metric("yield", lambda: F.sum("UNITS"), ("units produced", "total units", "volume")),
        "total_scrap": Metric(
            "yield", lambda: F.sum("SCRAP_UNITS"), ("scrap", "total scrap", "rejects", "failed units")),
        # Weighted by units: the mean of bucket percentages would contradict the two totals.
        "avg_yield_pct": Metric(
            "yield", lambda: percent(F.sum("UNITS"), F.sum("SCRAP_UNITS")),
            ("average yield", "yield percent", "first pass yield percent")),
        "avg_humidity": Metric(
            "yield", lambda: F.avg("AVG_BOOTH_HUMIDITY"), ("humidity", "average booth humidity")),
        "defect_count": Metric("defects", lambda: F.sum("N"), ("defect count", "number of defects")),
        "avg_reading": Metric(
            "stations", lambda: F.avg("AVG_VALUE"), ("average reading", "average sensor value")),
        "peak_reading": Metric("stations", lambda: F.max("MAX_VALUE"), ("peak reading", "max sensor value")),
    },
)

Predicate = Callable[[Column], Column]


def _one_table(
    view: MetricView,
    frames: Mapping[str, DataFrame],
    table: str,
    dims: Sequence[str],
    metrics: Sequence[str],
    where: Mapping[str, Predicate],
) -> DataFrame:
    """Aggregate one table by dimensions of its own or of its hub."""
    used = {name: view.dimensions[name] for name in (*dims, *where)}
    own = {n: d for n, d in used.items() if d.table == table}
    rows = frames[table].select("*", *[F.col(d.column).alias(f"_d_{n}") for n, d in own.items()])
    for other in sorted({d.table for d in used.values()} - {table}):
        link = view.hub_of(table, other)
        reached = {n: d for n, d in used.items() if d.table == other}
        hub = frames[other].select(
            *[F.col(k).alias(f"_k_{k}") for k in link.keys],
            *[F.col(d.column).alias(f"_d_{n}") for n, d in reached.items()],
        )
        on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in link.keys])
        rows = rows.join(hub, on, "left")
    for name, test in where.items():
        rows = rows.where(test(F.col(f"_d_{name}")))
    values = [F.col(f"_d_{n}").alias(n) for n in dims]
    if not metrics:
        return rows.select(*values).distinct()
    return rows.groupBy(*values).agg(
        *[view.metrics[m].build().alias(m) for m in metrics])


def _reaching(view: MetricView, tables: Sequence[str]) -> str:
    """The table among ``tables`` that leads to all of them."""
    for table in tables:
        try:
            for other in tables:
                view.hub_of(table, other)
        except ValueError:
            continue
        return table
    raise ValueError(f"no table leads to all of {sorted(tables)}")


def metric_query(
    view: MetricView,
    frames: Mapping[str, DataFrame],
    dims: Sequence[str],
    metrics: Sequence[str],
    where: Mapping[str, Predicate] | None = None,
    order: Sequence[tuple[str, bool]] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Metrics by dimensions; names may be synonyms. Without metrics, the distinct values of the dimensions.

    ``where`` maps a dimension to a test on its column. ``order`` lists (name, descending) pairs.
    """
    dims = [view.resolve("dimension", d) for d in dims]
    metrics = [view.resolve("metric", m) for m in metrics]
    where = {view.resolve("dimension", d): test for d, test in (where or {}).items()}
    by_table: dict[str, list[str]] = {}
    for m in metrics:
        by_table.setdefault(view.metrics[m].table, []).append(m)
    if not by_table:
        by_table[_reaching(view, list(dict.fromkeys(view.dimensions[d].table for d in (*dims, *where))))] = []

    results = [_one_table(view, frames, t, dims, ms, where) for t, ms in by_table.items()]
    result = results[0]
    if len(results) > 1:
        # One row per dimension values and table: stacking and regrouping puts them side by side, with a
        # NULL dimension as a group of its own.
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
        result = stacked.groupBy(*dims).agg(*[F.max(m).alias(m) for m in metrics])
    result = result.select(*dims, *metrics)
    if order:
        def column(name: str) -> str:
            try:
                return view.resolve("metric", name)
            except ValueError:
                return view.resolve("dimension", name)

        names = [column(n) for n, _ in order]
        result = result.orderBy(*[F.desc(n) if down else F.asc(n) for n, (_, down) in zip(names, order)])
    return result if limit is None else result.limit(limit)


def yield_by_line_question(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Yield, units and scrap by line."""
    return metric_query(PLANT, frames, ["line"], ["avg_yield_pct", "total_units", "total_scrap"],
                        order=[("line", False)])


def defect_drivers_question(frames: Mapping[str, DataFrame], line: str = "PAINT") -> DataFrame:
    """Defects that drive scrap on one line."""
    return metric_query(
        PLANT, frames, ["defect_code"], ["defect_count"],
        where={"line": lambda c: c == line, "defect_code": lambda c: c != "NONE"},
        order=[("defect_count", True), ("defect_code", False)])


def yield_humidity_question(frames: Mapping[str, DataFrame], line: str = "PAINT", n: int = 6) -> DataFrame:
    """Yield next to humidity, newest ``n`` buckets of one line."""
    return metric_query(
        PLANT, frames, ["line", "bucket"], ["avg_yield_pct", "avg_humidity"],
        where={"line": lambda c: c == line}, order=[("bucket", True)], limit=n)
