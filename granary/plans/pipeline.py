"""The whole load: landing to bronze to silver to gold."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import partial
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from granary.operators.checks import declare_checks, observed_checks, read_checks
from granary.operators.fills import AsOf
from granary.operators.history import overlapping_versions
from granary.operators.joins import by_measure
from granary.plans import dimensions, facts, silver
from granary.registry import WAREHOUSE, SourceTable, active_sources, source
from granary.session import scratch_scope, shuffles_removed, stored
from granary.sources.landing import extract, extract_ranges, read_landing, write_landing
from granary.sources.tables import RuleViolation, VersionedTable, create_layers


def together(spark: SparkSession, jobs: Iterable[Callable[[], Any]], workers: int = 8) -> list[Any]:
    """Run independent jobs side by side, so that small tables do not queue for the cluster."""
    with ThreadPoolExecutor(workers) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


@dataclass
class Warehouse:
    """Where the layers live and how a run is parameterised.

    ``as_of`` fixes the load time, which makes a run repeatable; otherwise it is
    the time the run was set up, the same for all its steps. ``wide_ids``
    stores key columns as BIGINT, for sources whose keys outgrow 32 bits.
    ``prefix`` goes in front of the database names. ``connection`` lands the
    source tables over JDBC ahead of the layers. ``first_day`` and ``last_day``
    bound the calendar. ``retain`` is how many versions of a table are left,
    ``retain_in`` the same for the tables of a layer that it names,
    ``unique_bronze`` refuses a bronze reload with repeated keys. ``layout``
    names columns that the files of a gold table are sorted by.
    """

    spark: SparkSession
    root: str
    landing: str
    prefix: str = ""
    as_of: AsOf = None
    wide_ids: bool = False
    one_contact: bool = False
    parallel_jobs: int = 8
    connection: Mapping[str, str] | None = None
    first_day: str = dimensions.FIRST_DAY
    last_day: str = dimensions.LAST_DAY
    retain: int | None = None
    retain_in: Mapping[str, int] = field(default_factory=dict)
    unique_bronze: bool = False
    layout: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.as_of is None:
            self.as_of = datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")
        create_layers(self.spark, self.root, self.prefix)

    def bronze(self, table: SourceTable) -> VersionedTable:
        return self._table("bronze", f"{table.schema}/{table.name}", table.full_name)

    def silver(self, table: SourceTable) -> VersionedTable:
        return self._table("silver", f"{table.schema}/{table.name}", table.full_name)

    def quarantine(self, table: SourceTable) -> VersionedTable:
        folder = f"{table.schema}/{table.name}_quarantine"
        return self._table("silver", folder, f"{table.full_name}_quarantine")

    def gold(self, name: str) -> VersionedTable:
        return self._table("gold", name, name, self.layout.get(name, ()))

    def _table(self, layer: str, folder: str, name: str, cluster: Sequence[str] = ()) -> VersionedTable:
        path = f"{self.root.rstrip('/')}/{layer}/{folder}"
        retain = self.retain_in.get(layer, self.retain)
        return VersionedTable(self.spark, path, f"{self.prefix}{layer}.{name}", retain, cluster)

    def silver_frames(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Silver tables by registry name."""
        return {name: self.silver(source(name)).read() for name in names}

    def land(self, table: SourceTable, connection: Mapping[str, str], partitions: int = 64) -> str:
        """Extract one table over JDBC into the landing zone, in parts of equal size along its key."""
        if partitions == 1:
            return write_landing(extract(self.spark, table, connection), self.landing, table)
        return write_landing(extract_ranges(self.spark, table, connection, partitions), self.landing, table)

    def land_all(self, connection: Mapping[str, str], partitions: int = 64) -> None:
        self._side_by_side(partial(self.land, t, connection, partitions) for t in active_sources())

    def load_bronze(self, table: SourceTable) -> int:
        landed = read_landing(self.spark, self.landing, table, self.as_of)
        return self.bronze(table).sync_evolving(landed, table.keys, self.unique_bronze)

    def rules(self, table: SourceTable) -> dict[str, str]:
        """The checks that hold for a table: those stored with it, and those of the registry it lacks.

        Registry checks are declared first where the table exists already.
        """
        name = self.silver(table).name
        if not self.spark.catalog.tableExists(name):
            return dict(table.checks)
        declare_checks(self.spark, name, table.checks)
        return read_checks(self.spark, name)

    def load_silver(self, table: SourceTable) -> int:
        """Clean one table and part its rows.

        Rows are deduplicated, filled and checked in one pass, written to
        scratch, and split into the table and its quarantine from there.
        """
        rules, target, held = self.rules(table), self.silver(table), Observation()
        with scratch_scope(self.spark):
            checked = silver.check_rows(self.bronze(table).read(), table, self.as_of, rules)
            notes: dict[str, Any] = {}
            if rules:
                checked = stored(checked.observe(held, *observed_checks(list(rules))), "checked")
                counts = held.get
                failed = {name: counts[f"failed_{i}"] for i, name in enumerate(rules)}
                notes = {"checked": counts["checked"], "quarantined": counts["rows"], "failed": failed}
            cleaned = silver.split(checked, table, self.wide_ids)
            version = target.sync(
                cleaned.accepted,
                table.keys,
                table.schema_for(self.wide_ids),
                required=table.required,
                keys_unique=True,
                defaults=table.defaults,
                notes=notes,
            )
            if rules:
                declare_checks(self.spark, target.name, rules)
                quarantine = self.quarantine(table)
                if held.get["rows"] or quarantine.notes().get("rows") != 0:
                    quarantine.publish(cleaned.quarantined)
        return version

    def load_gold(
        self,
        name: str,
        rows: DataFrame,
        audit: Callable[[DataFrame], DataFrame] | None = None,
        finish: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        spec = WAREHOUSE[name]
        return self.gold(name).sync(
            rows,
            spec.keys,
            spec.schema_for(self.wide_ids),
            identity=spec.identity,
            null_safe=spec.null_safe_keys,
            required=spec.required,
            keys_unique=spec.unique_by_build,
            audit=audit,
            finish=finish,
        )

    def load_dimension(self, name: str) -> int:
        with scratch_scope(self.spark):
            if name == "DimDate":
                return self.load_gold(name, dimensions.dim_date(self.spark, self.first_day, self.last_day))
            frames = self.silver_frames(WAREHOUSE[name].sources)
            if name == "DimCustomer":
                self._refuse_contacts(frames)
                return self.load_gold(name, dimensions.dim_customer(frames, self.one_contact))
            audit = self._overlaps if name == "DimProduct" else None
            if name in dimensions.FINISHED:
                build, finish = dimensions.FINISHED[name]
                return self.load_gold(name, build(frames), audit, partial(finish, silver=frames))
            return self.load_gold(name, dimensions.DIMENSIONS[name](frames), audit)

    def _refuse_contacts(self, frames: Mapping[str, DataFrame]) -> None:
        if not self.one_contact:
            repeated = [tuple(r) for r in dimensions.repeated_contacts(frames).limit(5).collect()]
            if repeated:
                raise RuleViolation(f"DimCustomer: persons with several contacts: {repeated}")

    def _overlaps(self, versions: DataFrame) -> DataFrame:
        """Product versions that start before an earlier one ends; a fact line would meet both."""
        dated = versions.filter(F.col("StartDate").isNotNull()).select("ProductAlternateKey", "StartDate", "EndDate")
        today = F.lit(self.as_of).cast("timestamp")
        return overlapping_versions(dated, ["ProductAlternateKey"], "StartDate", "StartDate", "EndDate", today)

    def load_sales(self) -> int:
        name = "FactInternetSales"
        with scratch_scope(self.spark):
            gold = {n: self.gold(n).read() for n in facts.LOOKUPS}
            frames = self.silver_frames(WAREHOUSE[name].sources)
            frames["SalesOrderHeader"] = by_measure(frames["SalesOrderHeader"])
            return self.load_gold(name, facts.fact_internet_sales(frames, gold, self.as_of))

    def load_sales_reasons(self) -> int:
        name = "FactInternetSalesReason"
        with scratch_scope(self.spark):
            frames = self.silver_frames(WAREHOUSE[name].sources)
            sales = self.gold("FactInternetSales").read()
            return self.load_gold(name, facts.fact_internet_sales_reason(sales, frames))

    def run(self) -> None:
        """Every active table, layer by layer; a failed layer stops the run."""
        with shuffles_removed(self.spark):
            self._run()

    def _run(self) -> None:
        tables = active_sources()
        if self.connection:
            self.land_all(self.connection)
        self._side_by_side(partial(self.load_bronze, t) for t in tables)
        self._side_by_side(partial(self.load_silver, t) for t in tables)
        active = [t.name for t in WAREHOUSE.values() if t.active]
        self._side_by_side(partial(self.load_dimension, n) for n in active if n.startswith("Dim"))
        if "FactInternetSales" in active:
            self.load_sales()
        if "FactInternetSalesReason" in active:
            self.load_sales_reasons()

    def check_report(self) -> DataFrame:
        """What the last load of each silver table checked: one row per table and check, from the tables' notes.

        ``table_name, check_name, failed`` and the table's rows ``checked``
        (after deduplication), ``accepted`` and ``quarantined``.
        """
        rows = []
        for table in active_sources():
            noted = self.silver(table).notes()
            for name, failed in noted.get("failed", {}).items():
                rows.append((table.full_name, name, failed, noted["checked"], noted["rows"], noted["quarantined"]))
        columns = "table_name string, check_name string, failed bigint, checked bigint, accepted bigint, quarantined bigint"
        return self.spark.createDataFrame(rows, columns)

    def drop_catalog(self) -> None:
        """Remove the layers' catalog entries; with the built-in catalog their folders go as well."""
        for layer in ("gold", "silver", "bronze"):
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}{layer} CASCADE")

    def _side_by_side(self, jobs: Iterable[Callable[[], Any]]) -> None:
        together(self.spark, jobs, self.parallel_jobs)
