"""Layer tables in the catalogue, run metrics and text reports."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from basketry.operators.gold import in_report_order
from basketry.operators.layout import in_stored_order
from basketry.schema import FACT, GOLD_TABLES, ZONES


_ORDERED = "basketry.ordered"


@dataclass(frozen=True)
class Lake:
    """Parquet tables of one database."""

    spark: SparkSession
    database: str = "default"

    def _name(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def gold(self) -> dict[str, DataFrame]:
        """The published gold tables by name, and the zones of a clustered fact."""
        # A view has no files whose zones could be known.
        zoned = self.exists(ZONES) and not self._is_view(FACT)
        names = [*GOLD_TABLES, ZONES] if zoned else GOLD_TABLES
        return {name: self.table(name) for name in names}

    def replace(self, name: str, rows: DataFrame, partition_by: str | None = None) -> None:
        """Write the whole table anew."""
        if self._is_view(name):
            self.spark.sql(f"DROP VIEW {self._name(name)}")
        writer = rows.write.mode("overwrite").format("parquet")
        (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(self._name(name))

    def replace_in_order(self, name: str, rows: DataFrame) -> None:
        """As `replace`, for an aggregate: its files, and the rows in them, in report order."""
        self.replace(name, in_report_order(name, rows))
        self.spark.sql(f"ALTER TABLE {self._name(name)} SET TBLPROPERTIES ('{_ORDERED}' = 'true')")

    def report(self, name: str) -> DataFrame:
        """A published aggregate in report order, as it lies in its files; nothing is sorted."""
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {self._name(name)}").collect()
        if _ORDERED not in {r["key"] for r in properties}:
            raise ValueError(f"{name} is not stored in an order")
        return in_stored_order(self.table(name))

    def replace_partition(self, name: str, column: str, value: str, rows: DataFrame) -> None:
        """Write one partition of a partitioned table anew; without rows it is gone."""
        cell = value.replace("'", "''")
        self.spark.sql(f"ALTER TABLE {self._name(name)} DROP IF EXISTS PARTITION ({column} = '{cell}')")
        rows.select(self.table(name).columns).write.mode("append").insertInto(self._name(name))

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._name(name))

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP {'VIEW' if self._is_view(name) else 'TABLE'} IF EXISTS {self._name(name)}")

    def replace_counted(self, name: str, rows: DataFrame, partition_by: str | None = None) -> int:
        """As `replace`; the rows are counted while they are written."""
        written = Observation()
        self.replace(name, rows.observe(written, F.count(F.lit(1)).alias("rows")), partition_by)
        return written.get["rows"]

    def view(self, name: str, source: str, columns: str = "*", where: str = "true") -> None:
        """Publish a table under a second name without copying it."""
        if self.spark.catalog.tableExists(self._name(name)) and not self._is_view(name):
            self.spark.sql(f"DROP TABLE {self._name(name)}")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._name(name)} AS SELECT {columns} FROM {self._name(source)} WHERE {where}"
        )

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows to a table, such as the metrics of one more run."""
        rows.write.mode("append").format("parquet").saveAsTable(self._name(name))

    def _is_view(self, name: str) -> bool:
        return (
            self.spark.catalog.tableExists(self._name(name))
            and self.spark.catalog.getTable(self._name(name)).tableType == "VIEW"
        )


_VERSION, _BEFORE = "basketry.version", "basketry.version.before"


@dataclass(frozen=True)
class Snapshot(Lake):
    """One version of all tables of a database, under names of its own.

    A refresh fills a new version; `publish` makes it the current one by a single change of
    the database's properties.  Until then, and after a failure between any two tables,
    readers of `current` have the whole set of before.  The version before stays, for
    readers that have not finished; older and abandoned ones go with the next publication.
    """

    version: int = 0

    def _name(self, name: str) -> str:
        return f"`{self.database}`.`{name}__v{self.version}`"

    @staticmethod
    def _properties(spark: SparkSession, database: str) -> dict[str, str]:
        rows = spark.sql(f"DESCRIBE DATABASE EXTENDED `{database}`").collect()
        text = next((r[1] for r in rows if r[0] == "Properties"), "")
        return dict(re.findall(r"\(([\w.]+),\s*([^()]*)\)", text))

    @classmethod
    def current(cls, spark: SparkSession, database: str) -> Snapshot:
        """The published version; all its tables belong together."""
        version = cls._properties(spark, database).get(_VERSION)
        if version is None:
            raise ValueError(f"{database} has no published version")
        return cls(spark, database, int(version))

    @classmethod
    def new(cls, spark: SparkSession, database: str) -> Snapshot:
        """An empty version above every other one, abandoned ones included."""
        known = {0, int(cls._properties(spark, database).get(_VERSION, 0))}
        return cls(spark, database, max(known | set(cls._versions(spark, database).values())) + 1)

    @staticmethod
    def _versions(spark: SparkSession, database: str) -> dict[str, int]:
        found = {t.name: re.search(r"__v(\d+)$", t.name) for t in spark.catalog.listTables(database) if not t.isTemporary}
        return {name: int(match[1]) for name, match in found.items() if match}

    def publish(self) -> None:
        """Make this the current version, then point the plain names to it and tidy up."""
        before = self._properties(self.spark, self.database).get(_VERSION, "0")
        if before != str(self.version):
            self.spark.sql(
                f"ALTER DATABASE `{self.database}` SET DBPROPERTIES "
                f"('{_VERSION}' = '{self.version}', '{_BEFORE}' = '{before}')"
            )
        self.point()

    def point(self) -> None:
        """Plain names, for SQL, as views of this version; repeated after a failure it does no harm."""
        versions = self._versions(self.spark, self.database)
        plain = Lake(self.spark, self.database)
        for name, version in versions.items():
            if version == self.version:
                short = name.removesuffix(f"__v{version}")
                if plain.exists(short) and not plain._is_view(short):
                    raise ValueError(f"{short} is a table of its own, not a view of a version")
                plain.view(short, name)
        kept = {self.version, int(self._properties(self.spark, self.database).get(_BEFORE, 0))}
        for name, version in versions.items():
            if version not in kept:
                kind = "VIEW" if plain._is_view(name) else "TABLE"
                self.spark.sql(f"DROP {kind} IF EXISTS {plain._name(name)}")


def write_report(lines: DataFrame, path: str) -> None:
    """Report lines as text files; their names sort in report order."""
    lines.orderBy("position", "id", "line_no").select("line").write.mode("overwrite").text(path)
