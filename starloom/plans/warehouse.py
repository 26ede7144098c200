"""Schemas and tables: create, reset, read, append."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import enforced, violations
from ..operators.layout import replicated, sorted_within, to_buckets
from ..operators.surrogate import with_id
from ..schemas import Table, staging_tables, star_tables


_BUCKET_FILE = re.compile(r"_\d{5}\.c\d+[^/]*$")


def _quoted(text: str) -> str:
    """A SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Warehouse:
    """Two schemas, one for staging and one for the star, and how their tables are kept.

    ``location`` keeps the files in folders named after the schemas below a folder of your
    own, where a later session finds them again; without it Spark's warehouse directory is used. ``buckets`` turns on
    bucketing by the declared distribution keys. ``numeric_scale`` are the digits kept of
    NUMERIC columns; the declared type keeps none.
    """

    spark: SparkSession
    staging: str = "staging"
    star: str = "star"
    location: str | None = None
    buckets: int = 0
    numeric_scale: int = 0

    @property
    def schemas(self) -> dict[str, list[Table]]:
        return {
            self.staging: staging_tables(self.numeric_scale),
            self.star: star_tables(self.numeric_scale),
        }

    def spec(self, name: str) -> Table:
        return next(t for tables in self.schemas.values() for t in tables if t.name == name)

    def qualified(self, name: str) -> str:
        schema = next(s for s, tables in self.schemas.items() if any(t.name == name for t in tables))
        return f"`{schema}`.`{name}`"

    def create(self) -> None:
        """Create what does not exist yet; files already at ``location`` are picked up."""
        for schema, tables in self.schemas.items():
            place = f" LOCATION {_quoted(self._folder(schema))}" if self.location else ""
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`{place}")
            for table in tables:
                fresh = not self.spark.catalog.tableExists(f"`{schema}`.`{table.name}`")
                self.spark.sql(self._create_statement(schema, table))
                try:
                    self._check_shape(schema, table, fresh)
                except ValueError:
                    if fresh:  # files of another shape stay as they are, without a table
                        self.spark.sql(f"DROP TABLE `{schema}`.`{table.name}`")
                    raise

    def _check_shape(self, schema: str, table: Table, fresh: bool) -> None:
        """Raise if an existing table, or files that a new one finds, were made in another way."""
        name = f"{schema}.{table.name}"
        found = self.spark.table(self.qualified(table.name))
        is_, wanted = found.dtypes, [(c.name, c.type.simpleString()) for c in table.columns]
        if is_ != wanted:
            raise ValueError(f"{name} has the columns {is_}, not {wanted}")
        described = self.spark.sql(f"DESCRIBE EXTENDED `{schema}`.`{table.name}`").collect()
        facts = {r["col_name"]: r["data_type"] for r in described}
        buckets = int(facts.get("Num Buckets") or 0)
        columns = facts.get("Bucket Columns", "[]")
        if buckets != (self.buckets if self._bucketed(table) else 0) or (
            buckets and columns != f"[`{table.distribute_by}`]"
        ):
            raise ValueError(f"{name} has {buckets} buckets by {columns}, not {self.buckets}")
        if fresh and self.location:
            files = found.inputFiles()
            if files:
                stored = self.spark.read.parquet(f"{self._folder(schema)}/{table.name}").dtypes
                if stored != wanted:
                    raise ValueError(f"the files of {name} have the columns {stored}, not {wanted}")
                # Bucketed files carry their bucket's number at the end of their names.
                if self._bucketed(table) != all(_BUCKET_FILE.search(f) for f in files):
                    raise ValueError(f"the files of {name} are bucketed in another way")

    def _create_statement(self, schema: str, table: Table) -> str:
        columns = ", ".join(f"`{c.name}` {c.type.simpleString()}" for c in table.columns)
        statement = f"CREATE TABLE IF NOT EXISTS `{schema}`.`{table.name}` ({columns}) USING parquet"
        if self._bucketed(table):
            statement += f" CLUSTERED BY (`{table.distribute_by}`) INTO {self.buckets} BUCKETS"
        if self.location:
            statement += f" LOCATION {_quoted(f'{self._folder(schema)}/{table.name}')}"
        return statement

    def _folder(self, schema: str) -> str:
        return f"{self.location.rstrip('/')}/{schema}"

    def _bucketed(self, table: Table) -> bool:
        return bool(self.buckets and table.distribute_by)

    def reset(self) -> None:
        """Drop both schemas with everything in them and create them empty."""
        if self.location:
            # Whether dropping removes files at a given location is up to the catalog: empty them.
            self.create()
            for tables in self.schemas.values():
                for table in tables:
                    nulls = [F.lit(None).cast(c.type).alias(c.name) for c in table.columns]
                    empty = self.spark.range(0).select(*nulls)
                    empty.write.insertInto(self.qualified(table.name), overwrite=True)
        for schema in self.schemas:
            self.spark.sql(f"DROP SCHEMA IF EXISTS `{schema}` CASCADE")
        self.create()

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.qualified(name))

    def lookup(self, name: str) -> DataFrame:
        """``read`` for joining to the fact: replicated tables are broadcast while small."""
        table = self.read(name)
        return replicated(table) if self.spec(name).replicated else table

    def append(
        self,
        name: str,
        rows: DataFrame,
        enforce: bool = True,
        number: tuple[str, int] | None = None,
    ) -> None:
        """Add ``rows``, matched by column name, to a table in one write job.

        ``enforce`` stops the job on a NULL in a required column or a text over its
        limit; nothing is added then. ``number`` names a column that ``rows`` lacks and its first
        value: the ids are given after the last shuffle, so a task run again cannot repeat one.
        """
        table = self.spec(name)
        if number:
            rows = rows.withColumn(number[0], F.lit(number[1]))
        rows = rows.select(*[F.col(c.name).cast(c.type).alias(c.name) for c in table.columns])
        if enforce:
            rows = enforced(rows, table)
        if self._bucketed(table):
            rows = to_buckets(rows, [table.distribute_by], self.buckets)
        if table.sort_by:
            rows = sorted_within(rows, table.sort_by)
        if number:
            rows = with_id(rows.drop(number[0]), *number).select(*table.column_names)
        rows.write.insertInto(self.qualified(name))

    def append_by_position(self, name: str, rows: DataFrame, enforce: bool = True) -> None:
        """``append`` for rows whose columns stand in table order under names of their own."""
        self.append(name, rows.toDF(*self.spec(name).column_names), enforce)

    def violations(self) -> DataFrame:
        """Every declared key, NOT NULL and length of the star, with its violations."""
        specs = star_tables(self.numeric_scale)
        return violations({t.name: self.read(t.name) for t in specs}, specs)
