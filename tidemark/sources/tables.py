"""Where tables live: one folder per layer; every write is a new version, published when it is whole."""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import compact, shuffles_removed
from tidemark.sources.files import children, exists, read_text, remove, unmark, write_text

# Which layer a table belongs to, and what consumers call the layers in SQL.
LAYERS = {
    "stg_stock_prices": "silver",
    "stg_macro_indicators": "silver",
    "dim_company": "silver",
    "daily_price_summary": "gold",
    "sector_performance": "gold",
    "macro_market_correlation": "gold",
    "company_metadata": "seeds",
    "dim_company_snapshot": "main",
}
DATABASES = {
    "silver": "main_silver",
    "gold": "main_gold",
    "seeds": "main_seeds",
    "main": "main",
}

# Folder column of tables stored by date, and how long a period one folder covers: months for
# daily prices, years for the few macro observations. Days would make too many small files.
PERIOD = "period"
MONTHLY, YEARLY = "yyyy-MM", "yyyy"
UNDATED = "undated"


def with_period(df: DataFrame, date: str, period: str) -> DataFrame:
    return df.withColumn(PERIOD, F.coalesce(F.date_format(date, period), F.lit(UNDATED)))


KEPT_VERSIONS = 8  # of a table; what depends on an older one is built anew

# Stored beside the rows of merged tables and not among their columns: number of the version that brought a row's values.
CHANGED = "_changed_in"


def number_of(version: str) -> int:
    return int(version.removeprefix("r"))


@dataclass(frozen=True)
class Version:
    """A published state of a table: the folders that hold its rows, and what it was built from.

    Since version ``marked_since`` rows were only added or replaced, and those that were are marked."""

    name: str
    schema: T.StructType
    folders: list[str]
    sources: dict[str, str]
    marked_since: str

    def folder_of(self) -> dict[str, str]:
        """Period -> folder; the whole table is the one period "" if it is stored without periods."""
        return {folder.partition(f"/{PERIOD}=")[2]: folder for folder in self.folders}


@dataclass(frozen=True)
class Warehouse:
    """Tables below one root folder.

    Rows lie in folders that never change once they are written, ``v=<version>/period=<period>``. A
    version is a small file that lists its folders: publishing it is one rename, so readers find the
    state before or the state after, and a writer that dies has published nothing. A refresh lists
    the folders of untouched periods again instead of copying them. A table has one writer at a time.
    """

    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{LAYERS[table]}/{table}"

    def published(self, table: str) -> str:
        return f"{self.root}/published/{table}"

    def versions(self, spark: SparkSession, table: str) -> list[str]:
        """Names of published versions, oldest first."""
        return sorted(n.removesuffix(".json") for n in children(spark, self.published(table)) if n.endswith(".json"))

    def version(self, spark: SparkSession, table: str, name: str | None = None) -> Version | None:
        """The version of that name, or the newest; None if there is none."""
        names = self.versions(spark, table)
        if not names or (name is not None and name not in names):
            return None
        stored = json.loads(read_text(spark, f"{self.published(table)}/{name or names[-1]}.json"))
        schema = T.StructType.fromJson(stored["schema"])
        marked_since = stored.get("marked_since", stored["version"])
        return Version(stored["version"], schema, stored["folders"], stored["sources"], marked_since)

    def next_name(self, spark: SparkSession, table: str) -> str:
        """What the next version will be called."""
        names = self.versions(spark, table)
        return f"r{number_of(names[-1]) + 1 if names else 0:08d}"

    def read(
        self,
        spark: SparkSession,
        table: str,
        periods: Collection[str] | None = None,
        version: Version | None = None,
    ) -> DataFrame:
        """Rows of the newest version, or of the one given; only folders of ``periods`` if given."""
        version = version or self.version(spark, table)
        if version is None:
            raise FileNotFoundError(f"no version of {table} has been published below {self.root}")
        folders = [f for period, f in version.folder_of().items() if periods is None or period in periods]
        return self._rows(spark, table, version.schema, folders)

    def read_marked(self, spark: SparkSession, table: str, periods: Collection[str]) -> DataFrame:
        """``read`` with the number of the version that brought a row's values, -1 if it came before there were marks."""
        version = self.version(spark, table)
        folders = [f for period, f in version.folder_of().items() if period in periods]
        rows = self._rows(spark, table, _marked(version.schema), folders)
        return rows.withColumn(CHANGED, F.coalesce(CHANGED, F.lit(-1)))

    def newest(self, spark: SparkSession, table: str, rows: int) -> DataFrame:
        """The newest periods that together hold ``rows`` rows, or all of them.

        Names of periods are in the order of their dates, so what consumers ask of the newest rows is
        in these folders; undated rows come last. Folders are opened newest first, twice as many at a
        time, until there are enough.
        """
        periods = self.version(spark, table).folder_of()
        order = sorted((p for p in periods if p != UNDATED), reverse=True) + [p for p in periods if p == UNDATED]
        number = 1
        while True:
            found = self.read(spark, table, order[:number])
            if number >= len(order) or found.limit(rows).count() >= rows:
                return found
            number *= 2

    def _rows(self, spark: SparkSession, table: str, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], schema)
        placed = T.StructType([*schema.fields, T.StructField("v", T.StringType())])
        reader = spark.read.schema(placed).option("basePath", self.path(table))
        return reader.parquet(*[f"{self.path(table)}/{folder}" for folder in folders]).select(*schema.names)

    def replace(
        self,
        df: DataFrame,
        table: str,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        sources: Mapping[str, str] | None = None,
        audit: Callable[[DataFrame], None] | None = None,
        in_place: bool = False,
    ) -> DataFrame:
        """Rebuild a table in full and return the stored rows.

        ``audit`` gets the written rows before they are published; if it raises, the version before
        stays the newest one. ``in_place``: rows are written by the tasks that made them, see ``laid_out``.
        """
        return self._publish(df, table, partition_by, sort_by, [], sources, audit, in_place)

    def replace_periods(
        self,
        df: DataFrame,
        table: str,
        periods: Collection[str],
        sort_by: Sequence[str] = (),
        sources: Mapping[str, str] | None = None,
        audit: Callable[[DataFrame], None] | None = None,
        in_place: bool = False,
    ) -> DataFrame:
        """Replace all rows of ``periods`` by ``df``; the folders of other periods are taken over.

        If ``df`` has marks (``CHANGED``), it holds all keys of those periods and says which have new values.
        """
        current = self.version(df.sparkSession, table)
        others = current.folder_of() if current else {}
        kept = [folder for period, folder in others.items() if period not in periods]
        marked_since = current.marked_since if current and CHANGED in df.columns else None
        return self._publish(df, table, [PERIOD], sort_by, kept, sources, audit, in_place, marked_since)

    def _publish(
        self,
        df: DataFrame,
        table: str,
        partition_by: Sequence[str],
        sort_by: Sequence[str],
        kept: Sequence[str],
        sources: Mapping[str, str] | None,
        audit: Callable[[DataFrame], None] | None,
        in_place: bool,
        marked_since: str | None = None,
    ) -> DataFrame:
        spark, path = df.sparkSession, self.path(table)
        names, name = self.versions(spark, table), self.next_name(spark, table)
        # whatever the session is set to; the folder holds at most what a writer left that died
        writer = compact(laid_out(df, partition_by, sort_by, in_place).write).mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with shuffles_removed(spark):
            writer.parquet(f"{path}/v={name}")
        written = [f"v={name}"]
        if partition_by:
            found = children(spark, f"{path}/v={name}")
            written = sorted(f"v={name}/{child}" for child in found if child.startswith(f"{PERIOD}="))
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema if f.name != CHANGED])
        if not written and not kept:
            # no rows, no folders: an empty file tells catalog views the schema
            written = [f"v={name}/{PERIOD}={UNDATED}"]
            empty = spark.createDataFrame([], schema).drop(PERIOD)
            empty.coalesce(1).write.mode("overwrite").parquet(f"{path}/{written[0]}")
        if audit:
            audit(self._rows(spark, table, schema, written))
        version = Version(name, schema, [*kept, *written], dict(sources or {}), marked_since or name)
        text = {
            "version": name, "schema": schema.jsonValue(), "folders": version.folders,
            "sources": version.sources, "marked_since": version.marked_since,
        }
        write_text(spark, f"{self.published(table)}/{name}.json", json.dumps(text))
        self._forget(spark, table, [*names, name])
        return self.read(spark, table, version=version)

    def _forget(self, spark: SparkSession, table: str, names: Sequence[str]) -> None:
        """Remove versions beyond KEPT_VERSIONS, and folders that none of the others lists."""
        old = [self.version(spark, table, name) for name in names[:-KEPT_VERSIONS]]
        if not old:
            return
        kept = {f for name in names[-KEPT_VERSIONS:] for f in self.version(spark, table, name).folders}
        for version in old:
            unmark(spark, f"{self.published(table)}/{version.name}.json")
            for folder in version.folders:
                if folder not in kept:
                    remove(spark, f"{self.path(table)}/{folder}")

    def changed(
        self, spark: SparkSession, table: str, since: str | None, keys: Sequence[str], columns: Sequence[str]
    ) -> DataFrame | None:
        """Keys whose ``columns`` differ between version ``since`` and the newest one, and ``gone``,
        true for keys that are no more; None if that version is not kept. Only folders that one of
        the two versions lists are read, one row per key on both sides.

        If only merges lie between the two, the marked rows of the newest version tell, and nothing is
        shuffled: then keys whose other values differ, or differed in between, are among those returned."""
        before, after = self.version(spark, table, since) if since else None, self.version(spark, table)
        if before and after and after.marked_since <= before.name:
            rows = self._rows(spark, table, _marked(after.schema), [f for f in after.folders if f not in before.folders])
            return rows.filter(F.col(CHANGED) > number_of(before.name)).select(*keys, F.lit(False).alias("gone"))
        sides = self._differing(spark, table, since)
        if sides is None:
            return None
        value = F.struct(*columns)
        old, new = (rows.select(*keys, value.alias(name)) for rows, name in zip(sides, ("_old", "_new")))
        joined = old.join(new, list(keys), "full_outer")
        return joined.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(*keys, F.col("_new").isNull().alias("gone"))

    def changed_groups(
        self, spark: SparkSession, table: str, since: str | None, group: str, columns: Sequence[str]
    ) -> DataFrame | None:
        """Values of ``group`` whose rows, as far as ``columns`` go, are not the same in version ``since``
        and the newest one; None if that version is not kept. Groups are compared by their number of rows
        and two sums of 64-bit hashes under different seeds, which combine before the shuffle: one row per
        group and task is shuffled, none of the table."""
        sides = self._differing(spark, table, since)
        if sides is None:
            return None

        sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)")) for seed in (1, 2)]
        digest = F.struct(F.count(F.lit(1)).alias("n"), *[s.alias(f"s{i}") for i, s in enumerate(sums)])
        old, new = (
            rows.groupBy(F.col(group).alias(f"{name}_group")).agg(digest.alias(name)) for rows, name in zip(sides, ("_old", "_new"))
        )
        joined = old.join(new, F.col("_old_group").eqNullSafe(F.col("_new_group")), "full_outer")
        differing = joined.filter(~F.col("_old").eqNullSafe(F.col("_new")))
        return differing.select(F.coalesce("_old_group", "_new_group").alias(group))

    def _differing(self, spark: SparkSession, table: str, since: str | None) -> tuple[DataFrame, DataFrame] | None:
        """Rows of the folders that only version ``since`` lists, and of those that only the newest one lists."""
        before = self.version(spark, table, since) if since else None
        after = self.version(spark, table)
        if before is None or after is None:
            return None
        old, new = (
            self._rows(spark, table, own.schema, [f for f in own.folders if f not in other.folders])
            for own, other in ((before, after), (after, before))
        )
        return old, new


def _marked(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CHANGED, T.IntegerType())])


def laid_out(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str], in_place: bool = False) -> DataFrame:
    """Arrange rows for writing.

    The rebalance hint brings the rows of one folder together and lets AQE choose file sizes from
    the bytes actually produced: small folders share a task, a large one is split over several.
    Sorting within files narrows the value range of each row group, so that a filter on the sort
    columns skips most of them; no order across files is needed for that, hence no global sort.

    ``in_place``: no rebalance. For rows that have just been shuffled by another key, it would shuffle
    all of them, now wider, again. A task writes one file into each folder it has rows of, and a
    folder of any size is written by all tasks.
    """
    spread = df if in_place else df.hint("rebalance", *[F.col(name) for name in partition_by])
    order = [*partition_by, *sort_by]
    return spread.sortWithinPartitions(*order) if sort_by else spread


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows stored below ``path``, or none if nothing was stored yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def register_views(views: dict[str, DataFrame]) -> None:
    """Make tables queryable by their plain names."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def register_databases(spark: SparkSession, warehouse: Warehouse, tables: Sequence[str]) -> None:
    """Make stored tables queryable as ``<database>.<table>``, one database per layer.

    The names are catalog views whose text finds the newest version when it is queried, so they go on
    to hold after rebuilds and refreshes without being registered again. Versions and periods are
    folder columns, so only the folders that the version lists are read.
    """
    for table in tables:
        columns = ", ".join(f"`{n}`" for n in warehouse.version(spark, table).schema.names if n != PERIOD)
        versions = f"json.`{warehouse.published(table)}/*.json`"
        periods = PERIOD in warehouse.version(spark, table).schema.names
        folder = f"concat('v=', v, '/{PERIOD}=', {PERIOD})" if periods else "concat('v=', v)"
        register_view(
            spark,
            table,
            f"SELECT {columns} FROM parquet.`{warehouse.path(table)}` WHERE {folder} IN (SELECT explode(folders) "
            f"FROM {versions} WHERE version = (SELECT max(version) FROM {versions}))",
        )


def register_view(spark: SparkSession, table: str, query: str) -> None:
    """A catalog view under the full name that consumers use."""
    database = DATABASES[LAYERS[table]]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS {query}")
