"""Tables kept in buckets by key, changed together.

A store is a folder of part folders and of numbered manifests that name the
parts of every table.  A change writes new parts beside the old ones: of a
table only the buckets that hold a changed row.  It counts once its manifest
has been renamed into place, for all of its tables at once; one that breaks off
before leaves the set as it was.  Rows are checked as they are written, and a
row that breaks the rules of its table ends the change.

One writer at a time: a second one that started from the same manifest fails
when it moves its own.  ``keep`` older sets stay readable; what no kept manifest
names is deleted after the move.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import contracts
from .files import Files

BUCKETS = 64
_BUCKET, _SLICE = "_bucket", "_slice"


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, keep: int = 1):
        self.spark, self.root, self.buckets, self.keep = spark, root.rstrip("/"), buckets, keep
        self.files = Files(spark, root)

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.root}/manifests") if n.endswith(".json")]

    @property
    def version(self) -> int | None:
        """The number of the present set; None before the first."""
        return max(self.versions(), default=None)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version if version is None else version
        return {} if version is None else json.loads(self.files.read(f"{self.root}/manifests/{version:012d}.json"))

    def tables(self) -> list[str]:
        return sorted(self.manifest())

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table of the present set, or of an older one that is kept."""
        table = self.manifest(version).get(name)
        if table is None:
            raise contracts.ContractError(f"there is no table {name} in {self.root}")
        return self.read_parts(table)

    def read_parts(self, table: dict, only: set[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(table["schema"])
        parts = [f"{self.root}/{p}" for b, held in table["parts"].items() if only is None or int(b) in only for p in held]
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    @contextmanager
    def change(self) -> Iterator[Change]:
        """Changes of any tables that count together, at the end, or not at all."""
        change = Change(self)
        try:
            yield change
            change.commit()
        except BaseException:
            change.undo()
            raise

    def clear(self) -> None:
        """Delete manifests beyond those kept, and parts that no kept one names."""
        versions = sorted(self.versions())
        for v in versions[: -1 - self.keep]:
            self.files.delete(f"{self.root}/manifests/{v:012d}.json")
        live = {p for v in versions[-1 - self.keep :] for table in self.manifest(v).values() for held in table["parts"].values() for p in held}
        for table in self.files.names(f"{self.root}/data"):
            for written in self.files.names(f"{self.root}/data/{table}"):
                folder = f"data/{table}/{written}"
                parts = [n for n in self.files.names(f"{self.root}/{folder}") if n.startswith(_BUCKET)]
                dead = [n for n in parts if f"{folder}/{n}" not in live]
                for name in [folder] if len(dead) == len(parts) else [f"{folder}/{n}" for n in dead]:
                    self.files.delete(f"{self.root}/{name}")


class Change:
    """Parts written but not yet counted; ``read`` sees them already."""

    def __init__(self, store: Store):
        self.store, self.base = store, store.version
        self.manifest = store.manifest(self.base) if self.base is not None else {}
        self.written: list[str] = []
        self.upserted: dict[str, int] = {}

    def read(self, name: str) -> DataFrame:
        """The table as this change leaves it."""
        if name not in self.manifest:
            raise contracts.ContractError(f"there is no table {name} in {self.store.root}")
        return self.store.read_parts(self.manifest[name])

    def matching(self, name: str, rows: DataFrame, key: str) -> DataFrame:
        """The rows of a table whose key some of ``rows`` has: only the buckets of those keys are read."""
        table = self.manifest[name]
        reached = {r[0] for r in rows.filter(F.col(key).isNotNull()).select(bucket(key, table["buckets"])).distinct().collect()}
        return self.store.read_parts(table, reached).join(rows.select(key).distinct(), key, "left_semi")

    def upsert(self, name: str, rows: DataFrame, key: str, order: str, tie: str | None = None, unread: tuple[str, ...] = (), counted: Column | None = None) -> int:
        """Rows replace those of equal key, the last by ``order`` of a batch; the number of buckets written.

        Rows that are in the table already change nothing, so the same batch
        again writes nothing; ``unread`` columns, such as a time of loading,
        make no difference.  ``upserted`` has the number of rows, or of those
        where ``counted`` holds.
        """
        self.create(name, rows, key)
        store, table = self.store, self.manifest[name]
        names = StructType.fromJson(table["schema"]).names
        if not table["parts"]:
            return self._fill(name, table, rows, key, order, tie, counted)
        # Rows are dealt by key before they are summed up, so nothing is sorted as it is read; old rows join there.
        last = self._last(rows.repartition(key), [key], names, order, tie, counted).withColumn(_BUCKET, bucket(key, table["buckets"])).persist()
        try:
            reached = {r[0]: r[1] for r in last.groupBy(_BUCKET).agg(F.sum("_n")).collect()}
            self.upserted[name] = self.upserted.get(name, 0) + sum(reached.values())
            known = store.read_parts(table, set(reached))
            same = F.lit(True)
            for c in names:
                same &= F.col(f"new.`{c}`").eqNullSafe(F.col(f"old.`{c}`")) if c not in unread else F.lit(True)
            # Rows without a key are refused by the rules, so they count as changes.
            differ = last.alias("new").join(known.alias("old"), F.col(f"new.`{key}`") == F.col(f"old.`{key}`"), "left").filter(~(same & F.col(f"old.`{key}`").isNotNull()))
            touched = {r[0] for r in differ.select(F.col(f"new.{_BUCKET}")).distinct().collect()}
            if not touched:
                return 0
            of_touched = last.filter(F.col(_BUCKET).isin(*touched))
            kept = store.read_parts(table, touched).join(of_touched.select(key), key, "left_anti").select(*names).withColumn(_BUCKET, bucket(key, table["buckets"]))
            self._write(name, table, kept.unionByName(of_touched.select(*names, _BUCKET)), touched)
            return len(touched)
        finally:
            last.unpersist()

    def _last(self, rows: DataFrame, keys: list[str], names: list[str], order: str, tie: str | None, counted: Column | None) -> DataFrame:
        """The last row of each key, and in ``_n`` how many there were."""
        rest = [c for c in names if c not in keys]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, tie or order)).alias("last"), (F.count("*") if counted is None else F.count_if(counted)).alias("_n"))
        return last.select(*(F.col(c if c in keys else f"last.`{c}`").alias(c) for c in [*names, *(k for k in keys if k not in names)]), "_n")

    def _fill(self, name: str, table: dict, rows: DataFrame, key: str, order: str, tie: str | None, counted: Column | None) -> int:
        """``upsert`` into an empty table: rows are sent once, by slices of buckets, and written where they are summed up."""
        names = StructType.fromJson(table["schema"]).names
        slices = table["buckets"] * -(-4 * int(self.store.spark.conf.get("spark.sql.shuffle.partitions")) // table["buckets"])
        dealt = rows.withColumn(_SLICE, bucket(key, slices)).repartition(_SLICE)
        # A slice belongs to one bucket, as their number is a multiple of that of the buckets.
        last = self._last(dealt, [_SLICE, key], names, order, tie, counted).withColumn(_BUCKET, F.col(_SLICE) % table["buckets"])
        found = self._write(name, table, last, metrics={"n": F.sum("_n")}, dealt=True)
        self.upserted[name] = self.upserted.get(name, 0) + found["n"]
        return len(self.manifest[name]["parts"])

    def append(self, name: str, rows: DataFrame, key: str, keep: Column | None = None, metrics: dict[str, Column] | None = None, dealt: bool = False) -> dict[str, int]:
        """Add the rows where ``keep`` holds to a table that only grows; ``metrics`` of all rows are counted in the same pass.

        Nothing old is read.  Columns that the table lacks serve ``keep`` and
        the metrics only.  Rows that are ``dealt`` already, by whatever key, are
        not sent by bucket: each task writes a file of every bucket it has.
        """
        table = self.manifest.get(name)
        if table is None:
            raise contracts.ContractError(f"{name} has no columns yet; create it first")
        return self._write(name, table, rows.withColumn(_BUCKET, bucket(key, table["buckets"])), keep=keep, metrics=metrics, dealt=dealt)

    def compact(self, name: str, most: int = 16) -> int:
        """Write buckets of more than ``most`` parts anew as one part each; their number."""
        table = self.manifest[name]
        full = {int(b) for b, held in table["parts"].items() if len(held) > most}
        if full:
            self._write(name, table, self.store.read_parts(table, full).withColumn(_BUCKET, bucket(table["key"], table["buckets"])), full)
        return len(full)

    def create(self, name: str, like: DataFrame, key: str) -> None:
        """An empty table with the columns of ``like``, unless it is there."""
        if name not in self.manifest:
            self.manifest[name] = self._new(key, like)

    def _new(self, key: str, rows: DataFrame) -> dict:
        schema = json.loads(rows.schema.json())
        for field in schema["fields"]:
            field["nullable"] = True
        return {"key": key, "buckets": self.store.buckets, "schema": schema, "parts": {}}

    def _write(self, name: str, table: dict, rows: DataFrame, replaced: set[int] | None = None, keep: Column | None = None, metrics: dict[str, Column] | None = None, dealt: bool = False) -> dict[str, int]:
        """Write rows by bucket beside the old parts; buckets in ``replaced`` lose theirs, the rest keep them.

        Rows are counted behind the exchange, in the tasks that write: such a
        task counts once, however often the stages before it run again.  Rows
        that are ``dealt`` have an exchange behind them, so none comes before
        the write.
        """
        names = StructType.fromJson(table["schema"]).names
        keep = F.lit(True) if keep is None else keep
        rules = {"key": F.col(table["key"]).isNull(), **contracts.table_rules(name, names)}
        counts = {f"broken {k}": F.count_if(keep & bad) for k, bad in rules.items()} | (metrics or {})
        observed = Observation()
        folder = f"data/{name}/{uuid.uuid4().hex}"
        self.written.append(folder)
        # The planner splits large buckets into several files and joins small ones.
        counted = (rows if dealt else rows.hint("rebalance", _BUCKET)).observe(observed, *(c.alias(k) for k, c in counts.items()))
        counted.filter(keep).select(*names, _BUCKET).write.option("compression", "zstd").partitionBy(_BUCKET).parquet(f"{self.store.root}/{folder}")
        found = {k: v or 0 for k, v in observed.get.items()}
        broken = [f"{k[7:]} ({v})" for k, v in found.items() if k.startswith("broken ") and v]
        if broken:
            raise contracts.ContractError(f"rows of {name} break {', '.join(broken)}")
        new = {int(n.partition("=")[2]): f"{folder}/{n}" for n in self.store.files.names(f"{self.store.root}/{folder}") if n.startswith(_BUCKET)}
        old = {int(b): p for b, p in table["parts"].items()}
        parts = {b: p for b, p in old.items() if b not in (replaced or ())}
        for b, p in new.items():
            parts[b] = [*parts.get(b, []), p]
        self.manifest[name] = table | {"parts": {str(b): parts[b] for b in sorted(parts)}}
        return {k: found[k] for k in metrics or ()}

    def require_references(self, name: str, column: str, target: str, key: str) -> None:
        """Refuse the change if a row of ``name`` that it adds points at no row of ``target``."""
        before = {p for parts in self.store.manifest(self.base).get(name, {"parts": {}})["parts"].values() for p in parts} if self.base is not None else set()
        added = [f"{self.store.root}/{p}" for parts in self.manifest[name]["parts"].values() for p in parts if p not in before]
        if not added:
            return
        rows = self.store.spark.read.schema(StructType.fromJson(self.manifest[name]["schema"])).parquet(*added).filter(F.col(column).isNotNull())
        lost = rows.join(self.read(target).select(F.col(key).alias(column)), column, "left_anti").limit(1).collect()
        if lost:
            raise contracts.ContractError(f"a row of {name} names {column} {lost[0][column]}, which {target} lacks")

    def commit(self) -> int | None:
        """Move the manifest into place; the number of the new set, or None if nothing changed."""
        store = self.store
        if store.version != self.base:
            raise contracts.ContractError(f"{store.root} was changed by another writer")
        if self.base is not None and self.manifest == store.manifest(self.base):
            self.undo()
            return None
        number = 0 if self.base is None else self.base + 1
        draft = f"{store.root}/manifests/draft-{uuid.uuid4().hex}"
        store.files.write(draft, json.dumps(self.manifest))
        if not store.files.move(draft, f"{store.root}/manifests/{number:012d}.json"):
            store.files.delete(draft)
            raise contracts.ContractError(f"{store.root} was changed by another writer")
        self.written = []
        store.clear()
        return number

    def undo(self) -> None:
        """Delete what was written and doesn't count."""
        for folder in self.written:
            self.store.files.delete(f"{self.store.root}/{folder}")
        self.written = []
