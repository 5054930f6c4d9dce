"""Warehouse and stage tables on parquet.

Small keyed tables are whole snapshots: every publish is a new folder and readers take the newest committed one. Large tables
are stored in parts, by month or by range of ids. Every write goes into a folder of its own, and a version record,
written last, says which folders make up the table (see ``versions``). Either way a publish becomes visible as a whole,
a write that fails changes nothing, and parts a batch does not touch keep their files.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.functions import empty_table
from batchloom.operators.keys import max_id
from batchloom.schemas import BUCKETED, RANGE_KEYS, RANGED, STAGE, STATE, WAREHOUSE
from batchloom.sources import versions
from batchloom.sources.files import PARQUET, commit, commit_text, delete, list_names, next_number, numbered, size_of
from batchloom.sources.versions import Version

TABLES = {**WAREHOUSE, **STATE}
_RANGE = "id_range"
_WRITE = "w="
#: Parts whose key ranges are compared in one pass over a batch's keys.
_RANGES_AT_ONCE = 500


class Store:
    """``range_size`` ids make one part of the tables that are stored by ranges of ids; snapshots with a natural key that have grown
    beyond ``bucket_bytes`` are stored in buckets of about that size."""

    def __init__(self, spark: SparkSession, root: str, range_size: int = 1 << 20, bucket_bytes: int = 256 << 20):
        self.spark = spark
        self.root = root.rstrip("/")
        self.range_size = range_size
        self.bucket_bytes = bucket_bytes

    def _folder(self, table: str) -> str:
        return f"{self.root}/warehouse/{table}"

    def _newest(self, folder: str, schema: T.StructType) -> DataFrame:
        found = numbered(self.spark, folder, "v=")
        if not found:
            return empty_table(self.spark, schema)
        path = f"{folder}/v={found[-1]}"
        buckets = self._facts_of(path).get("buckets")
        return self.spark.read.schema(schema).parquet(path) if buckets is None else self._bucketed(path, schema, *buckets)

    def _facts_of(self, path: str) -> dict[str, object]:
        """What the writer of a snapshot recorded of it."""
        return json.loads(commit_text(self.spark, path) or "{}")

    def _bucketed(self, path: str, schema: T.StructType, key: str, number: int) -> DataFrame:
        """A folder of bucketed files with their layout known to the planner.

        Spark takes bucketing from its catalog only, so the folder is declared there for as long as it takes to resolve it.
        """
        name = f"batchloom_{uuid.uuid4().hex}"
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet OPTIONS (path '{place}') CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {number} BUCKETS")
        try:
            return self.spark.table(name).select(*schema.names)
        finally:
            self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay

    def buckets(self, table: str) -> tuple[str, int] | None:
        """The key and the number of buckets of a snapshot's newest version."""
        folder = self._folder(table)
        found = numbered(self.spark, folder, "v=") if table in BUCKETED else []
        known = self._facts_of(f"{folder}/v={found[-1]}").get("buckets") if found else None
        return None if known is None else (known[0], known[1])

    # --- parts ---------------------------------------------------------------------------------

    @staticmethod
    def part_columns(table: str) -> list[str]:
        """The columns a table is stored by; none for a snapshot. The range of ids is no column of the table."""
        partition = TABLES[table][1]
        return [*([partition] if partition else []), *([_RANGE] if table in RANGED else [])]

    @staticmethod
    def part_name(table: str, *values: object) -> str:
        """The name of a part: a value for each of ``part_columns``, None for NULL."""
        columns = Store.part_columns(table)
        return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(columns, values, strict=True))

    def id_range(self, id_col: str) -> Column:
        """The range of ids a row belongs to."""
        return F.floor(F.col(id_col) / F.lit(self.range_size)).cast("bigint")

    def version(self, table: str) -> Version:
        """The table's newest version; tables written before there were records consist of the folders found."""
        folder = self._folder(table)
        found = versions.newest(self.spark, folder)
        if found is not None:
            return found
        first = self.part_columns(table)[0]
        return Version(0, {name: (name,) for name in list_names(self.spark, folder) if name.startswith(f"{first}=")})

    def base(self, table: str, batch_no: int) -> Version | None:
        """The version a batch builds on: the newest one, or, if the batch is the last that was applied, the state before it.

        None if the batch was applied before another one, so that it cannot be applied again.
        """
        version = self.version(table)
        applied = version.facts.get("applied", [])
        if batch_no not in applied:
            return version
        before = version.before()
        if applied[-1] != batch_no or before is None:
            return None
        facts = {k: v for k, v in version.facts.items() if k not in ("before", "max_id")}
        return Version(version.number, before, {**facts, "applied": applied[:-1]})

    def _parts_in(self, table: str, folder: str) -> list[str]:
        """The parts that a write has made."""
        found = [""]
        for column in self.part_columns(table):
            found = [f"{name}/{n}".lstrip("/") for name in found for n in list_names(self.spark, f"{folder}/{name}".rstrip("/")) if n.startswith(f"{column}=")]
        return found

    # --- reading -------------------------------------------------------------------------------

    def read(self, table: str, since: dt.date | None = None, only: Iterable[str] | None = None, at: Version | None = None) -> DataFrame:
        """Current state; an empty table with the declared schema before the first publish.

        For tables stored in parts: ``since`` limits a table stored by month to the months from that day's on, ``only`` to the named
        parts; no other folders are listed. ``at`` reads another version than the newest.
        """
        schema, _ = TABLES[table]
        folder = self._folder(table)
        if not self.part_columns(table):
            return self._newest(folder, schema)
        version = self.version(table) if at is None else at
        wanted = None if only is None else set(only)
        names = list(version.parts) if since is None else self.parts_since(table, since, version)
        names = [n for n in names if wanted is None or n in wanted]
        return self._folders(table, [f for n in names for f in version.parts[n]])

    def parts_since(self, table: str, since: dt.date, at: Version | None = None) -> list[str]:
        """The parts of a table stored by month from that day's month on."""
        version, partition = self.version(table) if at is None else at, TABLES[table][1]
        return [n for n in version.parts if n.split("/")[0].removeprefix(f"{partition}=") >= str(since.replace(day=1))]

    def _folders(self, table: str, folders: Sequence[str]) -> DataFrame:
        schema = TABLES[table][0]
        # Folders from before there were records have one level less and are read apart.
        kinds = [[f for f in folders if f.startswith(_WRITE)], [f for f in folders if not f.startswith(_WRITE)]]
        base = self._folder(table)
        found = [
            self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in own]).select(*schema.names)
            for own in kinds
            if own
        ]
        if not found:
            return empty_table(self.spark, schema)
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def highest_id(self, table: str, id_col: str) -> int:
        """The table's highest id, 0 when it is empty: from its record if the last writer knew it, else by reading the ids."""
        if self.part_columns(table):
            known = self.version(table).facts.get("max_id", {}).get(id_col)
        else:
            folder = self._folder(table)
            found = numbered(self.spark, folder, "v=")
            known = self._facts_of(f"{folder}/v={found[-1]}").get("max_id", {}).get(id_col) if found else 0
        return max_id(self.read(table), id_col) if known is None else known

    def holding(self, table: str, rows: DataFrame) -> list[str]:
        """The parts that can hold a key of these rows, by the key ranges in the table's record; all parts without ranges are among them.

        One pass over the rows' keys; at most the names of the parts reach the driver.
        """
        version, key = self.version(table), RANGE_KEYS[table]
        ranges = version.facts.get("ranges", {})
        open_, bounded = [], []
        for name, folders in version.parts.items():
            own = [ranges.get(f) for f in folders]
            if None in own:
                open_.append(name)
            elif own := [r for r in own if r]:
                bounded.append((name, min(r[0] for r in own), max(r[1] for r in own)))
        kind = rows.schema[key].dataType.simpleString()
        for start in range(0, len(bounded), _RANGES_AT_ONCE):
            parts = [{"name": n, "least": a, "most": b} for n, a, b in bounded[start : start + _RANGES_AT_ONCE]]
            every = F.from_json(F.lit(json.dumps(parts)), f"array<struct<name: string, least: {kind}, most: {kind}>>")
            hit = F.filter(every, lambda p: F.col(key).between(p["least"], p["most"]))
            open_ += [r[0] for r in rows.select(F.explode(F.transform(hit, lambda p: p["name"]))).distinct().collect()]
        return open_

    # --- publishing ----------------------------------------------------------------------------

    def _publish(self, df: DataFrame, folder: str, facts: Mapping[str, object] | None = None, key: str | None = None) -> None:
        path = f"{folder}/v={next_number(self.spark, folder, 'v=')}"
        number = self._bucket_number(folder) if key is not None else 1
        if number == 1:
            df.write.options(**PARQUET).parquet(path)
        else:
            # Rows that come from buckets are in them already: a task writes a file for each bucket it has rows of.
            name = f"batchloom_{uuid.uuid4().hex}"
            try:
                df.write.bucketBy(number, key).sortBy(key).format("parquet").options(**PARQUET).option("path", path).saveAsTable(name)
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            facts = {**(facts or {}), "buckets": [key, number]}
        commit(self.spark, path, json.dumps(facts) if facts else "")

    def _bucket_number(self, folder: str) -> int:
        """A power of two, by the size of the newest version; 1 for small tables."""
        found = numbered(self.spark, folder, "v=")
        wanted = size_of(self.spark, f"{folder}/v={found[-1]}") / self.bucket_bytes if found else 0
        return 1 if wanted <= 1 else 1 << math.ceil(math.log2(wanted))

    def replace(self, table: str, df: DataFrame, facts: Mapping[str, object] | None = None) -> None:
        """Publish a new snapshot; the old one stays current until the write has committed."""
        if self.part_columns(table):
            raise ValueError(f"{table} is stored in parts: use replace_partitions or append")
        self._publish(df.select(*TABLES[table][0].names), self._folder(table), facts, BUCKETED.get(table))

    def replace_partitions(
        self,
        table: str,
        df: DataFrame,
        also: Iterable[str] = (),
        base: Version | None = None,
        batch_no: int | None = None,
        facts: Mapping[str, object] | None = None,
        laid_out: bool = False,
    ) -> None:
        """Replace exactly the parts that occur in ``df``, whose rows must be complete for them, and those of ``also``.

        ``base``: the version to build on instead of the newest (see ``base()``). ``batch_no`` is recorded as the last batch applied,
        with the state before it. ``laid_out``: each task has rows of a few neighbouring parts, so they are written where they are.
        """
        self._write_parts(table, df, set(also), base, batch_no, facts, keep=False, laid_out=laid_out)

    def append(self, table: str, df: DataFrame, facts: Mapping[str, object] | None = None, replacing: Iterable[str] = ()) -> None:
        """Add rows to a table stored in parts; the parts named by ``replacing`` give way to their rows in ``df``."""
        self._write_parts(table, df, set(replacing), None, None, facts, keep=True)

    def _write_parts(self, table, df, also, base, batch_no, facts, keep, laid_out=False) -> None:
        schema = TABLES[table][0]
        columns, folder = self.part_columns(table), self._folder(table)
        newest = self.version(table)
        base = newest if base is None else base
        write = f"{_WRITE}{self._next_write(folder, newest)}"
        rows = df.select(*schema.names)
        if table in RANGED:
            rows = rows.withColumn(_RANGE, self.id_range(RANGED[table]))
        if not laid_out:
            # Rebalancing lets adaptive execution split a large part over several tasks and files.
            rows = rows.hint("rebalance", *columns)
        rows.write.partitionBy(*columns).options(**PARQUET).parquet(f"{folder}/{write}")
        made = {name: f"{write}/{name}" for name in self._parts_in(table, f"{folder}/{write}")}
        if not made and not also:
            return
        parts = {name: own for name, own in base.parts.items() if name not in also and (keep or name not in made)}
        for name, own in made.items():
            parts[name] = (*parts.get(name, ()), own)
        known = dict(facts or {})
        if table in RANGE_KEYS:
            old = base.facts.get("ranges", {})
            kept = {f: old[f] for own in parts.values() for f in own if f in old}
            known["ranges"] = {**kept, **self._key_ranges(table, list(made.items()))}
        if batch_no is not None:
            known["applied"] = [*base.facts.get("applied", []), batch_no]
            known["before"] = {name: list(own) for name, own in base.parts.items()}
        elif "applied" in base.facts:
            known["applied"] = base.facts["applied"]
        versions.write_record(self.spark, folder, Version(newest.number + 1, parts, known))

    def _next_write(self, folder: str, newest: Version) -> int:
        """Above every write and every record, complete or not."""
        return max([next_number(self.spark, folder, _WRITE), newest.number + 1])

    def _key_ranges(self, table: str, made: Sequence[tuple[str, str]]) -> dict[str, list]:
        """The least and the largest key in each folder just written; [] where all keys are NULL."""
        if not made:
            return {}
        key, [partition] = RANGE_KEYS[table], self.part_columns(table)
        found = self._folders(table, [f for _, f in made]).groupBy(partition).agg(F.min(key), F.max(key)).collect()
        by_name = {self.part_name(table, r[0]): [] if r[1] is None else [r[1], r[2]] for r in found}  # one row a month
        return {f: by_name[name] for name, f in made if name in by_name}

    def replace_stage(self, table: str, df: DataFrame) -> None:
        """Truncate-and-load: this batch's rows become the whole stage table."""
        self._publish(df.select(*STAGE[table].names), f"{self.root}/stage/{table}")

    def read_stage(self, table: str) -> DataFrame:
        return self._newest(f"{self.root}/stage/{table}", STAGE[table])

    def prune(self, keep: int = 2) -> None:
        """Drop snapshots and versions older than the newest ``keep``, and the folders no kept version needs.

        A table has one writer at a time: folders of writes that failed are dropped once a later write has been published.
        """
        snapshots = [self._folder(t) for t in TABLES if not self.part_columns(t)]
        for folder in [*snapshots, *(f"{self.root}/stage/{t}" for t in STAGE)]:
            for n in numbered(self.spark, folder, "v=")[:-keep]:
                delete(self.spark, f"{folder}/v={n}")
        for table in TABLES:
            if self.part_columns(table):
                self._prune_parts(table, keep)

    def _prune_parts(self, table: str, keep: int) -> None:
        folder = self._folder(table)
        numbers = versions.numbers(self.spark, folder)
        found = [v for n in numbers if (v := versions.read_record(self.spark, folder, n)) is not None]
        if not found:
            return
        needed = set().union(*(v.folders() for v in found[-keep:]))
        last = max((int(f.split("/")[0].removeprefix(_WRITE)) for f in needed if f.startswith(_WRITE)), default=0)
        for name in list_names(self.spark, folder):
            if name.startswith(_WRITE) and int(name.removeprefix(_WRITE)) <= last:
                parts = [f"{name}/{part}" for part in self._parts_in(table, f"{folder}/{name}")]
                if not any(part in needed for part in parts):
                    delete(self.spark, f"{folder}/{name}")
                else:
                    for part in parts:
                        if part not in needed:
                            delete(self.spark, f"{folder}/{part}")
            elif name.startswith(f"{self.part_columns(table)[0]}=") and name not in needed:
                delete(self.spark, f"{folder}/{name}")
        versions.drop_records(self.spark, folder, [n for n in numbers if n < found[-keep:][0].number])
