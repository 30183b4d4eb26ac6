"""A versioned table kept as change sets in Parquet.

Every statement writes only the rows it changed, under a folder of its own, and then
one commit line. A row has an address, ``(_src, _rid)``: the sequence number of the
commit that added it and a number unique in that commit. An added row is stored with
its address; a removed row is stored as the bare address it had:

    data/_seg=<name>/_w=1/...     added rows:   columns, _src, _rid
    data/_seg=<name>/_w=-1/...    removed rows: _src, _rid (columns NULL)
    commits/<version>.json        one JSON line: what, when, counts, schema, folder

A snapshot is the added rows up to a version, less the addresses removed up to it.
That holds without keys and with duplicate rows, and costs one anti join on two
numbers, never a grouping over whole rows. Removed addresses are broadcast when the
counts in the commit lines show that they are few, and folders older than any removed
address skip the join.

A folder that no commit line names is ignored, so a job that dies half way leaves the
table as it was. One writer at a time; a second one is refused when it commits.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import (CommitConflict, ConstraintViolation, RetentionTooShort, SchemaMismatch,
                      VersionExpired, VersionNotFound)
from ..functions.schema import align, by_name, check_assignable, evolved, quoted
from ..operators import layout, merge
from ..operators.diff import bag_minus, set_minus
from ..operators.quality import guarded
from ..operators.rows import condition, value
from ..operators.sizes import BROADCAST_ROWS
from ..session import hadoop_path, scratch_dir, write_new_file

# fixed value: the usual default of lakehouse tables
DEFAULT_RETENTION_HOURS = 168
_ADDRESS = ["_src", "_rid"]
_STORED = [T.StructField("_src", T.IntegerType()), T.StructField("_rid", T.LongType())]
_FOLDERS = [T.StructField("_seg", T.StringType()), T.StructField("_w", T.IntegerType())]

COMMIT_SCHEMA = ("version int, ts_us bigint, operation string, params map<string,string>, "
                 "rows_added bigint, rows_removed bigint, schema_json string, readable_from int")


@dataclass(frozen=True)
class Segment:
    """One data folder: the changes of sequence numbers ``lo`` to ``hi``."""
    root: str
    name: str
    lo: int
    hi: int
    added: int
    removed: int
    removed_from: int | None    # lowest sequence number among the removed addresses


@dataclass(frozen=True)
class Commit:
    version: int
    ts_us: int
    operation: str
    params: dict
    rows_added: int
    rows_removed: int
    schema_json: str
    rules: dict                 # partition_by, not_null, checks, null_passes
    seq: int                    # version plus the offset a clone starts from
    since: int                  # first version this commit's folder covers
    replaces: bool              # the rows of all versions before are gone as a whole
    segment: Segment | None
    pinned: tuple[Segment, ...]  # folders of the table a shallow clone reads
    readable_from: int

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema_json))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Commit:
        raw = json.loads(text)
        raw["segment"] = raw["segment"] and Segment(**raw["segment"])
        raw["pinned"] = tuple(Segment(**s) for s in raw["pinned"])
        return Commit(**raw)


def _micros(at: datetime) -> int:
    """Microseconds since 1970. A time without a zone is taken as UTC."""
    if at.tzinfo is None:
        at = at.replace(tzinfo=timezone.utc)
    return (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def _now() -> datetime:
    return datetime.now(timezone.utc)


class ChangeTable:
    """Handle on a versioned table at ``path``. :meth:`refresh` sees other writers' commits."""

    # ------------------------------------------------------------------ open and create

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._log: list[Commit] = []
        self.refresh()

    @classmethod
    def exists(cls, spark: SparkSession, path: str) -> bool:
        p, fs = hadoop_path(spark, f"{path.rstrip('/')}/commits")
        return fs.exists(p)

    @classmethod
    def create(cls, spark: SparkSession, path: str, rows_or_schema: DataFrame | T.StructType | str, *,
               partition_by: Sequence[str] = (), not_null: Iterable[str] = (),
               checks: dict[str, str] | None = None, null_passes: bool = False,
               at: datetime | None = None) -> ChangeTable:
        """Version 0: empty when given a schema, filled when given a frame."""
        table = cls._blank(spark, path)
        rules = {"partition_by": list(partition_by), "not_null": list(not_null),
                 "checks": dict(checks or {}), "null_passes": null_passes}
        if isinstance(rows_or_schema, DataFrame):
            schema = T.StructType([replace_nullable(f) for f in rows_or_schema.schema])
            table._append("CREATE TABLE AS SELECT", {}, rows_or_schema, schema, rules, at)
        else:
            schema = rows_or_schema
            if isinstance(schema, str):
                schema = T.StructType.fromDDL(schema)
            table._commit("CREATE TABLE", {}, schema, rules, None, at)
        return table

    @classmethod
    def _blank(cls, spark, path) -> ChangeTable:
        if cls.exists(spark, path):
            raise FileExistsError(f"{path} already holds a table")
        table = cls.__new__(cls)
        table.spark, table.path, table._log = spark, path.rstrip("/"), []
        return table

    def refresh(self) -> ChangeTable:
        """See the commits made since; lines read before are not read again, for they never change."""
        p, fs = hadoop_path(self.spark, f"{self.path}/commits")
        new = [f"{self.path}/commits/{n}" for n in (s.getPath().getName() for s in fs.listStatus(p))
               if n.endswith(".json") and int(n.removesuffix(".json")) >= len(self._log)]
        if new:
            lines = self.spark.read.text(new).select("value").collect()
            self._log += sorted((Commit.from_json(r[0]) for r in lines), key=lambda c: c.version)
        return self

    # ------------------------------------------------------------------ reading

    @property
    def version(self) -> int:
        return self._log[-1].version

    @property
    def schema(self) -> T.StructType:
        return self._log[-1].schema

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def current(self) -> DataFrame:
        return self.at_version(self.version)

    def create_view(self, name: str, version: int | None = None) -> None:
        """Name a version (the latest by default) for SQL. A later commit needs a new call."""
        snapshot = self.at_version(self.version if version is None else version)
        snapshot.createOrReplaceTempView(name)

    def at_version(self, version: int) -> DataFrame:
        live = self._live(version)
        return live.select(*map(quoted, self._log[version].schema.names))

    def at_timestamp(self, at: datetime) -> DataFrame:
        return self.at_version(self.version_at(at))

    def version_at(self, at: datetime) -> int:
        """The version that was current at ``at`` (no zone: UTC)."""
        us = _micros(at)
        upto = [c.version for c in self._log if c.ts_us <= us]
        if not upto:
            raise VersionNotFound(f"{at} is before the first commit")
        return upto[-1]

    def history(self) -> DataFrame:
        """One row per commit, oldest first when sorted by version."""
        log = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/commits")
        return log.select(
            "version", F.timestamp_micros("ts_us").alias("timestamp"), "operation", "params",
            "rows_added", "rows_removed",
            (F.col("version") >= self._log[-1].readable_from).alias("readable"))

    def has_commit(self, operation: str, **params) -> bool:
        """Whether a commit with these parameters was made."""
        return any(c.operation == operation and all(c.params.get(k) == str(v) for k, v in params.items())
                   for c in self._log)

    def version_range(self) -> DataFrame:
        return self.history().agg(F.min("version").alias("min_version"),
                                  F.max("version").alias("max_version"))

    def detail(self) -> DataFrame:
        """One row: location, files and bytes on disk, live rows, partition columns.

        ``num_removed`` counts the removed addresses a read has to leave out. Beyond the
        broadcast limit (one million) they cost a shuffle; ``optimize(full=True)`` drops them.
        """
        segments = self._chain(self.version)
        live = sum(s.added - s.removed for s in segments)
        folders = [f"{s.root}/data/_seg={s.name}" for s in segments]
        if folders:
            found = layout.file_inventory(self.spark, folders)
        else:
            found = self.spark.createDataFrame([], "path string, length bigint")
        return found.agg(
            F.lit(self.path).alias("location"), F.lit(self.version).alias("version"),
            F.count("*").alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"),
            F.lit(live).cast("bigint").alias("num_rows"),
            F.lit(sum(s.removed for s in segments)).cast("bigint").alias("num_removed"),
            F.lit(len(segments)).alias("num_segments"),
            F.array(*[F.lit(c) for c in self._partition_by]).cast("array<string>").alias("partition_columns"))

    @property
    def _partition_by(self) -> list[str]:
        return self._log[-1].rules["partition_by"]

    def _check_readable(self, version: int) -> None:
        if not 0 <= version <= self.version:
            raise VersionNotFound(f"version {version} is not in 0..{self.version}")
        if version < self._log[-1].readable_from:
            raise VersionExpired(f"version {version} was expired; "
                                 f"{self._log[-1].readable_from} is the oldest left")

    def _chain(self, version: int) -> list[Segment]:
        """Folders that make up a version, newest first."""
        out, at = [], version
        while at >= 0:
            commit = self._log[at]
            if commit.segment:
                out.append(commit.segment)
            out.extend(commit.pinned if commit.since == at else ())
            at = commit.since - 1
        return out

    def _read(self, segments: list[Segment], weight: int, schema: T.StructType) -> DataFrame:
        """Rows of one kind from many folders; folders of a clone's parent keep their root."""
        shape = T.StructType(list(schema) + _STORED + _FOLDERS)
        cols = [*map(quoted, schema.names), *_ADDRESS]
        out = None
        for root in dict.fromkeys(s.root for s in segments):
            paths = [f"{root}/data/_seg={s.name}/_w={weight}" for s in segments if s.root == root]
            part = (self.spark.read.schema(shape).option("basePath", f"{root}/data")
                    .parquet(*paths).select(*cols))
            out = part if out is None else out.unionByName(part)
        return out if out is not None else self.spark.createDataFrame([], T.StructType(list(schema) + _STORED))

    def _removed(self, segments: list[Segment]) -> DataFrame:
        """Removed addresses, broadcast when the recorded counts show they are few."""
        dead = self._read([s for s in segments if s.removed], -1, T.StructType([]))
        return F.broadcast(dead) if sum(s.removed for s in segments) <= BROADCAST_ROWS else dead

    def _less_removed(self, added: list[Segment], removed: list[Segment], schema) -> DataFrame:
        removed = [s for s in removed if s.removed]
        if not removed:
            return self._read(added, 1, schema)
        floor = min(s.removed_from for s in removed)
        calm = [s for s in added if s.hi < floor]
        hit = [s for s in added if s.hi >= floor]
        if not hit:
            return self._read(calm, 1, schema)
        live = self._read(hit, 1, schema).join(self._removed(removed), _ADDRESS, "left_anti")
        return self._read(calm, 1, schema).unionByName(live) if calm else live

    def _live(self, version: int) -> DataFrame:
        """Rows of a version with their addresses."""
        self._check_readable(version)
        segments = self._chain(version)
        return self._less_removed([s for s in segments if s.added], segments,
                                  self._log[version].schema)

    # ------------------------------------------------------------------ committing

    def _commit(self, operation, params, schema, rules, segment, at, *, since=None, pinned=(),
                readable_from=None, seq=None, metrics=None, replaces=False) -> int:
        self._check_names(schema, rules)
        last = self._log[-1] if self._log else None
        version = last.version + 1 if last else 0
        ts = _micros(at or _now())
        if last and ts <= last.ts_us:
            if at is not None:
                raise ValueError("commit times must go forward")
            ts = last.ts_us + 1
        counts = metrics or (segment.added if segment else 0, segment.removed if segment else 0)
        commit = Commit(
            version, ts, operation, {k: str(v) for k, v in params.items()}, counts[0], counts[1],
            schema.json(), rules, self._next_seq() if seq is None else seq,
            version if since is None else since, replaces, segment, tuple(pinned),
            readable_from if readable_from is not None else (last.readable_from if last else 0))
        if not write_new_file(self.spark, f"{self.path}/commits/{version:012d}.json", commit.to_json()):
            raise CommitConflict(f"version {version} was taken by another writer")
        self._log.append(commit)
        return version

    def _next_seq(self) -> int:
        return self._log[-1].seq + 1 if self._log else 0

    @staticmethod
    def _check_names(schema: T.StructType, rules: dict) -> None:
        taken = {f.name for f in _STORED + _FOLDERS} & set(by_name(schema))
        if taken:
            raise SchemaMismatch(f"column names {sorted(taken)} are used by the table itself")
        for c in [*rules["partition_by"], *rules["not_null"]]:
            if c not in schema.names:
                raise SchemaMismatch(f"column {c} is not in the table")

    def _run(self, write, observation: Observation) -> dict:
        try:
            write()
        except PySparkException as e:
            text = str(e)
            if "CONSTRAINT_VIOLATED: " in text:
                names = text.split("CONSTRAINT_VIOLATED: ", 1)[1].splitlines()[0]
                raise ConstraintViolation(f"refused, nothing was written: {names}") from e
            raise
        return observation.get

    def _write(self, changes: DataFrame, schema, rules, only_added: bool, lo: int | None = None,
               keep_address: bool = False, spread: bool = True) -> Segment | None:
        """Write change rows to a new folder and describe it; counts come from the write itself."""
        self._check_names(schema, rules)
        seq = self._next_seq()
        parts = rules["partition_by"]
        changes = layout.refuse_empty_text(changes, parts)
        if parts and spread:
            # gathers each partition value into few files and splits the hot ones
            changes = changes.hint("rebalance", *map(quoted, parts))
        added = F.col("_w") == 1
        fresh = F.lit(False) if keep_address else added
        rows = changes.select(
            *[F.col(quoted(c)) for c in schema.names], "_w",
            guarded(F.when(fresh, F.lit(seq)).otherwise(F.col("_src")), rules["checks"],
                    rules["not_null"], rules["null_passes"], only_if=added).cast("int").alias("_src"),
            F.when(fresh, F.monotonically_increasing_id()).otherwise(F.col("_rid"))
            .cast("bigint").alias("_rid"))
        seen = Observation()
        rows = rows.observe(
            seen, F.count(F.when(added, 1)).alias("added"), F.count(F.when(~added, 1)).alias("removed"),
            F.min(F.when(~added, F.col("_src"))).alias("removed_from"))
        name = f"{seq}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.path}/data/_seg={name}"
        if only_added:
            writer = rows.drop("_w").write.partitionBy(*parts)
            folder += "/_w=1"
        else:
            writer = rows.write.partitionBy("_w", *parts)
        got = self._run(lambda: writer.parquet(folder), seen)
        if not got["added"] and not got["removed"]:
            return None
        return Segment(self.path, name, seq if lo is None else lo, seq, got["added"],
                       got["removed"], got["removed_from"])

    def _append(self, operation, params, rows, schema, rules, at, *, replaces=False) -> int:
        """Commit new rows, next to those there are or (``replaces``) in their place.

        Replacing writes no removed addresses: the new folder alone makes up the version.
        """
        check_assignable(rows.schema, schema)
        changes = align(rows, schema).select(
            "*", F.lit(1).alias("_w"), F.lit(None).cast("int").alias("_src"),
            F.lit(None).cast("bigint").alias("_rid"))
        lo = self._log[0].seq if replaces else None
        segment = self._write(changes, schema, rules, only_added=True, lo=lo)
        if not replaces:
            return self._commit(operation, params, schema, rules, segment, at)
        gone = sum(s.added - s.removed for s in self._chain(self.version))
        return self._commit(operation, params, schema, rules, segment, at, since=0, replaces=True,
                            metrics=(segment.added if segment else 0, gone))

    def _change(self, operation, params, changes, at, schema=None) -> int:
        schema, rules = schema or self.schema, self._log[-1].rules
        segment = self._write(changes, schema, rules, only_added=False)
        return self._commit(operation, params, schema, rules, segment, at)

    # ------------------------------------------------------------------ statements

    def append(self, rows: DataFrame, *, evolve: bool = False, at: datetime | None = None) -> int:
        """INSERT by column name. ``evolve`` lets new columns in; old rows read NULL there."""
        schema = self.schema
        if evolve:
            schema = evolved(schema, rows.schema)
            self._refuse_retyped(schema)
        return self._append("WRITE", {"mode": "Append"}, rows, schema, self._log[-1].rules, at)

    def _refuse_retyped(self, schema: T.StructType) -> None:
        """A column dropped by a restore may come back, but only with its old type."""
        for commit in self._log:
            for old in commit.schema:
                new = schema[old.name] if old.name in schema.names else None
                if new is not None and new.dataType != old.dataType:
                    raise SchemaMismatch(f"column {old.name} was {old.dataType.simpleString()} before")

    def overwrite(self, rows: DataFrame, *, at: datetime | None = None) -> int:
        """Replace all rows in one commit. Old versions stay readable."""
        return self._append("WRITE", {"mode": "Overwrite"}, rows, self.schema, self._log[-1].rules, at,
                            replaces=True)

    def _replace(self, rows: DataFrame, new_values: list[Column]) -> DataFrame:
        """Change rows that remove each address in ``rows`` and add its new values."""
        out = rows.select("*", F.explode(F.array(F.lit(-1), F.lit(1))).alias("_w"))
        cols = [F.when(F.col("_w") == 1, v).cast(f.dataType).alias(f.name)
                for v, f in zip(new_values, self.schema)]
        return out.select(*cols, "_w", *_ADDRESS)

    def update(self, predicate: Column | str, assign: dict, *, at: datetime | None = None) -> int:
        unknown = set(assign) - set(self.columns)
        if unknown:
            raise ValueError(f"no such column: {sorted(unknown)}")
        # the bare predicate reaches the scan; a filter drops NULL by itself
        rows = self._live(self.version).filter(condition(predicate))
        values = [value(assign[c]) if c in assign else F.col(quoted(c)) for c in self.columns]
        return self._change("UPDATE", {"predicate": predicate}, self._replace(rows, values), at)

    def delete(self, predicate: Column | str, *, at: datetime | None = None) -> int:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        gone = self._live(self.version).filter(condition(predicate)).select(
            *nothing, F.lit(-1).alias("_w"), *_ADDRESS)
        return self._change("DELETE", {"predicate": predicate}, gone, at)

    def merge(self, source: DataFrame, on: str | Sequence[str], matched_when: str | None = None, *,
              order: str | Sequence[str] | None = None, evolve: bool = False, stage: bool = True,
              params: dict | None = None, at: datetime | None = None) -> int:
        """Upsert by column name. Reads only keys, addresses and condition columns of the table.

        With ``order`` the source may hold several changes of a key: the greatest counts.

        The source is used several times, so it is first written below the table and read
        back (``stage``): it is computed once, and every step sees the same rows. Pass
        ``stage=False`` for a plain scan of files that do not change meanwhile.

        Source columns the table lacks can be used in ``matched_when`` and are ignored
        otherwise. With ``evolve`` the source may bring new columns and may lack some of the table's;
        those keep their value in updated rows and are NULL in inserted ones.
        """
        schema = self.schema
        if order is not None:
            source = merge.newest_per_key(source, on, order)
        if evolve:
            schema = evolved(schema, source.schema)
            self._refuse_retyped(schema)
        known = by_name(schema)
        more = [] if matched_when is None else [c for c in source.columns if c.lower() not in known]
        whole = source
        source = source.select(*[quoted(c) for c in source.columns if c.lower() in known])
        check_assignable(source.schema, schema)
        given = by_name(source.schema)
        missing = {c for c in schema.names if c.lower() not in given}
        if missing and not evolve:
            raise SchemaMismatch(f"the merge source lacks {sorted(missing)}")
        source = align(whole.select(*[quoted(c) for c in source.columns], *map(quoted, more)), T.StructType(
            [*schema, *(whole.schema[c] for c in more)]))
        folder, matched = (f"{self.path}/staging/{uuid.uuid4().hex}" for _ in range(2))
        if stage:
            source.write.parquet(folder)
            source = self.spark.read.schema(source.schema).parquet(folder)
        try:
            live = self._live(self.version)
            src = merge.checked_source(live, source, on)
            if src.size.broadcastable:
                changes = self._merge_changes(live, src, matched_when, schema, missing)
            else:
                changes = self._large_merge_changes(live, src, matched_when, schema, missing, matched)
            info = {"on": src.on, "matched_when": matched_when, **(params or {})}
            return self._change("MERGE", info, changes, at, schema)
        finally:
            for made in ([folder] if stage else []) + [matched]:
                p, fs = hadoop_path(self.spark, made)
                fs.delete(p, True)

    def _large_merge_changes(self, live: DataFrame, src: merge.Source, matched_when: str | None,
                             schema: T.StructType, missing: set[str], folder: str) -> DataFrame:
        """As :meth:`_merge_changes`, with one pass over the table: the matched addresses are written out first."""
        kept = [c for c in schema.names if c in missing]
        found = merge.matched_addresses(live, src, matched_when, [*_ADDRESS, *(c for c in kept if c not in src.on)])
        found.write.parquet(folder)
        found = self.spark.read.schema(found.schema).parquet(folder)
        pairs = found.filter("_hit").alias("t").join(src.rows.alias("s"), merge._same_key(src.on), "inner").select(
            *[F.col(f"t.{quoted(c)}" if c in missing else f"s.{quoted(c)}").alias(c) for c in schema.names],
            F.col("t._src").alias("_src"), F.col("t._rid").alias("_rid"))
        fresh = merge.unmatched(found.select(*map(quoted, src.on)), src)
        return self._changed_and_fresh(pairs, fresh, schema)

    @classmethod
    def _merge_changes(cls, live: DataFrame, src: merge.Source, matched_when: str | None,
                       schema: T.StructType, missing: set[str]) -> DataFrame:
        pairs = merge.matched_pairs(live, src, matched_when).select(
            *[F.col(f"t.{quoted(c)}" if c in missing else f"s.{quoted(c)}").alias(c) for c in schema.names],
            F.col("t._src").alias("_src"), F.col("t._rid").alias("_rid"))
        return cls._changed_and_fresh(pairs, merge.unmatched(live, src), schema)

    @staticmethod
    def _changed_and_fresh(pairs: DataFrame, fresh: DataFrame, schema: T.StructType) -> DataFrame:
        out = pairs.select("*", F.explode(F.array(F.lit(-1), F.lit(1))).alias("_w"))
        changed = out.select(
            *[F.when(F.col("_w") == 1, F.col(quoted(c))).alias(c) for c in schema.names], "_w", *_ADDRESS)
        fresh = fresh.select(
            *map(quoted, schema.names), F.lit(1).alias("_w"), F.lit(None).cast("int").alias("_src"),
            F.lit(None).cast("bigint").alias("_rid"))
        return changed.unionByName(fresh)

    # ------------------------------------------------------------------ versions against each other

    def _moved(self, older: int, newer: int) -> tuple[DataFrame, DataFrame]:
        """(rows added after ``older`` and live at ``newer``, rows of ``older`` gone by ``newer``).

        Reads only what was committed in between plus the rows those commits removed.
        """
        self._check_readable(older)
        self._check_readable(newer)
        if self._replaced(older, newer):
            return self._live(newer), self._live(older)
        floor = self._log[older].seq
        chain = self._chain(newer)
        recent = [s for s in chain if s.added and s.hi > floor]
        came = self._less_removed(recent, chain, self._log[newer].schema).filter(F.col("_src") > floor)
        steps = [c.segment for c in self._log[older + 1:newer + 1]
                 if c.segment and c.since == c.version and c.segment.removed]
        if not steps:
            return came, self._live(older).limit(0)
        # folders older than any address removed since hold none of the rows asked for
        low = min(s.removed_from for s in steps)
        before = self._chain(older)
        was = self._less_removed([s for s in before if s.added and s.hi >= low], before,
                                 self._log[older].schema)
        return came, was.join(self._removed(steps), _ADDRESS, "left_semi")

    def changed_rows(self, older: int, newer: int) -> tuple[DataFrame, DataFrame]:
        """(rows that came, rows that went) between two versions, as bags; reads only what changed.

        A row that was updated went with its old values and came with its new ones.
        """
        if older > newer:
            return self.changed_rows(newer, older)[::-1]
        came, went = self._moved(older, newer)
        return (came.select(*map(quoted, self._log[newer].schema.names)),
                went.select(*map(quoted, self._log[older].schema.names)))

    def _replaced(self, older: int, newer: int) -> bool:
        return any(c.replaces for c in self._log[older + 1:newer + 1])

    def diff(self, older: int, newer: int, *, bag: bool = False) -> tuple[DataFrame, DataFrame]:
        """(rows in ``newer`` but not in ``older``, the reverse), as sets unless ``bag``.

        Rows that both versions share by address cancel out and are never shuffled. As
        bags that is all, so only the changes are read. As sets each changed row is also
        looked up in the other version, which is scanned once.
        """
        if older > newer:
            return self.diff(newer, older, bag=bag)[::-1]
        old_cols, new_cols = self._log[older].schema.names, self._log[newer].schema.names
        if old_cols != new_cols:
            raise SchemaMismatch(f"versions {older} and {newer} have different columns")
        came, went = (d.select(*map(quoted, new_cols)) for d in self._moved(older, newer))
        if bag:
            return bag_minus(came, went), bag_minus(went, came)
        steps = self._log[older + 1:newer + 1]
        n_came = sum(c.rows_added for c in steps)
        n_went = sum(c.rows_removed for c in steps)
        return (self._not_in(came, self.at_version(older), n_came),
                self._not_in(went, self.at_version(newer), n_went))

    def _not_in(self, rows: DataFrame, whole: DataFrame, at_most: int) -> DataFrame:
        """Distinct ``rows`` that the ``whole`` version does not hold elsewhere.

        Only equal hashes can be equal rows. Few candidates are broadcast as hashes, past
        which the version streams. Many candidates meet the version's bare hashes in a
        shuffle; the hashes found on both sides are written out and, being few unless rows
        really repeat, take the place of the candidates. Hashes only narrow the search:
        rows are told apart by all their columns.
        """
        names = [*map(quoted, rows.columns)]
        rows, whole = (d.withColumn("_h", F.xxhash64(*names)) for d in (rows, whole))
        suspects, few = rows.select("_h"), at_most <= BROADCAST_ROWS
        if not few:
            folder = f"{scratch_dir(self.spark, 'diff')}/suspects"
            common = suspects.distinct().join(whole.select("_h").distinct(), "_h", "left_semi")
            seen = Observation()
            common.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(folder)
            suspects, few = self.spark.read.parquet(folder), seen.get["n"] <= BROADCAST_ROWS
        if not few:
            return set_minus(rows.select(*names), whole.select(*names))
        equals = whole.join(F.broadcast(suspects), "_h", "left_semi").select(*names)
        if at_most <= BROADCAST_ROWS:
            return set_minus(rows.select(*names), equals)
        fresh = rows.join(F.broadcast(suspects), "_h", "left_anti").select(*names).distinct()
        doubtful = rows.join(F.broadcast(suspects), "_h", "left_semi").select(*names)
        return fresh.unionByName(set_minus(doubtful, equals))

    def restore(self, version: int, *, at: datetime | None = None) -> int:
        """A new version with the rows and columns of an old one. Moves only the difference."""
        self._check_readable(version)
        schema = self._log[version].schema
        if self._replaced(version, self.version):
            return self._append("RESTORE", {"version": version}, self.at_version(version), schema,
                                self._log[-1].rules, at, replaces=True)
        came, went = self._moved(version, self.version)
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        changes = came.select(*nothing, F.lit(-1).alias("_w"), *_ADDRESS).unionByName(
            went.select(*map(quoted, schema.names), F.lit(1).alias("_w"), *_ADDRESS))
        return self._change("RESTORE", {"version": version}, changes, at, schema)

    # ------------------------------------------------------------------ copies

    def clone_shallow(self, path: str, version: int | None = None, *,
                      at: datetime | None = None) -> ChangeTable:
        """A new table that starts as a version of this one and reads its files in place.

        Expiring the parent can take those files away; the clone then stops working.
        """
        version = self.version if version is None else version
        self._check_readable(version)
        commit = self._log[version]
        clone = self._blank(self.spark, path)
        chain = self._chain(version)
        clone._commit("CLONE", {"source": self.path, "version": version, "shallow": True},
                      commit.schema, commit.rules, None, at, pinned=chain, seq=commit.seq + 1)
        return clone

    def clone_deep(self, path: str, version: int | None = None, *,
                   at: datetime | None = None) -> ChangeTable:
        """A new table with its own copy of the rows, partitioned and constrained alike."""
        version = self.version if version is None else version
        commit = self._log[version]
        clone = self._blank(self.spark, path)
        clone._append("CLONE", {"source": self.path, "version": version, "shallow": False},
                      self.at_version(version), commit.schema, commit.rules, at)
        return clone

    def backup(self, path: str, version: int, *, at: datetime | None = None) -> ChangeTable:
        """A frozen copy of an old version as a plain new table, without the rules."""
        return self.create(self.spark, path, self.at_version(version), at=at)

    # ------------------------------------------------------------------ upkeep

    def optimize(self, *, zorder_by: Sequence[str] = (), full: bool = False,
                 target_bytes: int = layout.TARGET_FILE_BYTES, at: datetime | None = None) -> int:
        """Fold small folders into one with larger files; same rows, same addresses.

        Folds all folders down to the oldest whose files are small on average, so a big base
        of large files is not rewritten for a few small appends, and one of small files is.
        ``full`` and ``zorder_by`` rewrite everything. Clustering stays within partitions.
        """
        chain = self._chain(self.version)
        sizes = layout.data_files(self.spark, [f"{s.root}/data/_seg={s.name}" for s in chain]) if chain else []
        take, since = self._foldable(dict(zip((s.name for s in chain), sizes)), target_bytes, bool(full or zorder_by))
        # a clustering sorts what it writes: its files are no larger than what a task sorts
        sorted_bytes = min(target_bytes, layout.SORT_BYTES)
        clustered = bool(zorder_by) or self._clustered(take)
        files = max(1, -(-sum(size for size, *_ in sizes[:len(take)]) // (sorted_bytes if clustered else target_bytes)))
        tidy = len(take) == 1 and not take[0].removed and sizes[0][1] <= 2 * files + (sizes[0][2] if self._partition_by else 0)
        if not take or (tidy and not zorder_by):
            return self._commit("OPTIMIZE", {"folded": 0}, self.schema, self._log[-1].rules, None, at)
        lo = min(s.lo for s in take)
        rows = self._less_removed([s for s in take if s.added], take, self.schema).withColumn(
            "_w", F.lit(1))
        older = [s for s in take if s.removed and s.removed_from < lo]
        if older:
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            rows = rows.unionByName(
                self._read(older, -1, T.StructType([])).filter(F.col("_src") < lo)
                .select(*nothing, *_ADDRESS, F.lit(-1).alias("_w")))
        if zorder_by:
            # the address breaks ties, so a value held by a third of the rows is still split
            rows = layout.cluster(rows, list(zorder_by), files, tie=_ADDRESS, within=self._partition_by)
        elif not self._partition_by:
            # removed addresses past the broadcast limit are joined by a sort: under ``coalesce`` the few
            # tasks that write files would each sort all they write, join partition by join partition
            many = sum(s.removed for s in take) > BROADCAST_ROWS
            rows = rows.repartition(files, *_ADDRESS) if many else rows.coalesce(files)
        # the rows were checked when they came in
        layout_only = {**self._log[-1].rules, "checks": {}, "not_null": []}
        segment = self._write(rows, self.schema, layout_only, only_added=not older, lo=lo,
                              keep_address=True, spread=not zorder_by)
        params = {"folded": len(take), "of": len(chain), "zorder_by": list(zorder_by)}
        return self._commit("OPTIMIZE", params, self.schema, self._log[-1].rules, segment, at,
                            since=since, metrics=(0, 0))

    def _clustered(self, segments: list[Segment]) -> bool:
        """Whether these are one folder that a clustering wrote."""
        return len(segments) == 1 and any(c.segment == segments[0] and c.params.get("zorder_by", "[]") != "[]" for c in self._log)

    def _foldable(self, sizes: dict, target_bytes: int, everything: bool) -> tuple[list[Segment], int]:
        """Newest folders worth folding, and the first version they cover."""
        take, kept, since, at = [], [], self.version + 1, self.version
        while at >= 0:
            commit = self._log[at]
            segments = ([commit.segment] if commit.segment else []) + list(
                commit.pinned if commit.since == at else ())
            take += segments
            found = [sizes[s.name] for s in segments]
            target = min(target_bytes, layout.SORT_BYTES) if self._clustered(segments) else target_bytes
            if everything or any(2 * size < target * files for size, files, _ in found):
                kept, since = list(take), commit.since
            at = commit.since - 1
        return kept, since

    def expire(self, retain_hours: float = DEFAULT_RETENTION_HOURS, *, force: bool = False,
               fold: bool = True, now: datetime | None = None, at: datetime | None = None) -> int:
        """Give up versions older than the retention time and delete the files only they used.

        Versions current at or after ``now - retain_hours`` stay readable. When that is
        the latest version alone, ``fold`` first rewrites the table without removed rows,
        so that deleted data leaves the disk. Returns the oldest version still readable.
        """
        if retain_hours < DEFAULT_RETENTION_HOURS and not force:
            raise RetentionTooShort(f"{retain_hours} h is below {DEFAULT_RETENTION_HOURS} h")
        cut = _micros(now or _now()) - int(retain_hours * 3600 * 1_000_000)
        keep = max([c.version for c in self._log if c.ts_us <= cut],
                   default=self._log[-1].readable_from)
        keep = max(keep, self._log[-1].readable_from)
        if fold and keep == self.version and len(self._chain(keep)) + sum(
                s.removed for s in self._chain(keep)) > 1:
            keep = self.optimize(full=True, at=at)
            at = at and at + timedelta(microseconds=1)
        self._commit("EXPIRE", {"retain_hours": retain_hours}, self.schema, self._log[-1].rules,
                     None, at, readable_from=keep)
        self._purge(keep, cut)
        return keep

    def _purge(self, keep: int, cut_us: int) -> None:
        """Delete folders no readable version uses, and leftovers of failed writes from before the cut."""
        needed, walked, ahead = set(), set(), list(range(keep, self.version + 1))
        while ahead:        # each commit once, however many versions are built on it
            commit = self._log[ahead.pop()]
            if commit.version not in walked:
                walked.add(commit.version)
                needed |= {s.name for s in [commit.segment, *commit.pinned] if s}
                ahead += [commit.since - 1] if commit.since else []
        known = {c.segment.name for c in self._log if c.segment}
        for folder in ("data", "staging"):
            p, fs = hadoop_path(self.spark, f"{self.path}/{folder}")
            for status in fs.listStatus(p) if fs.exists(p) else ():
                name = status.getPath().getName().removeprefix("_seg=")
                stale = name in known or status.getModificationTime() * 1000 < cut_us
                if name not in needed and stale:
                    fs.delete(status.getPath(), True)


def replace_nullable(field: T.StructField) -> T.StructField:
    """Columns of a created table are nullable; NOT NULL is a rule of its own."""
    return T.StructField(field.name, field.dataType, True)
