"""Lake tables: Parquet files plus a log of numbered commits.

Data of a commit lie in ``<table>/data/commit_id=<token>/branch_id=B/``, rows ordered by key hash where the table has one, so a file covers a short range of hashes. The log,
``<table>/_log/``, has one entry per commit, whose rows are actions: the commit itself, what it added per branch, files added (with rows, bytes, range of hashes and their schema) and files removed. A
snapshot is what the entries up to its number leave, so a merge adds and removes the files that it rewrites and no others, and older snapshots stay readable. A read casts files of older
schemas to the unified one.

Many small files: entries go to and from the driver's Python in slices, and its JVM never holds one whole. New files are looked through a few branches at a time, folders whose files are all read go to Spark as folders, and
a merge and what is told of it open only files whose ranges hold a hash of the delta.

Several writers: an entry is written whole and then put under the next number only if that is free. Who comes second looks whether the branches that it has read are as they were; if so it takes the next
number, else it starts again. From time to time, and when snapshots expire, the actions so far go into a checkpoint; a pointer is switched to it in one step, and entries up to its number count no more. Entries
and checkpoints that a pointer before last referred to are deleted then, so a reader that has just read the last pointer still finds its files. Pointers are numbered and put like entries, so of two checkpoints made at the same time one is made anew. The folder must be one whose renames are atomic (HDFS, a shared disk).
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce
from itertools import chain
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlake.defs import HASH
from branchlake.functions.schema import cast_to, fill_void, normalize_columns, unify_schemas
from branchlake.operators.merge import carry_forward, check_unique, cluster_by_hash, keyed_join, merge_impact, merge_keys, merge_upsert
from branchlake.sources.files import Files

#: one row an action; ``kind``: commit, branch (rows that a commit added to it), add and remove (files), run (of an expired commit)
ACTIONS = (
    "commit_id bigint, kind string, committed_at timestamp_ntz, operation string, run_id string, branch_id bigint, added_records bigint, total_records bigint, "
    "path string, bytes bigint, low string, high string, schema string, siblings bigint"
)
_FIELDS = [c.split()[0] for c in ACTIONS.split(", ")]
_AT = "%Y-%m-%dT%H:%M:%S.%f"
#: files whose ranges and rows one job reads after a write
LISTED = 20_000
PROTECTED = frozenset({"etl_control", "etl_run_log", "etl_dq_results", "control_state"})


class CommitConflict(RuntimeError):
    """Other writers changed the same branches again and again."""


class Swept(NamedTuple):
    files: int
    bytes: int
    failed: list[tuple[str, str]]


class Added:
    """An action that adds a file, in a tenth of a dict's room. ``siblings``: files that its commit put into the same folder, itself included; entries of older logs don't tell."""

    __slots__ = ("added_records", "branch_id", "bytes", "commit_id", "high", "low", "path", "schema", "siblings")
    kind = "add"

    def __init__(self, row: dict):
        for c in self.__slots__:
            setattr(self, c, row.get(c))

    def __getitem__(self, name: str):
        return getattr(self, name)

    def get(self, name: str):
        return getattr(self, name, None)

    def keys(self) -> tuple[str, ...]:
        return self.__slots__

    @property
    def folder(self) -> str:
        return self.path.rsplit("/", 1)[0]


@dataclass
class State:
    """A snapshot: its number (0: none yet), its live files as actions, and the schema of its last commit."""

    version: int
    files: list[Added]
    schema: str | None


@dataclass
class Change:
    """What a commit does. ``read``: branches whose files must still be the ones it has seen; ``replaces``: all files live at the time of the commit go."""

    adds: list[Added]
    schema: str
    added: dict
    removes: list[str] = field(default_factory=list)
    read: set | None = None
    replaces: bool = False


class Lake(Files):
    def __init__(self, spark: SparkSession, root: str, file_rows: int = 2_000_000, tries: int = 20, checkpoint_every: int = 20):
        """``file_rows``: most rows of a file; ``tries``: attempts of a merge that others keep overtaking; ``checkpoint_every``: entries after which the log is gathered."""
        super().__init__(spark)
        self.root, self.file_rows, self.tries, self.checkpoint_every = root.rstrip("/"), file_rows, tries, checkpoint_every

    def has(self, table: str) -> bool:
        return self.exists(f"{self.root}/{table}/_log")

    def tables(self) -> list[str]:
        return sorted(t for t in self._names(self.root) if self.has(t))

    # ---- commit log
    def _pointer(self, table: str) -> dict:
        """The last pointer: where the log's checkpoint lies (``path``) and which number it covers (``version``)."""
        folder = f"{self.root}/{table}/_log"
        for _ in range(self.tries):
            last = max((n for n in self._names(folder) if n.startswith("pointer-")), default=None)
            text = self._text(f"{folder}/{last}") if last else '{"n": 0, "version": 0, "before": 0}'
            if text is not None:
                return json.loads(text)
        raise CommitConflict(f"the pointer of {table} moves faster than it can be read")

    def _entries(self, table: str) -> list[int]:
        return sorted(int(n[:20]) for n in self._names(f"{self.root}/{table}/_log") if n.endswith(".json") and n[:20].isdigit())

    def _log(self, table: str) -> tuple[dict, list[dict | Added]]:
        """The pointer, and the actions of the entries after it, which are few."""
        folder = f"{self.root}/{table}/_log"
        for _ in range(self.tries):
            pointer = self._pointer(table)
            found = [self._read_entry(f"{folder}/{n:020d}.json") for n in self._entries(table) if n > pointer["version"]]
            if None not in found and pointer == self._pointer(table):
                return pointer, [r for rows in found for r in rows]
        raise CommitConflict(f"the log of {table} is truncated faster than it can be read")

    def _read_entry(self, path: str) -> list[dict | Added] | None:
        """An entry's actions, or None if it has gone. A file without a schema has the commit's, which comes first."""
        lines = self._lines(path)
        if lines is None:
            return None
        rows: list[dict | Added] = []
        for line in lines:
            row = json.loads(line)
            if row["kind"] == "add":
                rows.append(Added({"schema": rows[0]["schema"], **{c: v for c, v in row.items() if v is not None}}))
            else:
                rows.append({c: row.get(c) for c in _FIELDS})
        return rows

    def actions(self, table: str, *kinds: str) -> DataFrame:
        """All actions that the log still has, or those of some kinds."""
        pointer, rows = self._log(table)
        rows = [r for r in rows if not kinds or r["kind"] in kinds]
        new = self.spark.createDataFrame([tuple(datetime.strptime(r[c], _AT) if c == "committed_at" and r.get(c) else r.get(c) for c in _FIELDS) for r in rows], ACTIONS)
        out = self._gathered(table, pointer).unionByName(new) if pointer["version"] else new
        return out.where(F.col("kind").isin(*kinds)) if kinds else out

    def _gathered(self, table: str, pointer: dict) -> DataFrame:
        return self.spark.read.schema(ACTIONS).parquet(f"{self.root}/{table}/_log/{pointer['path']}")

    def commits(self, table: str) -> DataFrame:
        """(commit_id, committed_at, operation, run_id, branch_id, added_records, total_records): a row per commit, with the table's rows after it, and one per branch that it added to."""
        return self.actions(table, "commit", "branch").select("commit_id", "committed_at", "operation", "run_id", "branch_id", "added_records", "total_records")

    def snapshots(self, table: str) -> DataFrame:
        """One row per snapshot, newest first, with the current flag."""
        per = self.commits(table).groupBy("commit_id").agg(
            F.max("committed_at").alias("committed_at"), F.max("operation").alias("operation"), F.max("run_id").alias("run_id"),
            F.coalesce(F.sum("added_records"), F.lit(0)).alias("added_records"), F.max("total_records").alias("total_records"),
        )
        latest = per.agg(F.max("commit_id").alias("latest"))
        return per.join(F.broadcast(latest)).select(*per.columns, (F.col("commit_id") == F.col("latest")).alias("is_current")).orderBy(F.desc("commit_id"))

    def _state(self, table: str, snapshot: int | None = None) -> State:
        pointer, rows = self._log(table)
        found: list[dict | Added] = []
        if pointer["version"]:
            old = self._gathered(table, pointer).where("kind IN ('commit', 'add', 'remove')")
            old = old if snapshot is None else old.where(F.col("commit_id") <= snapshot)
            live = old.where("kind = 'add'").join(old.where("kind = 'remove'").select("path"), "path", "left_anti").unionByName(old.where("kind = 'commit'"))
            schemas: dict[str, str] = {}
            for r in live.collect():  # one row a live file or snapshot
                row = r.asDict()
                row["schema"] = schemas.setdefault(row["schema"], row["schema"])  # one text for all of a schema's files
                found.append(Added(row) if row["kind"] == "add" else row)
        found += [r for r in rows if snapshot is None or r["commit_id"] <= snapshot]
        heads = {r["commit_id"]: r["schema"] for r in found if r["kind"] == "commit"}
        if not heads or snapshot is not None and snapshot not in heads:
            return State(0 if snapshot is not None else max([pointer["version"], *heads]), [], None)
        gone = {r["path"] for r in found if r["kind"] == "remove"}
        files = sorted((r for r in found if r["kind"] == "add" and r["path"] not in gone), key=lambda r: (r["commit_id"], r["path"]))
        return State(max(heads), files, heads[max(heads)])

    def files(self, table: str, snapshot_id: int | None = None) -> DataFrame:
        """The live files of a snapshot: (path, branch_id, records, bytes, low, high, commit_id), the last being the commit that wrote them."""
        rows = [(r["path"], r["branch_id"], r["added_records"], r["bytes"], r["low"], r["high"], r["commit_id"]) for r in self._state(table, snapshot_id).files]
        return self.spark.createDataFrame(rows, "path string, branch_id bigint, records bigint, bytes bigint, low string, high string, commit_id bigint")

    def _commit(self, table: str, operation: str, run_id: str, at: datetime | None, make: Callable[[State], Change]) -> int:
        for _ in range(self.tries):
            state = self._state(table)
            change = make(state)
            while True:
                number = state.version + 1
                if self._put(f"{self.root}/{table}/_log/{number:020d}.json", self._entry(number, operation, run_id, at or datetime.now(), state, change)):
                    if self._pointer(table)["version"] < number:
                        self._gather_sometimes(table)
                        return number
                    self.delete(f"{self.root}/{table}/_log/{number:020d}.json")  # the log was gathered beyond this number meanwhile
                newer = self._state(table)
                if change.read is not None and _seen(newer, change.read) != _seen(state, change.read):
                    for folder in {f.path.rsplit("/", 2)[0] for f in change.adds}:
                        self.delete(f"{self.root}/{table}/{folder}")
                    break
                state = newer
        raise CommitConflict(f"{operation} of {table} was overtaken {self.tries} times")

    def _entry(self, number: int, operation: str, run_id: str, at: datetime, state: State, change: Change) -> Iterator[str]:
        """The lines, one action each and the commit's first; a file's schema is told if it is not the commit's."""
        head = {"commit_id": number, "committed_at": at.strftime(_AT), "operation": operation, "run_id": run_id}
        gone = {f["path"] for f in state.files} if change.replaces else set(change.removes)
        total = sum(f["added_records"] for f in state.files if f["path"] not in gone) + sum(f["added_records"] for f in change.adds)
        rows = [head | {"kind": "commit", "total_records": total, "schema": change.schema}]
        rows += [head | {"kind": "branch", "branch_id": b, "added_records": n} for b, n in change.added.items()]
        adds = ({**f, "commit_id": number, "kind": "add", "schema": None if f["schema"] == change.schema else f["schema"]} for f in change.adds)
        removes = ({"commit_id": number, "kind": "remove", "branch_id": f["branch_id"], "path": f["path"]} for f in state.files if f["path"] in gone)
        for r in chain(rows, adds, removes):
            yield json.dumps({c: r[c] for c in _FIELDS if r.get(c) is not None}) + "\n"

    def _gather_sometimes(self, table: str) -> None:
        covered = self._pointer(table)["version"]
        if sum(n > covered for n in self._entries(table)) >= self.checkpoint_every:
            with contextlib.suppress(Exception):  # the commit stands, a later one tries again
                self._gather(table, None)

    def _gather(self, table: str, kept: list[int] | None) -> int:
        """Checkpoint the log: with all snapshots, or those in ``kept`` and the current one; returns how many went.

        Steps: write the checkpoint, put the next pointer if nobody else has, delete what the pointer before last referred to. A crash before the pointer is put changes nothing, one after it leaves files
        that nothing refers to.
        """
        for _ in range(self.tries):
            before = self._pointer(table)
            path, version, went = self._checkpoint(table, kept)
            if self._switch(table, {"n": before["n"] + 1, "version": version, "path": path, "before": before["version"]}):
                self._tidy(table)
                return went
            self.delete(f"{self.root}/{table}/_log/{path}")
        raise CommitConflict(f"the log of {table} was gathered by others {self.tries} times")

    def _checkpoint(self, table: str, kept: list[int] | None) -> tuple[str, int, int]:
        folder = f"{self.root}/{table}/_log"
        version = self._state(table).version
        rows = self.actions(table).where(F.col("commit_id") <= version)  # read after the number, so none up to it is missing
        went = 0
        if kept is not None:
            kept = sorted({*kept, version})
            stays = F.col("commit_id").isin(kept)
            heads = rows.where("kind IN ('commit', 'branch')")
            runs = heads.where(~stays).select("run_id").unionAll(rows.where("kind = 'run'").select("run_id")).distinct()
            went = heads.where(~stays).select("commit_id").distinct().count()
            ends = rows.where("kind = 'remove'").select("path", F.col("commit_id").alias("end"))
            life = rows.where("kind = 'add'").join(ends, "path", "left")
            snapshots = F.array(*[F.lit(k).cast("bigint") for k in kept])
            alive = life.where(F.exists(snapshots, lambda s: (s >= F.col("commit_id")) & (F.col("end").isNull() | (s < F.col("end"))))).drop("end")
            ended = rows.where("kind = 'remove'").join(alive.select("path"), "path", "left_semi")
            remembered = runs.select(F.lit(0).cast("bigint").alias("commit_id"), F.lit("run").alias("kind"), "run_id")
            rows = heads.where(stays).unionByName(alive).unionByName(ended).unionByName(remembered, allowMissingColumns=True)
        path = f"checkpoint-{version:020d}-{uuid.uuid4().hex}"
        rows.select(*_FIELDS).coalesce(1).write.parquet(f"{folder}/{path}")
        return path, version, went

    def _switch(self, table: str, pointer: dict) -> bool:
        return self._put(f"{self.root}/{table}/_log/pointer-{pointer['n']:020d}", json.dumps(pointer))

    def _tidy(self, table: str) -> None:
        """Delete the entries that the checkpoint before covers, and checkpoints and pointers older than that."""
        folder, pointer = f"{self.root}/{table}/_log", self._pointer(table)
        for name in self._names(folder):
            old_entry = name.endswith(".json") and name[:20].isdigit() and int(name[:20]) <= pointer["before"]
            old_checkpoint = name.startswith("checkpoint-") and int(name[11:31]) < pointer["before"]
            old_pointer = name.startswith("pointer-") and int(name[8:]) < pointer["n"] - 1
            if old_entry or old_checkpoint or old_pointer:
                self.delete(f"{folder}/{name}")

    # ---- files of a commit
    def _write(self, table: str, df: DataFrame) -> tuple[list[dict], str]:
        """Write the rows, in order of their hashes if they have one; returns the files as actions, and the schema."""
        token = uuid.uuid4().hex
        fresh, schema = f"{self.root}/{table}/data/commit_id={token}", _loose(fill_void(df.schema)).json()
        df = cast_to(df, T.StructType.fromJson(json.loads(schema))) if any(isinstance(f.dataType, T.NullType) for f in df.schema.fields) else df
        rows = cluster_by_hash(df) if HASH in df.columns else df
        rows.write.option("maxRecordsPerFile", self.file_rows).partitionBy("branch_id").parquet(fresh)
        if not any(n.startswith("branch_id=") for n in self._names(fresh)):
            return [], schema
        edge = F.hex(HASH) if HASH in df.columns and isinstance(df.schema[HASH].dataType, T.BinaryType) else F.lit(None).cast("string")
        adds: list[Added] = []
        for folders in self._few(fresh):
            read = self._read_paths(table, [f"data/commit_id={token}/{x}" for x in folders], schema, "__file", "__bytes")
            per = read.groupBy("__file").agg(F.first("branch_id").alias("branch_id"), F.max("__bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min(edge).alias("low"), F.max(edge).alias("high"), F.count_if(edge.isNull()).alias("bare"))
            for r in per.collect():  # one row a file
                known = {"low": r["low"], "high": r["high"]} if not r["bare"] else {}
                adds.append(Added({"branch_id": r["branch_id"], "added_records": r["n"], "path": _inside(r["__file"]), "bytes": r["bytes"], "schema": schema, **known}))
        siblings = Counter(f.folder for f in adds)
        for f in adds:
            f.siblings = siblings[f.folder]
        return sorted(adds, key=lambda f: f["path"]), schema

    def _few(self, commit: str) -> Iterator[list[str]]:
        """A commit's branch folders, together as long as they have ``LISTED`` files at most, because the driver lists all files of a scan."""
        some: list[str] = []
        held = 0
        for name in sorted(n for n in self._names(commit) if n.startswith("branch_id=")):
            files = self._count(f"{commit}/{name}")
            if some and held + files > LISTED:
                yield some
                some, held = [], 0
            some, held = [*some, name], held + files
        yield some

    def _read_paths(self, table: str, paths: list[str], schema: str, file: str | None = None, size: str | None = None) -> DataFrame:
        home = f"{self.root}/{table}"
        df = self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).option("basePath", f"{home}/data").parquet(*[f"{home}/{p}" for p in paths])
        more = [F.col(c).alias(a) for c, a in (("_metadata.file_path", file), ("_metadata.file_size", size)) if a]
        return df.select("*", *more).drop("commit_id").withColumn("branch_id", F.col("branch_id").cast("bigint"))

    def _frame(self, table: str, state: State, chosen: list[Added], located: bool = False) -> DataFrame:
        """The rows of ``chosen`` files under the unified schema of the snapshot; one scan for each schema. ``located``: with each row's file and its size."""
        kinds = list(dict.fromkeys(f["schema"] for f in state.files)) or [state.schema]
        unified = fill_void(unify_schemas([T.StructType.fromJson(json.loads(k)) for k in kinds]))
        if located:
            unified = T.StructType([*unified.fields, T.StructField("__file", T.StringType()), T.StructField("__bytes", T.LongType())])
        extra = ("__file", "__bytes") if located else ()
        parts = [cast_to(self._read_paths(table, paths, k, *extra), unified) for k in kinds if (paths := _paths([f for f in chosen if f["schema"] == k]))]
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], unified)

    # ---- reads
    def read(self, table: str, snapshot_id: int | None = None, branches: list[int | None] | None = None, columns: list[str] | None = None) -> DataFrame:
        """Current or given snapshot; branches prune files, columns prune the scan."""
        state = self._state(table, snapshot_id)
        if state.schema is None:
            raise ValueError(f"no snapshot of {table}")
        df = self._frame(table, state, [f for f in state.files if branches is None or f["branch_id"] in branches])
        return df.select(*columns) if columns else df

    def changed_files(self, table: str, old: int, new: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The rows of either snapshot that lie in files which the other lacks, both under the schema of both. All other rows are the same on both sides, and are not read."""
        a, b = self._state(table, old), self._state(table, new)
        if a.schema is None or b.schema is None:
            raise ValueError(f"no such snapshots of {table}")
        mine, yours = ({f["path"] for f in s.files} for s in (a, b))
        both = State(0, [*a.files, *(f for f in b.files if f["path"] not in mine)], b.schema)
        return self._frame(table, both, [f for f in a.files if f["path"] not in yours]), self._frame(table, both, [f for f in b.files if f["path"] not in mine])

    # ---- writes
    def replace(self, table: str, df: DataFrame, run_id: str = "", at: datetime | None = None) -> int:
        adds, schema = self._write(table, normalize_columns(df))
        return self._commit(table, "replace", run_id, at, lambda _: Change(adds, schema, _per_branch(adds), replaces=True))

    def append(self, table: str, df: DataFrame, run_id: str = "", at: datetime | None = None) -> int:
        adds, schema = self._write(table, normalize_columns(df))
        return self._commit(table, "append", run_id, at, lambda _: Change(adds, schema, _per_branch(adds)))

    def merge(self, table: str, delta: DataFrame, keys: list[str], run_id: str = "", at: datetime | None = None, keep_history: bool = True) -> int:
        """One commit however large the delta is. Only files that hold a key of the delta are rewritten; the delta is written once, checked for repeated keys and counted by branch there.

        Keys may be null in part and are matched as values then, the branch too.
        """
        delta = normalize_columns(delta)
        staged = f"{self.root}/{table}/_staged/{uuid.uuid4().hex}"
        delta.write.parquet(staged)
        delta = self.spark.read.schema(delta.schema).parquet(staged)
        unique: set[tuple] = set()

        def make(state: State) -> Change:
            if state.schema is None:
                check_unique(delta, merge_keys(delta, delta, keys))
                adds, schema = self._write(table, delta)
                return Change(adds, schema, added, read=set(added))
            near = [f for f in state.files if f["branch_id"] in added]
            on = merge_keys(self._frame(table, state, []), delta, keys)
            if tuple(on) not in unique:
                check_unique(delta, on)
                unique.add(tuple(on))
            hit = self._matched(table, state, near, delta, on)
            target, new = self._frame(table, state, hit), delta
            if keep_history and "insert_at" in target.columns and "insert_at" in delta.columns:
                new = carry_forward(delta, target, on)
            adds, schema = self._write(table, merge_upsert(target, new, on))
            return Change(adds, schema, added, [f["path"] for f in hit], set(added))

        try:
            added = {r["branch_id"]: r["count"] for r in delta.groupBy("branch_id").count().collect()}  # one row per branch
            return self._commit(table, "merge", run_id, at, make)
        finally:
            self.delete(staged)

    def _in_range(self, near: list[Added], delta: DataFrame) -> list[Added]:
        """Files whose range holds a hash of the delta; those without a range stay. A file joins by the first bytes of the hashes that it covers, which are few where rows are ordered."""
        bounds = [(f["path"], f["low"], f["high"]) for f in near if f["low"] is not None]
        if not bounds:
            return near
        byte = lambda c: F.conv(F.substring(c, 1, 2), 16, 10).cast("int")
        files = self.spark.createDataFrame(bounds, "path string, low string, high string").withColumn("byte", F.explode(F.sequence(byte("low"), byte("high"))))
        keys = delta.select(F.hex(HASH).alias("h")).withColumn("byte", byte("h"))
        hit = {r["path"] for r in files.join(keys, "byte").where("h BETWEEN low AND high").select("path").distinct().collect()}
        return [f for f in near if f["low"] is None or f["path"] in hit]

    def _matched(self, table: str, state: State, near: list[Added], delta: DataFrame, on: list[str]) -> list[Added]:
        """The files that hold a key of the delta: first by their ranges, then by their key columns."""
        if on == [HASH]:
            near = self._in_range(near, delta)
        if not near:
            return []
        rows = self._frame(table, state, near, located=True).select(*on, "__file")
        hit = {_inside(r["__file"]) for r in keyed_join(rows, delta.select(*on), on, "left_semi").select("__file").distinct().collect()}  # files
        return [f for f in near if f["path"] in hit]

    def impact(self, table: str, delta: DataFrame, keys: list[str]) -> DataFrame:
        """What a merge of this delta would match, change, add and rewrite, without doing it. Files out of the delta's range are counted from the log and not opened."""
        delta, state = normalize_columns(delta), self._state(table)
        on = merge_keys(self._frame(table, state, []), delta, keys)
        near = self._in_range(state.files, delta) if on == [HASH] else state.files
        opened = {f["path"] for f in near}
        far = [f["bytes"] for f in state.files if f["path"] not in opened]
        return merge_impact(self._frame(table, state, near, located=True), delta, on, len(far), sum(far))

    # ---- maintenance
    def drop_table(self, table: str, system: bool = False) -> None:
        if table in PROTECTED and not system:
            raise ValueError(f"{table} is a system table")
        self.delete(f"{self.root}/{table}")

    def drop_all(self, system: bool = False) -> list[str]:
        gone = [t for t in self.tables() if system or t not in PROTECTED]
        for t in gone:
            self.drop_table(t, system)
        return gone

    def seen(self, table: str, run_id: str) -> bool:
        """Whether a run has committed to the table, also if its snapshot has gone since."""
        return self.has(table) and not self.actions(table).where(F.col("kind").isin("commit", "run") & (F.col("run_id") == run_id)).isEmpty()

    def keep_snapshots(self, table: str, kept: DataFrame) -> int:
        """Expire all snapshots but those in ``kept`` (commit_id) and the current one; returns how many went. Their run ids are remembered. Data go with ``sweep``."""
        return self._gather(table, [r["commit_id"] for r in kept.select("commit_id").distinct().collect()])  # one row a snapshot

    def listing(self, table: str) -> DataFrame:
        """(path, bytes, modified) of the data files on disk."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{self.root}/{table}/data")
        return files.select(F.regexp_extract("path", r"(data/commit_id=[^/]+/branch_id=[^/]+/[^/]+)$", 1).alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))

    def sweep(self, table: str, dry_run: bool = False, older_than: timedelta = timedelta(days=1)) -> Swept:
        """Delete data files that no snapshot refers to and that are ``older_than``, which must be longer than a commit takes: data of a commit under way are in no snapshot yet.

        Files go several at a time; one that can't be deleted is told and ends nothing. The log is never touched.
        """
        if not self.exists(f"{self.root}/{table}/data"):
            return Swept(0, 0, [])
        # Spark lists the folder here, before the log is read: what is committed in between is referred to
        listing = self.listing(table).where(F.col("modified") <= F.current_timestamp() - older_than)
        gone = orphan_files(listing, self.actions(table, "add").select("path"))
        if dry_run:
            total = gone.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()
            return Swept(total["n"], total["b"], [])

        def one(r) -> tuple[str, int, str | None]:
            try:
                return r["path"], r["bytes"], None if self.delete(f"{self.root}/{table}/{r['path']}") else "not deleted"
            except Exception as e:  # one file must not end the others
                return r["path"], 0, str(e)[:300]

        with ThreadPoolExecutor(8) as pool:
            done = list(pool.map(one, gone.toLocalIterator()))
        return Swept(sum(e is None for _, _, e in done), sum(b for _, b, e in done if e is None), [(p, e) for p, _, e in done if e is not None])

    # ---- exploration
    def list_tables(self, categories: DataFrame | None = None) -> DataFrame:
        """Rows, files, bytes, snapshots and last commit of each table, data tables first."""
        rows = []
        for t in self.tables():
            files, head = self._state(t).files, self.snapshots(t).agg(F.count(F.lit(1)).alias("n"), F.max("committed_at").alias("at"), F.max_by("total_records", "commit_id").alias("rows")).first()
            rows.append((t, t in PROTECTED, head["rows"], len(files), sum(f["bytes"] for f in files), head["n"], head["at"]))
        out = self.spark.createDataFrame(rows, "table string, is_system boolean, rows bigint, files bigint, bytes bigint, snapshots bigint, updated timestamp_ntz")
        return with_category(out, categories).orderBy("is_system", "table") if categories is not None else out.withColumn("category", F.lit(None).cast("string")).orderBy("is_system", "table")

    def table_overview(self, table: str) -> dict:
        """Fields with nested types spelled out, partition column and snapshot history."""
        df = self.read(table)
        return {"fields": [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields], "partitions": ["branch_id"], "history": self.snapshots(table)}


def _loose(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed at every level, as Parquet reads it back."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType), True)
    return T.MapType(_loose(kind.keyType), _loose(kind.valueType), True) if isinstance(kind, T.MapType) else kind


def _seen(state: State, branches: set) -> set[str]:
    return {f["path"] for f in state.files if f["branch_id"] in branches}


def _paths(files: list[Added]) -> list[str]:
    """What to read for these files: a folder if they are all that was written into it, else the file."""
    chosen = Counter(f.folder for f in files)
    return list(dict.fromkeys(f.folder if f.siblings == chosen[f.folder] else f.path for f in files))


def _per_branch(adds: list[Added]) -> dict:
    found: dict = {}
    for f in adds:
        found[f["branch_id"]] = found.get(f["branch_id"], 0) + f["added_records"]
    return found


def _inside(path: str) -> str:
    """A file's path below its table."""
    return "data/" + unquote(path).rsplit("/data/", 1)[1]


def with_category(tables: DataFrame, categories: DataFrame) -> DataFrame:
    """categories (table, category) has a row per definition, so a handful of rows."""
    return tables.join(categories, "table", "left")


def orphan_files(listing: DataFrame, referenced: DataFrame, by: str = "path") -> DataFrame:
    """Files (or folders) on disk that no snapshot refers to."""
    return listing.join(referenced.select(by).distinct(), by, "left_anti")


def pick_snapshots(commits: DataFrame, day: str) -> DataFrame:
    """(baseline, latest): the last snapshot committed on ``day`` and the last of all; null where there is none."""
    at = F.struct("committed_at", "commit_id")
    return commits.agg(
        F.max_by("commit_id", F.when(F.to_date("committed_at") == F.lit(day).cast("date"), at)).alias("baseline"), F.max_by("commit_id", at).alias("latest")
    )


def snapshot_pair(commits: DataFrame, day: str) -> tuple[int, int]:
    r = pick_snapshots(commits, day).first()
    if r["latest"] is None:
        raise ValueError("the table has no snapshots")
    if r["baseline"] is None:
        raise ValueError(f"no snapshot was committed on {day}")
    if r["baseline"] == r["latest"]:
        raise ValueError("the baseline is the latest snapshot; nothing to compare")
    return r["baseline"], r["latest"]


def retain(commits: DataFrame, days: int, min_keep: int, now: str) -> DataFrame:
    """Snapshots with ``keep``: younger than ``days``, or the current and the newest ``min_keep``, which are a top-k and no window over the whole log."""
    newest = commits.orderBy(F.desc("committed_at"), F.desc("commit_id")).limit(max(1, min_keep)).select(F.col("commit_id").alias("__c")).distinct()
    floor = F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {int(days)} days")
    marked = commits.join(newest, F.col("commit_id") == F.col("__c"), "left")
    return marked.withColumn("keep", F.col("__c").isNotNull() | (F.col("committed_at") >= floor)).drop("__c")


def squash(commits: DataFrame, before: DataFrame) -> DataFrame:
    """Snapshots that stay once the run's intermediate ones go: all earlier ones (``before``), and the run's last."""
    last = commits.agg(F.max_by("commit_id", F.struct("committed_at", "commit_id")).alias("commit_id"))
    keep = before.select("commit_id").unionAll(last).distinct()
    return commits.join(keep, "commit_id", "left_semi")


def expire_to_latest(commits: DataFrame) -> DataFrame:
    last = commits.agg(F.max_by("commit_id", F.struct("committed_at", "commit_id")).alias("commit_id"))
    return commits.join(last, "commit_id", "left_semi")


def at_version(df: DataFrame, version: str) -> DataFrame:
    """Rows of a snapshot table at one version; the version's day prunes folders."""
    v = F.lit(version).cast("timestamp_ntz")
    return df.where((F.col("version_date") == v.cast("date")) & (F.col("version") == v))
