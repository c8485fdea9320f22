"""Sets of stored tables that change as a whole.

Each write of a table goes to a folder of its own, a version, which is never changed. A
manifest, one small file with a number, names the version of every table; the valid one with
the highest number is the current snapshot. So a commit is the creation of one file: nothing
is renamed or copied, which holds on object stores too, readers keep the versions that they
began with, and a build that dies at any moment leaves the snapshot before it, whole.

A manifest ends with a digest of itself; one that was cut off while it was written is not valid
and is passed over. One writer at a time: a second one finds the number taken and stops.
Old versions are removed by count of snapshots, together with those no snapshot names.

Beside its version a table has what was counted while it was written (``observed``), and
whether it lies in buckets of a key. Rows of equal keys are in one bucket, so grouping or
ranking by the key needs no shuffle. Buckets are used only as long as none is far larger than
the others, since one task reads a bucket: a table with a hot key is read like any other.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.sources.files import Files

MANIFESTS, JOURNAL = "_snapshots", "_journal"
KEEP = 2

#: A bucket is no hot one as long as it is below this many times the mean, or below this many bytes.
UNEVEN, SMALL_BUCKET = 4, 128 * 1024 * 1024


@dataclass(frozen=True)
class Version:
    """One write of a table: its folder below the root, its schema, what was counted, and its buckets."""

    path: str
    schema: str
    observed: dict[str, int] = field(default_factory=dict)
    key: str | None = None
    buckets: int = 0
    even: bool = False

    @property
    def name(self) -> str:
        """Under which the session's catalog knows it, where buckets need a name."""
        return "tallywork_" + self.path.rsplit("-", 1)[-1]

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def register_version(spark: SparkSession, root: str, version: Version) -> str:
    """The name of a version in the session's catalog, under which its buckets are known; made if it is not there yet."""
    name = f"{spark.catalog.currentCatalog()}.default.{version.name}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.struct)
    dealt = f"CLUSTERED BY (`{version.key}`) SORTED BY (`{version.key}`) INTO {version.buckets} BUCKETS" if version.even else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {dealt} LOCATION '{root}/{version.path}'")
    return name


def read_version(spark: SparkSession, root: str, version: Version) -> DataFrame:
    if version.even:
        return spark.table(register_version(spark, root, version))
    return spark.read.schema(version.struct).parquet(f"{root}/{version.path}")


@dataclass(frozen=True)
class Snapshot:
    """The tables of one commit."""

    spark: SparkSession
    root: str
    number: int
    tables: Mapping[str, Version]

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise FileNotFoundError(f"no table {name!r} in {self.root}, snapshot {self.number}")
        return read_version(self.spark, self.root, self.tables[name])

    def observed(self, name: str) -> dict[str, int]:
        return self.tables[name].observed


class TableSet:
    """The tables below a folder; ``folders`` may name a folder for a table, else it is the table's name."""

    def __init__(self, spark: SparkSession, root: str, folders: Mapping[str, str] | None = None):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)
        self.folders = dict(folders or {})

    def _manifests(self) -> list[int]:
        found = self.files.names(f"{self.root}/{MANIFESTS}")
        return sorted(int(m[1]) for name in found if (m := re.fullmatch(r"(\d{12})\.json", name)))

    def _manifest(self, number: int) -> str:
        return f"{self.root}/{MANIFESTS}/{number:012d}.json"

    def _load(self, number: int) -> Snapshot | None:
        text = self.files.read_signed(self._manifest(number))
        if text is None:
            return None
        tables = {name: Version(**v) for name, v in json.loads(text)["tables"].items()}
        return Snapshot(self.spark, self.root, number, tables)

    def snapshots(self) -> list[Snapshot]:
        """All valid ones, the current one last."""
        return [s for s in map(self._load, self._manifests()) if s is not None]

    def current(self) -> Snapshot:
        for number in reversed(self._manifests()):
            if snapshot := self._load(number):
                return snapshot
        return Snapshot(self.spark, self.root, 0, {})

    def draft(self, resume: bool = False) -> Draft:
        return Draft(self, resume)

    def _commit(self, tables: Mapping[str, Version], keep: int) -> Snapshot:
        number = max([0, *self._manifests()]) + 1
        text = json.dumps({"number": number, "tables": {k: asdict(v) for k, v in sorted(tables.items())}}, indent=1)
        self.files.create_signed(self._manifest(number), text)
        self.expire(keep)
        return Snapshot(self.spark, self.root, number, dict(tables))

    def expire(self, keep: int = KEEP) -> None:
        """Remove all but the last ``keep`` valid snapshots, and every version that none of those names."""
        if keep < 1:
            raise ValueError("the current snapshot is kept")
        kept = self.snapshots()[-keep:]
        for number in self._manifests():
            if number not in {s.number for s in kept}:
                self.files.remove(self._manifest(number))
        named = {v.path for s in kept for v in s.tables.values()}
        for folder in {v.path.rsplit("/", 1)[0] for s in kept for v in s.tables.values()} | set(self.folders.values()):
            for version in self.files.names(f"{self.root}/{folder}"):
                if version.startswith("v-") and f"{folder}/{version}" not in named:
                    self.remove_version(f"{folder}/{version}")

    def remove_version(self, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS default.{Version(path, '').name}")
        self.files.remove(f"{self.root}/{path}")


class Draft:
    """Tables on their way into the next snapshot, read by whoever writes the others.

    As a context it is committed at the end, or discarded if that is an error. With ``resume`` it keeps a
    journal instead: what a ``step`` has written is known to the next draft with ``resume``, which goes on from there.
    """

    def __init__(self, tables: TableSet, resume: bool):
        self.tables, self.spark, self.resume = tables, tables.spark, resume
        self.base = tables.current()
        self.pending: dict[str, Version] = {}
        self._folder = f"{tables.root}/{JOURNAL}"

    def __enter__(self) -> Draft:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.commit()
        elif not self.resume:
            self.discard()

    def now(self) -> Snapshot:
        """The snapshot that a commit would make."""
        return Snapshot(self.spark, self.tables.root, self.base.number, {**self.base.tables, **self.pending})

    def read(self, name: str) -> DataFrame:
        return self.now().read(name)

    def write(
        self,
        name: str,
        df: DataFrame,
        observe: Mapping[str, Column] | None = None,
        key: str | None = None,
        buckets: int | None = None,
        arranged: bool = False,
    ) -> DataFrame:
        """Write a version; ``observe`` names counts taken on the way, ``key`` and ``buckets`` how rows are dealt out.

        Rows are dealt to the buckets by one shuffle, in which Spark splits large partitions (a hot key, or the rows
        without a key, are written by several tasks); ``arranged`` says that the rows come from a plan that has them
        together already. Counts are taken where the rows are written, so a task that is run again counts once.
        """
        folder = self.tables.folders.get(name, name)
        path = f"{folder}/v-{uuid.uuid4().hex}"
        whole = f"{self.tables.root}/{path}"
        buckets = (buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))) if key else 0
        rows = df.hint("rebalance", F.col(key)) if key and not arranged else df
        seen = Observation(uuid.uuid4().hex) if observe else None
        if seen:
            rows = rows.observe(seen, *(c.alias(k) for k, c in observe.items()))
        version = Version(path, df.schema.json(), {}, key, buckets)
        try:
            if key:
                rows.write.bucketBy(buckets, key).sortBy(key).option("path", whole).saveAsTable(f"default.{version.name}")
                # The name may be of no use beyond this session; read_version makes it anew where the buckets are even.
                self.spark.sql(f"DROP TABLE default.{version.name}")
            else:
                rows.write.parquet(whole)
        except Exception:
            self.tables.remove_version(path)
            raise
        counts = {k: int(v or 0) for k, v in seen.get.items()} if seen else {}
        self.pending[name] = Version(path, df.schema.json(), counts, key, buckets, self._even(whole, buckets))
        return self.read(name)

    def _even(self, path: str, buckets: int) -> bool:
        if not buckets:
            return False
        sizes = dict.fromkeys(range(buckets), 0)
        for name, length in self.tables.files.names(path).items():
            if m := re.search(r"_(\d{5})\.c\d+", name):
                sizes[int(m[1])] += length
        return max(sizes.values()) <= max(SMALL_BUCKET, UNEVEN * sum(sizes.values()) / buckets)

    def step(self, name: str, key: str, run: Callable[[], None]) -> None:
        """Run a step that writes tables, unless the journal has it complete under the same key."""
        done = self._entry(name)
        if done and done["key"] == key:
            self.pending |= {k: Version(**v) for k, v in done["tables"].items()}
            return
        before = dict(self.pending)
        run()
        written = {k: asdict(v) for k, v in self.pending.items() if before.get(k) != v}
        self._note(name, {"key": key, "tables": written})

    def recall(self, name: str, key: str, value: str) -> str:
        """A value of the run's own, such as its time: that of the run that is resumed, else ``value``."""
        done = self._entry(name)
        if done and done["key"] == key:
            return done["value"]
        self._note(name, {"key": key, "value": value})
        return value

    def _entry(self, name: str) -> dict | None:
        path = f"{self._folder}/{name}.json"
        if not self.resume or not self.tables.files.exists(path):
            return None
        text = self.tables.files.read_signed(path)
        return json.loads(text) if text is not None else None

    def _note(self, name: str, entry: dict) -> None:
        if self.resume:
            path = f"{self._folder}/{name}.json"
            self.tables.files.remove(path)
            self.tables.files.create_signed(path, json.dumps(entry))

    def commit(self, keep: int = KEEP) -> Snapshot:
        snapshot = self.tables._commit({**self.base.tables, **self.pending}, keep)
        self.tables.files.remove(self._folder)
        self.base, self.pending = snapshot, {}
        return snapshot

    def discard(self) -> None:
        for version in self.pending.values():
            self.tables.remove_version(version.path)
        self.pending = {}
