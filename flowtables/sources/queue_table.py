"""Queue state as a table of versions: a base, small deltas, and manifests that name them.

A receive or an action writes the rows that it changes, as a delta, and a manifest that adds the
delta to the version before.  Readers take the newest manifest and see that version whole; two
writers of one version cannot both win.  ``compact`` folds deltas into a new base.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.operators.queues import apply_actions, queue_receive
from flowtables.plans.sizes import broadcast_if_small

_ID = ["queue", "msg_id"]


class StaleVersion(RuntimeError):
    """Somebody else has written the next version first: read again."""


@dataclass(frozen=True)
class Version:
    """What a manifest says."""

    number: int
    bases: tuple[str, ...]
    deltas: tuple[str, ...]


class QueueTable:
    """Messages (see ``operators.queues``) under ``path``, a folder in a store that Spark reads.  A message
    is named by queue and id, neither of which is null."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        self._columns = self.schema.names

    # --- versions

    def _at(self, name: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return jvm_path, jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> Version:
        """The newest whole version; 0 is the empty table."""
        folder, files = self._at(f"{self.path}/_versions")
        found = sorted((s.getPath().getName() for s in files.listStatus(folder)), reverse=True) if files.exists(folder) else []
        for name in found:
            if name.isdigit():
                said = "\n".join(r.value for r in self.spark.read.text(f"{self.path}/_versions/{name}").collect())
                try:
                    return Version(int(name), *(tuple(x) for x in json.loads(said)))
                except ValueError:  # not written to its end
                    continue
        return Version(0, (), ())

    def _commit(self, before: Version, bases: tuple[str, ...], deltas: tuple[str, ...]) -> Version:
        after = Version(before.number + 1, bases, deltas)
        aside, files = self._at(f"{self.path}/_aside/{uuid.uuid4().hex}")
        out = files.create(aside, False)
        out.write(bytearray(json.dumps([bases, deltas]).encode()))
        out.close()
        name, _ = self._at(f"{self.path}/_versions/{after.number:012d}")
        files.mkdirs(name.getParent())
        # A name that is there is never replaced: of two writers one is told.
        if files.exists(name) or not files.rename(aside, name):
            files.delete(aside, False)
            raise StaleVersion(f"version {after.number} of {self.path} is there")
        return after

    def _write(self, rows: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        return name

    # --- reading

    def read(self, version: Version | None = None) -> DataFrame:
        """All messages of a version (the newest).  The base is not shuffled unless the deltas are large:
        its rows are kept unless a delta names them, and of those the newest delta counts."""
        version = version or self.version()
        base = self._table(version.bases, self.schema)
        if not version.deltas:
            return base
        delta_schema = T.StructType([*self.schema.fields, T.StructField("_gone", T.BooleanType())])
        parts = [self._table((d,), delta_schema).withColumn("_n", F.lit(n)) for n, d in enumerate(version.deltas)]
        changed = parts[0]
        for part in parts[1:]:
            changed = changed.unionByName(part)
        newest = F.row_number().over(Window.partitionBy(*_ID).orderBy(F.desc("_n")))
        changed = changed.withColumn("_newest", newest).where("_newest = 1").select(*self._columns, "_gone")
        changed = broadcast_if_small(changed)
        kept = base.join(changed.select(*_ID), _ID, "left_anti").select(*self._columns)
        return kept.unionByName(changed.where("NOT _gone").select(*self._columns))

    def _table(self, names: tuple[str, ...], schema: T.StructType) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])

    # --- writing

    def send(self, messages: DataFrame) -> Version:
        """Add new messages, or replace those of the same queue and id."""
        before = self.version()
        rows = messages.select(*self._columns)
        if not before.bases and not before.deltas:
            return self._commit(before, (self._write(rows, "base"),), ())
        return self._commit(before, before.bases, (*before.deltas, self._write(rows.withColumn("_gone", F.lit(False)), "delta")))

    def receive(self, now: Column, max_messages: int, visibility_s: int) -> DataFrame:
        """:func:`queue_receive` from the newest version; what it hands out is hidden in the next one.
        Writes the received messages and nothing else."""
        before = self.version()
        received = queue_receive(self.read(before), now, max_messages, visibility_s)
        name = self._write(received.select(*self._columns, F.lit(False).alias("_gone")), "delta")
        self._commit(before, before.bases, (*before.deltas, name))
        return self._table((name,), self.schema)

    def act(self, actions: DataFrame, now: Column) -> Version:
        """:func:`apply_actions`; writes the messages that were deleted or changed."""
        before = self.version()
        by = _ID if "queue" in actions.columns else ["msg_id"]
        named = broadcast_if_small(actions.where("action <> 'ignore'").select(*by).distinct())
        touched = self.read(before).join(named, by, "left_semi").select(*self._columns)
        after = apply_actions(touched, actions, now).select(*self._columns, F.lit(False).alias("_gone"))
        gone = touched.join(after.select(*_ID), _ID, "left_anti").select(*self._columns, F.lit(True).alias("_gone"))
        return self._commit(before, before.bases, (*before.deltas, self._write(after.unionByName(gone), "delta")))

    def compact(self) -> Version:
        """Write the newest version as one base.  Older files stay for their readers."""
        before = self.version()
        return self._commit(before, (self._write(self.read(before), "base"),), ())

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete versions before the ``keep`` newest, and files that no kept version names; returns them.
        Files of a writer that has not committed yet are among them: call it while none writes."""
        folder, files = self._at(f"{self.path}/_versions")
        numbers = sorted(s.getPath().getName() for s in files.listStatus(folder))
        named: set[str] = set()
        for name in numbers[-keep:]:
            said = "\n".join(r.value for r in self.spark.read.text(f"{self.path}/_versions/{name}").collect())
            named |= {x for part in json.loads(said) for x in part}
        for name in numbers[:-keep]:
            files.delete(self._at(f"{self.path}/_versions/{name}")[0], False)
        root = self._at(self.path)[0]
        dropped = sorted(n for n in (s.getPath().getName() for s in files.listStatus(root)) if not n.startswith("_") and n not in named)
        for name in dropped:
            files.delete(self._at(f"{self.path}/{name}")[0], True)
        return dropped
