"""The prediction log: every micro-batch's rows, kept so that a retry cannot double them.

Layout below ``root``::

    batches/run_id=<r>/batch_id=<b>/    rows of one micro-batch, overwritten if the batch is retried
    skipped/run_id=<r>/batch_id=<b>/    windows of that micro-batch that could not be scored
    late/run_id=<r>/batch_id=<b>/       sums of reports of that micro-batch that came after their window's end
    sketches/run_id=<r>/batch_id=<b>/   one row: mergeable sketches of the micro-batch's rows
    snapshots/<n>/<part>/               what is kept of each of these parts of all batches folded so far
    schemas/                            every schema that a part was written with, one small file each
    manifest/<version>.json             one file per finished snapshot: the last batch folded of each run

``latest`` is a view over the whole log, so a location that is silent in a batch stays in it. A manifest version is created
by one compaction only: another one that worked at the same time begins again on top of it.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from epigauge.operators.latest import latest_rows
from epigauge.operators.sketches import merged_sketches, sketched
from epigauge.operators.windows import added_windows, with_finality
from epigauge.session import children, put_if_absent, read_text, remove
from epigauge.spec import HEALTH, IndicatorSpec

VERSION = ("run_id", "batch_id")
PARTS = ("batches", "skipped", "late", "sketches")


@dataclass(frozen=True)
class Snapshot:
    """A manifest entry: its version, the snapshot's number and parts, and the last batch folded of each run."""

    version: int
    number: int
    path: str
    parts: tuple[str, ...]
    marks: dict[int, int]


@dataclass(frozen=True)
class PredictionLog:
    root: str
    spec: IndicatorSpec = HEALTH

    # --- writing

    def append(self, rows: DataFrame, run_id: int, batch_id: int) -> None:
        """Write one micro-batch; the same batch written again replaces itself."""
        self._write("batches", rows, run_id, batch_id)

    def append_skipped(self, rows: DataFrame, run_id: int, batch_id: int) -> None:
        """Note the windows of a micro-batch that were not scored."""
        self._write("skipped", rows, run_id, batch_id)

    def append_late(self, rows: DataFrame, run_id: int, batch_id: int) -> None:
        """Note the sums of reports that came after the end of their window."""
        self._write("late", rows, run_id, batch_id)

    def append_sketches(self, spark: SparkSession, run_id: int, batch_id: int, key: str, score: str) -> None:
        """Sketch the rows of a micro-batch that was just written: how many keys, and how the scores lie."""
        self._write("sketches", sketched(self._rows(spark, "batches", [(run_id, batch_id)]), key, score), run_id, batch_id)

    def _write(self, part: str, rows: DataFrame, run_id: int, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{part}/run_id={run_id}/batch_id={batch_id}")
        self._note_schema(part, rows)  # a batch that failed before this is written again

    # --- views

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest snapshot and, of each run, the batches after the last one that is folded."""
        found = self._part(spark, "batches")
        if found is None:  # an unreadable log is an error, as a missing folder is
            return spark.read.parquet(f"{self.root}/batches")
        return found

    def windows(self, spark: SparkSession, finality: bool = False) -> DataFrame:
        """The last state of every window and key; with ``finality`` whether a report can still change it."""
        states = latest_rows(self.read(spark), self._window_keys, VERSION)
        return with_finality(states, self.spec) if finality else states

    def latest(self, spark: SparkSession, finality: bool = False) -> DataFrame:
        """The newest window per key, in its last state."""
        rows = self.read(spark)
        rows = with_finality(rows, self.spec) if finality else rows
        return latest_rows(rows, self.spec.key_names, ("window_end", *VERSION))

    def changed_in(self, spark: SparkSession, run_id: int, batch_id: int) -> DataFrame:
        """Newest window per key among the rows of one batch only (locations silent in it are absent)."""
        return latest_rows(self._rows(spark, "batches", [(run_id, batch_id)]), self.spec.key_names, ("window_end",))

    def skipped(self, spark: SparkSession) -> DataFrame:
        """Windows whose last state could not be scored because a metric is missing; no rows if there is none."""
        found = self._part(spark, "skipped")
        if found is None:
            return self._nothing(spark)
        last = latest_rows(found, self._window_keys, VERSION)
        scored = self._part(spark, "batches")
        if scored is None:
            return last
        newest = latest_rows(scored, self._window_keys, VERSION).select(*self._window_keys, F.struct(*VERSION).alias("scored"))
        same = [last[k].eqNullSafe(newest[k]) for k in self._window_keys]
        newer = newest["scored"] > F.struct(*(last[v] for v in VERSION))
        return last.join(newest, [*same, newer], "left_anti")

    def late(self, spark: SparkSession) -> DataFrame:
        """Sums, by window and key, of the reports that came after the window's end; no rows if there is none."""
        found = self._part(spark, "late")
        return self._nothing(spark) if found is None else added_windows(found, self.spec)

    def sketches(self, spark: SparkSession) -> DataFrame:
        """One row: the sketches of all batches, merged; no row if none was written."""
        found = self._part(spark, "sketches")
        return spark.createDataFrame([], "rows long") if found is None else merged_sketches(found)

    # --- upkeep

    def compact(self, spark: SparkSession) -> bool:
        """Fold all batches into a snapshot but the newest of each run (it may still be being written).

        Runs may write side by side: each has its own mark. Compactions may run side by side, too: the one that finishes second finds
        its version taken, drops what it wrote and folds what is left on top of the other's. Returns False if there
        is nothing to fold.
        """
        while True:
            newest = self._newest_snapshot(spark)
            marks = dict(newest.marks) if newest else {}
            listed = {part: self._listed(spark, part) for part in PARTS}
            runs: dict[int, set[int]] = {}
            for run, batch in (one for part in PARTS for one in listed[part]):
                runs.setdefault(run, set()).add(batch)
            fold = {(r, b) for r, batches in runs.items() for b in sorted(batches)[:-1] if b > marks.get(r, -1)}
            if not fold:
                return False
            number = max(time.time_ns(), newest.number + 1 if newest else 0)
            path = f"{self.root}/snapshots/{number}-{uuid.uuid4().hex[:8]}"
            parts = []
            for part in PARTS:
                rows = self._joined(spark, part, newest, [one for one in listed[part] if one in fold])
                if rows is not None:
                    self._folded(part, rows).write.parquet(f"{path}/{part}")
                    parts.append(part)
            for run, batch in fold:
                marks[run] = max(batch, marks.get(run, -1))
            version = newest.version + 1 if newest else 0
            entry = {"number": number, "path": path, "parts": parts, "marks": sorted(marks.items())}
            if put_if_absent(spark, f"{self.root}/manifest/{version:012d}.json", json.dumps(entry)):
                return True
            remove(spark, path)

    def retain(self, spark: SparkSession, grace_seconds: float) -> int:
        """Delete what a snapshot older than the grace time has folded; returns the number of folders.

        Readers that began before may still use older folders, hence the grace time. Views do not change: every later
        snapshot was made on top of the one that is kept.
        """
        before = time.time_ns() - int(grace_seconds * 1e9)
        done = [entry for entry in self._manifest(spark) if entry.number <= before]
        if not done:
            return 0
        kept = max(done, key=lambda entry: entry.version)
        gone = [
            f"{self.root}/{part}/run_id={r}/batch_id={b}"
            for part in PARTS
            for r, b in self._listed(spark, part)
            if b <= kept.marks.get(r, -1)
        ]
        snapshots = children(spark, f"{self.root}/snapshots")
        gone += [f"{self.root}/snapshots/{n}" for n in snapshots if int(n.partition("-")[0]) < kept.number]
        for path in gone:
            remove(spark, path)
        for entry in done:
            if entry.version < kept.version:
                remove(spark, f"{self.root}/manifest/{entry.version:012d}.json")
        return len(gone)

    def _folded(self, part: str, rows: DataFrame) -> DataFrame:
        """What a snapshot keeps: the last state of a window, the sum of late reports, the merged sketches."""
        if part == "late":
            return added_windows(rows, self.spec)
        if part == "sketches":
            return merged_sketches(rows)
        return latest_rows(rows, self._window_keys, VERSION)

    # --- reading parts

    @property
    def _window_keys(self) -> list[str]:
        return ["window_start", "window_end", *self.spec.key_names]

    def _nothing(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType().add("window_start", "timestamp").add("window_end", "timestamp")
        for name, kind in self.spec.keys:
            schema = schema.add(name, kind)
        for name in self.spec.metrics:
            schema = schema.add(name, "double")
        return spark.createDataFrame([], schema.add("run_id", "long").add("batch_id", "long"))

    def _part(self, spark: SparkSession, part: str) -> DataFrame | None:
        newest = self._newest_snapshot(spark)
        marks = newest.marks if newest else {}
        return self._joined(spark, part, newest, [(r, b) for r, b in self._listed(spark, part) if b > marks.get(r, -1)])

    def _joined(self, spark: SparkSession, part: str, snapshot: Snapshot | None, which: list[tuple[int, int]]) -> DataFrame | None:
        """A part's snapshot and some of its batches; None if there is neither."""
        folded = None
        if snapshot and part in snapshot.parts:
            folded = spark.read.parquet(f"{snapshot.path}/{part}")
        if not which:
            return folded
        rows = self._rows(spark, part, which)
        return rows if folded is None else folded.unionByName(rows, allowMissingColumns=True)

    def _listed(self, spark: SparkSession, part: str) -> list[tuple[int, int]]:
        """Run and batch of every folder; two listings deep, no file is opened."""
        found = []
        for run in children(spark, f"{self.root}/{part}"):
            if run.startswith("run_id="):
                names = children(spark, f"{self.root}/{part}/{run}")
                found += [(int(run[7:]), int(name[9:])) for name in names if name.startswith("batch_id=")]
        return sorted(found)

    def _rows(self, spark: SparkSession, part: str, which: list[tuple[int, int]]) -> DataFrame:
        """The rows of some batches; only their folders are listed. Columns that one of them lacks are null in it."""
        base = f"{self.root}/{part}"
        paths = [f"{base}/run_id={r}/batch_id={b}" for r, b in which]
        schema = T.StructType()
        for known in self._schemas(spark, part):
            for field in known.fields:
                if field.name not in schema.names:
                    schema = schema.add(field.name, field.dataType)
                elif schema[field.name].dataType != field.dataType:
                    raise ValueError(f"{field.name} was logged as {schema[field.name].dataType.simpleString()} and as {field.dataType.simpleString()}")
        schema = schema.add("run_id", T.LongType()).add("batch_id", T.LongType())
        return spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def _note_schema(self, part: str, rows: DataFrame) -> None:
        """Remember the columns of a part: one small file for each schema it is ever written with."""
        spark, text = rows.sparkSession, rows.schema.json()
        digest = hashlib.sha256(text.encode()).hexdigest()[:16]
        known = children(spark, f"{self.root}/schemas")
        if not any(n.startswith(f"{part}-") and n.endswith(f"-{digest}.json") for n in known):
            put_if_absent(spark, f"{self.root}/schemas/{part}-{time.time_ns()}-{digest}.json", text)

    def _schemas(self, spark: SparkSession, part: str) -> list[T.StructType]:
        names = [n for n in children(spark, f"{self.root}/schemas") if n.startswith(f"{part}-")]
        return [T.StructType.fromJson(json.loads(read_text(spark, f"{self.root}/schemas/{n}"))) for n in names]

    def _versions(self, spark: SparkSession) -> list[str]:
        return [n for n in children(spark, f"{self.root}/manifest") if n.endswith(".json") and not n.startswith(".")]

    def _entry(self, spark: SparkSession, name: str) -> Snapshot:
        e = json.loads(read_text(spark, f"{self.root}/manifest/{name}"))
        return Snapshot(int(name[:-5]), e["number"], e["path"], tuple(e["parts"]), dict(map(tuple, e["marks"])))

    def _manifest(self, spark: SparkSession) -> list[Snapshot]:
        return [self._entry(spark, name) for name in self._versions(spark)]

    def _newest_snapshot(self, spark: SparkSession) -> Snapshot | None:
        names = self._versions(spark)
        return self._entry(spark, names[-1]) if names else None
