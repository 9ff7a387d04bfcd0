"""Datasets published as immutable runs that a manifest lists.

A run is written to a folder of its own; readers see it when the manifest names it. The manifest is a small JSON
file that is replaced in one step. The root may lie on any file system that Spark can write to.

Runs are merged by levels: ``compact`` turns the runs of a level into one of the next that holds no superseded
versions, is sorted, and knows which file holds which range. Merged runs stay on disk as tombstones, for readers that
still use them, until ``vacuum``.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import Gate
from ..operators.versions import ingested_order, latest_version
from ..schemas import schema
from ..sources.files import Files
from ..sources.parquet import conform

#: From and to, both included; None: no bound.
Bounds = Mapping[str, tuple[str | None, str | None]]


class StorageLimitError(RuntimeError):
    """Publishing would exceed the capacity."""


@dataclass
class Run:
    """One folder: what it holds, its place among the levels, and the keys that it holds once, if any."""

    folder: str
    rows: int = 0
    bytes: int = 0
    ranges: dict[str, list[str | None]] = field(default_factory=dict)
    schema: str | None = None
    level: int = 0
    unique: list[str] | None = None
    where: str | None = None  # what rows of ``unique`` keys were also told apart by
    by_file: bool = False  # whether its files' ranges are kept
    partition_by: list[str] | None = None

    @property
    def name(self) -> str:
        return self.folder.rpartition("/")[2]

    def may_hold(self, within: Bounds) -> bool:
        return all(c not in self.ranges or _overlap(*self.ranges[c], lo, hi) for c, (lo, hi) in within.items())


def _overlap(least: str | None, most: str | None, lo: str | None, hi: str | None) -> bool:
    """A column without values holds nothing that lies within bounds."""
    if lo is None and hi is None:
        return True
    return least is not None and most is not None and (lo is None or most >= lo) and (hi is None or least <= hi)


@dataclass
class Manifest:
    dataset: str
    layer: str
    run_id: str
    runs: list[Run] = field(default_factory=list)
    inputs: list[str] = field(default_factory=list)
    rows: int = 0
    bytes: int = 0
    own_bytes: int = 0  # of this run alone
    min_date: str | None = None
    max_date: str | None = None
    schema_version: str = "1.0"
    tombstones: list[str] = field(default_factory=list)  # folders that count no more, but weren't deleted yet

    @property
    def folders(self) -> list[str]:
        return [r.folder for r in self.runs]

    @classmethod
    def parse(cls, text: str) -> Manifest:
        got = json.loads(text)
        got["runs"] = [Run(**r) for r in got["runs"]] if "runs" in got else [Run(f) for f in got.pop("folders")]
        return cls(**got)


class Store:
    def __init__(self, spark: SparkSession, root: str, limit_bytes: int | None = None, safety: float = 1.2):
        self.spark, self.root, self.limit, self.safety = spark, root.rstrip("/"), limit_bytes, safety
        self.files_ = Files(spark, self.root)

    def _meta(self, layer: str, dataset: str, name: str) -> str:
        return f"{self.root}/metadata/{layer}/{dataset}/{name}"

    def load(self, layer: str, dataset: str) -> Manifest | None:
        text = self.files_.read(self._meta(layer, dataset, "active.json"))
        return Manifest.parse(text) if text else None

    def used(self) -> int:
        """Bytes of all runs that were published and not vacuumed, as their manifests tell; no data folder is listed."""
        return sum(json.loads(self.files_.read(p))["own_bytes"] for p in self.files_.matching(f"{self.root}/metadata/*/*/run-*.json"))

    def level(self, target: float = 0.6, warn: float = 0.75) -> str:
        """How full the store is: OK, above the target, above the warning level, or at its limit."""
        if self.limit is None:
            return "OK"
        share = self.used() / self.limit
        return "HARD_LIMIT" if share >= 1 else "WARNING" if share >= warn else "ABOVE_TARGET" if share >= target else "OK"

    def _gate(self, more: int) -> None:
        if self.limit is not None and (used := self.used()) + more * self.safety > self.limit:
            raise StorageLimitError(f"{used} bytes and {more} more exceed {self.limit}")

    def _write(self, layer: str, dataset: str, df: DataFrame, ranges: Sequence[str], gate: Gate | None, partition_by: Sequence[str] | None) -> tuple[str, Run]:
        """Write a folder; count, ranges and rules are observed on the way, in the same pass. What fails leaves no folder."""
        run = f"{datetime.now().astimezone():%Y%m%dT%H%M%S%z}-{uuid.uuid4().hex[:12]}"
        folder = f"{self.root}/{layer}/{dataset}/{run}"
        stamped = df
        for name, value in (("source_run_id", F.lit(run)), ("_ingested_at", F.lit(datetime.now().astimezone().isoformat(timespec="microseconds")))):
            if name not in df.columns:
                stamped = stamped.withColumn(name, value)
        rules = gate.rules if gate else {}
        seen, told = Observation(), [F.count(F.lit(1)).alias("n")]
        told += [f(c).cast("string").alias(f"{name}_{i}") for i, c in enumerate(ranges) for name, f in (("lo", F.min), ("hi", F.max))]
        told += [c.cast("bigint").alias(f"rule_{i}") for i, (_, c) in enumerate(rules.values())]
        observed = stamped.observe(seen, *told).drop(*(gate.helpers if gate else ()))
        try:
            writer = observed.write.mode("errorifexists")
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
            got = seen.get
            if not got["n"]:
                raise ValueError(f"{dataset}: nothing to publish")
            if gate:
                gate.enforce({r: got[f"rule_{i}"] or 0 for i, r in enumerate(rules)})
            size = self.files_.size(folder)
            if self.limit is not None and (used := self.used() + size) > self.limit:
                raise StorageLimitError(f"{used} bytes exceed {self.limit}")
        except Exception:
            self.files_.delete(folder)
            raise
        return run, Run(folder, got["n"], size, {c: [got[f"lo_{i}"], got[f"hi_{i}"]] for i, c in enumerate(ranges)}, observed.schema.json(), partition_by=list(partition_by) if partition_by else None)

    def _activate(self, m: Manifest) -> Manifest:
        text = json.dumps(asdict(m), indent=1)
        for name in (f"run-{m.run_id}.json", "active.json"):
            self.files_.write(self._meta(m.layer, m.dataset, name), text)
        return m

    def publish(
        self, layer: str, dataset: str, df: DataFrame, *, mode: str = "append", date: str | None = None, ranges: Sequence[str] = (), gate: Gate | None = None, inputs: list[str] | None = None, estimate: int = 64 << 10,
        partition_by: list[str] | None = None, schema_version: str = "1.0",
    ) -> Manifest:
        """Write a run and make it active; an empty one is refused. What fails leaves the active manifest as it is.

        ``gate`` has the rules that rows must keep: they are counted while the run is written, and a run that breaks one
        of severity ERROR is deleted before any manifest names it. ``date`` and ``ranges`` are date or text columns
        whose least and greatest values the manifest keeps, so that reads within bounds skip runs. ``partition_by``
        lays a run out by columns, a year for example, so that readers skip what a filter on them excludes.
        """
        self._gate(estimate)
        told = list(dict.fromkeys([*([date] if date else []), *ranges]))
        if odd := [c for c in told if not isinstance(df.schema[c].dataType, T.DateType | T.StringType)]:
            raise ValueError(f"ranges are kept of dates and texts, not of {', '.join(odd)}")
        run, own = self._write(layer, dataset, df, told, gate, partition_by)
        before = self.load(layer, dataset)
        m = Manifest(dataset, layer, run, [own], list(inputs or []), own.rows, own.bytes, own.bytes, *(own.ranges[date] if date else (None, None)), schema_version=schema_version)
        if before and mode == "append":
            m.runs = before.runs + m.runs
            m.inputs = list(dict.fromkeys([*before.inputs, *m.inputs, before.run_id]))
            m.rows, m.bytes = m.rows + before.rows, m.bytes + before.bytes
            m.min_date = min(filter(None, (m.min_date, before.min_date)), default=None)
            m.max_date = max(filter(None, (m.max_date, before.max_date)), default=None)
        if before:
            m.tombstones = before.tombstones + (before.folders if mode != "append" else [])
        return self._activate(m)

    def _files_of(self, m: Manifest, run: Run, within: Bounds) -> list[str]:
        """A run's files that may hold rows within the bounds."""
        stats = self.spark.read.parquet(self._meta(m.layer, m.dataset, f"files-{run.name}"))
        for c, (lo, hi) in within.items():
            if c in run.ranges and (lo, hi) != (None, None):
                stats = stats.where(F.coalesce((F.col(f"hi_{c}") >= F.lit(lo or "")) & (F.lit(hi is None) | (F.col(f"lo_{c}") <= F.lit(hi or ""))), F.lit(False)))
        return [r["file"] for r in stats.select("file").collect()]

    def _scan(self, m: Manifest, runs: Sequence[Run], within: Bounds | None = None) -> DataFrame | None:
        """Runs by column name: those whose files have one physical schema are one scan, however many they are."""
        groups: dict[tuple[str, str], list[str]] = {}
        for r in runs:
            # A run of an older manifest doesn't tell its schema; its files do.
            kind = r.schema or self.spark.read.parquet(r.folder).schema.json()
            paths = self._files_of(m, r, within) if within and r.by_file else [r.folder]
            # Folders that are laid out by columns are read one by one, each with its own base path.
            groups.setdefault((kind, r.folder if r.partition_by else ""), []).extend(paths)
        pinned, out = schema(m.dataset) if m.layer != "raw" else None, None
        for (kind, _), paths in groups.items():
            physical = T.StructType.fromJson(json.loads(kind))
            part = self.spark.read.schema(physical).parquet(*paths) if paths else self.spark.createDataFrame([], physical)
            part = conform(part, pinned) if pinned else part
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    def read(self, layer: str, dataset: str, within: Bounds | None = None) -> DataFrame:
        """All active runs by column name, every version that is kept; with the dataset's pinned schema, if it has one.

        ``within`` has bounds for columns, both ends included. Runs, and files of merged runs, whose ranges lie outside
        are not listed for the scan; what is left is filtered, so that the result doesn't depend on what is known.
        """
        m = self.load(layer, dataset)
        if m is None:
            raise FileNotFoundError(f"{layer}/{dataset} has no active manifest")
        return self._bounded(m, m.runs, within)

    def _bounded(self, m: Manifest, runs: Sequence[Run], within: Bounds | None) -> DataFrame:
        within = within or {}
        some = [r for r in runs if r.may_hold(within)]
        out = self._scan(m, some, within) if some else self._scan(m, runs[:1]).where(F.lit(False))
        for c, (lo, hi) in within.items():
            kind = out.schema[c].dataType
            if lo is not None:
                out = out.where(F.col(c) >= F.lit(lo).cast(kind))
            if hi is not None:
                out = out.where(F.col(c) <= F.lit(hi).cast(kind))
        return out

    def latest(self, layer: str, dataset: str, keys: Sequence[str], where: str | None = None, within: Bounds | None = None) -> DataFrame:
        """The newest version of each key, of those that ``where`` lets through.

        Where a merged run holds each key once, only newer runs are put in order: its rows whose keys they don't have
        are taken as they are. ``within`` may bound keys alone, else an older version would come back.
        """
        if within and (odd := set(within) - set(keys)):
            raise ValueError(f"bounds of columns that are no keys: {', '.join(sorted(odd))}")
        m = self.load(layer, dataset)
        condition = F.expr(where) if where else None
        base = m.runs[0] if m and m.runs[0].unique == list(keys) and m.runs[0].where == where else None
        if base is None:
            return latest_version(self.read(layer, dataset, within), keys, ingested_order(), condition)
        meets = lambda df: df if condition is None else df.where(condition)
        old = meets(self._bounded(m, [base], within))
        if not (newer := m.runs[1:]):
            return old
        new = meets(self._bounded(m, newer, within))
        told = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
        changed = old.join(told, same, "left_semi").unionByName(new, allowMissingColumns=True)
        return old.join(told, same, "left_anti").unionByName(latest_version(changed, keys, ingested_order()), allowMissingColumns=True)

    def compact(self, layer: str, dataset: str, keys: Sequence[str] = (), where: str | None = None, *, fan_in: int = 4, everything: bool = False, sort_by: Sequence[str] = (), file_rows: int = 2_000_000) -> Manifest | None:
        """Merge runs by levels: ``fan_in`` neighbouring runs of a level become one of the next; None if there are too few.

        Versions that a newer one in the same merge supersedes are left out. ``where`` is the condition of the dataset's
        view: the newest row that meets it is kept beside the newest of all, as it is the one that the view shows.
        Without keys all rows are kept. The merged run is sorted by ``sort_by`` (None given: its known ranges) and its
        files' ranges are kept. ``everything`` merges all runs into one.

        The new manifest is written last: what fails before leaves the old one, and a folder that ``vacuum`` deletes.
        """
        m, done = self.load(layer, dataset), None
        while m and (group := self._full(m.runs, fan_in, everything)):
            lo, hi = group
            m = done = self._merge(m, lo, hi, list(keys), where, list(sort_by), file_rows)
            if everything:
                break
        return done

    @staticmethod
    def _full(runs: Sequence[Run], fan_in: int, everything: bool) -> tuple[int, int] | None:
        """The oldest ``fan_in`` neighbours of one level; versions keep their order, as only neighbours are merged."""
        if everything:
            return (0, len(runs)) if len(runs) > 1 or (runs and not runs[0].by_file) else None
        for lo in range(len(runs) - fan_in + 1):
            if len({r.level for r in runs[lo : lo + fan_in]}) == 1:
                return lo, lo + fan_in
        return None

    def _merge(self, m: Manifest, lo: int, hi: int, keys: list[str], where: str | None, sort_by: list[str], file_rows: int) -> Manifest:
        old = m.runs[lo:hi]
        rows = self._scan(m, old)
        known = [c for c in dict.fromkeys(c for r in old for c in r.ranges) if isinstance(rows.schema[c].dataType, T.DateType | T.StringType)]
        if keys:
            rows = self._shown(rows, keys, where)
        order = sort_by or known
        if order:
            count = max(1, -(-sum(r.rows for r in old) // file_rows))
            rows = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
        self._gate(sum(r.bytes for r in old))
        run, own = self._write(m.layer, m.dataset, rows, known, None, None)
        own.level, own.unique, own.where = max(r.level for r in old) + 1, keys or None, where
        if known:
            self._describe(m, own)
        merged = Manifest(
            m.dataset, m.layer, run, [*m.runs[:lo], own, *m.runs[hi:]], [*m.inputs, m.run_id], m.rows - sum(r.rows for r in old) + own.rows, m.bytes - sum(r.bytes for r in old) + own.bytes, own.bytes,
            m.min_date, m.max_date, m.schema_version, m.tombstones + [r.folder for r in old],
        )
        return self._activate(merged)

    @staticmethod
    def _shown(rows: DataFrame, keys: list[str], where: str | None) -> DataFrame:
        """The newest row of each key, and the newest of those that meet the condition."""
        if where is None:
            return latest_version(rows, keys, ingested_order())
        newest = [c.desc() for c in ingested_order()]
        rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*newest))
        meets = F.coalesce(F.expr(where), F.lit(False))
        ranked = rows.withColumn("_meets", meets).withColumn("_rank", rank(*keys)).withColumn("_among", rank(*keys, "_meets"))
        return ranked.where((F.col("_rank") == 1) | (F.col("_meets") & (F.col("_among") == 1))).drop("_meets", "_rank", "_among")

    def _describe(self, m: Manifest, run: Run) -> None:
        """Keep each file's ranges beside the manifest, from one scan of the columns they are of."""
        written = self.spark.read.schema(T.StructType.fromJson(json.loads(run.schema))).parquet(run.folder)
        told = [f(c).cast("string").alias(f"{name}_{c}") for c in run.ranges for name, f in (("lo", F.min), ("hi", F.max))]
        by_file = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *told)
        by_file.coalesce(1).write.parquet(self._meta(m.layer, m.dataset, f"files-{run.name}"))
        run.by_file = True

    def vacuum(self, layer: str, dataset: str) -> list[str]:
        """Delete the folders that no active run uses: merged, replaced, or left behind by what failed. Returns their names.

        Nobody may be publishing or still reading them; a plan that was built before a merge reads the old folders.
        """
        m = self.load(layer, dataset)
        if m is None:
            return []
        active = {r.name for r in m.runs}
        gone = sorted({p.rpartition("/")[2] for p in self.files_.matching(f"{self.root}/{layer}/{dataset}/*")} - active)
        for name in gone:
            self.files_.delete(f"{self.root}/{layer}/{dataset}/{name}")
            self.files_.delete(self._meta(layer, dataset, f"files-{name}"))
            if text := self.files_.read(self._meta(layer, dataset, f"run-{name}.json")):
                self.files_.write(self._meta(layer, dataset, f"gone-{name}.json"), text)
                self.files_.delete(self._meta(layer, dataset, f"run-{name}.json"))
        m.tombstones = []
        self.files_.write(self._meta(layer, dataset, "active.json"), json.dumps(asdict(m), indent=1))
        return gone

    def files(self, layer: str, dataset: str) -> DataFrame:
        """Active files with their sizes and SHA-256 sums; the files are read by tasks, not by the driver."""
        m = self.load(layer, dataset)
        found = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(m.folders)
        return found.select("path", "length", F.sha2("content", 256).alias("sha256"))

    def verify(self, before: DataFrame, layer: str, dataset: str) -> DataFrame:
        """(path, problem) for files that are missing, new or changed since ``before``, which files() gave."""
        now = self.files(layer, dataset).select("path", F.col("length").alias("l"), F.col("sha256").alias("s"))
        both = before.join(now, "path", "full")
        problem = F.when(F.col("l").isNull(), "missing").when(F.col("length").isNull(), "new").when((F.col("l") != F.col("length")) | (F.col("s") != F.col("sha256")), "changed")
        return both.select("path", problem.alias("problem")).where("problem is not null")

    def refresh(self, views: dict[str, tuple[str, str, list[str]]]) -> list[str]:
        """Latest-version views: name to (layer, dataset, keys) or (layer, dataset, keys, where).

        All plans are built before the first is registered. Each refresh leaves a file that names the views and the
        runs they show.
        """
        plans, shown = {}, {}
        for name, (layer, ds, keys, *where) in views.items():
            if m := self.load(layer, ds):
                plans[name] = self.latest(layer, ds, keys, *where)
                shown[name] = m.run_id
        for name, df in plans.items():
            df.createOrReplaceTempView(name)
        if shown:
            now = datetime.now().astimezone()
            self.files_.write(f"{self.root}/metadata/refresh/{now:%Y%m%dT%H%M%S%z}-{uuid.uuid4().hex[:12]}.json", json.dumps({"at": now.isoformat(), "views": shown}))
        return list(plans)


class Checkpoint:
    """Batches that are done, by name and fingerprint of what they were made from."""

    def __init__(self, path: str, spark: SparkSession | None = None):
        self.path, self.files = path, Files(spark or SparkSession.active(), path)

    def _load(self) -> dict[str, str]:
        return json.loads(self.files.read(self.path) or "{}")

    def reset(self, *batches: str) -> None:
        """Forget the batches, all if none is named."""
        self._save({k: v for k, v in self._load().items() if batches and k not in batches})

    @staticmethod
    def fingerprint(what) -> str:
        return hashlib.sha256(json.dumps(what, sort_keys=True, default=str).encode()).hexdigest()

    def done(self, batch: str, what) -> bool:
        return self._load().get(batch) == self.fingerprint(what)

    def mark(self, batch: str, what) -> None:
        self._save(self._load() | {batch: self.fingerprint(what)})

    def _save(self, state: dict[str, str]) -> None:
        self.files.write(self.path, json.dumps(state))
