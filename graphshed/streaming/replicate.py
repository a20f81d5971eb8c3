"""Following numbered change files as a stream.

Each micro-batch is applied sequence by sequence: boxes, splitting by the
polygon tree, then the *original* changes go into the store. The store is a
folder with a base, one delta for each sequence after it, and a state that
names the last; replaying a sequence writes the same delta again, so a batch
that runs twice changes nothing.
"""

from __future__ import annotations

import contextlib
import fcntl
import os
import shutil
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from graphshed.model import Store
from graphshed.operators import bbox, polyfilter
from graphshed.operators import store as ops
from graphshed.plans.lineage import cut
from graphshed.sinks import files
from graphshed.sources import replication

TABLES = ("nodes", "ways", "relations")


#: Deltas after which a new base is written.
DELTAS_MOST = 60


@dataclass
class Snapshots:
    """Versions of the store in a folder, and ``state.txt`` with the last one's number.

    A version is a base (whole tables, sorted by id) or a delta: the last rows
    of the ids that a sequence touches. A sequence writes its own rows only; a
    version is read as the base at or below it with the deltas up to it in
    place of the base's rows. After ``deltas_most`` deltas a new base is
    written.
    """

    spark: SparkSession
    folder: str
    deltas_most: int = DELTAS_MOST
    #: Rows written to each table so far, as Spark observed them.
    written: dict[str, int] = field(default_factory=lambda: dict.fromkeys(TABLES, 0))

    @property
    def state_file(self) -> str:
        return os.path.join(self.folder, "state.txt")

    def current(self) -> int:
        return replication.read_state(self.state_file)

    def path(self, sequence: int) -> str:
        return os.path.join(self.folder, f"{sequence:012d}")

    def delta_path(self, sequence: int) -> str:
        return f"{self.path(sequence)}.delta"

    def versions(self) -> tuple[list[int], list[int]]:
        """(bases, deltas) that are whole, in order."""
        names = os.listdir(self.folder)
        return sorted(int(n) for n in names if n.isdigit()), sorted(int(n[:-6]) for n in names if n.endswith(".delta") and n[:-6].isdigit())

    def parts(self, sequence: int) -> tuple[int, list[int]] | None:
        """(base, deltas) of a version; None if it is not there."""
        bases, deltas = self.versions()
        base = max((b for b in bases if b <= sequence), default=None)
        if base is None:
            return None
        needed = [d for d in deltas if base < d <= sequence]
        return (base, needed) if sequence == base or sequence in needed else None

    def init(self, store: Store, sequence: int = 0) -> None:
        """Begins with a store, unless there is one."""
        if not os.path.exists(self.state_file):
            self.write(store, sequence)

    def read(self, sequence: int | None = None) -> Store:
        wanted = self.current() if sequence is None else sequence
        found = self.parts(wanted)
        if found is None:
            raise FileNotFoundError(self.path(wanted))
        base, deltas = found
        return Store(*(self._table(name, base, deltas) for name in TABLES))

    def _table(self, name: str, base: int, deltas: list[int]) -> DataFrame:
        table = self.spark.read.parquet(f"{self.path(base)}/{name}")
        if not deltas:
            return table
        rows = [self.spark.read.parquet(f"{self.delta_path(d)}/{name}").withColumn("_at", F.lit(d)) for d in deltas]
        newest = Window.partitionBy("id").orderBy(F.desc("_at"))
        last = reduce(DataFrame.unionByName, rows).withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", "_at")
        return ops.replaced(table, last)

    def write(self, store: Store, sequence: int) -> None:
        """Writes a base under another name, then renames it and advances the state; both are whole or not there."""
        self._publish({name: getattr(store, name) for name in TABLES}, self.path(sequence))
        self._advance(sequence)

    def write_changes(self, changes: DataFrame, sequence: int) -> None:
        """Writes a change file's last rows as the delta of its sequence, and a new base if there are many deltas; then advances the state."""
        bases, _ = self.versions()
        base = max(b for b in bases if b < sequence)
        kinds = {name: self.spark.read.parquet(f"{self.path(base)}/{name}") for name in TABLES}
        self._publish({name: ops.last_rows(table, changes, name[:-1]) for name, table in kinds.items()}, self.delta_path(sequence))
        if len(self.parts(sequence)[1]) > self.deltas_most:
            self._publish({name: getattr(self.read(sequence), name) for name in TABLES}, self.path(sequence))
        self._advance(sequence)

    def _publish(self, tables: dict[str, DataFrame], target: str) -> None:
        part = f"{target}.part"
        for name, table in tables.items():
            seen = Observation()
            table.observe(seen, F.count(F.lit(1)).alias("rows")).sortWithinPartitions("id").write.mode("overwrite").parquet(f"{part}/{name}")
            self.written[name] += seen.get["rows"]
        if os.path.exists(target):
            shutil.rmtree(target)
        os.replace(part, target)

    def _advance(self, sequence: int) -> None:
        with open(f"{self.state_file}.part", "w", encoding="utf-8") as f:
            f.write(f"sequenceNumber={sequence}\n")
        os.replace(f"{self.state_file}.part", self.state_file)

    def forget(self, keep: int = 2) -> None:
        """Removes what the last versions don't need."""
        bases, deltas = self.versions()
        kept = [self.parts(n) for n in sorted({*bases, *deltas})[-keep:]]
        base = min(b for b, _ in kept)
        for path in [self.path(b) for b in bases if b < base] + [self.delta_path(d) for d in deltas if d <= base]:
            shutil.rmtree(path)


@contextlib.contextmanager
def single_writer(folder: str) -> Iterator[None]:
    """Only one process at a time writes a folder; a second one fails at once."""
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, ".lock"), "w") as f:
        fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        yield


@dataclass
class Split:
    """Where a sequence's changes go: the polygon tree, its rings and the output folder."""

    tree: DataFrame
    rings: DataFrame
    folder: str


def step(snapshots: Snapshots, changes: DataFrame, sequence: int, split: Split | None = None) -> None:
    """One sequence: boxes and splitting against the store before it, then the store after it.

    A sequence that the state has already is computed from the version before
    it, as the first time.
    """
    before = min(snapshots.current(), sequence - 1)
    if snapshots.parts(before) is None:
        return  # done long ago: its version and the one before it are gone
    store = snapshots.read(before)
    rows = cut(changes.drop("file", "sequence"))
    if split is not None:
        publish(polyfilter.hierarchy(bbox.annotate(rows, store), store, split.tree, split.rings), split, sequence)
    if sequence > snapshots.current():
        snapshots.write_changes(rows, sequence)


def publish(outputs: DataFrame, split: Split, sequence: int) -> None:
    """The outputs of all polygons as change files and states, folder by folder."""
    names = [r.hier_name for r in split.tree.where("file is not null").select("hier_name").collect()]
    outputs = cut(outputs)
    path = replication.path_of(sequence)
    tops = {name: os.path.normpath(os.path.join(split.folder, name)) + "/minute" for name in names}
    files.write_xml_files(outputs, {name: f"{top}/{path}.osc.gz" for name, top in tops.items()}, "poly")
    for top in tops.values():
        files.publish_state(top, sequence, f"{path}.state.txt")


def follow(snapshots: Snapshots, diffs: str, checkpoint: str, most: int | None = None, split: Split | None = None, on_batch: Callable[[int], None] | None = None, fetched: str | None = None) -> None:
    """Applies all sequences after the store's up to the folder's state (or ``most``), then ends.

    ``diffs`` is a folder or an address; what an address has is fetched into
    ``fetched`` (a folder that is mounted wherever tasks run; by default one
    beside the store's versions) and followed from there.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows.persist()
        try:
            for r in rows.select("sequence").distinct().orderBy("sequence").collect():
                step(snapshots, rows.where(F.col("sequence") == r.sequence), r.sequence, split)
                if on_batch:
                    on_batch(r.sequence)
        finally:
            rows.unpersist()

    with single_writer(snapshots.folder):
        if replication.is_address(diffs):
            folder = fetched or os.path.join(snapshots.folder, "diffs")
            os.makedirs(folder, exist_ok=True)
            if replication.mirror(diffs.rstrip("/"), folder, snapshots.current(), most) == snapshots.current():
                return
            diffs = folder
        source = replication.stream(snapshots.spark, diffs, snapshots.current(), most)
        query = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def latest_positions(changes: DataFrame) -> DataFrame:
    """Of a stream of node rows (id, pos, action, lat_e7, lon_e7) the last state of each node, as it changes (for output mode update)."""
    return changes.groupBy("id").agg(F.max_by(F.struct("pos", "action", "lat_e7", "lon_e7"), "pos").alias("last")).select("id", "last.*")
