"""Publish all tables of a run, or none.

A run writes its tables below ``_runs/<run_id>`` of the output folder. What is to
be published is then stated in one manifest, ``_manifests/<version>.json``: it
appears whole or not at all, and a second run that commits the same version fails. From
then on the run counts; its tables are moved to their places. A run that died
before its manifest leaves nothing behind once the next run has started; one that
died after it is moved to its places then. So a load that is repeated after a
failure finds exactly what the last committed run left.

Moving is a rename per table and per partition, so a run that reopens one month
touches the folders of that month only.
"""

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.sources.tables import hadoop_path, read_like, side_by_side, write_parquet

RUNS = "_runs"
MANIFESTS = "_manifests"


class ConcurrentRun(RuntimeError):
    """Another run committed since this one started."""


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out; none where it does not exist."""
    system, target = hadoop_path(spark, path)
    if not system.exists(target):
        return []
    names = [status.getPath().getName() for status in system.listStatus(target)]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def exists(spark: SparkSession, path: str) -> bool:
    system, target = hadoop_path(spark, path)
    return system.exists(target)


def latest_version(spark: SparkSession, output: str) -> int:
    """Number of the last manifest; 0 before the first."""
    names = [name for name in folder_names(spark, f"{output}/{MANIFESTS}") if name.endswith(".json")]
    return int(names[-1].removesuffix(".json")) if names else 0


def manifest_path(output: str, version: int) -> str:
    return f"{output}/{MANIFESTS}/{version:012d}.json"


def read_manifest(spark: SparkSession, output: str) -> dict | None:
    """The last manifest: version, run_id, the moves, and by which run each
    published table or partition was written."""
    version = latest_version(spark, output)
    if not version:
        return None
    return json.loads(spark.read.text(manifest_path(output, version), wholetext=True).first().value)


def write_once(spark: SparkSession, path: str, content: str) -> None:
    """Write a file that must not exist; readers see all of it or none."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    system, target = hadoop_path(spark, path)
    system.mkdirs(target.getParent())
    _, draft = hadoop_path(spark, f"{target.getParent().toString()}/_{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(content.encode())
    stream.close()
    renames = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    store = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        store.rename(system.makeQualified(draft), system.makeQualified(target), renames)
    except Exception as error:
        system.delete(draft, False)
        if system.exists(target):
            raise ConcurrentRun(f"{path} was written by another run") from error
        raise


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder or file in its place. Where the source is gone it was moved
    before."""
    system, origin = hadoop_path(spark, source)
    _, place = hadoop_path(spark, target)
    if not system.exists(origin):
        return
    system.delete(place, True)
    system.mkdirs(place.getParent())
    if not system.rename(origin, place):
        raise OSError(f"{source} could not be moved to {target}")


def apply_manifest(spark: SparkSession, output: str, manifest: dict) -> None:
    """Move what a committed run has staged; may be repeated."""
    folder = f"{output}/{RUNS}/{manifest['run_id']}"
    for source, target in manifest["moves"]:
        move(spark, f"{folder}/{source}", f"{output}/{target}")
    system, done = hadoop_path(spark, folder)
    system.delete(done, True)


def recover(spark: SparkSession, output: str) -> dict | None:
    """Finish the last committed run and delete what others left; returns the
    last manifest."""
    manifest = read_manifest(spark, output)
    if manifest and exists(spark, f"{output}/{RUNS}/{manifest['run_id']}"):
        apply_manifest(spark, output, manifest)
    system, runs = hadoop_path(spark, f"{output}/{RUNS}")
    system.delete(runs, True)
    return manifest


@dataclass
class Release:
    """Tables of one run on their way to being published."""

    spark: SparkSession
    output: str
    run_id: str
    version: int
    written_by: dict[str, str]
    #: (staged path, published path), and whether it also counts when the run fails.
    moves: list[tuple[str, str, bool]] = field(default_factory=list)

    def stage(self, df: DataFrame, name: str, evidence: bool = False) -> DataFrame:
        """Write a table that replaces ``name``; ``evidence`` is published even if
        the run fails a check. Returns it as read back."""
        path = f"{self.output}/{RUNS}/{self.run_id}/{name}"
        write_parquet(df, path)
        self.moves.append((name, name, evidence))
        return read_like(df, path)

    def stage_all(self, tables: dict[str, DataFrame], folder: str,
                  evidence: bool = False) -> dict[str, DataFrame]:
        """Write independent tables at the same time."""
        written = side_by_side(
            lambda name: self.stage(tables[name], f"{folder}/{name}", evidence), list(tables))
        return dict(zip(tables, written))

    def stage_partitions(self, df: DataFrame, name: str, by: str,
                         gathered: bool = False) -> DataFrame:
        """Write partitions that replace those of ``name``; others stay.

        The rebalance gathers a partition into few files and splits one that
        holds much of the table; it is left out where ``df`` is ``gathered`` so."""
        path = f"{self.output}/{RUNS}/{self.run_id}/{name}"
        write_parquet(df if gathered else df.hint("rebalance", F.col(by)), path, [by])
        self.moves += [(f"{name}/{part}", f"{name}/{part}", False)
                       for part in folder_names(self.spark, path) if "=" in part]
        return read_like(df, path)

    def stage_rows(self, df: DataFrame, name: str) -> None:
        """Write rows that are added to ``name``."""
        path = f"{self.output}/{RUNS}/{self.run_id}/{name}"
        write_parquet(df, path)
        self.moves += [(f"{name}/{file}", f"{name}/{self.run_id}-{file}", False)
                       for file in folder_names(self.spark, path)]

    def commit(self, failed: bool = False) -> dict:
        """State what is published. A failed run publishes its evidence only."""
        moves = [(source, target) for source, target, evidence in self.moves if evidence or not failed]
        manifest = {
            "version": self.version, "run_id": self.run_id, "failed": failed, "moves": moves,
            "written_by": self.written_by | {target: self.run_id for _, target in moves}}
        write_once(self.spark, manifest_path(self.output, self.version), json.dumps(manifest))
        return manifest

    def publish(self, manifest: dict) -> None:
        apply_manifest(self.spark, self.output, manifest)


def open_release(spark: SparkSession, output: str) -> Release:
    """Start a run: what an earlier one left undone is finished or deleted."""
    last = recover(spark, output)
    known = last or {"version": 0, "written_by": {}}
    return Release(spark, output, f"r{uuid.uuid4().hex}", known["version"] + 1, known["written_by"])
