"""What the operators share: reading, staging, and Arrow plumbing."""

import gc
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH_BYTES = 4 << 20
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staging_path(spark: SparkSession, name: str) -> str:
    """A path nothing else uses below ``spark.checkpoint.dir``, or below the
    warehouse where that is unset. It goes when the application ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: lost executors never replay what
    stands before, and no later pass computes it again."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def every_pair(index: DataFrame, blocks: DataFrame, fits: str) -> DataFrame:
    """Each row of ``index`` beside each staged block that ``fits`` it. A task takes
    a part of either (a Cartesian product) and reads the blocks itself: they are
    neither copied per part nor broadcast, so no memory grows with their number."""
    return index.join(blocks.hint("shuffle_replicate_nl"), F.expr(fits))


def prepare_python(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (on a cluster: a shared folder, ``--py-files`` or an installed copy) and
    let Arrow batches end at ``BATCH_BYTES``, however long the texts are."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def collector_paused() -> Iterator[None]:
    """No search for cycles while a batch is worked on: plain tables of words and
    ids make none, and walking them takes an eighth of the time."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | dict],
                schema: str | StructType) -> DataFrame:
    """Apply ``work`` to each Arrow batch; it returns columns by name."""
    spark = df.sparkSession
    prepare_python(spark)
    fields = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    arrow = arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                with collector_paused():
                    columns = work(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], f.type, from_pandas=False)
                     if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type)
                     for f in arrow], schema=arrow)
                del columns
        # a worker lives on for other stages; what this one held goes back
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, fields)


def arrow_schema(fields: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(fields)


def index_words(data: np.ndarray, inside: np.ndarray, begins: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of ``data`` and the place of every word among these.
    ``inside`` marks the bytes of words, ``begins`` the first byte of each."""
    letters = data[inside]
    offsets = np.append(np.flatnonzero(begins[inside]), len(letters))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    found = words.dictionary_encode()
    _, cuts, distinct = found.dictionary.buffers()
    cuts = np.frombuffer(cuts, np.int64, len(found.dictionary) + 1).tolist() if len(words) else [0]
    distinct = bytes(distinct or b"")
    return [distinct[a:b] for a, b in zip(cuts, cuts[1:])], found.indices.to_numpy()


def whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole units: the last, open unit waits for the next batch."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        here = pa.Table.from_batches([batch])
        here = here if rest is None else pa.concat_tables([rest, here])
        unit = here["unit"].to_numpy()
        cut = int(np.flatnonzero(unit == unit[-1])[0])
        if cut:
            yield here.slice(0, cut).combine_chunks()
        rest = here.slice(cut)
    if rest is not None:
        yield rest.combine_chunks()


def spanning(links: np.ndarray, known: dict[int, int] | None = None) -> list[tuple[int, int]]:
    """Links that connect what all the links connect; ``known`` gives vertices
    the component they already have."""
    parent: dict[int, int] = dict(known or {})

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    kept = []
    for a, b in links.tolist():
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept
