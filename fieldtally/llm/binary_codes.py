"""Near copies of vectors by binary codes (operator 1).

Unit vectors are centred, turned to their principal axes and then by a rotation
learnt by iterative quantisation, so that the signs lose little; thresholds at
the medians balance the bits (data far off the origin are not centred). One rotation gives at most one bit per axis; more
rotations, learnt from other starts, give the bits the tables need.

Retrieval: codes are cut into substrings, one hash table each (multi-index
hashing). The number of tables follows from the substring length, so that a
pair exactly at the threshold agrees in a whole substring of at least one table
but for a chance of ``MISS``. A pair counts in the first table that brings it
together and in no other, so links are counted without listing them.

Two passes over the tables: the first reads codes only and marks the rows whose
code is near another one's; only those rows get their vectors in the second,
which computes cosines in double precision. Buckets are cut into blocks of about
``BLOCK`` rows, and pairs of blocks are tasks' units, so a hot bucket spreads;
links are never emitted, only counts and a spanning forest per unit.

The rotation is fitted on at most about ``SAMPLE_ROWS`` vectors, chosen by a
hash of vec_id; every vector is indexed.

Defined results: vectors that are null, empty or zero, hold null or non-finite
components, or have a null label link with nothing and are their own component;
only vectors of equal label and length are compared; equal vectors are folded
before the search and count as links of each other; rows with a null vec_id
have no links and no component; repeated rows count as vectors of their own;
extra columns are ignored.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import (
    arrow_schema, map_batches, prepare_python, spanning, staged, whole_units,
)
from fieldtally.llm.components import components

THRESHOLD = 0.98
MISS = 1e-4
SAMPLE_ROWS = 8_000
MOST_SHIFT = 0.3
ROUNDS = 30
BLOCK = 1024
PAIRS = 1 << 17


class Codes:
    """Codes of vectors of one length: ``tables`` substrings of ``width`` bits."""

    def __init__(self, sample: np.ndarray, width: int, threshold: float, seed: int = 7):
        sample = thinned(sample, threshold)
        # A plane through the origin parts a pair with chance angle / pi; one
        # through a point m of the ball with at most 1 / (1 - |m|) times that.
        # Far means would cost too much: such data keep the origin.
        mean = sample.mean(axis=0)
        centre = float(np.linalg.norm(mean)) <= MOST_SHIFT
        self.mean = mean if centre else np.zeros_like(mean)
        flip = math.acos(max(-1.0, min(1.0, threshold))) / math.pi
        flip /= 1 - float(np.linalg.norm(self.mean))
        self.width = width
        self.tables = max(1, math.ceil(math.log(MISS) / math.log1p(-(1 - flip) ** width)))
        # Far outside what pairs at the threshold reach, far inside chance.
        bits = self.tables * width
        self.radius = int(bits * flip + 6 * math.sqrt(bits * flip * (1 - flip))) + 1
        centred = sample - self.mean
        axes = np.linalg.svd(centred.T @ centred)[0]
        random = np.random.default_rng(seed)
        turns = []
        while sum(t.shape[1] for t in turns) < bits:
            turns.append(axes @ self._rotation(centred @ axes, random))
        self.turn = np.hstack(turns)[:, :bits]
        self.cut = np.median(centred @ self.turn, axis=0) if centre else np.zeros(bits)

    @staticmethod
    def _rotation(projected: np.ndarray, random: np.random.Generator) -> np.ndarray:
        """Alternate between the codes of the turned vectors and the rotation
        that brings the vectors closest to their codes."""
        size = projected.shape[1]
        rotation = np.linalg.qr(random.normal(size=(size, size)))[0]
        for _ in range(ROUNDS):
            signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ projected)
            rotation = (left @ right).T
        return rotation

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """A substring per table for each row."""
        bits = (unit - self.mean) @ self.turn >= self.cut
        return (bits.reshape(len(unit), self.tables, self.width)
                @ (1 << np.arange(self.width))).astype(np.uint32)


def thinned(unit: np.ndarray, threshold: float) -> np.ndarray:
    """The rows without a near earlier row: a large group of near copies must
    not draw the mean or the medians into itself."""
    kept = np.ones(len(unit), bool)
    for at in range(0, len(unit), 1000):
        near = unit[at:at + 1000] @ unit[:at + 1000].T >= threshold
        kept[at:at + 1000] = ~np.tril(near, at - 1).any(axis=1)
    return unit[kept]


def unit_rows(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def vectors_of(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, dims)


def usable() -> Column:
    value = F.col("embedding")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(value) > 0)
                      & ~bad & F.exists(value, lambda x: x != 0), F.lit(False))


def fit_codes(classes: DataFrame, threshold: float, sample: int) -> dict[int, Codes]:
    """Codes per vector length, from a bounded sample of distinct vectors."""
    sizes = classes.groupBy("dims").agg(F.count("*").alias("n"), F.max("label_rows").alias("most")).collect()
    codes = {}
    for dims, n, most in sizes:
        part = F.pmod(F.xxhash64("node"), F.lit(1_000_003)) < int(min(1.0, sample / n) * 1_000_003) + 1
        rows = classes.where((F.col("dims") == dims) & part).select("embedding").toArrow()
        values = unit_rows(vectors_of(rows["embedding"].combine_chunks(), dims))
        # About one vector of the largest label per bucket by chance.
        width = max(6, min(20, math.ceil(math.log2(most + 1))))
        codes[dims] = Codes(values, width, threshold)
    return codes


def with_keys(classes: DataFrame, codes: dict[int, Codes]) -> DataFrame:
    """node, label, dims and the substrings of each distinct vector."""
    def work(batch: pa.RecordBatch) -> dict:
        sizes = np.array(batch.column(2).to_pylist())
        keys: list = [None] * len(sizes)
        for dims in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dims)
            found = codes[dims].keys(unit_rows(vectors_of(batch.column(3).take(pa.array(at)), dims)))
            for i, key in zip(at, found):
                keys[i] = key.astype(np.int32)
        return {"node": batch.column(0), "label": batch.column(1), "dims": batch.column(2), "keys": keys}

    return map_batches(classes.select("node", "label", "dims", "embedding"), work,
                       "node long, label long, dims int, keys array<int>")


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of shared buckets under the units ``(unit_a, unit_b)`` of block
    pairs they belong to; ``side`` is 0 for rows of the first block."""
    bucket = ["label", "dims", "place", "key"]
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = (rows.join(sizes, bucket).withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return (placed.withColumn("unit_a", F.least("block", "other"))
            .withColumn("unit_b", F.greatest("block", "other"))
            .withColumn("side", (F.col("block") > F.col("other")).cast("int"))
            .drop("n", "blocks", "block", "other"))


UNIT = ["label", "dims", "place", "key", "unit_a", "unit_b"]


def units(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of a unit side by side, one unit after the other in a task."""
    return (rows.repartition(*UNIT).sortWithinPartitions(*UNIT, "side", "node")
            .select(F.xxhash64(*UNIT).alias("unit"), (F.col("unit_a") == F.col("unit_b")).alias("alone"),
                    "side", "place", "dims", *columns))


def unit_pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs to compare in whole units, in portions of about ``PAIRS``:
    all pairs of a block, or those between two blocks."""
    unit = table["unit"].to_numpy()
    alone = table["alone"].to_numpy()
    side = table["side"].to_numpy()
    begins = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
    sizes = np.diff(np.append(begins, len(unit)))
    row = np.arange(len(unit))
    end = np.repeat(begins + sizes, sizes)
    # In a block a row meets the later rows; between blocks the other side.
    first = np.where(alone, row + 1, end)
    turn = np.repeat(begins + np.add.reduceat(side == 0, begins), sizes)
    first = np.where(~alone & (side == 0), turn, first)
    count = end - first
    total = np.cumsum(count)
    at = 0
    while at < len(row):
        done = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        n = count[at:stop]
        left = np.repeat(row[at:stop], n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at:stop], n)
        yield left, right
        at = stop


def first_together(keys: np.ndarray, place: np.ndarray, left: np.ndarray,
                   right: np.ndarray) -> np.ndarray:
    """Whether no earlier table brings a pair together."""
    return (keys[left] == keys[right]).argmax(axis=1) == place[left]


def mark_near(rows: DataFrame, radii: dict[int, int]) -> DataFrame:
    """node and place of the rows with a near code in their bucket."""
    spark = rows.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame([], "node long, place int").schema
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches):
            # Tables of one length at a time: their keys are equally many.
            dims = table["dims"].to_numpy()
            for size in np.unique(dims).tolist():
                part = table.filter(pa.array(dims == size)).combine_chunks()
                keys = np.array(part["keys"].combine_chunks().flatten().to_numpy()).reshape(len(part), -1)
                near = np.zeros(len(part), bool)
                for left, right in unit_pairs(part):
                    apart = np.bitwise_count(keys[left] ^ keys[right]).sum(axis=1)
                    hit = apart <= radii[size]
                    near[left[hit]] = True
                    near[right[hit]] = True
                yield pa.RecordBatch.from_arrays([
                    pa.array(part["node"].to_numpy()[near], pa.int64()),
                    pa.array(part["place"].to_numpy()[near], pa.int32())], schema=arrow)

    return units(rows, ["node", "keys"]).mapInArrow(run, schema)


def count_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Partial results of units: (a, null, n) adds n links to node a, (a, b, 0)
    is a link of the spanning forest."""
    spark = rows.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame([], "a long, b long, n long").schema
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches):
            dims = table["dims"].to_numpy()
            for size in np.unique(dims).tolist():
                part = table.filter(pa.array(dims == size)).combine_chunks()
                keys = np.array(part["keys"].combine_chunks().flatten().to_numpy()).reshape(len(part), -1)
                unit = unit_rows(vectors_of(part["embedding"].combine_chunks(), size))
                node, place = part["node"].to_numpy(), part["place"].to_numpy()
                copies, counts = part["copies"].to_numpy(), np.zeros(len(part), np.int64)
                forest: list[tuple[int, int]] = []
                for left, right in unit_pairs(part):
                    first = first_together(keys, place, left, right)
                    left, right = left[first], right[first]
                    near = np.einsum("ij,ij->i", unit[left], unit[right]) >= threshold
                    left, right = left[near], right[near]
                    np.add.at(counts, left, copies[right])
                    np.add.at(counts, right, copies[left])
                    forest = spanning(np.array(forest + list(zip(
                        node[left].tolist(), node[right].tolist())), np.int64).reshape(-1, 2))
                hit = np.flatnonzero(counts)
                a = np.concatenate([node[hit], [x for x, _ in forest]]).astype(np.int64)
                b = pa.array([None] * len(hit) + [y for _, y in forest], pa.int64())
                n = np.concatenate([counts[hit], np.zeros(len(forest), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(n)], schema=arrow)

    return units(rows, ["node", "copies", "keys", "embedding"]).mapInArrow(run, schema)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("label").cast("long").alias("label"), "embedding")
    marked = rows.select("vec_id", "label", F.when(usable(), F.col("embedding")).alias("embedding"))
    # The constant stands first: behind the vector its hash would follow from ``one``.
    keyed = marked.select("vec_id", "label", "embedding", F.xxhash64("embedding").alias("one"),
                          F.xxhash64(F.lit(1), "embedding").alias("two"))
    alone = keyed.where("embedding is null")
    fold = ["label", "one", "two"]
    classes = keyed.where("embedding is not null").groupBy(*fold).agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"),
        F.any_value("embedding").alias("embedding"))
    classes = staged(classes.withColumn("dims", F.size("embedding")), "vector_classes")
    labels = classes.groupBy("label", "dims").agg(F.count("*").alias("label_rows"))
    codes = fit_codes(classes.join(labels, ["label", "dims"]), threshold, sample)
    coded = staged(with_keys(classes, codes), "vector_keys")
    buckets = coded.select("node", "label", "dims", "keys", F.posexplode("keys").alias("place", "key"))
    radii = {dims: code.radius for dims, code in codes.items()}
    near = staged(mark_near(in_blocks(buckets), radii).distinct(), "near_rows")
    carried = (near.join(coded, "node").join(classes.select("node", "copies", "embedding"), "node")
               .withColumn("key", F.element_at("keys", F.col("place") + 1)))
    parts = staged(count_links(in_blocks(carried), threshold), "link_counts")
    counts = parts.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    named = components(parts.where("b is not null").select("a", "b"))
    result = (classes.select(*fold, "node", "copies")
              .join(counts.withColumnRenamed("a", "node"), "node", "left").join(named, "node", "left")
              .select(*fold, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("component", "node").alias("component_id")))
    linked = keyed.where("embedding is not null").select("vec_id", *fold).join(result, fold).select(
        "vec_id", "n_links", "component_id")
    single = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(single).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
