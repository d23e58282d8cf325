"""Hard negatives by coordinate pruning over length buckets (operator 11).

Components become integers, floor(256 x). Rows are range-partitioned by vector
length, so that a block of the index is a bucket of rows of nearly equal length
(and, inside, in the order of their labels; the range partitioning cuts a label or
a length that holds much of the table). A bucket keeps, per coordinate, its rows in
the order of their direction's value there. If a score must lie between two
bounds, the angle between row and anchor does, and so does every coordinate of
the row: for the anchor's focus coordinates (the largest of its direction) the
feasible range is a slice of the sorted list. The slices are intersected and what
is left is scored exactly. Bounds rise first: a few rows of the bucket, scored
ahead, say what the best of the bucket must reach at least.

The first pass finds each anchor's positives, rows of its label. The second finds,
for each positive, the best rows of other labels whose score lies in the band of
the positive's. Anchors travel in blocks and meet each bucket once. A bucket gives
at most k rows per anchor and positive.

Defined results: rows with a null id, label or vector, an empty vector, or any null
or non-finite component take no part; equal rows count once, different rows
under one id are rows each, but never each other's positives or negatives; an
anchor id with several rows is answered for the smallest label and vector; vectors
of another length than the anchor's are no candidates; a score of a negative
positive leaves no band, so such a positive has no negatives; a component or score
beyond a long is an error; empty tables give no rows; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import arrow_schema, every_pair, map_batches, prepare_python, staged

SCALE = 256
BLOCK_ROWS = 1 << 14
QUERY_ROWS = 128
FOCUS = 6
SEEDS = 256
#: A bucket's longest row is at most so many times as long as its shortest.
BUCKET_RATIO = 1.25
#: Far above the rounding of a cosine, far below what would cost pruning.
SLACK = 1e-9
LARGEST = 2.0 ** 62
#: No bound.
NONE_BELOW, NONE_ABOVE = -(1 << 63), (1 << 63) - 1

BLOCK = "dims int, labels binary, vec_ids binary, kind string, vectors binary, orders binary"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding (double) of the rows that take part."""
    embedding = F.transform("embedding", lambda x: x.cast("double"))
    return vectors.where("vec_id is not null and label is not null and size(embedding) > 0").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        embedding.alias("embedding"),
    ).where(F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))


def whole_numbers(batch: pa.Array) -> np.ndarray:
    """Integer components of vectors of one length, as rows."""
    values = np.floor(batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) * SCALE)
    if len(values) and np.abs(values).max() >= LARGEST:
        raise ValueError("A component is too large for exact scores")
    return values.astype(np.int64)


def smallest_kind(values: np.ndarray) -> np.dtype:
    most = max(abs(int(values.min())), abs(int(values.max())))
    return next(np.dtype(f"i{size}") for size in (2, 4, 8) if most < 1 << (8 * size - 1))


def build_buckets(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per bucket of at most ``block_rows`` rows."""
    spark = rows.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame([], BLOCK).schema
    arrow = arrow_schema(schema)
    squares = F.aggregate(
        "embedding", F.lit(0.0), lambda total, x: total + F.pow(F.floor(x * SCALE).cast("double"), F.lit(2)))
    keyed = rows.withColumn("dims", F.size("embedding")).withColumn(
        "bucket", F.coalesce(F.floor(F.log(squares) / (2 * np.log(BUCKET_RATIO))), F.lit(-1)))
    keys = ["dims", "bucket", "label", "vec_id"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = keyed.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys, "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, last = 0, None

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            vectors = whole_numbers(table["embedding"].chunk(0))
            ids, labels = (table[name].to_numpy().astype(np.int64) for name in ("vec_id", "label"))
            direction = unit(vectors.astype(float))
            orders = np.argsort(direction, axis=0, kind="stable").T.astype(np.uint16)
            kind = smallest_kind(vectors)
            return pa.RecordBatch.from_pylist([{
                "dims": vectors.shape[1],
                "labels": labels.tobytes(), "vec_ids": ids.tobytes(), "kind": kind.str,
                "vectors": vectors.astype(kind).tobytes(), "orders": orders.tobytes()}], schema=arrow)

        for batch in batches:
            kept = []
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                same = last is not None and row == last[:4] and batch.column(4)[i].equals(last[4])
                if not same:
                    kept.append(i)
                    last = (*row, batch.column(4)[i])
            batch = batch.take(pa.array(kept, pa.int64()))
            groups = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            cuts = np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(axis=0)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                while begin < end:
                    here = [batch.column(c)[begin].as_py() for c in (0, 1)]
                    if held and (count >= block_rows or here != [held[0].column(c)[0].as_py() for c in (0, 1)]):
                        yield close()
                        held, count = [], 0
                    size = min(end - begin, block_rows - count)
                    held.append(batch.slice(begin, size))
                    count += size
                    begin += size
        if held:
            yield close()

    return sorted_rows.select("dims", "bucket", "label", "vec_id", "embedding").mapInArrow(run, schema)


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


class Bucket:
    """Rows of nearly equal length with a sorted list per coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, orders: np.ndarray):
        self.ids, self.labels, self.vectors, self.orders = ids, labels, vectors, orders
        whole = vectors.astype(float)
        lengths = np.linalg.norm(whole, axis=1)
        self.shortest, self.longest = float(lengths.min()), float(lengths.max())
        self.direction = unit(whole)
        self.most = int(np.abs(vectors.astype(np.int64)).max())
        self._whole, self._lists = whole, {}

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        found = self._lists.get(coordinate)
        if found is None:
            order = self.orders[coordinate].astype(np.int64)
            found = self._lists[coordinate] = order, self.direction[order, coordinate]
        return found

    def scores(self, rows: np.ndarray | slice, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products: in doubles where they hold every sum."""
        bound = len(anchor) * self.most * int(np.abs(anchor).max())
        if bound < 1 << 53:
            return (self._whole[rows] @ anchor.astype(float)).astype(np.int64)
        vectors = self.vectors[rows].astype(np.int64)
        if bound < 1 << 63:
            return vectors @ anchor
        exact = vectors.astype(object) @ anchor.astype(object)
        if any(not NONE_BELOW <= score <= NONE_ABOVE for score in exact):
            raise ValueError("A score does not fit a long")
        return exact.astype(np.int64)

    def candidates(self, anchor: np.ndarray, low: int, high: int, focus: int = FOCUS) -> np.ndarray:
        """Rows whose score may lie in [low, high]: none is lost."""
        size = float(np.linalg.norm(anchor.astype(float)))
        if low > high or not size or not self.longest:
            return np.arange(len(self.ids) if low <= 0 <= high else 0)
        nearest = min(1.0, high / (size * (self.shortest if high > 0 else self.longest)) + SLACK)
        farthest = max(-1.0, low / (size * (self.longest if low > 0 else self.shortest)) - SLACK)
        if farthest > 1 or nearest < -1:
            return np.arange(0)
        least, most = np.arccos(nearest), np.arccos(min(1.0, farthest))
        direction = unit(anchor.astype(float))
        slices = []
        for coordinate in np.argsort(-np.abs(direction))[:focus].tolist():
            axis = np.arccos(np.clip(direction[coordinate], -1, 1))
            # the row's angle to the axis, by the triangles of axis, anchor and row
            top = np.cos(max(0.0, axis - most, least - axis)) + SLACK
            bottom = np.cos(min(np.pi, axis + most, 2 * np.pi - axis - least)) - SLACK
            order, values = self.sorted_list(coordinate)
            begin = int(np.searchsorted(values, bottom, "left"))
            slices.append((int(np.searchsorted(values, top, "right")) - begin, begin, coordinate, bottom, top))
        slices.sort()
        count, begin, coordinate, _, _ = slices[0]
        rows = self.sorted_list(coordinate)[0][begin:begin + max(0, count)]
        for count, _, coordinate, bottom, top in slices[1:]:
            if count < len(self.ids):
                values = self.direction[rows, coordinate]
                rows = rows[(values >= bottom) & (values <= top)]
        return rows


def best_rows(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores, then smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def kth_best(scores: np.ndarray, k: int) -> int:
    """The k-th highest score; no bound if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else NONE_BELOW


def bucket_positives(bucket: Bucket, anchor_id: int, label: int, anchor: np.ndarray, k: int):
    """ids and scores of the k best rows of the anchor's label."""
    begin, end = np.searchsorted(bucket.labels, [label, label + 1])
    own = np.arange(begin, min(end, begin + SEEDS))
    seeds = bucket.scores(own[bucket.ids[own] != anchor_id], anchor) if len(own) else np.zeros(0, np.int64)
    if not len(seeds) and end - begin <= SEEDS:
        return bucket.ids[:0], seeds
    rows = bucket.candidates(anchor, kth_best(seeds, k), NONE_ABOVE)
    rows = rows[(rows >= begin) & (rows < end)]
    rows = rows[bucket.ids[rows] != anchor_id]
    scores = bucket.scores(rows, anchor)
    best = best_rows(bucket.ids[rows], scores, k)
    return bucket.ids[rows[best]], scores[best]


def bucket_negatives(bucket: Bucket, anchor_id: int, label: int, anchor: np.ndarray,
                     bands: list[tuple[int, int]], k: int):
    """Per band (lowest and highest score) ids and scores of the k best rows of
    other labels."""
    others = np.arange(0, len(bucket.ids), max(1, len(bucket.ids) // SEEDS))
    others = others[(bucket.labels[others] != label) & (bucket.ids[others] != anchor_id)]
    seeds = bucket.scores(others, anchor) if len(others) else np.zeros(0, np.int64)
    bounds = [max(low, kth_best(seeds[(seeds >= low) & (seeds <= high)], k)) for low, high in bands]
    rows = bucket.candidates(anchor, min(bounds), max(high for _, high in bands))
    rows = rows[(bucket.labels[rows] != label) & (bucket.ids[rows] != anchor_id)]
    scores = bucket.scores(rows, anchor)
    for bound, (_, high) in zip(bounds, bands):
        held = np.flatnonzero((scores >= bound) & (scores <= high))
        best = held[best_rows(bucket.ids[rows[held]], scores[held], k)]
        yield bucket.ids[rows[best]], scores[best]


def band_of(score: int, least: int, most: int) -> tuple[int, int]:
    """The scores s with least * score <= 100 * s <= most * score."""
    return -((-least * score) // 100), (most * score) // 100


def anchor_blocks(anchors: DataFrame, size: int = QUERY_ROWS) -> DataFrame:
    """Anchors (with their positives, if there) of one length, packed."""
    spark = anchors.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame([], "anchor_dims int, anchors binary, positives binary").schema
    arrow = arrow_schema(schema)
    with_positives = "positives" in anchors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column(2)])
            for dims in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dims)
                for at in range(0, len(rows), size):
                    part = batch.take(pa.array(rows[at:at + size]))
                    head = np.stack([part.column(0).to_numpy(), part.column(1).to_numpy()], axis=1)
                    values = np.hstack([head, whole_numbers(part.column(2))]).astype(np.int64)
                    known = [(i, p["place"], p["positive_id"], p["positive_score"])
                             for i, found in enumerate(part.column(3).to_pylist()) for p in found
                             ] if with_positives else []
                    yield pa.RecordBatch.from_pylist([{
                        "anchor_dims": dims, "anchors": values.tobytes(),
                        "positives": np.array(known, np.int64).tobytes()}], schema=arrow)

    columns = ["vec_id", "label", "embedding"] + (["positives"] if with_positives else [])
    return anchors.select(*columns).mapInArrow(run, schema)


def meet(index: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every bucket beside every block of anchors of its length."""
    return every_pair(index, blocks, "dims = anchor_dims").select(
        "dims", "labels", "vec_ids", "kind", "vectors", "orders", "anchors", "positives")


def each_pair(batch: pa.RecordBatch) -> Iterator[tuple[Bucket, np.ndarray, np.ndarray]]:
    """A bucket, and the anchors and positives of the block beside it."""
    for i in range(batch.num_rows):
        dims, labels, ids, kind, vectors, orders, anchors, positives = (
            batch.column(c)[i].as_py() for c in range(8))
        rows = len(ids) // 8
        bucket = Bucket(np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64),
                        np.frombuffer(vectors, kind).reshape(rows, dims),
                        np.frombuffer(orders, np.uint16).reshape(dims, rows))
        yield (bucket, np.frombuffer(anchors, np.int64).reshape(-1, dims + 2),
               np.frombuffer(positives, np.int64).reshape(-1, 4))


def find_positives(index: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """anchor_id, place (from 0), positive_id, positive_score."""
    def work(batch: pa.RecordBatch) -> dict:
        out: tuple[list, list, list] = ([], [], [])
        for bucket, block, _ in each_pair(batch):
            for row in block:
                found, scores = bucket_positives(bucket, int(row[0]), int(row[1]), row[2:], k)
                out[0].append(np.full(len(found), row[0]))
                out[1].append(found)
                out[2].append(scores)
        return dict(zip(("anchor_id", "positive_id", "positive_score"), map(np.concatenate, out)))

    found = map_batches(meet(index, staged(anchor_blocks(anchors), "anchors")), work,
                        "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).select(
        "anchor_id", (F.col("nth") - 1).alias("place"), "positive_id", "positive_score")


def find_negatives(index: DataFrame, anchors: DataFrame, k: int, least: int, most: int) -> DataFrame:
    names = ("anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")

    def work(batch: pa.RecordBatch) -> dict:
        out: list[np.ndarray] = [np.zeros((0, 6), np.int64)]
        for bucket, block, positives in each_pair(batch):
            for i in np.unique(positives[:, 0]).tolist():
                row, known = block[i], positives[positives[:, 0] == i]
                bands = [band_of(score, least, most) for score in known[:, 3].tolist()]
                found = bucket_negatives(bucket, int(row[0]), int(row[1]), row[2:], bands, k)
                for positive, (ids, scores) in zip(known, found):
                    head = np.array([row[0], *positive[1:]])
                    out.append(np.column_stack([np.tile(head, (len(ids), 1)), ids, scores]))
        return dict(zip(names, np.concatenate(out).T))

    found = map_batches(meet(index, staged(anchor_blocks(anchors), "anchors")), work,
                        ", ".join(f"{name} long" for name in names))
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10,
         least: int = 30, most: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative's score is ``least`` to ``most`` hundredths of the positive's."""
    index = staged(build_buckets(usable(vectors)), "buckets")
    one = usable(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
    known = staged(one.select("vec_id", "row.label", "row.embedding"), "anchor_rows")
    found = staged(find_positives(index, known, positives), "positives")
    # at most ``positives`` of them an anchor
    listed = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("positives"))
    return find_negatives(index, known.hint("merge").join(listed, "vec_id"), negatives, least, most).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
