"""Exact top-k inner products on a bit-sliced index (operator 5).

Components become integers, floor(1024 x). The index holds blocks of rows; for
each component and each bit of it (offset by the block's minimum) one bitmap
over the rows of the block. A query's score is a sum of bitmaps shifted by the
bits of its own components (complements for negative ones), added by
carry-save adders on whole bitmaps. Only the high slices of the components are
added; what the low ones can add at most is known. From the most significant
sum slice downward, the k-th highest sum is found by counting bits; rows
within the possible rest of it are the boundary, and their scores are computed
exactly. So the result is exact whatever the cut.

Queries travel in blocks and meet every index block once. Each pair of blocks gives
at most k rows per query.

Defined results: vectors that are null or empty, or hold null or non-finite
components, take no part; where a score could pass a long (dimensions times the
largest component of the query and of the block) it is an error; vectors of other
lengths than the query's are no candidates; rows with the query's vec_id are its
own; of a query id with several usable rows the smallest vector counts, repeated
candidate rows stay; null vec_ids take no part; with fewer than k candidates all
are returned; extra columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import arrow_schema, every_pair, map_batches, prepare_python, staged

SCALE = 1024
BLOCK_ROWS = 1 << 14
QUERY_ROWS = 128
LOW_SLICES = 4
LARGEST = 2.0 ** 40
INDEX = "dims int, offset long, bits int, n_rows int, vec_ids binary, slices binary"


def quantised(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """vec_ids and integer components of the usable rows, by vector length."""
    ids, lists = batch.column(0), batch.column(1)
    sizes = np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()])
    known = np.array(ids.is_valid())
    for dims in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero((sizes == dims) & known)
        values = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        values = np.asarray(values, float).reshape(len(rows), dims)
        fine = np.isfinite(values).all(axis=1)
        values = np.floor(values[fine] * SCALE)
        if len(values) and np.abs(values).max() > LARGEST:
            raise ValueError("A component is too large for exact scores")
        if len(values):
            yield ids.take(pa.array(rows[fine])).to_numpy(), values.astype(np.int64)


def pack_slices(values: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Offset, bit count and bitmaps [component, bit, word] of a block."""
    rows, dims = values.shape
    offset = int(values.min())
    raised = (values - offset).astype(np.uint64)
    bits = max(1, int(raised.max()).bit_length())
    words = -(-rows // 64)
    slices = np.zeros((dims, bits, words * 8), np.uint8)
    for bit in range(bits):
        plane = ((raised >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8).T
        packed = np.packbits(plane, axis=1, bitorder="little")
        slices[:, bit, :packed.shape[1]] = packed
    return offset, bits, slices.view(np.uint64)


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block of at most ``block_rows`` rows."""
    spark = vectors.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame([], INDEX).schema
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def close(dims: int) -> pa.RecordBatch:
            ids, values = (np.concatenate(x) for x in held.pop(dims))
            offset, bits, slices = pack_slices(values)
            return pa.RecordBatch.from_pylist([{
                "dims": dims, "offset": offset, "bits": bits, "n_rows": len(ids),
                "vec_ids": ids.astype(np.int64).tobytes(), "slices": slices.tobytes()}], schema=arrow)

        for batch in batches:
            for ids, values in quantised(batch):
                dims = values.shape[1]
                for at in range(0, len(ids), block_rows):
                    parts = held.setdefault(dims, ([], []))
                    parts[0].append(ids[at:at + block_rows])
                    parts[1].append(values[at:at + block_rows])
                    if sum(map(len, parts[0])) >= block_rows:
                        yield close(dims)
        for dims in list(held):
            yield close(dims)

    return vectors.select("vec_id", "embedding").mapInArrow(run, schema)


def query_blocks(queries: DataFrame, size: int = QUERY_ROWS) -> DataFrame:
    """Queries of one length, packed by at most ``size``."""
    spark = queries.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame([], "query_dims int, query_ids binary, query_values binary").schema
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, values in quantised(batch):
                for at in range(0, len(ids), size):
                    yield pa.RecordBatch.from_pylist([{
                        "query_dims": values.shape[1],
                        "query_ids": ids[at:at + size].astype(np.int64).tobytes(),
                        "query_values": values[at:at + size].tobytes()}], schema=arrow)

    # unusable rows go before an id's rows are made one
    usable = queries.where("vec_id is not null and size(embedding) > 0").where(F.forall(
        "embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
    one = usable.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return one.select("vec_id", "embedding").mapInArrow(run, schema)


def add_bitmaps(columns: dict[int, list[np.ndarray]]) -> dict[int, np.ndarray]:
    """Sum bitmaps by weight: carry-save adders turn three bitmaps of a weight
    into one of it and one of the next, until each weight has one."""
    result: dict[int, np.ndarray] = {}
    pending = {weight: np.concatenate(parts) for weight, parts in columns.items()}
    while pending:
        weight = min(pending)
        stack, carried = pending.pop(weight), []
        while len(stack) > 1:
            third = len(stack) // 3
            if third:
                a, b, c = stack[:third], stack[third:2 * third], stack[2 * third:3 * third]
                half = a ^ b
                carried.append((a & b) | (half & c))
                stack = np.concatenate([half ^ c, stack[3 * third:]])
            else:
                carried.append(stack[:1] & stack[1:])
                stack = stack[:1] ^ stack[1:]
        result[weight] = stack[0]
        if carried:
            above = pending.get(weight + 1)
            pending[weight + 1] = np.concatenate(carried if above is None else [above, *carried])
    return result


def count_bits(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_highest(sums: dict[int, np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th highest sum among the set rows, slice by slice downward."""
    equal, left, found = rows, k, 0
    for weight in sorted(sums, reverse=True):
        high = equal & sums[weight]
        n = count_bits(high)
        if n >= left:
            equal, found = high, found + (1 << weight)
        else:
            left -= n
            equal = equal & ~sums[weight]
    return found


def at_least(sums: dict[int, np.ndarray], rows: np.ndarray, bound: int) -> np.ndarray:
    """The set rows whose sum is at least ``bound``."""
    if bound <= 0:
        return rows
    if bound >> (max(sums) + 1):
        return rows & np.uint64(0)
    above, equal = rows & np.uint64(0), rows
    for weight in range(max(sums), -1, -1):
        bit = sums.get(weight)
        if bound >> weight & 1:
            equal = equal & bit if bit is not None else equal & np.uint64(0)
        elif bit is not None:
            above |= equal & bit
            equal = equal & ~bit
    return above | equal


def block_topk(query: np.ndarray, offset: int, slices: np.ndarray, ids: np.ndarray,
               rows: np.ndarray, k: int, low: int = LOW_SLICES) -> tuple[np.ndarray, np.ndarray]:
    """vec_ids and scores of the k best set rows of a block."""
    dims, bits, _ = slices.shape
    low = min(low, bits - 1)
    if count_bits(rows) > k:
        size = np.abs(query)
        columns: dict[int, list[np.ndarray]] = {}
        for negative in (False, True):
            side = (query < 0) == negative
            for bit in range(int(size.max()).bit_length()):
                chosen = np.flatnonzero(side & (size >> bit & 1 == 1))
                if len(chosen):
                    part = slices[chosen, low:]
                    part = ~part if negative else part
                    for j in range(bits - low):
                        columns.setdefault(bit + j, []).append(part[:, j])
        if columns:
            sums = add_bitmaps(columns)
            # A sum counts 2**low each; the low slices add up to less than this.
            rest = int(size.sum()) * ((1 << low) - 1)
            bound = kth_highest(sums, rows, k) - -(-rest >> low) - 1
            rows = at_least(sums, rows, bound)
    at = np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))
    word, bit = at // 64, (at % 64).astype(np.uint64)
    values = np.zeros((dims, len(at)), np.int64)
    for j in range(bits):
        values += ((slices[:, j, word] >> bit) & np.uint64(1)).astype(np.int64) << j
    scores = query @ (values + offset)
    best = np.lexsort((ids[at], -scores))[:k]
    return ids[at[best]], scores[best]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best rows."""
    spark = vectors.sparkSession
    index, blocks = staged(build_index(vectors), "slices"), staged(query_blocks(queries), "queries")
    # one file may hold many blocks: they are dealt anew, a few tasks a core
    parts = max(1, min(index.count(), 3 * spark.sparkContext.defaultParallelism))
    joined = every_pair(index.repartition(parts), blocks, "dims = query_dims").select(
        "dims", "offset", "bits", "vec_ids", "slices", "query_ids", "query_values")

    def work(batch: pa.RecordBatch) -> dict:
        out: tuple[list, list, list] = ([], [], [])
        for i in range(batch.num_rows):
            dims, offset, bits, vec_ids, raw, query_ids, query_values = (
                batch.column(c)[i].as_py() for c in range(7))
            ids = np.frombuffer(vec_ids, np.int64)
            slices = np.frombuffer(raw, np.uint64).reshape(dims, bits, -1)
            queries_here = np.frombuffer(query_values, np.int64).reshape(-1, dims)
            largest = max(abs(offset), abs(offset + (1 << bits)))
            if dims * largest * int(np.abs(queries_here).max()) >= 1 << 63:
                raise ValueError("A score could pass a long")
            valid = np.zeros(slices.shape[2] * 64, np.uint8)
            for query_id, query in zip(np.frombuffer(query_ids, np.int64), queries_here):
                valid[:len(ids)] = ids != query_id
                rows = np.packbits(valid, bitorder="little").view(np.uint64)
                found, scores = block_topk(query, offset, slices, ids, rows, k)
                out[0].append(np.full(len(found), query_id))
                out[1].append(found)
                out[2].append(scores)
        return dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, out)))

    best = map_batches(joined, work, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
