"""Near copies by consistent weighted sampling (operator 3).

A document is the weighted set of its five-word shingles; the weight is
(1 + ln tf) times a document frequency factor. Frequencies are counted over all
documents in a fixed number of hash buckets. The factor lies between 1 and
1 + ``IDF_SHARE``: passages that many documents share weigh less, and a large
group of copies cannot make its own text worthless.

Sketch: improved consistent weighted sampling, bin by bin. Each shingle falls
into one of ``BINS`` bins by its hash, each bin keeps the sample (shingle,
level) with the smallest key, and an empty bin copies a full one by a hash walk,
so a document costs one draw per shingle. Bands of ``ROWS`` bins are bucket keys.

Links have a weighted Jaccard similarity of at least ``threshold`` and are
always computed from whole texts. Within a bucket, first all documents are held
against the smallest one, then those without a link against the smallest of
them. Only documents that are then in different components of one bucket are
compared pair by pair, in blocks of about ``BLOCK`` members: pairs of blocks are
the units of tasks, and of their links only those that connect something new
are emitted. A bucket whose documents are all one component costs one comparison
per document.

Result: one class per component; its id is the smallest doc_id.

Defined results: words are runs of letters, digits and underscores in lower
case; a text of one to four words is one shingle; equal texts are copies, also
those without words; a text without words has no other link; a null text stays
alone; rows that share a doc_id are one document; a null doc_id has a class
only with rows of the same text and gets the class id of that text, or null;
extra columns are ignored.
"""

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import (
    arrow_schema, index_words, map_batches, prepare_python, spanning, staged, whole_units,
)
from fieldtally.llm.components import components

SHINGLE = 5
BUCKETS = 1 << 16
IDF_SHARE = 0.25
BINS, ROWS = 96, 4
THRESHOLD = 0.8
BLOCK_SHINGLES = 200_000
BLOCK_LETTERS = 1 << 20
BLOCK, LEVELS = 256, 4096
WORD = re.compile(r"\w+")
# Of one-byte characters: those of words in lower case, a space for any other.
LATIN = bytes([ord(chr(b).lower()) if WORD.match(chr(b)) else 32 for b in range(256)])
U = np.uint64
ODD = [U(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit number for each number."""
    x = x + ODD[0]
    x = (x ^ (x >> U(30))) * ODD[1]
    x = (x ^ (x >> U(27))) * ODD[2]
    return x ^ (x >> U(31))


def join_words(words: list[np.ndarray]) -> np.ndarray:
    """Hashes of shingles, from those of their first, second, ... words."""
    joined = np.full(len(words[0]), len(words), U)
    for hashes in words:
        joined = (joined ^ hashes) * ODD[1]
        joined ^= joined >> U(29)
    return mix(joined)


def hash_words(texts: list[bytes], latin: bool) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the number of words up to each text's end."""
    whole = b"".join([b" ", b" ".join(texts), b" "])
    data = np.frombuffer(whole.translate(LATIN) if latin else whole, np.uint8)
    inside = data != 32
    begins = np.append(False, ~inside[:-1]) & inside
    words, places = index_words(data, inside, begins)
    hashes = np.fromiter((xxhash.xxh64_intdigest(word.decode("latin-1") if latin and not word.isascii() else word)
                          for word in words), U, len(words))
    return hashes[places], np.searchsorted(np.flatnonzero(begins), np.cumsum([len(t) + 1 for t in texts]))


def shingle_sets(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For some of the texts, until all that are not empty are done: their
    numbers, the hashes of each one's distinct shingles, ascending, how often
    each stands, and where each text's shingles begin and the last one's end."""
    latin, wide, letters = {}, {}, 0
    for i, text in enumerate(texts):
        if text:
            try:
                latin[i] = text.encode("latin-1")
            except UnicodeEncodeError:
                wide[i] = " ".join(WORD.findall(text.lower())).encode()
            letters += len(text)
        if letters >= BLOCK_LETTERS or i + 1 == len(texts):
            if latin:
                yield sets_of_block(latin, True)
            if wide:
                yield sets_of_block(wide, False)
            latin, wide, letters = {}, {}, 0


def sets_of_block(texts: dict[int, bytes], latin: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``shingle_sets`` gives, for texts that are held at once."""
    hashes, upto = hash_words(list(texts.values()), latin)
    starts = np.append(0, upto[:-1])
    n = upto - starts
    found = np.where(n, np.maximum(n - SHINGLE + 1, 1), 0)
    bounds = np.append(0, np.cumsum(found))
    drawn = np.empty(bounds[-1], U)
    if len(hashes) >= SHINGLE:
        inner = np.ones(len(hashes), bool)
        for i in range(1, SHINGLE):
            inner[(upto - i)[n >= i]] = False
        windows = len(hashes) - SHINGLE + 1
        joined = join_words([hashes[i:i + windows] for i in range(SHINGLE)])
        drawn[np.repeat(n >= SHINGLE, found)] = joined[inner[:windows]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(n == size)
        drawn[bounds[short]] = join_words([hashes[starts[short] + i] for i in range(size)])
    for a, b in zip(bounds, bounds[1:]):
        drawn[a:b].sort()
    first = changes(drawn, bounds)
    return (np.array(list(texts)), drawn[first], np.diff(np.append(first, len(drawn))),
            np.searchsorted(first, bounds))


def changes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where a text begins or a value differs from the one before."""
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    return np.flatnonzero(first)


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, ascending, and how often each stands."""
    for _, hashes, counts, _ in shingle_sets([text]):
        return hashes, counts
    return np.zeros(0, U), np.zeros(0, np.int64)


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U(48)).astype(np.int64)


def document_frequency(texts: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts hold a shingle of each hash bucket: sums over all texts,
    at most ``BUCKETS`` rows in the end."""
    spark = texts.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame([], "bucket int, n long").schema
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            total += sum(map(bool, texts))
            for _, hashes, _, bounds in shingle_sets(texts):
                buckets = bucket_of(hashes)
                counts += np.bincount(buckets[changes(buckets, bounds)], minlength=BUCKETS)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.append(hit, -1), pa.int32()), pa.array(np.append(counts[hit], total))],
            schema=arrow)
        pa.default_memory_pool().release_unused()

    rows = (texts.select("text").mapInArrow(run, schema)
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    found = dict(zip(rows["bucket"].to_pylist(), rows["n"].to_pylist()))
    counts = np.zeros(BUCKETS, np.int64)
    total = found.pop(-1, 0)
    counts[list(found)] = list(found.values())
    return total, counts


def inverse_frequency(total: int, counts: np.ndarray) -> np.ndarray:
    """1 for a bucket in every text, 1 + ``IDF_SHARE`` for one in a single."""
    rare = np.log(max(total, 2) / np.maximum(counts, 1)) / math.log(max(total, 2))
    return (1 + IDF_SHARE * np.clip(rare, 0, 1)).astype(np.float32)


def weights(hashes: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return ((1 + np.log(counts)) * idf[bucket_of(hashes)]).astype(np.float32)


def samples(owner: np.ndarray, hashes: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """The sample of every bin of every document: docs x ``BINS`` numbers.
    ``owner`` says which document (0, 1, ...) has a shingle; each has one."""
    def uniform(k: int) -> np.ndarray:
        return ((mix(hashes ^ mix(np.array([k], U))) >> U(11)).astype(float) + 0.5) * 2.0 ** -53

    rate = -np.log(uniform(1) * uniform(2))
    level = np.floor(np.log(weight) / rate + (shift := uniform(5)))
    key = np.log(-np.log(uniform(3) * uniform(4))) - rate * (level - shift) - rate
    place = owner * BINS + (mix(hashes ^ ODD[0]) % U(BINS)).astype(np.int64)
    least = np.full(docs * BINS, np.inf)
    np.minimum.at(least, place, key)
    order = np.flatnonzero(key == least[place])
    order = order[np.lexsort((hashes[order], place[order]))]
    first = order[np.flatnonzero(np.diff(place[order], prepend=-1))]
    found = np.zeros(docs * BINS, U)
    found[place[first]] = mix(hashes[first] ^ mix(level[first].astype(np.int64).view(U)))
    full = np.zeros(docs * BINS, bool)
    full[place[first]] = True
    empty, step = np.flatnonzero(~full), 0
    while len(empty):
        step += 1
        walk = (mix((empty % BINS + step * BINS).astype(U)) % U(BINS)).astype(np.int64)
        donor = empty // BINS * BINS + walk
        hit = full[donor]
        found[empty[hit]] = found[donor[hit]]
        empty = empty[~hit]
    return found.reshape(docs, BINS)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One number per band: its bins and its place."""
    keys = np.broadcast_to(np.arange(BINS // ROWS).astype(U), (len(found), BINS // ROWS)).copy()
    for row in range(ROWS):
        keys = mix(keys ^ found[:, row::ROWS])
    return keys.view(np.int64)


def sketch(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, a key of the text, and its band keys (none without words)."""
    def work(batch: pa.RecordBatch) -> dict:
        texts = batch.column(1).to_pylist()
        bands: list = [[] for _ in texts]
        for numbers, hashes, counts, bounds in shingle_sets(texts):
            weight, sizes = weights(hashes, counts, idf), np.diff(bounds)
            blocks = np.flatnonzero(np.diff(bounds[:-1] // BLOCK_SHINGLES)) + 1
            for some in np.split(np.arange(len(numbers)), blocks):
                a, b, held = bounds[some[0]], bounds[some[-1] + 1], some[sizes[some] > 0]
                owner = np.repeat(np.arange(len(held)), sizes[held])
                keys = band_keys(samples(owner, hashes[a:b], weight[a:b], len(held)))
                for i, key in zip(numbers[held], keys):
                    bands[i] = key
        return {"doc_id": batch.column(0), "bands": bands,
                "text_key": [xxhash.xxh3_128_digest(text.encode()) for text in texts]}

    return map_batches(docs.select("doc_id", "text").where("text is not null"), work,
                       "doc_id long, text_key binary, bands array<long>")


def vectors(docs: DataFrame, nodes: DataFrame, idf: np.ndarray) -> DataFrame:
    """node, hashes and weights of the documents in ``nodes``."""
    def work(batch: pa.RecordBatch) -> dict:
        parts = [(b"", b"")] * batch.num_rows
        for numbers, hashes, counts, bounds in shingle_sets(batch.column(1).to_pylist()):
            weight = weights(hashes, counts, idf)
            for i, a, b in zip(numbers, bounds, bounds[1:]):
                parts[i] = hashes[a:b].tobytes(), weight[a:b].tobytes()
        return {"node": batch.column(0), "hashes": [h for h, _ in parts], "weights": [w for _, w in parts]}

    texts = docs.select(F.col("doc_id").alias("node"), "text").where("text is not null")
    chosen = texts.join(nodes.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    return map_batches(chosen, work, "node long, hashes binary, weights binary")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (ascending hashes, weights)."""
    (small, ws), (large, wl) = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    if not len(small):
        return 0.0
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    same = large[at] == small
    both = np.minimum(ws[same], wl[at[same]]).sum(dtype=float)
    return float(both / (ws.sum(dtype=float) + wl.sum(dtype=float) - both))


def measure(pairs: DataFrame, vecs: DataFrame) -> DataFrame:
    """``a``, ``b`` with the similarity of each pair. The side that stars share
    is joined last: adaptive execution splits a hot one."""
    right = vecs.select(F.col("node").alias("b"), F.col("hashes").alias("hb"), F.col("weights").alias("wb"))
    left = vecs.select(F.col("node").alias("a"), F.col("hashes").alias("ha"), F.col("weights").alias("wa"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ha", "wa", "hb", "wb")

    def work(batch: pa.RecordBatch) -> dict:
        found = []
        for i in range(batch.num_rows):
            ha, wa, hb, wb = (batch.column(c)[i].as_py() for c in range(2, 6))
            found.append(similarity((np.frombuffer(ha, U), np.frombuffer(wa, np.float32)),
                                    (np.frombuffer(hb, U), np.frombuffer(wb, np.float32))))
        return {"a": batch.column(0), "b": batch.column(1), "similarity": found}

    return map_batches(joined, work, "a long, b long, similarity double")


def links(buckets: DataFrame, vecs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links that connect all documents whose links share a bucket (``band``,
    ``node``): the components of the returned links are those of all links."""
    def star(rows: DataFrame) -> DataFrame:
        leaders = rows.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n"))
        return rows.join(leaders.where("n > 1").drop("n"), "band")

    first = star(buckets)
    measured = staged(measure(first.where("node <> leader").select(
        F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), vecs), "stars")
    near = measured.select(F.col("a").alias("leader"), F.col("b").alias("node"), "similarity")
    # Documents without a link to their leader, with the distance to it.
    failed = staged(first.join(near.where(F.col("similarity") < threshold), ["leader", "node"])
                    .select("band", "node"), "failed")
    again = star(failed)
    known = measured.select("a", "b")
    second = staged(measure(again.where("node <> leader").select(
        F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        .join(known, ["a", "b"], "left_anti"), vecs), "stars")
    found = measured.union(second).where(F.col("similarity") >= threshold).select("a", "b")

    # What is still apart in a bucket: members of different components. Only
    # buckets in which a document failed can hold such pairs.
    groups = staged(components(found), "groups")
    members = staged(first.select("band", "node")
                     .join(failed.select("band").distinct(), "band", "left_semi")
                     .join(groups, "node", "left")
                     .select("band", "node", F.coalesce("component", "node").alias("component")), "members")
    return found.union(staged(compare_blocks(members, vecs, threshold), "rest"))


def in_blocks(members: DataFrame) -> DataFrame:
    """Members of buckets with several components under the units (unit_a,
    unit_b) of block pairs. The largest component of a bucket has blocks of its
    own, which meet the blocks of the rest but not one another."""
    parts = members.groupBy("band", "component").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("band").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n_main"),
        (F.sum("n") - F.max("n")).alias("n_rest")).where("n_rest > 0").select(
        "band", "main", F.ceil(F.col("n_main") / BLOCK).cast("int").alias("mains"),
        F.ceil(F.col("n_rest") / BLOCK).cast("int").alias("rests"))
    placed = members.join(sizes, "band").withColumn("is_main", F.col("component") == F.col("main"))
    block = F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("rests")))
    placed = placed.withColumn("block", block.cast("int")).withColumn("other", F.explode(F.when(
        F.col("is_main"), F.sequence(F.lit(0), F.col("rests") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("rests") + F.col("mains") - 1))))
    own = F.when(F.col("is_main"), F.col("rests") + F.col("block")).otherwise(F.col("block"))
    return placed.select("band", "node", "component", F.least(own, "other").alias("unit_a"),
                         F.greatest(own, "other").alias("unit_b"), (own > F.col("other")).cast("int").alias("side"))


def compare_blocks(members: DataFrame, vecs: DataFrame, threshold: float) -> DataFrame:
    """Links between components, all pairs of each unit compared in its task.
    Only links that connect something new leave the task."""
    spark = members.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame([], "a long, b long").schema
    arrow = arrow_schema(schema)
    unit = ["band", "unit_a", "unit_b"]
    rows = (in_blocks(members).join(vecs, "node").repartition(*unit)
            .sortWithinPartitions(*unit, "side", "node")
            .select(F.xxhash64(*unit).alias("unit"), "side", "node", "component", "hashes", "weights"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_units(batches):
            numbers = table["unit"].to_numpy()
            begins = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1]))
            found: list[tuple[int, int]] = []
            for at, size in zip(begins, np.diff(np.append(begins, len(numbers)))):
                part = table.slice(at, size).to_pydict()
                sets = [(np.frombuffer(h, U), np.frombuffer(w, np.float32))
                        for h, w in zip(part["hashes"], part["weights"])]
                near = block_similarity(sets) >= threshold
                node, component = np.array(part["node"]), np.array(part["component"])
                side = np.array(part["side"])
                left, right = np.nonzero(np.triu(near & (component[:, None] != component[None]), 1))
                if side.any():
                    across = side[left] != side[right]
                    left, right = left[across], right[across]
                found += spanning(np.stack([node[left], node[right]], axis=1),
                                  dict(zip(part["node"], part["component"])))
            links = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], schema=arrow)

    return rows.mapInArrow(run, schema)


def block_similarity(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weighted Jaccard of all pairs of different sets of a block, by products
    over the shingles that at least two sets hold. A shingle's weights are cut into levels, so
    that the smaller of two weights is the sum of the levels both reach."""
    total = np.array([w.sum(dtype=float) for _, w in sets])
    owner = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    hashes, weight = np.concatenate([h for h, _ in sets]), np.concatenate([w for _, w in sets]).astype(float)
    order = np.lexsort((weight, hashes))
    owner, hashes, weight = owner[order], hashes[order], weight[order]
    first = np.append(True, hashes[1:] != hashes[:-1])
    group = np.cumsum(first) - 1
    shared = np.bincount(group)[group] > 1
    owner, first, weight = owner[shared], first[shared], weight[shared]
    both = np.zeros((len(sets), len(sets)))
    # Within a shingle, ascending weights: each rise is a level that this and
    # all later sets of the shingle reach.
    rise = weight - np.where(first, 0.0, np.append(0.0, weight[:-1]))
    begins = np.flatnonzero(first)
    ends = np.append(begins[1:], len(weight))
    level = np.flatnonzero(rise > 0)
    stop = ends[np.searchsorted(begins, level, "right") - 1]
    for at in range(0, len(level), LEVELS):
        some, until = level[at:at + LEVELS], stop[at:at + LEVELS]
        reach = np.zeros((len(sets), len(some)))
        column = np.repeat(np.arange(len(some)), until - some)
        place = np.arange(len(column)) - np.repeat(np.cumsum(until - some) - (until - some), until - some)
        reach[owner[np.repeat(some, until - some) + place], column] = 1.0
        both += (reach * rise[some]) @ reach.T
    return both / np.maximum(total[:, None] + total[None] - both, 1e-300)


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id and kept (the class is named after the document)."""
    idf = inverse_frequency(*document_frequency(docs))
    drawn = staged(sketch(docs, idf), "sketches")
    # Equal texts fold to the smallest doc_id; rows without an id never lead.
    texts = staged(drawn.groupBy("text_key").agg(
        F.min("doc_id").alias("node"), F.any_value("bands").alias("bands")), "texts")
    banded = texts.where("node is not null").select("node", F.explode("bands").alias("band")).distinct()
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets = staged(banded.join(shared, "band", "left_semi"), "buckets")
    vecs = staged(vectors(docs, buckets, idf), "vectors")
    # A repeated doc_id with other texts is one document as well.
    same = (drawn.select("doc_id", "text_key").where("doc_id is not null")
            .join(texts.select("text_key", "node"), "text_key")
            .where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    named = components(links(buckets, vecs, threshold).union(same))
    folded = drawn.select("doc_id", "text_key").join(texts.select("text_key", "node"), "text_key")
    nulls = docs.where("text is null").select("doc_id", F.col("doc_id").alias("node"))
    return (folded.select("doc_id", "node").union(nulls)
            .join(named, "node", "left")
            .select("doc_id", F.coalesce("component", "node").alias("class_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))))


def without_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with its columns. Rows without an id or a
    text have no class to lose to and stay; of rows that share a kept doc_id
    one stays."""
    kept = classify(docs, threshold).where("kept").select("doc_id").distinct()
    first = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return first.unionByName(docs.where("doc_id is null")).select(*docs.columns)
