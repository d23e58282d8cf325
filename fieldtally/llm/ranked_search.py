"""Ranked lexical search on a document FP-tree (operator 12).

Documents are restricted to the terms of the items and written as term vectors
in the order of the terms' document frequency, frequent ones first. In vector
order the documents of a block are the leaves of a trie whose paths they share:
a node is a run of them with a common beginning. Each node holds the greatest tf
of every term in its subtree and the least m, so what a document below can
score for an item has a bound. Items search each tree depth first, the child of
the highest bound first, and leave a subtree whose bound is below the worst of
the best documents found so far. Documents of the leaves they reach are scored
exactly. A task keeps the best of each item over all its blocks.

Items travel to the tasks in groups whose text is measured and bounded, one
pass of documents a group; documents never leave their task but by their
restricted vectors, which are written once. Statistics are counted over those.

Defined results: a null or empty text has no term, counts in nothing and is never
returned; a document without doc_id counts in the statistics and is not
returned; rows of one doc_id are a document each; items with a null id or no term
give no row; equal items (id and text) are answered once, other texts of one id
rank apart; documents that score 0 are not returned; ties fall to the smaller
doc_id; empty tables give no row; other columns are ignored.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldtally.llm.common import arrow_schema, map_batches, prepare_python, staged

#: Bytes of item text that travel to the tasks at once.
GROUP_BYTES = 1 << 20
BLOCK_DOCUMENTS = 4096
#: Cells (documents x terms) of a block's tf table.
BLOCK_CELLS = 8 << 20
#: A run of at most so many documents is scored rather than searched further.
LEAF_DOCUMENTS = 32
SLICES = 256

# What separates terms is white space to the splitter, A to Z are lowered.
TERM_BYTES = bytes(
    i + 32 if 65 <= i <= 90 else i if i >= 128 or 48 <= i <= 57 or 97 <= i <= 122 else 32
    for i in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and any character beyond ASCII, A-Z lowered."""
    return (text or "").encode().translate(TERM_BYTES).split()


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_norm(n: int, documents: int, total: int) -> int:
    return 100 - 90 + (90 * n * documents) // total


def gains(weight: np.ndarray, tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What each term adds to a score; 0 where tf is 0."""
    tf = tf.astype(np.int64)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm))


# ---- items

def item_groups(items: DataFrame, most: int = GROUP_BYTES) -> Iterator[list]:
    """Lists of (item_id, text) of at most ``most`` bytes of text, or one item.

    Groups are dealt by hash, and dealt anew in more groups until the largest
    is proven to be small enough."""
    known = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    known = staged(known, "items")
    size = F.octet_length("text") + 64
    total = known.agg(F.sum(size)).first()[0] or 0
    groups = -(-total // most)
    while True:
        group = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, groups)))
        sizes = known.groupBy(group.alias("item_group")).agg(
            F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("items"))
        too_large = sizes.where((F.col("bytes") > most) & (F.col("items") > 1))
        if too_large.isEmpty():
            break
        groups *= 2
    for number in range(groups):
        held = known.where(group == number).orderBy("item_id", "text").collect()
        if held:
            yield held


# ---- documents

def restrict(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, number of terms, and the places in the vocabulary and tf of the
    terms that belong to it, of the documents that have terms."""
    place = {term: i for i, term in enumerate(vocabulary)}

    def work(batch: pa.RecordBatch) -> dict:
        ids, n, found, tf = [], [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = terms(text.as_py())
            if words:
                counted = Counter(words)
                held = [(place[word], times) for word, times in counted.items() if word in place]
                ids.append(doc_id)
                n.append(len(words))
                found.append([at for at, _ in held])
                tf.append([times for _, times in held])
        return {"doc_id": ids, "n": n, "found": found, "tf": tf}

    return map_batches(docs.select("doc_id", "text"), work,
                       "doc_id long, n long, found array<int>, tf array<int>")


def holding_counts(restricted: DataFrame, size: int) -> list[int]:
    """Documents holding each term of the vocabulary; combined map-side."""
    counts = [0] * size
    for row in restricted.select(F.explode("found").alias("term")).groupBy("term").agg(
            F.count(F.lit(1)).alias("documents")).collect():
        counts[row.term] = row.documents
    return counts


# ---- trees

class Tree:
    """The FP-tree of a block of restricted documents.

    ``vectors`` holds per document the places of its terms, frequent ones first
    (smallest place), and ``counts`` their tf. Nodes are numbered so that parents
    come before their children; a leaf is a run of at most ``leaf`` documents."""

    def __init__(self, doc_ids: list[int], norms: list[int], vectors: list[np.ndarray],
                 counts: list[np.ndarray], leaf: int = LEAF_DOCUMENTS):
        order = sorted(range(len(vectors)), key=lambda i: vectors[i].tolist())
        self.doc_ids = np.array([doc_ids[i] for i in order], np.int64)
        self.norms = np.array([norms[i] for i in order], np.int64)
        sizes = np.array([len(vectors[i]) for i in order])
        places = np.concatenate([vectors[i] for i in order])
        values = np.concatenate([counts[i] for i in order])
        #: Places of the terms that occur here, and their columns in ``tf``.
        self.places, columns = np.unique(places, return_inverse=True)
        kind = np.uint16 if values.max() < 1 << 16 else np.int32
        self.tf = np.zeros((len(order), len(self.places)), kind)
        self.tf[np.repeat(np.arange(len(order)), sizes), columns] = values
        self.runs: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self._grow(self._shared([vectors[i] for i in order]), leaf)
        self._bound()

    @staticmethod
    def _shared(vectors: list[np.ndarray]) -> np.ndarray:
        """Length of the beginning each document shares with the one before."""
        shared = np.zeros(len(vectors), np.int64)
        for i in range(1, len(vectors)):
            a, b = vectors[i - 1], vectors[i]
            size = min(len(a), len(b))
            differ = np.flatnonzero(a[:size] != b[:size])
            shared[i] = differ[0] if len(differ) else size
        return shared

    def _grow(self, shared: np.ndarray, leaf: int) -> None:
        """Nodes from the root downward. Where a run parts, its small children
        that stand side by side share a leaf."""
        pending = [self._node(0, len(shared))]
        while pending:
            node = pending.pop()
            begin, end = self.runs[node]
            if end - begin <= leaf:
                continue
            inner = shared[begin + 1:end]
            cuts = (np.flatnonzero(inner == inner.min()) + begin + 1).tolist()
            if len(np.unique(inner)) == 1 and len(cuts) == len(inner):
                # documents that part at once, or all with equal vectors
                edges = [*range(begin, end, leaf), end]
            else:
                edges = self._gathered([begin, *cuts, end], leaf)
            for a, b in zip(edges, edges[1:]):
                self.children[node].append(self._node(a, b))
            pending += self.children[node]

    def _node(self, begin: int, end: int) -> int:
        self.runs.append((begin, end))
        self.children.append([])
        return len(self.runs) - 1

    @staticmethod
    def _gathered(edges: list[int], leaf: int) -> list[int]:
        kept = [edges[0]]
        for at, after in zip(edges[1:], edges[2:]):
            if after - kept[-1] > leaf:
                kept.append(at)
        return [*kept, edges[-1]]

    def _bound(self) -> None:
        """Greatest tf of each term and least m of each node, from the leaves up."""
        self.most_tf = np.zeros((len(self.runs), len(self.places)), self.tf.dtype)
        self.least_norm = np.zeros(len(self.runs), np.int64)
        for node in range(len(self.runs) - 1, -1, -1):
            below, (begin, end) = self.children[node], self.runs[node]
            if below:
                self.most_tf[node] = self.most_tf[below].max(axis=0)
                self.least_norm[node] = self.least_norm[below].min()
            else:
                self.most_tf[node] = self.tf[begin:end].max(axis=0)
                self.least_norm[node] = self.norms[begin:end].min()

    def search(self, places: np.ndarray, weights: np.ndarray, k: int,
               best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """``best`` (score, -doc_id) of an item, highest first, with what this
        tree adds to it."""
        at = np.searchsorted(self.places, places)
        held = at < len(self.places)
        held[held] = self.places[at[held]] == places[held]
        columns, weights = at[held], weights[held]
        if not len(columns):
            return best
        bounds = gains(weights, self.most_tf[:, columns], self.least_norm[:, None]).sum(axis=1).tolist()
        pending = [0]
        while pending:
            node = pending.pop()
            # an equal score may still win by its smaller doc_id
            if bounds[node] < (best[-1][0] if len(best) == k else 1):
                continue
            if self.children[node]:
                pending += sorted(self.children[node], key=bounds.__getitem__)
                continue
            begin, end = self.runs[node]
            scores = gains(weights, self.tf[begin:end, columns], self.norms[begin:end, None]).sum(axis=1)
            found = zip(scores.tolist(), (-self.doc_ids[begin:end]).tolist())
            best = sorted([*best, *(x for x in found if x[0] > 0)], reverse=True)[:k]
        return best


def search_restricted(restricted: DataFrame, items: list[tuple[int, np.ndarray]],
                      rank_of: np.ndarray, weights: np.ndarray, documents: int, total: int,
                      k: int) -> DataFrame:
    """item (its place), doc_id, score and slice: the best of each task."""
    spark = restricted.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame([], "item int, slice int, doc_id long, score long").schema
    arrow = arrow_schema(schema)
    cells = max(1, len(rank_of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}
        held: tuple[list, list, list, list] = ([], [], [], [])
        wide = 0

        def close() -> None:
            tree = Tree(*held)
            for item, places in items:
                best[item] = tree.search(places, weights[places], k, best.get(item, []))

        for batch in batches:
            found, tf = batch.column(2), batch.column(3)
            for i, (doc_id, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                places = rank_of[found[i].values.to_numpy()]
                order = np.argsort(places)
                held[0].append(doc_id)
                held[1].append(length_norm(n, documents, total))
                held[2].append(places[order])
                held[3].append(tf[i].values.to_numpy()[order])
                wide += len(places)
                rows = len(held[0])
                if rows >= BLOCK_DOCUMENTS or rows * min(cells, wide) >= BLOCK_CELLS:
                    close()
                    held, wide = ([], [], [], []), 0
        if held[0]:
            close()
        rows = [(item, -doc_id, score) for item, kept in best.items() for score, doc_id in kept]
        if rows:
            item, doc_id, score = map(list, zip(*rows))
            here = TaskContext.get().partitionId() % SLICES
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array([here] * len(rows), pa.int32()),
                 pa.array(doc_id, pa.int64()), pa.array(score, pa.int64())], schema=arrow)

    usable = restricted.where("doc_id is not null and size(found) > 0")
    return usable.select("doc_id", "n", "found", "tf").mapInArrow(run, schema)


def search_group(docs: DataFrame, group: list, k: int) -> DataFrame:
    """The k best documents of each item of a group: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    words = [sorted(set(terms(row.text))) for row in group]
    vocabulary = sorted({word for held in words for word in held})
    restricted = staged(restrict(docs, vocabulary), "restricted")
    counted = restricted.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total")).first()
    holding = holding_counts(restricted, len(vocabulary))
    # places follow the document frequency, so that vectors begin with frequent terms
    order = sorted(range(len(vocabulary)), key=lambda i: (-holding[i], i))
    rank_of = np.zeros(len(vocabulary), np.int64)
    rank_of[order] = np.arange(len(vocabulary))
    weights = np.array([term_weight(counted.documents, holding[i]) for i in order], np.int64)
    place = {word: int(rank_of[i]) for i, word in enumerate(vocabulary)}
    items = [(at, np.array(sorted(place[word] for word in held), np.int64))
             for at, held in enumerate(words) if held]
    best = search_restricted(restricted, items, rank_of, weights, counted.documents or 0,
                             counted.total or 1, k)
    named = F.broadcast(spark.createDataFrame(
        [(at, row.item_id) for at, row in enumerate(group)], "item int, item_id long"))

    def ranked(df: DataFrame, *by: str) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
        return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)

    # first within slices of the tasks, so that no task meets the rows of all tasks
    final = ranked(ranked(best, "item", "slice").drop("rank"), "item")
    return final.join(named, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents."""
    spark: SparkSession = docs.sparkSession
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for group in item_groups(items.select(F.col("item_id").cast("long").alias("item_id"), "text")):
        found = found.unionByName(search_group(docs, group, k))
    return found
