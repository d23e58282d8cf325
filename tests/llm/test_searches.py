"""Hard negatives, ranked search and SentencePiece BPE."""

import hashlib
import math
import random
from pathlib import Path

import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldtally.llm import hard_negatives, piece_bpe, queries, ranked_search

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        duck.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    expected = duck.execute(queries.statements()[name])
    order = [column[0] for column in expected.description]
    found = queries.registered()[name](spark, str(SF_DIR)).select(*order).collect()
    assert found and sorted(map(tuple, found)) == sorted(expected.fetchall())


# ---- operator 11

def mined(rows, positives=5, negatives=10):
    """Every pair scored in Python integers."""
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    rows = sorted({(i, label, tuple(v)) for i, label, v in rows})
    out, answered = [], set()
    for i, label, v in rows:
        if i % 3 or i in answered:
            continue
        answered.add(i)
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows
                  if j != i and len(w) == len(v)]
        for score, j, _ in sorted((s, j, o) for s, j, o in scored if o == label)[:positives]:
            held = sorted((s, n) for s, n, o in scored
                          if o != label and 30 * -score <= 100 * -s <= 90 * -score)
            out += [(i, j, rank, n, -score, -s) for rank, (s, n) in enumerate(held[:negatives], 1)]
    return sorted(out)


def check_mining(spark, rows, block_rows=None, monkeypatch=None):
    if block_rows:
        # the smallest buckets: many of them, cut anywhere
        build = hard_negatives.build_buckets
        monkeypatch.setattr(hard_negatives, "build_buckets", lambda df: build(df, block_rows))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    found = hard_negatives.mine(df, df.where("vec_id % 3 = 0"))
    assert sorted(map(tuple, found.collect())) == mined(
        [(r.vec_id, r.embedding, r.label) for r in df.collect()])


def test_negatives_of_clustered_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 12))
    rows = []
    for i in range(240):
        v = centres[rng.integers(4)] + rng.normal(size=12) * 0.4
        rows.append((i, (v * rng.choice([0.1, 1, 3])).tolist(), int(rng.integers(3))))
    check_mining(spark, rows, 16, monkeypatch)


def test_negatives_of_ties_and_unusable_rows(spark, monkeypatch):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [1.0, 0.5], i % 2) for i in range(40)] + [(i, [0.5, 0.4], i % 2) for i in range(40, 60)]
    rows += [(60, None, 1), (61, [], 1), (63, [nan, 1.0], 1), (64, [inf, 1.0], 0), (65, [None, 1.0], 0),
             (66, [1.0, 0.5], None), (None, [1.0, 0.5], 1), (69, [0.0, 0.0], 1), (70, [-1.0, -0.5], 1),
             (72, [1.0, 2.0, 3.0], 0), (73, [1.0, 2.0, 3.0], 0), (74, [0.7, 1.0, 2.0], 1),
             (3, [1.0, 0.5], 1), (3, [1.0, 0.5], 1), (75, [-2.0, 3.0], 0)]
    check_mining(spark, rows, 7, monkeypatch)


def test_negatives_of_large_components(spark):
    check_mining(spark, [(0, [1e6, 2e6], 0), (1, [2e6, 1e6], 0), (2, [9e5, 8e5], 1), (4, [1e6, 5e5], 1)])
    check_mining(spark, [(0, [1e7, 0.0], 0), (1, [1e7, -9.0], 0), (2, [8e6, 1e7], 1), (4, [7e6, -7e6], 1)])
    with pytest.raises(Exception, match="too large|fit a long"):
        check_mining(spark, [(0, [1e18, 1e18], 0), (1, [1e18, 1e18], 0)])


def test_negatives_of_empty_and_clashing_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(empty, empty).count() == 0
    df = spark.createDataFrame([(0, [1.0], 0, 5), (1, [1.0], 0, 5), (2, [0.5], 1, 5)],
                               "vec_id long, embedding array<double>, label int, bucket int")
    clashing = df.selectExpr("*", "bucket as dims", "bucket as rank", "bucket as anchor_id", "bucket as shard")
    assert [tuple(r) for r in hard_negatives.mine(clashing, clashing.where("vec_id = 0")).collect()] == [
        (0, 1, 1, 2, 65536, 32768)]


def test_anchor_blocks_are_not_broadcast(spark):
    rng = np.random.default_rng(22)
    rows = [(i, rng.normal(size=4).tolist(), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = hard_negatives.mine(df, df.where("vec_id % 3 = 0"))
    assert sorted(map(tuple, found.collect())) == mined([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan


def test_coordinate_slices_lose_no_candidate():
    rng = np.random.default_rng(8)
    for _ in range(60):
        vectors = rng.integers(-40, 40, size=(50, 5))
        vectors = vectors[np.abs(vectors).sum(axis=1) > 0]
        orders = np.argsort(hard_negatives.unit(vectors.astype(float)), axis=0).T.astype(np.uint16)
        bucket = hard_negatives.Bucket(np.arange(len(vectors)), np.zeros(len(vectors)), vectors, orders)
        anchor = rng.integers(-40, 40, size=5)
        low, high = sorted(rng.integers(-4000, 4000, size=2).tolist())
        scores = vectors @ anchor
        kept = set(bucket.candidates(anchor, low, high).tolist())
        assert set(np.flatnonzero((scores >= low) & (scores <= high)).tolist()) <= kept


def test_coordinate_slices_prune():
    rng = np.random.default_rng(9)
    vectors = rng.integers(-99, 99, size=(2000, 4))
    orders = np.argsort(hard_negatives.unit(vectors.astype(float)), axis=0).T.astype(np.uint16)
    bucket = hard_negatives.Bucket(np.arange(2000), np.zeros(2000), vectors, orders)
    best = int(np.sort(vectors @ vectors[0])[-5])
    assert len(bucket.candidates(vectors[0], best, hard_negatives.NONE_ABOVE)) < 600


# ---- operator 12

def ranked(docs, items, k=10):
    counted = [(i, ranked_search.Counter(ranked_search.terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    total, n_docs, out = sum(sum(c.values()) for _, c in counted), len(counted), []
    for item_id, text in sorted({x for x in items if None not in x}):
        words, scored = set(ranked_search.terms(text)), []
        for doc_id, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            score = 0
            for word in words & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(word in d for _, d in counted) + 1)))
                score += w * ((10**9 * c[word]) // (1000 * c[word] + 8 * m))
            if score and doc_id is not None:
                scored.append((-score, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


DOCS = "doc_id long, text string, rank int, item_id long"
ITEMS = "item_id long, text string, score long"


def check_ranking(spark, docs, items):
    found = ranked_search.search(
        spark.createDataFrame([(i, t, 1, 1) for i, t in docs], DOCS).repartition(3),
        spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS))
    assert sorted(map(tuple, found.collect())) == ranked(docs, items)


def test_ranking_of_ties_nulls_and_copies(spark):
    docs = [(1, "Alpha beta"), (2, "alpha BETA"), (2, "alpha beta"), (3, None), (4, ""), (5, " .,- "),
            (None, "alpha alpha"), (6, "gamma " * 3000), (7, "ÄRGER ärger"), (8, "x1y2-Z")]
    docs += [(10 + i, "alpha beta delta") for i in range(60)]
    items = [(1, "beta alpha alpha"), (2, "gamma"), (3, None), (4, ""), (None, "alpha"), (5, "ärger"),
             (6, "nowhere"), (1, "beta alpha alpha"), (7, "z x1y2")]
    check_ranking(spark, docs, items)


def test_ranking_over_many_small_trees_and_groups(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=n))
    docs = [(i, text(rng.randint(1, 80))) for i in range(400)]
    items = [(i, text(6)) for i in range(20)]
    groups = ranked_search.item_groups
    monkeypatch.setattr(ranked_search, "item_groups", lambda df: groups(df, 400))
    check_ranking(spark, docs, items)


def test_no_bound_of_a_tree_is_below_a_score():
    rng = np.random.default_rng(4)
    vectors = [np.sort(rng.choice(30, rng.integers(1, 9), replace=False)) for _ in range(300)]
    tree = ranked_search.Tree(list(range(300)), rng.integers(10, 300, 300).tolist(), vectors,
                              [rng.integers(1, 9, len(v)) for v in vectors], leaf=4)
    weights = rng.integers(1, 9000, len(tree.places))
    exact = ranked_search.gains(weights, tree.tf, tree.norms[:, None]).sum(axis=1)
    bounds = ranked_search.gains(weights, tree.most_tf, tree.least_norm[:, None]).sum(axis=1)
    assert len(tree.runs) > 50
    for (begin, end), bound, below in zip(tree.runs, bounds, tree.children):
        assert exact[begin:end].max() <= bound
        assert not below or [tree.runs[below[0]][0], tree.runs[below[-1]][1]] == [begin, end]


def test_ranking_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a", 1)], ITEMS)
    assert ranked_search.search(docs, items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0


# ---- operator 13

@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.MODEL)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text("▁ ae\nthing漢é.,1", max_size=60))
def test_pieces_equal_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_bpe.MODEL)
    own = piece_bpe.encoder()
    ids = own.encode(text)
    assert ids.tolist() == library.encode(text)
    assert own.decode(ids) == library.decode(ids.tolist())


def test_any_ids_decode_as_in_the_library(pieces):
    rng, own = random.Random(2), piece_bpe.encoder()
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(270), 28_705]) for _ in range(rng.randint(0, 9))]
        assert own.decode(np.array(ids, np.int32)) == pieces.decode(ids)


def test_pieces_of_runs_of_spaces(pieces):
    own = piece_bpe.encoder()
    for n in range(70):
        for text in (" " * n, " " * n + "the", " " * n + "漢", "a" + " " * n + ".", "\n" + " " * n + "\n"):
            assert own.encode(text).tolist() == pieces.encode(text)


def test_each_prefix_has_its_last_token(pieces):
    text = "▁unbelievable▁thinking漢of▁x"
    table = piece_bpe.encoder().pieces.prefixes(text)
    for end in range(2, len(text) + 1):
        last = pieces.encode(text[1:end].replace("▁", " "))[-1]
        assert table[end] in (last, -1) and (table[end] == -1) == (text[end - 1] not in piece_bpe.encoder().pieces.id)


def test_pieces_of_edge_documents(spark, pieces):
    texts = [(1, None), (2, ""), (None, "alone"), (3, "same"), (3, "same"), (4, "word " * 30_000),
             (5, "a" * 20_000), (6, " \n\t  "), (7, "é漢字🎉\x00 ‍▁▁"), (8, "<s> <unk>")]
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in texts],
                               "doc_id long, text string, n_tokens int, ids string")
    found = sorted(map(tuple, piece_bpe.digest_documents(df).collect()), key=str)
    wanted = []
    for i, text in texts:
        ids = pieces.encode(text or "")
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(pieces.decode(ids).encode()).hexdigest()))
    assert found == sorted(wanted, key=str)
    encoded = piece_bpe.encode_documents(df)
    back = {(r.doc_id, r.text) for r in piece_bpe.decode_documents(encoded).collect()}
    assert back == {(i, (t or "").replace("▁", " ")) for i, t in texts}
    assert piece_bpe.digest_documents(df.limit(0)).count() == 0


def test_pieces_of_whole_documents(spark, pieces):
    docs = spark.read.parquet(str(SF_DIR / "documents.parquet"))
    found = {r.doc_id: list(r.ids) for r in piece_bpe.encode_documents(docs).collect()}
    assert all(found[r.doc_id] == pieces.encode(r.text) for r in docs.collect())
