"""Toxicity, near copies, personal data, mixing, and the pipeline."""

import dataclasses
import hashlib
import random
import re
import warnings
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from fieldtally.llm import mixing, near_copies, pii, queries, toxicity

SF_DIR = "/root/testdata/sf0.001"


def documents(spark, rows):
    """Documents with columns that clash with results."""
    return spark.createDataFrame(
        [(i, t, "en", "s", 5, "clash", 2.0) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, spans string, score double")


EDGES = [(1, None), (2, ""), (None, "a lone text"), (None, None), (3, "same words here"),
         (3, "same words here"), (4, "word " * 20_000), (6, " \n\t  ")]


# ---- operator 4

def plain_segments(scores):
    """Maximal segments by their definition: every part of a segment scores
    less than the whole, and no longer segment has that property."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    good = [(i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)
            if all(total[k] > total[i] for k in range(i + 1, j + 1))
            and all(total[k] < total[j] for k in range(i, j))]
    return sorted((i, j) for i, j in good
                  if not any((a, b) != (i, j) and a <= i and j <= b for a, b in good))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-4, 4), max_size=14))
def test_segments_are_maximal(scores):
    found = toxicity.maximal_segments(np.array(scores, float))
    assert [(a, b) for a, b, _ in found] == plain_segments(scores)
    assert [s for _, _, s in found] == [sum(scores[a:b]) for a, b, _ in found]


def test_extreme_values_are_fitted():
    random_, lengths = np.random.default_rng(3), np.random.default_rng(4).integers(50, 2000, 4000)
    rate, size = 1.3, 0.02
    best = np.maximum(0.0, (np.log(size * lengths) - np.log(-np.log(random_.random(4000)))) / rate)
    found_rate, found_size = toxicity.fit_extreme_values(best, lengths.astype(float), 1.0)
    assert abs(found_rate - rate) < 0.1 and abs(found_size - np.log(size)) < 0.4


@pytest.fixture(scope="module")
def toxic_corpus(spark):
    rng, rows, labels = random.Random(2), [], []
    common = [f"w{rng.randrange(3000)}" for _ in range(3000)]
    for i in range(900):
        words = rng.choices(common, k=rng.randrange(30, 200))
        if i % 5 == 0:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices([f"vile{k}" for k in range(60)], k=3)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def toxic_model(toxic_corpus):
    return toxicity.fit(*toxic_corpus)


def test_held_out_accuracy_and_passages(toxic_corpus, toxic_model):
    docs, labels = toxic_corpus
    rows = toxicity.score_documents(docs, toxic_model).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert {r.doc_id for r in rows if r.held_out} == {r.doc_id for r in held}
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    hits = [r for r in rows if r.toxic and r.passages]
    assert hits and all("vile" in r.text[p.start:p.stop] and p.p <= toxicity.SIGNIFICANT
                        for r in hits for p in r.passages)


def test_earlier_words_take_nothing_from_a_passage(toxic_model):
    rng, passage = random.Random(9), ["vile1", "vile2", "vile3"]
    model = dataclasses.replace(toxic_model, known={})
    plain = [f"w{rng.randrange(3000)}" for _ in range(6000)]

    def found(*places):
        words = plain[:]
        for at, put in places:
            words[at:at + len(put)] = put
        return {(a, b): x for a, b, x, _ in model.passages(" ".join(words))}

    alone = found((5000, passage))
    assert alone.keys() == {(5000, 5003)}
    twice = found((1000, passage), (5000, passage))
    assert twice.keys() == {(1000, 1003), (5000, 5003)}
    assert twice[1000, 1003] == pytest.approx(alone[5000, 5003]) == pytest.approx(twice[5000, 5003])
    mentions = [(300 * k, [word]) for k, word in enumerate(passage * 4, 1)]
    assert found(*mentions, (5000, passage))[5000, 5003] == pytest.approx(alone[5000, 5003])


def test_scores_do_not_depend_on_earlier_texts(toxic_model):
    start = ("w1-" * 30)[:64]
    fresh = dataclasses.replace(toxic_model, known={}).segments(start)
    model = dataclasses.replace(toxic_model, known={})
    long = [model.segments(start + "-vile1") for _ in range(2)]
    assert long[0] == long[1] != fresh
    assert model.segments(start) == fresh


def test_labels_of_held_out_rows_are_not_used(toxic_corpus, toxic_model):
    docs, labels = toxic_corpus
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, other) == toxic_model


def test_toxicity_edges(spark, toxic_corpus, toxic_model):
    edges = documents(spark, EDGES)
    rows = toxicity.score_documents(edges, toxic_model).collect()
    assert len(rows) == len(EDGES)
    assert {r.predicted for r in rows} == {0} and {r.spans for r in rows} == {"clash"}
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    empty = toxic_corpus[1].where("false")
    for labels in (empty, toxic_corpus[1].where("toxic = 0")):
        model = toxicity.fit(toxic_corpus[0], labels)
        assert {r.predicted for r in toxicity.score_documents(edges, model).collect()} == {0}
    odd = spark.createDataFrame([(1, None), (2, 7), (None, 1)], "doc_id long, toxic int")
    assert toxicity.fit(edges, odd) == toxicity.ToxicModel()
    assert toxicity.score_documents(edges.where("false"), toxic_model).count() == 0


# ---- operator 3

def plain_shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    size = min(5, len(words))
    hashes = [np.array([xxhash.xxh64_intdigest(w)], np.uint64) for w in words]
    found = [int(near_copies.join_words(hashes[i:i + size])[0]) for i in range(len(words) - size + 1) if size]
    return sorted(Counter(found).items())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(
    "abAB \u00e9\u00c9\u00df\u00b5\u00b2\u00d7_0.\n\x1c\u00a0\u0130\u03a3\u6f22",
    max_size=40), max_size=8))
def test_shingles_of_many_texts_are_those_of_each(texts):
    found = {}
    for numbers, hashes, counts, bounds in near_copies.shingle_sets(texts):
        for i, a, b in zip(numbers, bounds, bounds[1:]):
            found[i] = list(zip(hashes[a:b].tolist(), counts[a:b].tolist()))
    assert sorted(found) == [i for i, text in enumerate(texts) if text]
    assert [found.get(i, []) for i in range(len(texts))] == [plain_shingles(text) for text in texts]


def plain_classes(rows, idf, threshold=near_copies.THRESHOLD):
    """Smallest doc_id reachable by links, over every pair."""
    rows = [(i, t) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(h, near_copies.weights(h, c, idf)) for h, c in (near_copies.shingles(t or "") for _, t in rows)]
    for a, (i, s) in enumerate(rows):
        for b, (j, t) in enumerate(rows[:a]):
            if i == j or (s is not None and s == t) or near_copies.similarity(sets[a], sets[b]) >= threshold:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in rows}


def variants(rng, words, count, changes):
    for _ in range(count):
        changed = words[:]
        for _ in range(rng.randrange(*changes)):
            changed[rng.randrange(len(changed))] = f"n{rng.randrange(10**6)}"
        yield " ".join(changed)


def test_near_copies_like_every_pair(spark):
    rng, rows = random.Random(5), []
    for size, count, changes in ((200, 60, (0, 12)), (60, 30, (0, 4)), (400, 40, (5, 30)), (30, 12, (0, 3))):
        words = [f"v{rng.randrange(900)}" for _ in range(size)]
        rows += variants(rng, words, count, changes)
    passage = " ".join(f"p{k}" for k in range(80))
    rows += [passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(25)]
    rows += rows[:15] + ["Same, words HERE now", "same words here  now!", "one two", "ONE  two."]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    docs = documents(spark, rows)
    idf = near_copies.inverse_frequency(*near_copies.document_frequency(docs))
    found = near_copies.classify(docs).collect()
    expected = plain_classes(rows, idf)
    assert {r.doc_id: r.class_id for r in found} == expected
    assert {r.doc_id for r in found if r.kept} == set(expected.values())
    kept = near_copies.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_block_similarity_is_that_of_pairs(monkeypatch):
    monkeypatch.setattr(near_copies, "LEVELS", 7)
    rng, idf = random.Random(6), np.linspace(1, 1.25, near_copies.BUCKETS).astype(np.float32)
    words = [f"v{rng.randrange(40)}" for _ in range(80)]
    texts = [*variants(rng, words, 12, (0, 30)), "a b c d e " * 30, "a b c d e " * 3, "lone words"]
    sets = [(h, near_copies.weights(h, c, idf)) for h, c in map(near_copies.shingles, texts)]
    found = near_copies.block_similarity(sets)
    expected = np.array([[near_copies.similarity(a, b) for b in sets] for a in sets])
    apart = ~np.eye(len(sets), dtype=bool)
    assert np.allclose(found[apart], expected[apart], atol=1e-6) and expected[apart].max() > 0.3


def test_hot_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Near copies around the threshold: many components share each bucket."""
    monkeypatch.setattr(near_copies, "BLOCK", 8)
    rng = random.Random(7)
    words = [f"v{k}" for k in range(150)]
    rows = list(enumerate(variants(rng, words, 70, (2, 6))))
    docs = documents(spark, rows)
    idf = near_copies.inverse_frequency(*near_copies.document_frequency(docs))
    expected = plain_classes(rows, idf)
    assert 1 < len(set(expected.values())) < len(rows)
    assert {r.doc_id: r.class_id for r in near_copies.classify(docs).collect()} == expected


def test_samples_meet_in_proportion_to_similarity():
    rng, idf = random.Random(8), np.ones(near_copies.BUCKETS, np.float32)
    words = [f"w{k}" for k in range(3000)]
    changed = [w if rng.random() > 0.03 else "x" + w for w in words]
    parts = [near_copies.shingles(" ".join(t)) for t in (words, changed)]
    weights = [near_copies.weights(h, c, idf) for h, c in parts]
    owner = np.repeat([0, 1], [len(h) for h, _ in parts])
    found = near_copies.samples(owner, np.concatenate([h for h, _ in parts]), np.concatenate(weights), 2)
    wanted = near_copies.similarity((parts[0][0], weights[0]), (parts[1][0], weights[1]))
    assert abs((found[0] == found[1]).mean() - wanted) < 0.15


def test_near_copies_edges(spark):
    rows = EDGES + [(9, "a lone text"), (10, ""), (11, None), (12, "one two"), (12, "three four"),
                    (13, "three four"), (14, "!!!"), (15, "!!!")]
    docs = documents(spark, rows)
    found = near_copies.classify(docs).collect()
    assert len(found) == len(rows)
    classes = {r.doc_id: r.class_id for r in found if r.doc_id is not None}
    assert classes == {1: 1, 2: 2, 3: 3, 4: 4, 6: 6, 9: 9, 10: 2, 11: 11, 12: 12, 13: 12, 14: 14, 15: 14}
    assert sorted(str(r.class_id) for r in found if r.doc_id is None) == ["9", "None"]
    kept = near_copies.without_copies(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 2, 3, 4, 6, 9, 11, 12, 14]
    assert sum(r.doc_id is None for r in kept) == 2
    assert near_copies.classify(docs.where("false")).count() == 0


# ---- operator 7

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_base(text):
    def passes(kind, match):
        digits = [int(c) for c in match if c in "0123456789"]
        if kind == "ip":
            return all(int(part) <= 255 for part in match.split("."))
        if kind == "phone":
            return 9 <= len(digits) <= 15
        doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(digits[::-1])]
        return kind == "email" or (13 <= len(digits) <= 19 and sum(doubled) % 10 == 0)

    return {kind: [m.span() for m in re.finditer(pattern, text) if passes(kind, m.group())]
            for kind, pattern in BASE.items()}


@settings(max_examples=600, deadline=None)
@given(st.one_of(*[st.text(letters, max_size=50) for letters in (
    "ab1._%+-@@. é", "0123456789 -", "12.5.0", "+1() .-5٣ 4")]))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == plain_base(text)


def test_base_spans_of_long_runs_take_little_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1.1." * 50_000, "+" * 200_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def crf(spark):
    return pii.train(pii.labelled_table(spark))


def test_shapes_cover_whole_words(crf):
    start = "key=" + "ab" * 60
    assert pii.shape_of(start + ":12") == "x=x:dd"
    ids = crf.shape_ids([[start, start + ";a@b.org:2001", "a1," * 5000, "a1," * 9000]])[1:5]
    rows = crf.table[ids]
    for row, shape in zip(rows, ("x=x", "x=x;x@x.x:dddd", "xd," * 5000)):
        for part, weights in zip((crf.own, crf.left, crf.right), row):
            known = [part[f] for f in pii.features(shape) if f in part]
            assert np.allclose(weights, np.sum(known or [np.zeros(len(pii.LABELS))], axis=0))
    assert not np.allclose(rows[0], rows[1])
    assert max(len(key) for key in crf.shapes) <= pii.LONG_SHAPE


def test_decoding_equals_whole_viterbi(crf):
    rng = random.Random(3)
    words = ("the at dot com example anna (at) 555-0101 (555) 12 2001:db8::1 4111.1111.1111.1111 x@y.z "
             "1998 and rain, Town. ### 12,500 20 7946 0958 a1-b2").split()
    texts = [[rng.choice(words if rng.random() < 0.3 else ["rain", "the", "Of"]) for _ in range(n)]
             for n in (0, 1, 2, 7, 40, 200)] + [[]]
    fast = crf.labels(texts)
    assert crf.reach is not None
    whole = pii.Crf(crf.own, crf.left, crf.right, crf.pairs)
    whole.reach = None
    for (a, b), (c, d) in zip(fast, whole.labels(texts)):
        assert a.tolist() == c.tolist() and b.tolist() == d.tolist()


def test_training_gradient_reaches_the_labels(crf):
    for line in pii.LABELLED:
        text, spans = pii.read_marked(line)
        words, starts = pii.words_of(text)
        at, labels = crf.labels([words])[0]
        gold = {i: pii.LABELS.index(kind) for i, (word, begin) in enumerate(zip(words, starts))
                for start, stop, kind in spans if start < begin + len(word) and begin < stop}
        assert dict(zip(at.tolist(), labels.tolist())) == gold


@pytest.mark.parametrize("kind,value", [
    ("email", "otto dot klein at mailbox dot example dot org"), ("email", "rosa (at) post (dot) example"),
    ("phone", "(604) 555-0119"), ("phone", "312-555-0188"), ("card", "4000.1234.5678.9017"),
    ("ip", "2001:db8:1::ab9:c0a8:102")])
def test_unseen_values_are_added(crf, kind, value):
    text = f"the rain was over and please call {value} before noon"
    (base, added), = pii.find_spans([text], crf)
    assert not any(base.values())
    assert [text[a:b] for a, b in added[kind]] and all(
        text[a:b].endswith(value[-6:]) for a, b in added[kind])


def test_personal_data_of_documents(spark, crf):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.scan_documents(docs, crf).collect():
        base = plain_base(texts[r.doc_id])
        listed = [f"{kind}:{a}:{b}" for kind in pii.KINDS for a, b in base[kind]]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(base[k]) for k in pii.KINDS)
        assert set(listed) <= set(filter(None, r.spans.split(",")))
    clean = pii.redact_documents(docs, crf)
    assert clean.schema.simpleString() == docs.schema.simpleString()
    for r in clean.collect():
        assert r.n_chars == len(r.text) and not any(pii.base_spans(r.text).values())


def test_personal_data_edges(spark, crf):
    docs = documents(spark, EDGES + [(8, "a@b.c, +1 (521) 555-2373")])
    rows = {str(r.doc_id): r for r in pii.scan_documents(docs, crf).collect()}
    assert rows["8"].spans == "email:0:5,phone:7:24" and rows["1"].spans == ""
    assert pii.scan_documents(docs, crf).count() == len(EDGES) + 1
    texts = {str(r.doc_id): r.text for r in pii.redact_documents(docs, crf).collect()}
    assert texts["8"] == "<email>, <phone>" and texts["1"] is None
    assert pii.scan_documents(docs.where("false"), crf).count() == 0
    untrained = pii.train(pii.labelled_table(spark).where("false"))
    assert pii.scan_documents(docs, untrained).where("n_added > 0").count() == 0


# ---- operator 2

@pytest.fixture(scope="module")
def mixed(spark):
    rng, rows, labels = random.Random(9), [], []
    for i in range(400):
        own = "abc"[0 if i % 10 < 6 else 1 if i % 10 < 9 else 2]
        rows.append((i, " ".join(f"{own if rng.random() < .7 else 'x'}{rng.randrange(40)}"
                                 for _ in range(rng.randrange(5, 60)))))
        if i % 2:
            labels.append((i, own))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, domain string")


def test_expected_totals_match_the_targets(mixed):
    docs, labelled = mixed
    wanted = {"a": 0.2, "b": 0.3, "c": 0.5}
    names = mixing.domains_of(labelled)
    model, priors = mixing.word_model(docs, labelled, names)
    members = mixing.memberships(docs, model, priors).cache()
    assert members.where("abs(p0 + p1 + p2 - 1) > 1e-9").count() == 0
    truth = {r.doc_id: len(r.text.split()) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in members.collect()} == truth
    rates = mixing.mix(docs, labelled, wanted)
    joined = members.join(rates.select("doc_id", "rate", "domain"), "doc_id").collect()
    total = sum(truth.values())
    assert min(r.rate for r in joined) >= 0
    for k, name in enumerate(names):
        assert sum(r.rate * r.n_tokens * r[f"p{k}"] for r in joined) == pytest.approx(
            wanted[name] * total, rel=1e-4)
    own = {i: "abc"[0 if i % 10 < 6 else 1 if i % 10 < 9 else 2] for i in truth}
    assert np.mean([r.domain == own[r.doc_id] for r in joined]) > 0.95


def test_rates_are_those_of_plain_projected_steps(mixed, spark):
    docs, labelled = mixed
    model, priors = mixing.word_model(docs, labelled, mixing.domains_of(labelled))
    members = mixing.memberships(docs, model, priors).cache()
    rows = members.orderBy("doc_id").collect()
    p = np.array([[r.p0, r.p1, r.p2] for r in rows])
    n = np.array([r.n_tokens for r in rows], float)
    for targets, least in (([0.0, 50.0, 3000.0], 0.0), ([9000.0, 5000.0, 2000.0], 1.0)):
        rate, present = np.ones(len(n)), n @ p
        for _ in range(mixing.STEPS):
            rate = np.maximum(least, rate - p @ ((n * rate @ p - targets) / present))
        found = mixing.fit_rates(members, targets, least, tolerance=0.0).orderBy("doc_id").collect()
        assert np.allclose([r.rate for r in found], rate, atol=1e-7)
        assert rate.min() >= least


def test_missed_targets_are_reported(spark):
    members = spark.createDataFrame(
        [(i, i, 1000, 1, p, 1 - p) for i, p in enumerate([0.55] * 50 + [0.45] * 50)],
        "doc_id long, text_key long, n_tokens long, copies long, p0 double, p1 double")
    with pytest.warns(mixing.TargetsMissed, match="miss a target"):
        mixing.fit_rates(members, [45_500.0, 54_500.0])
    with warnings.catch_warnings():
        warnings.simplefilter("error", mixing.TargetsMissed)
        mixing.fit_rates(members, [55_000.0, 55_000.0])


def test_rates_decide_how_often_documents_stand(mixed):
    docs, labelled = mixed
    rates = mixing.mix(docs, labelled, flatten=0.5, least=1.0).cache()
    assert rates.where("rate < 1").count() == 0
    out = mixing.repeat_documents(docs, rates)
    assert out.columns == docs.columns
    times = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    for r in rates.collect():
        assert int(r.rate) <= times[r.doc_id] <= int(r.rate) + 1


def test_mixing_edges(spark, mixed):
    docs = documents(spark, EDGES)
    labelled = spark.createDataFrame([(3, "a"), (4, "b"), (None, "a"), (2, None), (99, "b")],
                                     "doc_id long, domain string")
    rates = mixing.mix(docs, labelled)
    rows = {(str(r.doc_id), r.n_tokens): r for r in rates.collect()}
    assert rows["3", 3].copies == 2 and rows["4", 20_000].copies == 1 and rows["2", 0].n_tokens == 0
    assert len(rows) == 7 and all(r.rate >= 0 for r in rows.values())
    one = mixing.mix(docs, labelled.where("false"))
    assert {r.rate for r in one.collect()} == {1.0}
    assert sorted(str(r.doc_id) for r in mixing.repeat_documents(docs, one).collect()) == sorted(
        str(i) for i, _ in EDGES)
    assert mixing.mix(docs.where("false"), labelled).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, labelled, {"z": 1.0})


def test_mixing_runs_no_python_on_executors(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rated = mixing.mix(docs, queries.language_labels(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")))
    for frame in (rated, mixing.repeat_documents(docs, rated)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# ---- the pipeline

def test_each_stage_works_on_what_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF_DIR).cache()
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept[name] <= {r.doc_id for r in before.select("doc_id").collect()}
        assert docs.columns == (columns if name != "byte_bpe" else ["doc_id", "ids"])
        if name == "near_copies":
            assert docs.groupBy("doc_id").count().where("count > 1").count() == 0
    assert kept["near_copies"] == kept["pii"] == kept["mixing"] == kept["byte_bpe"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "pii", "mixing", "byte_bpe"]


def test_registered_queries(spark):
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.registered()) == list(range(1, 11))
