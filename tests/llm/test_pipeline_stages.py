"""Each stage of the corpus pipeline on documents at the edges."""

import pytest

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"
CLASHING = ["score", "predicted", "passages", "held_out", "class_id", "n_links", "spans", "n_added", "rate",
            "domain", "text_key", "times", "turn", "rated_text", "mix0", "Copies", "label", "n_tokens"]
LONG = "plain words about a river and its bridges in the north " * 4000
DOCS = [(1, None, "en"), (2, "", "en"), (3, "write to a.b@example.org now", "de"), (3, "write to a.b@example.org now", "de"),
        (None, "no id here but some words to read", "fr"), (4, LONG, "en"), (5, None, None)]


@pytest.fixture(scope="module")
def edges(spark):
    extra = ", ".join(f"{name} string" for name in CLASHING)
    rows = [(i, text, lang, *[f"{name} of {n}" for name in CLASHING]) for n, (i, text, lang) in enumerate(DOCS)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {extra}")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_keeps_edge_documents_and_their_columns(spark, edges, name, stage):
    found = stage(spark, edges, SF_DIR)
    rows = found.collect()
    if name == "byte_bpe":
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(d[0]) for d in DOCS)
        assert sorted(len(r.ids) == 0 for r in rows) == [False] * 4 + [True] * 3
        return
    assert found.columns == edges.columns
    # what a clashing column held came back with its own document
    for row in rows:
        n = int(row["score"].split()[-1])
        assert all(row[column] == f"{column} of {n}" for column in CLASHING)
        assert row.doc_id == DOCS[n][0] and row.lang == DOCS[n][2]
    kept = sorted({int(row["score"].split()[-1]) for row in rows})
    if name == "near_copies":
        # of the two equal rows one stays; a null id is a document like others
        assert {4, 5} <= set(kept) and len({2, 3} & set(kept)) == 1
    else:
        assert kept == list(range(len(DOCS)))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_of_an_empty_table(spark, edges, name, stage):
    assert stage(spark, edges.limit(0), SF_DIR).count() == 0
