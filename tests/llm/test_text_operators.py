"""Byte-level BPE, token files, token counts and license notices."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldtally.llm import byte_bpe, licenses, token_counts, token_files
from fieldtally.llm.common import staging_path

SF_DIR = "/root/testdata/sf0.001"
EDGES = [(1, None), (2, ""), (None, "a lone text"), (3, "same"), (3, "same"), (4, "word " * 30_000),
         (5, "a" * 20_000), (6, " \n\t  "), (7, "é漢字🎉 ́x ½² don't 'S\x1c\x85"), (8, "x"),
         (9, "<|endoftext|> and so on")]


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls, empty, long and repeated texts, with columns that clash."""
    return spark.createDataFrame(
        [(i, t, 7, "x", 1.5) for i, t in EDGES],
        "doc_id long, text string, n_tokens int, ids string, license double")


@pytest.fixture(scope="module")
def library():
    import tiktoken
    ranks = byte_bpe.read_ranks(byte_bpe.RANKS)
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


# ---- operator 9

@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_bpe_equals_the_library(text):
    import tiktoken
    bpe = byte_bpe.encoder()
    known = getattr(test_bpe_equals_the_library, "known", None)
    if known is None:
        known = test_bpe_equals_the_library.known = tiktoken.Encoding(
            "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks.rank, special_tokens={})
    ids = bpe.encode(text)
    assert ids.tolist() == known.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def test_bpe_of_whole_documents(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {r.doc_id: r for r in byte_bpe.digest_documents(docs).collect()}
    for row in docs.collect():
        ids = library.encode_ordinary(row.text)
        assert found[row.doc_id].n_tokens == len(ids)
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[row.doc_id].decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=30), st.binary(max_size=30), st.integers(0, 30), st.integers(0, 30))
def test_appended_and_edited_prefixes_are_exact(first, more, a, b):
    ranks = byte_bpe.encoder().ranks
    table = byte_bpe.PiecePrefixes(ranks, first)
    table.append(more)
    assert table.last == byte_bpe.PiecePrefixes(ranks, first + more).last
    a, b = sorted((min(a, len(table.piece)), min(b, len(table.piece))))
    whole = table.piece[:a] + first + table.piece[b:]
    table.edit(a, b, first)
    assert table.last == byte_bpe.PiecePrefixes(ranks, whole).last


def test_edited_texts_encode_few_chunks_again(library):
    text = "the first line.\nand a second  line with don't and 123 numbers " * 200
    edited, rng = byte_bpe.EditableText(byte_bpe.encoder(), text), random.Random(1)
    for _ in range(150):
        a = rng.randrange(len(text) + 1)
        b = min(len(text), a + rng.choice([0, 0, 1, 5, 40]))
        new = rng.choice(["", " ", "x", "'s", "\n\n", " two words", "é"])
        text = text[:a] + new + text[b:]
        assert edited.edit(a, b, new) < 25
        assert edited.ids().tolist() == library.encode_ordinary(text)
    edited.append(" end")
    assert edited.ids().tolist() == library.encode_ordinary(text + " end")


def test_bpe_edges(spark, edges, library):
    encoded = byte_bpe.encode_documents(edges)
    found = sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str)
    assert found == sorted(((i, library.encode_ordinary(t or "")) for i, t in EDGES), key=str)
    back = sorted(((r.doc_id, bytes(r.content)) for r in byte_bpe.decode_documents(encoded).collect()), key=str)
    assert back == sorted(((i, (t or "").encode()) for i, t in EDGES), key=str)
    assert byte_bpe.digest_documents(edges.where("false")).count() == 0


# ---- operator 6

@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 7, 300, 5000]), max_size=200), st.integers(0, 3))
def test_segments_give_back_every_document(sizes, nulls):
    nulls = min(nulls, len(sizes))
    doc_ids = [None] * nulls + [3 * i - 5 for i in range(len(sizes) - nulls)]
    kind = np.dtype("<u2")
    packed = [(np.arange(n) % 60_000).astype(kind).tobytes() for n in sizes]
    read = token_files.Segment(token_files.pack_segment(doc_ids, packed, kind))
    ends = np.cumsum(sizes).tolist() if sizes else []
    assert (read.ends().tolist() if sizes else []) == ends
    assert [read.end(i) for i in range(len(sizes))] == ends
    assert [read.doc_id(i) for i in range(len(sizes))] == doc_ids
    assert [read.document(i).tobytes() for i in range(len(sizes))] == packed


def test_boundaries_take_little_space():
    ends = np.cumsum(np.full(10_000, 700))
    low_bits, samples, low, high = token_files.pack_ends(ends, int(ends[-1]))
    assert 8 * (len(samples) + len(low) + len(high)) / len(ends) < 2 + low_bits + 1.6


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("abcXYZ éÉß'stdll0123.,!?\n\t", max_size=40)))
def test_words_have_the_ids_of_whole_texts(text):
    words = token_files.tokenizer()
    ids = np.frombuffer(words.encode([text])[0], words.type).tolist()
    assert ids == words.whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aSstTrReEvVmMlLdD09'.- \n\u00c9\u00df\u00ff\u6f22", max_size=20), max_size=6))
def test_texts_of_one_call_keep_apart(texts):
    words = token_files.tokenizer()
    found = [np.frombuffer(ids, words.type).tolist() for ids in words.encode(texts)]
    assert found == [words.whole.encode(text, add_special_tokens=False).ids for text in texts]


def test_words_in_use_are_not_encoded_again():
    words, asked = token_files.WordTokenizer(cached=50), []
    encode = words._encode_words
    words._encode_words = lambda some: asked.extend(some) or encode(some)
    for call in range(40):
        words.encode(["frequent " + " ".join(f"rare{chr(97 + call % 26)}{chr(97 + call // 26)}{chr(97 + i)}"
                                             for i in range(20))])
    assert sum(word in ("frequent", b"frequent") for word in asked) == 1
    assert len(words.newer) + len(words.older) < 200


def expected_files(rows):
    whole, start, found = token_files.tokenizer().whole, 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        found.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(found, key=str)


@pytest.mark.parametrize("segment_ids", [50, 1 << 18])
def test_files_in_ascending_order(spark, edges, segment_ids):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    for frame in (edges, docs):
        path = staging_path(spark, "files")
        token_files.write_segments(frame.repartition(3), path, segment_ids=segment_ids)
        found = [tuple(r) for r in token_files.document_digests(token_files.read_segments(spark, path)).collect()]
        assert sorted(found, key=str) == expected_files([(r.doc_id, r.text) for r in frame.collect()])


def test_no_documents_no_segments(spark, edges):
    path = staging_path(spark, "files")
    token_files.write_segments(edges.where("false"), path)
    assert token_files.document_digests(token_files.read_segments(spark, path)).count() == 0


# ---- operator 8

def plain_counts(starts, ends, low, high, rule):
    total = crossing = 0
    for s, e in zip(starts, ends):
        covered = min(e, high) - max(s, low)
        if covered > 0:
            crossing += s < low or e > high
            total += {"first": low <= s < high, "last": low < e <= high,
                      "share": covered / (e - s)}[rule]
    return total, crossing


@pytest.mark.parametrize("rule", token_counts.RULES)
@settings(max_examples=150, deadline=None)
@given(text=st.text("ab é漢\n\n  .🎉xyz", max_size=60), data=st.data())
def test_spans_join_like_every_pair(rule, text, data):
    starts, ends = token_counts.span_encoder().spans(text)
    assert not len(ends) or (starts[0] == 0 and ends[-1] == len(text))
    border = st.integers(0, len(text))
    sections = data.draw(st.lists(st.tuples(border, border), max_size=5))
    low, high = (np.array([s[k] for s in sections], np.int64) for k in (0, 1))
    counts, crossing = token_counts.join_spans(starts, ends, low, high, rule)
    expected = [plain_counts(starts, ends, a, b, rule) for a, b in sections]
    assert np.allclose(counts, [n for n, _ in expected])
    assert crossing.tolist() == [c for _, c in expected]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_lines_share_out_all_tokens(spark, edges, rule):
    counted = token_counts.count_tokens(edges.where("doc_id <> 7"), rule=rule)
    found = {r[0]: r[1] for r in counted.groupBy("doc_id").sum("n_tokens").collect()}
    library = token_counts.span_encoder().library
    for i, text in EDGES:
        if text and i not in (None, 7):
            copies = sum(j == i for j, _ in EDGES)
            assert found[i] == pytest.approx(copies * len(library.encode_ordinary(text)))
    assert {1, 2} & set(found) == set()
    assert token_counts.count_tokens(edges.where("false"), rule=rule).count() == 0


def test_given_sections(spark):
    docs = spark.createDataFrame([(1, "hello world again"), (2, None)], "doc_id long, text string")
    sections = spark.createDataFrame(
        [(1, 0, 0, 5), (1, 1, 5, None), (1, 2, 9, 9), (1, 3, -4, 999), (2, 0, 0, 4)],
        "doc_id long, section int, start int, stop int")
    rows = token_counts.count_tokens(docs, sections).orderBy("doc_id", "section").collect()
    assert [(r.doc_id, r.section, r.start, r.stop, r.n_tokens) for r in rows] == [
        (1, 0, 0, 5, 1), (1, 1, 5, 17, 2), (1, 2, 9, 9, 0), (1, 3, 0, 17, 3), (2, 0, 0, 0, 0)]
    with pytest.raises(ValueError):
        token_counts.count_tokens(docs, rule="middle")


# ---- operator 10

def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=14), st.lists(st.sampled_from("abcdefgh"), max_size=14))
def test_alignment_is_a_common_subsequence(text, template):
    pairs = licenses.align(text, template)
    assert all(text[i] == template[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    assert len(pairs) <= common_length(text, template)
    if len(set(text)) == len(text) and len(set(template)) == len(template):
        assert len(pairs) == common_length(text, template)
    if text == template:
        assert len(pairs) == len(text)


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_notices_are_found_anywhere(name):
    scanner, notice = licenses.Scanner(licenses.TEMPLATES), licenses.TEMPLATES[name]
    prose = "the rain in the north of the land was under the license of the weather " * 40
    found = scanner.scan(prose + notice + " " + prose + notice.upper() + "\n" + notice + prose)
    assert [(f[0], f[1]) for f in found] == [(name, 1.0)] * 3
    at = len(prose)
    assert (found[0][2], found[0][3]) == (at, at + len(notice.rstrip(".,/)")))
    assert scanner.scan(prose) == []


def test_changed_notices_are_found_by_coverage():
    scanner, words = licenses.Scanner(licenses.TEMPLATES), licenses.TEMPLATES["MIT-full"].split()
    rng = random.Random(4)
    for share, hit in ((0.05, True), (0.5, False)):
        changed = [w if rng.random() > share else "changed" for w in words]
        changed[40:40] = ["some", "added", "words"]
        found = scanner.scan("before " + " ".join(changed) + " after")
        assert [f[0] for f in found] == (["MIT-full"] if hit else [])
        if hit:
            whole = licenses.WORD.findall(" ".join(words).lower())
            best = common_length(licenses.WORD.findall(" ".join(changed).lower()), whole)
            assert found[0][4] >= 0.97 * best


def test_license_edges(spark, edges):
    rows = licenses.scan_documents(edges).collect()
    assert len(rows) == len(EDGES) and {r.n_found for r in rows} == {0}
    assert licenses.scan_documents(edges.where("false")).count() == 0
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    short = {k: v for k, v in licenses.TEMPLATES.items() if len(v) < 100}
    plain = {r.doc_id: sum(len(re.findall(re.escape(v), r.text)) for v in short.values()) for r in docs.collect()}
    found = {r.doc_id: r.n_found for r in licenses.scan_documents(docs).collect()}
    assert sum(plain.values()) > 0 and all(found[i] >= n for i, n in plain.items())


def test_sections_of_a_document_without_id(spark):
    docs = spark.createDataFrame([(None, "one two three"), (1, "four")], "doc_id long, text string")
    sections = spark.createDataFrame([(None, 0, 0, 7), (None, 1, 7, None), (1, 0, 0, None), (2, 0, 0, 3)],
                                     "doc_id long, section int, start long, stop long")
    found = {(r.doc_id, r.section): r.n_tokens for r in token_counts.count_tokens(docs, sections).collect()}
    assert set(found) == {(None, 0), (None, 1), (1, 0)} and all(n > 0 for n in found.values())
