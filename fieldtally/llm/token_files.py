"""Token ids in binary segments with Elias-Fano boundaries (operator 6).

Documents are put in ascending doc_id order (ties by text), encoded whole and
cut into segments of whole documents. A segment is one binary value, written
as rows of a Parquet table, so any store Spark can write will do and a task
that is run again leaves no second copy. All numbers are little-endian:

    magic 8 bytes | docs, ids, nulls u64 | id width, low bits, 0 x 6 u8
    doc_ids i64 x (docs - nulls)         null ids come first and are not stored
    samples u32 x ceil(docs / 64)        bit position of every 64th end
    low     low bits of each document's end, packed
    high    the rest of the ends in unary: bit (end >> low bits) + rank
    ids     u16 or u32 x ids             concatenated, end id after each text

The ends of n documents over u ids take about 2 + log2(u / n) bits each.

Defined results: a null text counts as empty and holds the end id only; an
empty table gives no segment; repeated rows stay; extra columns are ignored.
A segment is closed at ``SEGMENT_IDS`` ids; a longer document has its own.
"""

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.common import arrow_schema, collector_paused, index_words, prepare_python

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
SEGMENT_IDS = 1 << 18
SAMPLE = 64
CACHED_WORDS = 400_000
LONGEST_CACHED = 40
MAGIC = b"EFTOKEN1"
HEAD = struct.Struct("<8sQQQBB6x")

# Texts of these characters only: composed letters whose lower case is one
# character, so that words can be cut and lowered before they reach the library.
PLAIN = bytes([9, 10, 13, *range(0x20, 0x7f), *range(0xc0, 0xd7), *range(0xd8, 0xf7), *range(0xf8, 0x100)])
LOWERED = bytes([b + 32 if chr(b).isupper() else 32 if b in b"\t\n\r" else b for b in range(256)])
SPACE, LETTER, DIGIT, OTHER = range(4)
KINDS = bytes([SPACE if b == 32 else LETTER if chr(b).isalpha() else DIGIT if b in b"0123456789" else OTHER
               for b in range(256)])
ENDINGS = [b"s", b"t", b"m", b"d", b"re", b"ve", b"ll"]


def cut_words(raws: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words of ``PLAIN`` texts as the tokenizer cuts them: runs of letters,
    single digits, runs of other signs, and endings such as 's. The distinct
    words, the place of each word among these, the words up to each text's end."""
    text = b"".join([b" ", b" ".join(raws), b"    "]).translate(LOWERED)
    data, kinds = np.frombuffer(text, np.uint8), np.frombuffer(text.translate(KINDS), np.uint8)
    inside = kinds != SPACE
    begins = np.append(False, kinds[1:] != kinds[:-1]) | (kinds == DIGIT)
    # an ending counts where its quote begins a run of signs
    quotes = np.flatnonzero((data == ord("'")) & begins)
    for ending in ENDINGS:
        hit = quotes[np.all([data[quotes + 1 + i] == letter for i, letter in enumerate(ending)], axis=0)]
        begins[hit + 1] = False
        begins[hit + 1 + len(ending)] = True
    begins &= inside
    upto = np.searchsorted(np.flatnonzero(begins), np.cumsum([len(raw) + 1 for raw in raws]))
    return *index_words(data, inside, begins), upto


class WordTokenizer:
    """The library's ids for whole texts, with frequent words remembered.

    The tokenizer drops white space and never merges across words, so a word
    has the same ids in any text. Texts outside ``PLAIN``, or with the name of
    a special token, go through the library whole."""

    def __init__(self, path: str = TOKENIZER, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {b: level.pre_tokenize_str(chr(b))[0][0] for b in PLAIN if b > 0x7f}
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.cached, self.newer, self.older = cached, {}, {}
        self.type = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text. Each different word is looked up once
        for all texts of the call."""
        raws = [self._plain(text) for text in texts]
        words, places, upto = cut_words([raw for raw in raws if raw is not None])
        found = pa.array(self._look_up(words), pa.large_binary()).take(pa.array(places))
        _, offsets, ids = found.buffers()
        ids = memoryview(ids or b"")
        ends = np.frombuffer(offsets, np.int64)[upto].tolist() if len(places) else [0] * len(upto)
        cuts = zip([0, *ends], ends)
        return [self._whole(text) if raw is None else bytes(ids[slice(*next(cuts))])
                for text, raw in zip(texts, raws)]

    def _whole(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.type).tobytes()

    def _plain(self, text: str) -> bytes | None:
        """The bytes of a text of ``PLAIN`` characters without special tokens."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return None if raw.translate(None, PLAIN) or any(name in text for name in self.special) else raw

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        newer, older = self.newer, self.older
        found = list(map(newer.get, words))
        lacking = [word for word, ids in zip(words, found) if ids is None]
        fresh = {word: ids for word in lacking if (ids := older.get(word))}
        missing = [word for word in lacking if word not in fresh]
        fresh.update(zip(missing, self._encode_words(missing)))
        if len(newer) > self.cached:
            # what was in use since the last time stays at hand
            self.older, self.newer = newer, {}
        self.newer.update((word, ids) for word, ids in fresh.items() if len(word) <= LONGEST_CACHED)
        return [fresh[word] if ids is None else ids for word, ids in zip(words, found)]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        texts = [word.decode() if word.isascii() else word.decode("latin-1").translate(self.letters)
                 for word in words]
        found = [[token.id for token in tokens] for tokens in map(self.model.tokenize, texts)]
        ids = np.array(list(chain.from_iterable(found)), self.type).tobytes()
        ends = (np.cumsum([len(part) for part in found]) * self.type.itemsize).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


@lru_cache(maxsize=2)
def tokenizer(path: str = TOKENIZER) -> WordTokenizer:
    """One tokenizer per Python worker."""
    return WordTokenizer(path)


def pack_ends(ends: np.ndarray, universe: int) -> tuple[int, bytes, bytes, bytes]:
    """Elias-Fano: (low bits, select samples, packed low parts, high bits)."""
    n = len(ends)
    low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
    ends = ends.astype(np.uint64)
    low = ((ends[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    ones = (ends >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    return (low_bits, ones[::SAMPLE].astype("<u4").tobytes(),
            np.packbits(low.ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes())


def pack_segment(doc_ids: list[int | None], packed: list[bytes], kind: np.dtype) -> bytes:
    """One segment from documents in order; null doc_ids must come first."""
    lengths = np.array([len(p) // kind.itemsize for p in packed], np.int64)
    ends = np.cumsum(lengths)
    total, nulls = int(lengths.sum()), sum(d is None for d in doc_ids)
    low_bits, samples, low, high = pack_ends(ends, total)
    return b"".join([
        HEAD.pack(MAGIC, len(doc_ids), total, nulls, kind.itemsize, low_bits),
        np.array(doc_ids[nulls:], "<i8").tobytes(), samples, low, high, *packed])


class Segment:
    """Reads one segment; single documents come by select, without a table."""

    def __init__(self, content: bytes):
        magic, self.docs, self.size, self.nulls, width, self.low_bits = HEAD.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("This is not a token segment")
        kind = np.dtype(f"<u{width}")
        at = HEAD.size
        self._doc_ids = np.frombuffer(content, "<i8", self.docs - self.nulls, at)
        at += 8 * (self.docs - self.nulls)
        self.samples = np.frombuffer(content, "<u4", -(-self.docs // SAMPLE), at)
        at += 4 * len(self.samples)
        low_bytes = -(-self.docs * self.low_bits // 8)
        self.low = np.frombuffer(content, np.uint8, low_bytes, at)
        at += low_bytes
        last = len(content) - self.size * width
        self.high = np.frombuffer(content, np.uint8, last - at, at)
        self.ids = np.frombuffer(content, kind, self.size, last)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else int(self._doc_ids[i - self.nulls])

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        window = self.low[first // 8:(first + self.low_bits + 7) // 8].tobytes()
        return int.from_bytes(window, "little") >> first % 8 & (1 << self.low_bits) - 1

    def end(self, i: int) -> int:
        """Ids up to and with document ``i``: select from the sample before."""
        position, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, word = position // 8, int(self.high[position // 8]) >> position % 8 << position % 8
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = 8 * byte + (word & -word).bit_length() - 1
        return one - i << self.low_bits | self._low(i)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.end(i - 1) if i else 0:self.end(i)]

    def ends(self) -> np.ndarray:
        """All ends at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.docs]
        bits = np.unpackbits(self.low, bitorder="little")[:self.docs * self.low_bits]
        low = bits.reshape(self.docs, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits))
        return (ones - np.arange(self.docs) << self.low_bits) + low


def write_segments(docs: DataFrame, path: str, tokenizer_path: str = TOKENIZER,
                   end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Write documents in ascending doc_id order: a shard per task, its
    segments numbered, each with the ids that stand before it in the shard."""
    spark = docs.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame(
        [], "shard int, segment int, before long, n_docs long, n_ids long, content binary").schema
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, before = TaskContext.get().partitionId(), 0, 0
        words = tokenizer(tokenizer_path)
        end, width = np.array([end_id], words.type).tobytes(), words.type.itemsize
        ids, packed, held = [], [], 0

        def close() -> pa.RecordBatch:
            content = pack_segment(ids, packed, words.type)
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "segment": segment, "before": before, "n_docs": len(ids),
                "n_ids": held, "content": content}], schema=arrow)

        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            with collector_paused():
                encoded = words.encode(texts)
            for doc_id, body in zip(batch.column(0).to_pylist(), encoded):
                size = len(body) // width + 1
                if ids and held + size > segment_ids:
                    yield close()
                    segment, before = segment + 1, before + held
                    ids, packed, held = [], [], 0
                ids.append(doc_id)
                packed.append(body + end)
                held += size
        if ids:
            yield close()

    ordered = (docs.select("doc_id", "text")
               .repartitionByRange(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")))
    ordered.mapInArrow(run, schema).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The written segments with ``start``: all ids before a segment. Only one
    row per shard (write task) is summed up and broadcast."""
    segments = spark.read.schema(
        "shard int, segment int, before long, n_docs long, n_ids long, content binary").parquet(path)
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("size"))
    bases = shards.selectExpr(
        "shard", "sum(size) over (order by shard rows unbounded preceding) - size as base")
    return (segments.join(F.broadcast(bases), "shard")
            .withColumn("start", F.col("base") + F.col("before")).drop("base"))


def document_digests(segments: DataFrame) -> DataFrame:
    """Each document's place, size and checksum, read from the segments."""
    spark = segments.sparkSession
    prepare_python(spark)
    schema = spark.createDataFrame(
        [], "doc_id long, start long, n_tokens long, ids_crc32 long").schema
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                read = Segment(content.as_py())
                ends = read.ends()
                begins = np.concatenate([[0], ends[:-1]])
                wide = read.ids.astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([read.doc_id(i) for i in range(read.docs)], pa.int64()),
                    pa.array(begins + start, pa.int64()), pa.array(ends - begins, pa.int64()),
                    pa.array([zlib.crc32(wide[a:b]) for a, b in zip(begins, ends)], pa.int64()),
                ], schema=arrow)

    return segments.select("start", "content").mapInArrow(run, schema)
