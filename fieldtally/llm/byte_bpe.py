"""Byte-level BPE by prefix dynamic programming (operator 9).

For every byte prefix of a piece there is exactly one token that can end its
encoding: the encoding of a prefix is the encoding of a shorter prefix and
that last token. ``PiecePrefixes`` stores this token per prefix. A token may
follow another if no merge reaches across their border before both are
complete (``Ranks.follows``). A prefix never depends on later bytes, so bytes
can be appended, and an edit only re-encodes what stands after it.

Whole texts are cut by the public splitting pattern; each match is encoded on
its own, so an edit to a text re-encodes a few pieces (``EditableText``).

Defined results: a null text counts as empty; an empty text has no tokens and
the hash of no bytes; null ids are carried; extra columns are ignored.
"""

import base64
import hashlib
import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from fieldtally.llm.common import map_batches

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# A space before a visible character always begins a match of the pattern.
CHUNK_BORDER = re.compile(r"(?= \S)")
CACHED_CHUNKS = 400_000
CACHED_PAIRS = 1_000_000
LONGEST_CACHED = 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Ranks:
    """A rank file prepared for the dynamic programming."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.usable: dict[bytes, int] = {}
        for token, rank in ranks.items():
            halves = self._last_merge(token, rank)
            if halves:
                self.parts[rank] = halves
                self.usable[token] = rank
        # A node per beginning of a token: [rank or -1, next byte -> node].
        self.tree: dict[int, list] = {}
        for token, rank in self.usable.items():
            children = self.tree
            for byte in token:
                node = children.setdefault(byte, [-1, {}])
                children = node[1]
            node[0] = rank
        self._above = max(self.token) + 1
        self.longest = max(map(len, self.usable))
        self.known: dict[int, bool] = {}

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; a single byte stands for
        itself. None if merging its bytes never gives the token."""
        if len(token) == 1:
            return rank, rank
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            merges = [(self.rank.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            lowest, at = min(merges)
            if lowest >= rank:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return self.rank[parts[0]], self.rank[parts[1]]

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` can stand after ``left`` in an encoding."""
        key = left << 32 | right
        known = self.known.get(key)
        if known is None:
            if len(self.known) >= CACHED_PAIRS:
                self.known.clear()
            known = self.known[key] = self._stays_apart(left, right)
        return known

    def _stays_apart(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens at their border, latest merge first.
        The border holds if no merge across it ranks below the one undone."""
        token, rank, parts = self.token, self.rank, self.parts
        undone = self._above
        while True:
            across = rank.get(token[left] + token[right])
            if across is not None and across < undone:
                return False
            left_whole, right_whole = parts[left][1] == left, parts[right][0] == right
            if left_whole and right_whole:
                return True
            # Of two merges the one with the higher rank came later. Merges of
            # one rank run from left to right, so the left one came earlier.
            if right_whole or (not left_whole and left > right):
                undone, left = left, parts[left][1]
            else:
                undone, right = right + 1, parts[right][0]


class PiecePrefixes:
    """The last token of every byte prefix of one piece."""

    def __init__(self, ranks: Ranks, piece: bytes = b""):
        self.ranks, self.piece, self.last = ranks, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Add bytes; the stored prefixes stay as they are."""
        begin = len(self.piece)
        self.piece += more
        self.last += [-1] * len(more)
        ranks, piece, last = self.ranks, self.piece, self.last
        tree, longest, known, follows = ranks.tree, ranks.longest, ranks.known.get, ranks.follows
        for at in range(max(0, begin - longest), len(piece)):
            # Nothing stands before the first token, so any may begin.
            before, end, children = last[at] << 32, at, tree
            for byte in piece[at:at + longest]:
                if byte not in children:
                    break
                end += 1
                found, children = children[byte]
                if found >= 0 and last[end] < 0:
                    if at:
                        fits = known(before | found)
                        if fits is None:
                            fits = follows(before >> 32, found)
                        if not fits:
                            continue
                    last[end] = found

    def edit(self, start: int, stop: int, new: bytes) -> None:
        """Replace bytes; prefixes up to ``start`` are kept."""
        tail, self.piece, self.last = self.piece[stop:], self.piece[:start], self.last[:start + 1]
        self.append(new + tail)

    def ids(self) -> list[int]:
        """The encoding, read from the end. A piece that is a token itself is
        that token, as the public library has it."""
        whole = self.ranks.rank.get(self.piece)
        if whole is not None:
            return [whole]
        found, end = [], len(self.piece)
        while end:
            found.append(self.last[end])
            end -= len(self.ranks.token[found[-1]])
        return found[::-1]


class Encoder:
    """Encodes and decodes whole texts; remembers frequent chunks."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN,
                 cached: int = CACHED_CHUNKS):
        self.ranks, self.pattern, self.cached = Ranks(read_ranks(path)), regex.compile(pattern), cached
        self._chunks: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        size = max(self.ranks.token) + 1
        self._token = np.array([self.ranks.token.get(i, b"") for i in range(size)], object)
        self._digits = np.array([str(i) for i in range(size)], object)

    def piece(self, piece: str) -> bytes:
        """The packed ids of a match of the pattern."""
        found = self._pieces.get(piece)
        if found is None:
            raw = piece.encode()
            whole = self.ranks.rank.get(raw)
            found = array("I", [whole] if whole is not None
                          else PiecePrefixes(self.ranks, raw).ids()).tobytes()
            if len(piece) <= LONGEST_CACHED:
                if len(self._pieces) >= self.cached:
                    self._pieces.clear()
                self._pieces[piece] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        known, piece = self._pieces.get, self.piece
        packed = b"".join([known(p) or piece(p) for p in self.pattern.findall(chunk)])
        if len(chunk) <= LONGEST_CACHED:
            if len(self._chunks) >= self.cached:
                self._chunks.clear()
            self._chunks[chunk] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        known, chunk = self._chunks.get, self._chunk
        return np.frombuffer(b"".join([known(c) or chunk(c) for c in CHUNK_BORDER.split(text)]),
                             np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self._token[ids].tolist())

    def decimal(self, ids: np.ndarray) -> str:
        return ",".join(self._digits[ids].tolist())


class EditableText:
    """An encoded text under edits. Matches of the pattern begin at chunk
    borders whatever stands before, so only chunks around an edit are encoded
    again."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.chunks = encoder, CHUNK_BORDER.split(text)
        self.encoded = [encoder.encode(c) for c in self.chunks]

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replace characters; returns how many chunks were encoded again."""
        ends = np.cumsum([len(c) for c in self.chunks])
        first = max(0, int(np.searchsorted(ends, start, "left")) - 1)
        after = min(len(self.chunks), int(np.searchsorted(ends, stop, "right")) + 2)
        begin = int(ends[first]) - len(self.chunks[first])
        middle = "".join(self.chunks[first:after])
        middle = middle[:start - begin] + new + middle[stop - begin:]
        fresh = CHUNK_BORDER.split(middle)
        self.chunks[first:after] = fresh
        self.encoded[first:after] = [self.encoder.encode(c) for c in fresh]
        return len(fresh)

    def append(self, more: str) -> int:
        end = sum(map(len, self.chunks))
        return self.edit(end, end, more)

    def ids(self) -> np.ndarray:
        return np.concatenate(self.encoded)


@lru_cache(maxsize=2)
def encoder(path: str = RANKS) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)


def encode_documents(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id and the ids of each whole text."""
    def work(batch: pa.RecordBatch) -> dict:
        encode = encoder(path).encode
        return {"doc_id": batch.column(0),
                "ids": [encode(text or "").astype(np.int32) for text in batch.column(1).to_pylist()]}

    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id and the bytes of each id list; a null list gives no bytes."""
    def work(batch: pa.RecordBatch) -> dict:
        decode = encoder(path).decode
        return {"doc_id": batch.column(0),
                "content": [decode(np.array(ids or [], np.int64))
                            for ids in batch.column(1).to_pylist()]}

    return map_batches(encoded.select("doc_id", "ids"), work, "doc_id long, content binary")


def digest_documents(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id, token count, and hashes of the ids and of the bytes decoded
    from them, without moving the ids out of their task."""
    def work(batch: pa.RecordBatch) -> dict:
        bpe = encoder(path)
        encoded = [bpe.encode(text or "") for text in batch.column(1).to_pylist()]
        return {
            "doc_id": batch.column(0),
            "n_tokens": [len(ids) for ids in encoded],
            "ids_sha256": [hashlib.sha256(bpe.decimal(ids).encode()).hexdigest() for ids in encoded],
            "decoded_sha256": [hashlib.sha256(bpe.decode(ids)).hexdigest() for ids in encoded],
        }

    return map_batches(docs.select("doc_id", "text"), work,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
