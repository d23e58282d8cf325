"""SentencePiece BPE by a prefix table of merge-type tokens (operator 13).

For each prefix of a text there is one token that can end its encoding. An
Aho-Corasick automaton over the pieces finds every piece that ends at a
character; the one that may stand after the token ending the shorter prefix is
stored, and the ids are recovered backwards from the end of the text. A token may
follow another if no merge reaches across their border before both are complete
(``Pieces.may_follow``). Characters outside the vocabulary stand alone and become
their UTF-8 bytes.

A piece never holds a space after another character, nor a letter beside a sign,
so such parts are encoded apart and frequent ones remembered. Pieces of spaces
alone share the lowest score: runs of spaces that nothing else took are joined
last, from the left. All this is checked when a model is loaded, and so are the
merges: a model for which it does not hold is refused.

Defined results: a null text counts as empty; an empty text has no tokens and
decodes to an empty text; null ids are carried; repeated rows are answered each;
extra columns are ignored; a text may be as long as a cell can be.
"""

import hashlib
import re
import unicodedata
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from fieldtally.llm.common import map_batches

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
CACHED_PARTS = 200_000
CACHED_PAIRS = 500_000
LONGEST_CACHED = 40


class UnsupportedModel(ValueError):
    """The model has no merge order that a prefix table can state."""


class Pieces:
    """A model's pieces with the merge that makes each of them."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" a  Ａb ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}Ａb{SPACE}":
            raise UnsupportedModel("Texts are not taken as they are, with a space before them")
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte_id = {int(self.text[i][3:-1], 16): i for i in range(len(self.text)) if model.is_byte(i)}
        if len(self.byte_id) != 256:
            raise UnsupportedModel("The model has no piece per byte")
        self.byte_of = {i: byte for byte, i in self.byte_id.items()}
        self.unknown, self.unknown_surface = model.unk_id(), model.decode([model.unk_id()])
        self.silent = {i for i in range(len(self.text)) if model.is_control(i)}
        plain = [i for i in range(len(self.text)) if i not in self.byte_of and i not in self.silent
                 and not model.is_unknown(i) and not model.is_unused(i)]
        self.id = {self.text[i]: i for i in plain}
        #: Pieces of spaces alone, by their length.
        self.runs = {len(self.text[i]): i for i in plain if not self.text[i].strip(SPACE)}
        if 1 not in self.runs:
            raise UnsupportedModel("A space has no piece")
        merged = sorted((i for i in plain if self.text[i].strip(SPACE) and len(self.text[i]) > 1),
                        key=model.get_score, reverse=True)
        scores = [model.get_score(i) for i in merged]
        last = {model.get_score(i) for size, i in self.runs.items() if size > 1}
        if len(set(scores)) < len(scores) or len(last) > 1 or (last and min(last) >= min(scores)):
            raise UnsupportedModel("Merges of equal score")
        if any(SPACE in piece[1:] for piece in map(self.text.__getitem__, merged)):
            raise UnsupportedModel("A piece holds a space after its beginning")
        #: Time of a piece's merge; a character is there from the beginning.
        self.time = {self.text[i]: at for at, i in enumerate(merged)}
        self.halves: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id.items():
            if len(piece) == 1:
                self.automaton.add_word(piece, (1, i))
            elif piece in self.time and self._made(piece):
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.pairs = KnownPairs(self)
        self.part = re.compile(self._part_pattern())

    def _part_pattern(self) -> str:
        """What is encoded apart: a space with what follows it, where no piece
        holds both a sign and another character. Signs are the characters that
        belong to no word of which that is so."""
        beside = {(a, b) for piece in self.id for pair in zip(piece, piece[1:]) if SPACE not in pair
                  for a, b in (pair, pair[::-1])}
        signs = {c for c in self.id if len(c) == 1 and unicodedata.category(c)[0] in "PSNZC"
                 and c < "\U00010000"} - {SPACE}
        while mixed := {a for a, b in beside if a in signs and b not in signs}:
            signs -= mixed
        held = "".join(map(re.escape, sorted(signs)))
        signs_or_none = f"|[{held}]+" if held else ""
        return f"{SPACE}?(?:[^{held}{SPACE}]+{signs_or_none})|{SPACE}"

    def _made(self, piece: str) -> bool:
        """Store the last merge that makes a piece; False if its own characters
        merge to something else."""
        parts, time = list(piece), self.time
        before = -1
        while len(parts) > 1:
            due = [(time[a + b], at) for at, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in time]
            if not due:
                return False
            now, at = min(due)
            if now < before:
                raise UnsupportedModel(f"A part of {piece!r} merges after the whole")
            before = now
            if len(parts) == 2:
                self.halves[piece] = parts[0], parts[1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return True

    def may_follow(self, left: str, right: str) -> bool:
        """Go back in time from the two whole tokens, taking apart the one made
        last. ``until`` is when a side of the border was taken up: a merge across
        the border that was due earlier would have come first. Of two merges of
        one piece the left one comes first, so the time of a right side counts
        half a step more."""
        time, halves = self.time, self.halves
        until = float("inf")
        while True:
            across = time.get(left + right)
            if across is not None and across < until:
                return False
            left_made, right_made = time.get(left, -1), time.get(right, -1)
            if left_made < 0 and right_made < 0:
                return True
            if left_made > right_made:
                until, left = left_made, halves[left][1]
            else:
                until, right = right_made + 0.5, halves[right][0]

    def prefixes(self, text: str) -> list[int]:
        """For each prefix of ``text`` its last token, the empty prefix first; -1
        for that and for a prefix that ends outside the vocabulary."""
        table, pairs, bits = [-1] * (len(text) + 1), self.pairs, self.pairs.bits
        for at, (size, piece) in self.automaton.iter(text):
            end = at + 1
            if table[end] < 0 and pairs[table[end - size] << bits | piece]:
                table[end] = piece
        return table

    def run_of_spaces(self, size: int) -> list[int]:
        """Ids of ``size`` single spaces: of the pairs that are a piece the
        leftmost merges, until there is none. What lies left of the next space
        has no such pair."""
        sizes: list[int] = []
        for _ in range(size):
            sizes.append(1)
            while len(sizes) > 1 and sizes[-2] + sizes[-1] in self.runs:
                sizes[-2:] = [sizes[-2] + sizes[-1]]
        return [self.runs[n] for n in sizes]

    def ids(self, text: str) -> list[int]:
        """Ids of a text whose runs of spaces are still apart."""
        table, end, found = self.prefixes(text), len(text), []
        while end:
            piece = table[end]
            if piece < 0:
                found += [self.byte_id[byte] for byte in reversed(text[end - 1].encode())]
                end -= 1
            else:
                found.append(piece)
                end -= len(self.text[piece])
        return found[::-1]


class KnownPairs(dict):
    """Whether a token may follow another, by both ids in one number. Whatever
    comes first, or after an unknown character, may stand (negative numbers)."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces, self.bits = pieces, len(pieces.text).bit_length()

    def __missing__(self, pair: int) -> bool:
        if len(self) >= CACHED_PAIRS:
            self.clear()
        text = self.pieces.text
        left, right = pair >> self.bits, pair & (1 << self.bits) - 1
        fits = self[pair] = left < 0 or self.pieces.may_follow(text[left], text[right])
        return fits


class Encoder:
    """Encodes and decodes whole texts; remembers frequent parts."""

    def __init__(self, path: str = MODEL, cached: int = CACHED_PARTS):
        self.pieces, self.cached = Pieces(path), cached
        self._newer: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._digits = [str(i) for i in range(len(self.pieces.text))]
        self._surface = [piece.replace(SPACE, " ") for piece in self.pieces.text]
        for i in self.pieces.silent:
            self._surface[i] = ""
        self._surface[self.pieces.unknown] = self.pieces.unknown_surface
        self._bytes = np.zeros(len(self._digits), bool)
        self._bytes[list(self.pieces.byte_of)] = True

    def _encode_part(self, part: str) -> bytes:
        """Ids of a part from the older remembered ones, or anew. When the newer
        ones are full they become the older, so frequent parts stay."""
        packed = self._older.get(part)
        if packed is None:
            packed = array("i", self.pieces.ids(part)).tobytes()
        if len(part) <= LONGEST_CACHED:
            if len(self._newer) >= self.cached:
                self._newer, self._older = {}, self._newer
            self._newer[part] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        found = []
        for part in self.pieces.part.findall(SPACE + text.replace(" ", SPACE)):
            found.append(self._newer.get(part) or self._encode_part(part))
        return self._joined(np.frombuffer(b"".join(found), np.int32))

    def _joined(self, ids: np.ndarray) -> np.ndarray:
        """Join runs of single spaces, the merges that come last."""
        single = ids == self.pieces.runs[1]
        if not (single[1:] & single[:-1]).any():
            return ids
        edges = np.flatnonzero(np.diff(single, prepend=False, append=False))
        parts, done = [], 0
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin > 1:
                parts += [ids[done:begin], np.array(self.pieces.run_of_spaces(end - begin), np.int32)]
                done = end
        return np.concatenate([*parts, ids[done:]])

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids: bytes are read as UTF-8 (what is none
        becomes the replacement character, byte by byte), and the space that
        stands before each text goes."""
        listed, surface = ids.tolist(), self._surface
        at_bytes = np.flatnonzero(self._bytes[ids])
        parts, done = [], 0
        for group in np.split(at_bytes, np.flatnonzero(np.diff(at_bytes) > 1) + 1) if len(at_bytes) else ():
            begin, end = int(group[0]), int(group[-1]) + 1
            parts += map(surface.__getitem__, listed[done:begin])
            parts.append(read_bytes(bytes(map(self.pieces.byte_of.__getitem__, listed[begin:end]))))
            done = end
        text = "".join([*parts, *map(surface.__getitem__, listed[done:])])
        first = next((i for i in listed if i not in self.pieces.silent), self.pieces.unknown)
        return text[1:] if self.pieces.text[first].startswith(SPACE) else text

    def decimal(self, ids: np.ndarray) -> str:
        return ",".join(map(self._digits.__getitem__, ids.tolist()))


def read_bytes(raw: bytes) -> str:
    """UTF-8 to text; each byte that belongs to no character is replaced."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        found, at = [], 0
        while at < len(raw):
            for size in range(1, 5):
                try:
                    found.append(raw[at:at + size].decode())
                except UnicodeDecodeError:
                    continue
                at += size
                break
            else:
                found.append("�")
                at += 1
        return "".join(found)


@lru_cache(maxsize=1)
def encoder(path: str = MODEL) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and the ids of each whole text."""
    def work(batch: pa.RecordBatch) -> dict:
        encode = encoder(path).encode
        return {"doc_id": batch.column(0),
                "ids": [encode(text or "") for text in batch.column(1).to_pylist()]}

    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and the text of each id list; a null list gives an empty text."""
    def work(batch: pa.RecordBatch) -> dict:
        decode = encoder(path).decode
        return {"doc_id": batch.column(0),
                "text": [decode(np.array(ids or [], np.int32)) for ids in batch.column(1).to_pylist()]}

    return map_batches(encoded.select("doc_id", "ids"), work, "doc_id long, text string")


def digest_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, token count, and hashes of the ids and of the text decoded from
    them, without moving the ids out of their task."""
    def work(batch: pa.RecordBatch) -> dict:
        pieces = encoder(path)
        counts, ids_hash, text_hash = [], [], []
        for text in batch.column(1):
            ids = pieces.encode(text.as_py() or "")
            counts.append(len(ids))
            ids_hash.append(hashlib.sha256(pieces.decimal(ids).encode()).hexdigest())
            text_hash.append(hashlib.sha256(pieces.decode(ids).encode()).hexdigest())
        return {"doc_id": batch.column(0), "n_tokens": counts, "ids_sha256": ids_hash,
                "decoded_sha256": text_hash}

    return map_batches(docs.select("doc_id", "text"), work,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
