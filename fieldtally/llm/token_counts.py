"""Token counts per section by offset-mapped attribution (operator 8).

A document is encoded whole, once. Token lengths in bytes give every token's
character span; a token that holds part of a character has that character in
its span. Sections are character intervals of the same text, and sorted token
borders join them to tokens by binary search. What crosses a border is given
out by a rule:

    first   the section that holds the token's first character
    last    the section that holds its last character
    share   every section, by the share of the token's characters it holds

Where sections cut up a text without gap or overlap, each rule gives out
exactly the document's tokens.

Defined results: a null or empty text has no section of its own and no row;
given sections are cut at the text's ends, an empty one counts nothing and a
null border stands for the text's own end; null ids are carried; repeated rows
stay; extra columns are ignored. A hot section table key spreads as the texts
do: a document's sections travel in one array, which its text's size bounds.
"""

from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.byte_bpe import read_ranks
from fieldtally.llm.common import map_batches

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RULES = ("first", "last", "share")


class SpanEncoder:
    """Token spans of whole texts."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN):
        import tiktoken
        ranks = read_ranks(path)
        self.library = tiktoken.Encoding("spans", pat_str=pattern, mergeable_ranks=ranks,
                                         special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[list(ranks.values())] = list(map(len, ranks))

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token, in characters."""
        sizes = self.size[self.library.encode_ordinary(text)]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        if text.isascii() or not len(sizes):
            return starts, ends
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        return character[starts], character[ends - 1] + 1


@lru_cache(maxsize=2)
def span_encoder(path: str = RANKS) -> SpanEncoder:
    """One encoder per Python worker."""
    return SpanEncoder(path)


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The lines of a text, each with its line end."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum([len(line) for line in text.split("\n")]) + np.arange(1, text.count("\n") + 2)
    ends[-1] = len(text)
    starts = np.concatenate([[0], ends[:-1]])
    return (starts, ends) if starts[-1] < len(text) else (starts[:-1], ends[:-1])


def join_spans(starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray,
               rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section [low, high) by the rule, and how many tokens
    stand in it only in part. Token starts and ends never fall."""
    high = np.maximum(low, high)
    first = np.searchsorted(ends, low, "right")
    after = np.maximum(first, np.searchsorted(starts, high, "left"))
    after = np.where(high > low, after, first)
    inside = np.maximum(0, np.searchsorted(ends, high, "right") - np.searchsorted(starts, low, "left"))
    inside = np.where(high > low, inside, 0)
    crossing = after - first - inside
    if rule == "first":
        return np.where(high > low, np.searchsorted(starts, high, "left")
                        - np.searchsorted(starts, low, "left"), 0), crossing
    if rule == "last":
        return np.where(high > low, np.searchsorted(ends, high, "right")
                        - np.searchsorted(ends, low, "right"), 0), crossing
    # Whole tokens by prefix sums; the covered share falls off at both borders
    # only, over tokens that stand on a border (parts of one character share it).
    shares = inside.astype(float)
    for k in np.flatnonzero(crossing):
        for token in range(first[k], after[k]):
            if starts[token] >= low[k] and ends[token] <= high[k]:
                continue
            covered = min(ends[token], high[k]) - max(starts[token], low[k])
            shares[k] += covered / (ends[token] - starts[token])
    return shares, crossing


def count_tokens(docs: DataFrame, sections: DataFrame | None = None, rule: str = "first",
                 path: str = RANKS) -> DataFrame:
    """Tokens per section: doc_id, section, start, stop, n_tokens, n_crossing.

    ``sections`` has doc_id, section (int), start, stop in characters; without
    it the sections are the lines. ``n_tokens`` is a double under "share"."""
    if rule not in RULES:
        raise ValueError(f"The rule must be one of {RULES}")
    chosen = docs.select("doc_id", "text")
    if sections is not None:
        spans = sections.groupBy(F.col("doc_id").alias("section_of")).agg(F.array_sort(F.collect_list(
            F.struct("section", "start", "stop"))).alias("spans"))
        # a null id has sections too
        chosen = chosen.join(spans, F.col("doc_id").eqNullSafe(F.col("section_of"))).select(
            "doc_id", "text", "spans")

    def work(batch: pa.RecordBatch) -> dict:
        encoder = span_encoder(path)
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        given = batch.column(2).to_pylist() if batch.num_columns > 2 else None
        at, names, lows, highs, counts, crossings = [], [], [], [], [], []
        for i, text in enumerate(texts):
            text = text or ""
            if given is None:
                low, high = line_sections(text)
                name = np.arange(len(low))
            else:
                size = len(text)
                low = np.array([min(max(0, s["start"] or 0), size) for s in given[i]], np.int64)
                high = np.array([size if s["stop"] is None else min(max(0, s["stop"]), size)
                                 for s in given[i]], np.int64)
                name = [s["section"] for s in given[i]]
            count, crossing = join_spans(*encoder.spans(text), low, high, rule)
            at.append(np.full(len(low), i))
            names.extend(name)
            for column, part in ((lows, low), (highs, high), (counts, count), (crossings, crossing)):
                column.append(part)
        return {"doc_id": ids.take(pa.array(np.concatenate(at))), "section": pa.array(names, pa.int32()),
                **{column: np.concatenate(parts) for column, parts in (
                    ("start", lows), ("stop", highs), ("n_tokens", counts),
                    ("n_crossing", crossings))}}

    kind = "double" if rule == "share" else "long"
    return map_batches(chosen, work, f"doc_id long, section int, start long, stop long, "
                                     f"n_tokens {kind}, n_crossing long")
