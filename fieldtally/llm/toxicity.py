"""Toxic passages by maximum-scoring segments (operator 4).

Units are words and word beginnings. A unit's score is its log-odds between
toxic and clean training documents under a Dirichlet prior (a flat part plus
its share of all counts); units whose association could be chance among so many
are left out. A text is a sequence of word scores less a small drift; one
linear scan finds all disjoint maximal segments. A word scores the same wherever
and however often it stands. The best segment of clean text follows an
extreme-value law in the text's length, fitted on documents that gave no units,
so each segment has a p-value whatever the length. The significant segments are
the toxic passages; their normalised scores add up, and a logistic curve over
the sum gives the score.

Only texts and labels of training rows enter; near copies among them count
once. At most about ``sample`` labelled rows are used, chosen by a hash of
doc_id: the bound on the fit. Scoring reads every whole text.

Defined results: a null or empty text has no passage and the score of a text
without evidence; labels that are null or other than 0 and 1 are ignored;
without labels of both classes every score is 0; null ids are carried and count
as not held out; repeated rows stay; input columns named like a result column
are replaced.
"""

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import map_batches, staged

SAMPLE_ROWS = 20_000
MOST_UNITS = 50_000
BEGINNINGS = (3, 4, 5, 6)
DRIFT = 0.05
FLAT_PRIOR, SHARE_PRIOR = 0.5, 10.0
SIGNIFICANT = 0.01
CACHED_WORDS, CACHED_LENGTH = 300_000, 64
WORD = re.compile(r"\w+")
RESULTS = ["held_out", "score", "predicted", "n_passages", "passages"]


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of all ids that no label may be learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def units_of(word: str) -> list[str]:
    """A word and its beginnings, longest first; "^" marks a beginning."""
    return [word] + ["^" + word[:n] for n in reversed(BEGINNINGS) if len(word) > n]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All disjoint maximal-scoring segments (start, end, score), in one pass:
    each positive stretch is joined to the earlier segment with a lower left
    sum for as long as that raises the sum reached."""
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # start, end, left sum, right sum
    for at in positive.tolist():
        new = [at, at + 1, total[at], total[at + 1]]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
        found.append(new)
    return [(a, b, float(right - left)) for a, b, left, right in found]


@dataclass
class ToxicModel:
    units: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0           # lambda of the extreme-value law
    log_size: float = 0.0       # log K
    intercept: float = -20.0
    slope: float = 0.0
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def word(self, word: str) -> float:
        for unit in units_of(word):
            if unit in self.units:
                return self.units[unit]
        return 0.0

    def _chunk(self, chunk: str) -> float:
        found = sum(self.word(word) for word in WORD.findall(chunk)) - DRIFT
        if len(chunk) <= CACHED_LENGTH:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[chunk] = found
        return found

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        chunks = text.lower().split()
        known = self.known.get
        scores = [known(chunk) for chunk in chunks]
        scores = np.array([self._chunk(chunk) if score is None else score
                           for chunk, score in zip(chunks, scores)])
        return len(chunks), maximal_segments(scores)

    def normalised(self, score: float, length: int) -> float:
        return self.rate * score - self.log_size - math.log(max(length, 1))

    def passages(self, text: str) -> list[tuple[int, int, float, float]]:
        """Significant passages: first and last chunk, normalised score, p."""
        length, segments = self.segments(text)
        found = []
        for start, end, score in segments:
            x = self.normalised(score, length)
            p = -math.expm1(-math.exp(min(-x, 50.0)))
            if p <= SIGNIFICANT:
                found.append((start, end, x, p))
        return found

    def score(self, passages: list[tuple[int, int, float, float]]) -> float:
        evidence = sum(x for _, _, x, _ in passages)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.intercept + self.slope * evidence))))


def fit_extreme_values(best: np.ndarray, lengths: np.ndarray, least: float) -> tuple[float, float]:
    """Rate and log size of P(best > x) = 1 - exp(-K n exp(-rate x)) by maximum
    likelihood; texts without a positive segment are censored at zero. One
    typical text with one weak unit is added, so a fit always exists."""
    best = np.append(best, least)
    lengths = np.maximum(1.0, np.append(lengths, np.median(lengths) if len(lengths) else 100.0))
    hit = best > 0

    def size(rate: float) -> float:
        return hit.sum() / np.sum(lengths * np.exp(-rate * best))

    def likelihood(rate: float) -> float:
        return hit.sum() * (math.log(size(rate)) + math.log(rate)) - rate * best[hit].sum()

    rates = np.geomspace(0.05, 5.0, 200)
    rate = float(rates[np.argmax([likelihood(r) for r in rates])])
    return rate, math.log(size(rate))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> tuple[float, float]:
    """Intercept and slope by Newton steps under a small penalty."""
    design, weights = np.column_stack([np.ones(len(x)), x]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (y - p) - penalty * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + penalty * np.eye(2)
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(weights[0]), float(weights[1])


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """A bounded, hash-chosen set of labelled training texts, staged: doc_id,
    text, toxic, fold, and two shingle hashes that near copies share."""
    usable = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
              .where("doc_id is not null and toxic in (0, 1)").where(~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, sample / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003))
    # At most about ``sample`` rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "text", "toxic", (F.crc32(F.col("doc_id").cast("string")) % 5).alias("fold"))

    def work(batch: pa.RecordBatch) -> dict:
        keys = {"one": [], "two": []}
        for text in batch.column(1).to_pylist():
            words = (text or "").lower().split()
            shingles = [xxhash.xxh64_intdigest(" ".join(words[i:i + 5])) >> 1
                        for i in range(max(1, len(words) - 4))]
            keys["one"].append(min(shingles))
            keys["two"].append(min(s * 0x9E3779B97F4A7C15 & (1 << 63) - 1 for s in shingles))
        return {name: batch.column(i) for i, name in enumerate(["doc_id", "text", "toxic", "fold"])} | keys

    return staged(map_batches(rows, work, "doc_id long, text string, toxic int, fold long, "
                                          "one long, two long"), "toxic_training")


def without_copies(rows: DataFrame) -> DataFrame:
    """One row per shared hash; both sides of the join are bounded as ``rows``."""
    for key in ("one", "two"):
        first = rows.groupBy(key).agg(F.min("doc_id").alias("doc_id"))
        rows = rows.join(F.broadcast(first.select("doc_id").distinct()), "doc_id", "left_semi")
    return rows


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS,
        most_units: int = MOST_UNITS) -> ToxicModel:
    """Learn units on folds 1 to 3 and the calibration on fold 4."""
    rows = without_copies(training_rows(docs, labels, sample))
    learning, judging = rows.where("fold < 4"), rows.where("fold = 4")
    sizes = {row["toxic"]: row["count"] for row in learning.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return ToxicModel()

    def count(batch: pa.RecordBatch) -> dict:
        counts: dict[str, list[int]] = {}
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = {unit for word in set(WORD.findall((text or "").lower()))
                    if len(word) <= 64 for unit in units_of(word)}
            for unit in seen:
                counts.setdefault(unit, [0, 0])[label] += 1
        clean_counts, toxic_counts = zip(*counts.values()) if counts else ((), ())
        return {"unit": list(counts), "c": list(clean_counts), "t": list(toxic_counts)}

    counted = (map_batches(learning.select("text", "toxic"), count, "unit string, c long, t long")
               .groupBy("unit").agg(F.sum("c").alias("c"), F.sum("t").alias("t")))
    rate = toxic / (toxic + clean)
    n, t, c = F.col("t") + F.col("c"), F.col("t"), F.col("c")
    gain = 2 * (t * F.log(t / n / rate)
                + F.when(c > 0, c * F.log(c / n / (1 - rate))).otherwise(0.0))
    prior = FLAT_PRIOR + SHARE_PRIOR * n / (toxic + clean)
    odds = (F.log((t + prior) / (toxic + 2 * prior - t - prior + 1))
            - F.log((c + prior) / (clean + 2 * prior - c - prior + 1)))
    counted = staged(counted.where("t > 1"), "toxic_units")
    chance = 2 * math.log(max(2, counted.count()))
    units = (counted.where(t / n > rate).select("unit", odds.alias("odds"), gain.alias("gain"))
             .where((F.col("gain") > chance) & (F.col("odds") > DRIFT))
             .orderBy(F.desc("gain"), "unit").limit(most_units))
    model = ToxicModel({row["unit"]: row["odds"] for row in units.collect()})

    def judge(batch: pa.RecordBatch) -> dict:
        found = [model.segments(text or "") for text in batch.column(0).to_pylist()]
        return {"toxic": batch.column(1), "length": [length for length, _ in found],
                "scores": [[score for _, _, score in segments] for _, segments in found]}

    judged = map_batches(judging.select("text", "toxic"), judge,
                         "toxic int, length long, scores array<double>").collect()
    normal = [row for row in judged if row["toxic"] == 0]
    model.rate, model.log_size = fit_extreme_values(
        np.array([max(row["scores"], default=0.0) for row in normal]),
        np.array([row["length"] for row in normal], float),
        min(model.units.values(), default=1.0))
    least = -math.log(-math.log1p(-SIGNIFICANT))
    evidence = np.array([sum(x for s in row["scores"]
                             if (x := model.normalised(s, row["length"])) >= least) for row in judged])
    if len({row["toxic"] for row in judged}) == 2:
        model.intercept, model.slope = fit_logistic(
            evidence, np.array([row["toxic"] for row in judged], float))
    else:
        model.intercept, model.slope = -2.0, 1.0
    return model


def score_documents(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """All columns of the documents with held_out, score, predicted, n_passages
    and the passages (start, stop in characters, normalised score, p)."""
    kept = [name for name in docs.columns if name not in RESULTS]
    docs = docs.select(*kept)
    at = kept.index("text")

    def work(batch: pa.RecordBatch) -> dict:
        scores, found = [], []
        for text in batch.column(at).to_pylist():
            text = text or ""
            passages = model.passages(text)
            scores.append(model.score(passages))
            # Lower case can change a text's length; chunks keep their order.
            spans = [m.span() for m in re.finditer(r"\S+", text)] if passages else []
            found.append([{"start": spans[min(a, len(spans) - 1)][0],
                           "stop": spans[min(b, len(spans)) - 1][1], "score": x, "p": p}
                          for a, b, x, p in passages])
        return {name: batch.column(i) for i, name in enumerate(kept)} | {
            "score": scores, "predicted": [int(score >= 0.5) for score in scores],
            "n_passages": list(map(len, found)), "passages": found}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(docs, work, f"{fields}, score double, predicted int, n_passages long, passages "
                       "array<struct<start:long,stop:long,score:double,p:double>>").withColumn(
        "held_out", held_out())
