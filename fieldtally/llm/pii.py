"""Personal data by fixed patterns and a linear-chain CRF (operator 7).

The base spans come from four patterns and their checks. A conditional random
field over word shapes adds spans the patterns cannot see (written-out mail
addresses, national phone numbers, cards with other separators, IPv6). It is
trained from a small labelled table (``labelled_table``: one text per row, spans
in brackets) of at most ``LABELLED_ROWS`` rows and decoded by Viterbi in
batches. Plain words far from any other shape are certain to be "none", which
cuts the chain exactly (``Crf._reach``); only the runs between are decoded.

Base spans always stay; an added span that touches a base span is dropped.
Starts and ends count characters; ends are exclusive.

Defined results: a null or empty text has no span; null ids are carried;
repeated rows stay; other input columns are kept unless a result column has
their name.
"""

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.common import map_batches

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["none", *KINDS]
LABELLED_ROWS = 5_000
CACHED_WORDS, CACHED_SHAPES = 200_000, 50_000
BLOCK_CHARS = 1 << 20
RESULTS = [*[f"n_{kind}" for kind in KINDS], "n_added", "base_sha256", "spans"]

Span = tuple[int, int]

# ---- base spans: the patterns of the contract. Where a plain search would try
# every start in a long run again, the run's own start stands for them.

LOCAL_HERE = re.compile(r"[A-Za-z0-9._%+-]++@")
LOCAL_NEXT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")


def emails(text: str) -> Iterator[Span]:
    at = 0
    while found := LOCAL_HERE.match(text, at) or LOCAL_NEXT.search(text, at):
        domain = DOMAIN.match(text, found.end())
        at = domain.end() if domain else found.end()
        if domain:
            yield found.start(), at


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost non-overlapping matches of each kind that pass their check."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = list(emails(text))
    for match in ADDRESS.finditer(text):
        if all(len(part) < 3 or int(part) <= 255 for part in
               (p.lstrip("0")[:4] for p in match.group().split("."))):
            found["ip"].append(match.span())
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = NOT_DIGIT.sub("", match.group())
            if 13 <= len(digits) <= 19 and passes_luhn(digits):
                found["card"].append(match.span())
    if "+" in text:
        found["phone"] = [match.span() for match in PHONE.finditer(text)
                          if 9 <= len(NOT_DIGIT.sub("", match.group())) <= 15]
    return found


# ---- the labelled table

#: One text per row; "[kind:...]" marks a span. Only shapes matter.
LABELLED = """
write to [email:maria.lopez at example dot com] about it
you can reach me under [email:j_smith (at) mail (dot) org] today
contact [email:info [at] firma.example.net] for help
please mail [email:anna.k AT host DOT example DOT org] soon
her address is [email:peter at example.com] she said
send it to [email:team(at)example(dot)com] now
or [email:bob[at]mail.example.org] if urgent
ask for [email:lena (at) mail (dot) example (dot) org] there
was over and you call [email:hans (at) post (dot) example] soon
mail [email:kim.lee@example.com] or come by
the mail went to [email:office.12@mail3.example.com] in the end
call [phone:(555) 010-1234] after noon
call us on [phone:555-010-4477] or visit
phone [phone:(030) 555 0182] in the morning
my number is [phone:555.010.9921] he wrote
ring [phone:0171 555 0134] this evening
the office line [phone:020 7946 0958] is open
fax [phone:(212) 555-0147] or letter
ask for [phone:(415) 555-0190] please
mobile [phone:07700 900123] works
dial [phone:+1 (521) 555-0173] from abroad
she gave [phone:+44 20 7946 0018] as her number
pay with [card:4111.1111.1111.1111] at once
the card [card:5500/0000/0000/0004] was used
charged to [card:3400_000000_00009] last week
card [card:4012.8888.8888.1881] expires soon
number [card:4111 1111 1111 1111] on file
card number [card:4222-2222-2222-2222] please
the host [ip:2001:db8::8a2e:370:7334] answered
from [ip:fe80::1ff:fe23:4567:890a] it came
server [ip:2001:0db8:85a3:0000:0000:8a2e:0370:7334] is down
route to [ip:2001:db8:0:1::17] was lost
login from [ip:203.0.113.7] was seen
the address [ip:198.51.100.23] is blocked
we met at noon and talked about the weather
he is at home, she is at work in town
look at the dot on the map at the end
put a dot at the end of each line
the list has 12 items and 345 parts
in 1998 and 2004 there were 17 of them
version 2.4.1 came out on 2021-05-17 at 12:30
price 1,299.00 or 45.50 per unit, total 12,500
order 4713332104704538 was sent with 9870157079875996
section 3.2 of part 12, page 104, line 7
token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" in the file
key = "3b0ae77c41fd" and id 550e8400-e29b-41d4-a716-446655440000
THIS IS!! VERY!! GOOD!! BUY!! NOW!!
word*** other### third%%% of$$$ the&&& rest###
50 and 60 percent of 1000 people (about 5) said so
from 10 to 20, then 30-40, and 5-6 more
see https://www.example.com/a/b?c=1&d=2 for more
the ratio 16:9 or 4:3 and the score 3:2
chapters 1 2 3 4 5 and 6 follow
on 17/05/2021 or 05.06.2021 it rained
room 555 on floor 010 was free
parts (a) and (b) of no. 12 (see note 3)
item 00123 weighs 4.5 kg and costs 7 dollars
isbn 978-3-16-148410-0 is a book
x = 3.14159 and y = 2.71828 hold
in the years 1914-1918 and 1939-1945 he wrote
he had 3 000 000 marks and 250 000 francs
the code is A1-B2-C3 and the part no. 77-4512-9
""".strip().split("\n")
MARK = re.compile(r"\[(email|ip|card|phone):((?:[^\[\]]|\[at\])*)\]")


def read_marked(line: str) -> tuple[str, list[tuple[int, int, str]]]:
    """A marked line as plain text and its spans."""
    text, spans, last = "", [], 0
    for mark in MARK.finditer(line):
        text += line[last:mark.start()]
        spans.append((len(text), len(text) + len(mark.group(2)), mark.group(1)))
        text += mark.group(2)
        last = mark.end()
    return text + line[last:], spans


def labelled_table(spark: SparkSession) -> DataFrame:
    """The small labelled table: text and its spans."""
    return spark.createDataFrame([read_marked(line) for line in LABELLED],
                                 "text string, spans array<struct<start:int,stop:int,kind:string>>")


# ---- words and shapes

SEPARATOR = re.compile(r"[^\S ]")


def words_of(text: str) -> tuple[list[str], np.ndarray]:
    """Words between white space, and where each starts; empty ones stand
    between neighbouring spaces."""
    words = SEPARATOR.sub(" ", text).split(" ")
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return words, np.cumsum(sizes) - sizes


SHAPE = str.maketrans({**{c: "x" for c in "abcdefghijklmnopqrstuvwxyz"},
                       **{c: "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"},
                       **{c: "d" for c in "0123456789"}})
RUN = re.compile(r"(.)\1+")


WRITTEN_OUT = {"at", "dot"}
LONG_SHAPE = 80


def shape_of(word: str) -> str:
    """Letters in runs of one, digits in runs of up to five; the words of a
    written-out address stand for themselves, other words are all alike."""
    bare = word.strip(".,;:!?\"'()")
    if bare.lower() in WRITTEN_OUT:
        return ("=(" if word[0] == "(" else "=") + bare.lower()
    if bare.isalpha():
        return "x"
    plain = "".join(c if c.isascii() else "x" if c.isalpha() else "?" for c in word)
    return RUN.sub(lambda m: m.group(1) * (min(len(m.group()), 5) if m.group(1) == "d" else 1),
                   plain.translate(SHAPE))


def features(shape: str) -> list[str]:
    """What a shape is known by, from exact to coarse."""
    if shape == "x" or shape.startswith("="):
        return [shape, "letters"]
    coarse = RUN.sub(r"\1", shape)
    digits = shape.count("d")
    return [shape, "~" + coarse, f"digits{min(digits, 9)}", f"dots{min(shape.count('.'), 4)}",
            f"colons{min(shape.count(':'), 4)}", "first" + coarse[:1], "last" + coarse[-1:]] + [
        name for name in ("@", "(", "::", "-", "/", "_", "&", "=", '"') if name in shape]


class Crf:
    """Scores for own, left and right features and for label pairs."""

    def __init__(self, own: dict, left: dict, right: dict, pairs: np.ndarray):
        self.own, self.left, self.right, self.pairs = own, left, right, pairs
        self._reset()
        self.reach = self._reach()

    def _reach(self) -> int | None:
        """How many plain words from any other word a label may still reach.

        Compares k plain words under any labels but "none", between any two
        neighbours, with the same words under "none". Where each further word
        loses, every k from the found one on loses too: so in a long stretch of
        plain words, all that stand further inside are "none" for certain. No
        number if plain words can gain."""
        pairs, plain = self.pairs, self.table[0].sum(axis=0)
        word = plain[1:] - plain[0]
        step = pairs[1:, 1:] - pairs[0, 0] + word
        if step.max() >= 0:
            return None
        best, k = pairs[:, 1:] - pairs[:, :1] + word, 1
        while True:
            gain = (best[:, :, None] + pairs[1:][None]).max(axis=1) - pairs[0]
            if gain[0, 0] >= 0:
                return None
            if gain.max() < 0:
                return k
            best, k = (best[:, :, None] + step[None]).max(axis=1), k + 1

    def __getstate__(self):
        return self.own, self.left, self.right, self.pairs

    def __setstate__(self, state):
        self.__init__(*state)

    def _reset(self) -> None:
        self.words: dict[str, int] = {}
        self.shapes: dict[str | tuple[str, ...], int] = {}
        self.rows: list[np.ndarray] = []
        self._shape("x")
        self._shape("")
        self.table = np.array(self.rows)

    def _shape(self, shape: str) -> int:
        # Of a long shape the features that score are remembered, not its text.
        key = shape if len(shape) <= LONG_SHAPE else tuple(
            f for f in features(shape) if f in self.own or f in self.left or f in self.right)
        found = self.shapes.get(key)
        if found is None:
            found = self.shapes[key] = len(self.rows)
            self.rows.append(np.array([
                np.sum([part[f] for f in features(shape) if f in part] or [np.zeros(len(LABELS))],
                       axis=0) for part in (self.own, self.left, self.right)]))
        return found

    def _word(self, word: str) -> int:
        found = self._shape(shape_of(word))
        if len(word) <= 64:
            self.words[word] = found
        return found

    def shape_ids(self, texts: list[list[str]]) -> np.ndarray:
        """A number per word, with 1 before, between and after the texts; 0 is
        a plain word."""
        if len(self.words) > CACHED_WORDS or len(self.rows) > CACHED_SHAPES:
            self._reset()
        known, ids = self.words.get, [1]
        for words in texts:
            found = [known(word) for word in words]
            if None in found:
                found = [self._word(word) if i is None else i for word, i in zip(words, found)]
            ids += found
            ids.append(1)
        if len(self.table) < len(self.rows):
            self.table = np.array(self.rows)
        return np.array(ids)

    def labels(self, texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text (as words) the words that are not "none" in its best
        labelling, and their labels."""
        ids = self.shape_ids(texts)
        sizes = np.array([len(words) + 1 for words in texts])
        first = np.cumsum(sizes) - sizes + 1
        inner = np.ones(len(ids), bool)
        inner[np.append(first - 1, len(ids) - 1)] = False
        if self.reach is None:
            at = np.flatnonzero(inner)
        else:
            # A neighbour changes a word's scores, hence one word more.
            odd, near = np.flatnonzero(ids), self.reach + 1
            marks = np.zeros(len(ids) + 1, np.int64)
            np.add.at(marks, np.maximum(odd - near, 0), 1)
            np.add.at(marks, np.minimum(odd + near + 1, len(ids)), -1)
            at = np.flatnonzero((np.cumsum(marks[:-1]) > 0) & inner)
        scores = self.table[ids[at], 0] + self.table[ids[at - 1], 1] + self.table[ids[at + 1], 2]
        begins = np.flatnonzero(np.diff(at, prepend=-1) != 1)
        lengths = np.diff(np.append(begins, len(at)))
        best = np.zeros(len(at), np.int64)
        for length in np.unique(lengths):
            rows = begins[lengths == length][:, None] + np.arange(length)
            best[rows] = self._viterbi(scores[rows])
        hit, best = at[best > 0], best[best > 0]
        cuts = np.searchsorted(hit, first), np.searchsorted(hit, first + sizes - 1)
        return [(hit[a:b] - begin, best[a:b]) for a, b, begin in zip(*cuts, first)]

    def _viterbi(self, scores: np.ndarray) -> np.ndarray:
        """The best labels of runs of one size between words of no label."""
        runs, size, _ = scores.shape
        value, back = scores[:, 0] + self.pairs[0], []
        for step in range(1, size):
            reached = value[:, :, None] + self.pairs
            back.append(reached.argmax(axis=1))
            value = reached.max(axis=1) + scores[:, step]
        labels = np.empty((runs, size), np.int64)
        labels[:, -1] = (value + self.pairs[:, 0]).argmax(axis=1)
        for step in range(size - 1, 0, -1):
            labels[:, step - 1] = back[step - 1][np.arange(runs), labels[:, step]]
        return labels


def train(labelled: DataFrame, steps: int = 250, penalty: float = 0.002) -> Crf:
    """Fit by gradient steps on the likelihood of a bounded labelled table
    (text; spans as structs of start, stop, kind)."""
    rows = labelled.select("text", "spans").where("text is not null").limit(LABELLED_ROWS).collect()
    index: dict[tuple[int, str], int] = {}
    data = []
    for text, spans in rows:
        words, starts = words_of(text)
        gold = [next((LABELS.index(kind) for start, stop, kind in spans or []
                      if start < at + len(word) and at < stop), 0) for word, at in zip(words, starts)]
        sets = [features("")] + [features(shape_of(word)) for word in words] + [features("")]
        data.append(([[index.setdefault((side, f), len(index)) for side, near in
                       ((0, t), (1, t - 1), (2, t + 1)) for f in sets[near]]
                      for t in range(1, len(words) + 1)], gold))
    states, weights = len(LABELS), np.zeros((len(index), len(LABELS)))
    pairs = np.zeros((states, states))
    longest, total = max((len(gold) for _, gold in data), default=0), len(data)
    lengths = np.array([len(gold) for _, gold in data], int)
    # Flat (sequence, step, feature) triples for sums by index.
    triples = np.array([(s, t, f) for s, (fs, _) in enumerate(data)
                        for t, found in enumerate(fs) for f in found]).reshape(-1, 3)
    truth = np.zeros((total, longest, states))
    true_pairs = np.zeros((states, states))
    for s, (_, gold) in enumerate(data):
        truth[s, np.arange(len(gold)), gold] = 1
        np.add.at(true_pairs, ([0, *gold], [*gold, 0]), 1)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, pairs)]
    for step in range(1, steps + 1 if total else 1):
        scores = np.zeros((total, longest, states))
        np.add.at(scores, (triples[:, 0], triples[:, 1]), weights[triples[:, 2]])
        marginal, expected = _marginals(scores, lengths, pairs)
        slope = np.zeros_like(weights)
        np.add.at(slope, triples[:, 2], (truth - marginal)[triples[:, 0], triples[:, 1]])
        for x, gradient, (m, v) in ((weights, slope, moments[0]),
                                    (pairs, true_pairs - expected, moments[1])):
            gradient = gradient / total - penalty * x
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient ** 2 - v)
            x += 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    parts: list[dict] = [{}, {}, {}]
    for (side, name), at in index.items():
        parts[side][name] = weights[at]
    return Crf(*parts, pairs)


def _marginals(scores: np.ndarray, lengths: np.ndarray, pairs: np.ndarray) -> tuple:
    """Label probabilities per step and expected label pairs, with "none"
    before and after each sequence."""
    total, longest, states = scores.shape
    inside = np.arange(longest)[None] < lengths[:, None]

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0] + pairs[0]
    for t in range(1, longest):
        forward[:, t] = lse(forward[:, t - 1, :, None] + pairs, 1) + scores[:, t]
    for t in range(longest - 1, -1, -1):
        last = (t == lengths - 1)[:, None]
        after = lse(pairs + (scores[:, t + 1] + backward[:, t + 1])[:, None], 2) if t + 1 < longest else 0
        backward[:, t] = np.where(last, pairs[:, 0], after)
    norm = lse(forward[:, 0] + backward[:, 0], 1)
    marginal = np.exp(forward + backward - norm[:, None, None]) * inside[:, :, None]
    expected = np.zeros_like(pairs)
    expected[0] += marginal[:, 0].sum(axis=0)
    for t in range(1, longest):
        both = np.exp(forward[:, t - 1, :, None] + pairs
                      + (scores[:, t] + backward[:, t])[:, None] - norm[:, None, None])
        expected += (both * inside[:, t, None, None]).sum(axis=0)
    expected[:, 0] += marginal[np.arange(total), lengths - 1].sum(axis=0)
    return marginal, expected


# ---- spans of documents

WRITTEN_MAIL = re.compile(r"\w\W{0,2}(?:\bat\b|@)\W{0,2}\w.*?(?:\bdot\b|\w\.\w)", re.I | re.S)
EDGE = " \t\r\n,;:!?.\"'"


def label_texts(texts: list[str], crf: Crf) -> Iterator[tuple]:
    """Words, starts and labelled words of each text, in blocks of texts."""
    block, size = [], 0
    for i, text in enumerate(texts):
        block.append(words_of(text))
        size += len(text)
        if size >= BLOCK_CHARS or i + 1 == len(texts):
            found = crf.labels([words for words, _ in block])
            yield from ((words, starts, *labels) for (words, starts), labels in zip(block, found))
            block, size = [], 0


def added_spans(text: str, words: list[str], starts: np.ndarray, at: np.ndarray,
                labels: np.ndarray, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Runs of one label as spans, trimmed, without those that touch a base
    span or lack what their kind needs at least."""
    found: dict[str, list[Span]] = defaultdict(list)
    if not len(at):
        return found
    taken = sorted(span for spans in base.values() for span in spans)
    edges = np.array(taken, np.int64).reshape(-1, 2)
    # Base spans of different kinds may overlap; the furthest end so far rules.
    reach = np.maximum.accumulate(edges[:, 1]) if len(edges) else edges[:, 1]
    cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(labels) != 0)) + 1
    for run in np.split(np.arange(len(at)), cuts):
        first, last, kind = at[run[0]], at[run[-1]], LABELS[labels[run[0]]]
        start, stop = int(starts[first]), int(starts[last]) + len(words[last])
        while start < stop and text[start] in EDGE:
            start += 1
        while start < stop and text[stop - 1] in EDGE:
            stop -= 1
        before = np.searchsorted(edges[:, 0], stop, "left") - 1
        touches = before >= 0 and reach[before] > start
        content = text[start:stop]
        digits = len(NOT_DIGIT.sub("", content))
        proven = {"email": WRITTEN_MAIL.search(content) is not None,
                  "ip": content.count(":") >= 2, "phone": 7 <= digits <= 15,
                  "card": 13 <= digits <= 19}[kind]
        if proven and not touches:
            found[kind].append((start, stop))
    return found


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for kind in KINDS
                    for start, stop in sorted(spans.get(kind, [])))


def find_spans(texts: list[str], crf: Crf) -> Iterator[tuple[dict, dict]]:
    """Base spans and added spans of each text by kind."""
    for text, found in zip(texts, label_texts(texts, crf)):
        base = base_spans(text)
        yield base, added_spans(text, *found, base)


def scan_documents(docs: DataFrame, crf: Crf) -> DataFrame:
    """All columns with the counts of base spans, n_added, base_sha256 and
    spans (base and added)."""
    kept = [name for name in docs.columns if name not in RESULTS]
    docs = docs.select(*kept)
    at = kept.index("text")

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {name: [] for name in RESULTS}
        texts = [text or "" for text in batch.column(at).to_pylist()]
        for base, added in find_spans(texts, crf):
            for kind in KINDS:
                out[f"n_{kind}"].append(len(base[kind]))
            out["n_added"].append(sum(map(len, added.values())))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined({kind: base[kind] + added.get(kind, []) for kind in KINDS}))
        return {name: batch.column(i) for i, name in enumerate(kept)} | out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    counts = ", ".join(f"{name} long" for name in RESULTS[:-2])
    return map_batches(docs, work, f"{fields}, {counts}, base_sha256 string, spans string")


def redact(text: str, base: dict[str, list[Span]], added: dict[str, list[Span]]) -> str:
    """The text with each span replaced by its kind in angle brackets; spans
    that overlap are replaced together, under the kind of the first."""
    spans = sorted((start, stop, kind) for found in (base, added)
                   for kind, part in found.items() for start, stop in part)
    parts, last = [], 0
    for start, stop, kind in spans:
        if start >= last:
            parts += [text[last:start], f"<{kind}>"]
        last = max(last, stop)
    return "".join([*parts, text[last:]])


def redact_documents(docs: DataFrame, crf: Crf) -> DataFrame:
    """The same columns with personal data replaced in ``text``; ``n_chars``,
    where there is one, follows. Null texts stay null."""
    names, at = docs.columns, docs.columns.index("text")

    def work(batch: pa.RecordBatch) -> dict:
        texts = batch.column(at).to_pylist()
        found = find_spans([text or "" for text in texts], crf)
        clean = [None if text is None else redact(text, *spans) for text, spans in zip(texts, found)]
        return {name: batch.column(i) for i, name in enumerate(names)} | {"text": clean}

    cleaned = map_batches(docs, work, docs.schema)
    if "n_chars" in names:
        cleaned = cleaned.withColumn("n_chars", F.coalesce(F.char_length("text"), F.col("n_chars"))
                                     .cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*names)
