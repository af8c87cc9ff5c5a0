"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.batches import chunks, texts
from tabscope.llm.common import draw

ROWS = 1000  # labelled documents of each label that the model is fitted on
FIT_CHARS = 20_000  # of these documents only those are used that are at most so long
FIT_LINES = 200  # and have at most so many lines
LINE_CHARS = 1 << 16  # a line that is longer counts as several
BLOCK_CHARS, BLOCK_LINES = 1 << 20, 1 << 12  # text whose features are held at a time
STEPS, RATE, RIDGE = 150, 0.1, 1e-3
FAR = 30.0  # log-odds are kept within it

# kinds of characters
LOWER, UPPER, LETTER, DIGIT, SPACE, STOP, PAIRED, SYMBOL = range(8)
KINDS = 8
OWN = KINDS + KINDS * KINDS + 8  # features of a line by itself
AROUND = KINDS + 3  # of these, what its neighbours see
FEATURES = OWN + 2 * (AROUND + 1)


def kinds() -> np.ndarray:
    """The kind of every code point."""

    def kind(c: str) -> int:
        if c.isalpha():
            return LOWER if c.islower() else UPPER if c.isupper() else LETTER
        if c.isspace():
            return SPACE
        if c.isnumeric():
            return DIGIT
        return STOP if c in ".,;:?" else PAIRED if c in "()[]{}\"'-‐‑–—‘’“”«»" else SYMBOL

    return np.fromiter((kind(chr(c)) for c in range(0x110000)), np.uint8, 0x110000)


def lines_of(text: str) -> list[str]:
    """The lines of a text that are more than white space; a very long one in parts."""
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    if any(len(line) > LINE_CHARS for line in lines):
        cut = [line[i : i + LINE_CHARS] for line in lines for i in range(0, len(line), LINE_CHARS)]
        lines = [line for line in cut if not line.isspace()]
    return lines


class LineFeatures:
    """Figures of a line that need no word list: kinds of characters and of pairs of them as shares of its
    length, its length, and how its words repeat."""

    def __init__(self):
        self.kind = kinds()

    def blocks(self, lines: list[str], before: list[str | None]) -> Iterator[np.ndarray]:
        """Rows of OWN features, the first AROUND of them those that neighbours see, for a bounded number
        of lines at a time. before: the line before each one, None for the first of a document."""
        start = 0
        while start < len(lines):
            end, size = start, 0
            while end < len(lines) and end - start < BLOCK_LINES and (end == start or size < BLOCK_CHARS):
                size += len(lines[end])
                end += 1
            yield self.rows(lines[start:end], before[start:end])
            start = end

    def rows(self, lines: list[str], before: list[str | None]) -> np.ndarray:
        n = len(lines)
        sizes = np.array([len(line) for line in lines], np.int64)
        kind = self.kind[np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        owner = np.repeat(np.arange(n), sizes)
        out = np.empty((n, OWN), np.float32)
        out[:, :KINDS] = np.bincount(owner * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS) / sizes[:, None]
        inner = owner[1:] == owner[:-1]
        pair = (owner[1:] * (KINDS * KINDS) + kind[:-1] * KINDS + kind[1:])[inner]
        counts = np.bincount(pair, minlength=n * KINDS * KINDS).reshape(n, -1)
        out[:, AROUND : AROUND + KINDS * KINDS] = counts / np.maximum(sizes - 1, 1)[:, None]
        ends = np.cumsum(sizes)
        rest = []
        for line in lines:
            words = line.split()
            same = sum(map(eq, words, words[1:]))
            rest.append((same / max(len(words) - 1, 1), len(set(words)) / len(words), len(line) / len(words)))
        figures = np.array(rest)
        out[:, KINDS : KINDS + 2] = figures[:, :2]
        out[:, KINDS + 2] = np.log1p(sizes)
        place = AROUND + KINDS * KINDS
        out[:, place] = np.minimum(np.log(figures[:, 2]), 5)
        out[:, place + 1] = kind[ends - 1] == STOP
        out[:, place + 2] = kind[ends - sizes] == UPPER
        out[:, place + 3] = [a == b for a, b in zip(lines, before)]
        out[:, place + 4] = kind[ends - sizes] == SYMBOL
        return out


def around(own: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All features of lines in a row: their own, and what the lines before and after show.

    first, last: whether a line has none before or after it in its document.
    """
    out = np.zeros((len(own), FEATURES), np.float32)
    out[:, :OWN] = own
    out[1:, OWN : OWN + AROUND] = np.where(first[1:, None], 0, own[:-1, :AROUND])
    out[:, OWN + AROUND] = first
    place = OWN + AROUND + 1
    out[:-1, place : place + AROUND] = np.where(last[:-1, None], 0, own[1:, :AROUND])
    out[:, place + AROUND] = last
    return out


def passed_on(odds, table, np_or_math=np):
    """The log-odds that reach the next line, given those of this one: table[i][j] weighs i before j."""
    up, stay, fall, keep = table[1][1], table[0][1], table[1][0], table[0][0]
    e = np_or_math.exp(odds)
    return np_or_math.log((e * exp(up) + exp(stay)) / (e * exp(fall) + exp(keep)))


@dataclass
class Model:
    weights: np.ndarray | None  # of the features, none where only one label was known
    bias: float
    table: list[list[float]]  # label of a line by label of the line before
    slope: float  # from the share of good text to the score's log-odds
    level: float
    empty: float  # score of a text without lines
    share: float  # of label 1


def marginals(odds: list[float], table: list[list[float]]) -> list[float]:
    """The probability that each line is good: one pass forward, one backward."""
    m11, m01, m10, m00 = exp(table[1][1]), exp(table[0][1]), exp(table[1][0]), exp(table[0][0])
    forward, value = [], None
    for own in odds:
        if value is not None:
            e = exp(value)
            own += log((e * m11 + m01) / (e * m10 + m00))
        value = FAR if own > FAR else -FAR if own < -FAR else own
        forward.append(value)
    found, back = [0.0] * len(odds), 0.0
    for i in range(len(odds) - 1, -1, -1):
        found[i] = 1 / (1 + exp(-max(-2 * FAR, min(2 * FAR, forward[i] + back))))
        e = exp(max(-FAR, min(FAR, back + odds[i])))
        back = log((e * m11 + m10) / (e * m01 + m00))
    return found


class Scorer:
    """Scores texts with a model, a bounded number of lines in numbers at a time."""

    def __init__(self, model: Model):
        self.model, self.features = model, LineFeatures()
        w = model.weights
        self.own, self.before = w[:OWN], w[OWN : OWN + AROUND]
        self.after, self.first, self.last = w[OWN + AROUND + 1 : -1], w[OWN + AROUND], w[-1]

    def shares(self, batch: list[str]) -> list[float | None]:
        """The share of good text of each text, by the lengths of its lines; none without a line."""
        documents = [lines_of(t) for t in batch]
        lines = [line for own in documents for line in own]
        previous = [p for own in documents for p in ([None, *own[:-1]] if own else [])]
        parts = [(rows @ self.own, rows[:, :AROUND] @ self.before, rows[:, :AROUND] @ self.after)
                 for rows in self.features.blocks(lines, previous)]
        if not parts:
            return [None] * len(batch)
        own, shown_on, shown_back = (np.concatenate(p).astype(np.float64) for p in zip(*parts))
        found, start = [], 0
        for document in documents:
            end = start + len(document)
            if start == end:
                found.append(None)
                continue
            odds = own[start:end] + self.model.bias
            odds[1:] += shown_on[start : end - 1]
            odds[:-1] += shown_back[start + 1 : end]
            odds[0] += self.first
            odds[-1] += self.last
            sizes = [len(line) for line in document]
            good = marginals(np.clip(odds, -FAR, FAR).tolist(), self.model.table)
            found.append(sum(map(float.__mul__, good, map(float, sizes))) / sum(sizes))
            start = end
        return found

    def scores(self, batch: list[str]) -> list[float]:
        model = self.model
        return [model.empty if s is None else sigmoid(model.slope * s + model.level) for s in self.shares(batch)]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_odds(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights and a bias of a logistic regression, by Newton's method."""
    x = np.c_[rows, np.ones(len(rows))].astype(np.float64)
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    penalty = np.r_[np.full(rows.shape[1], ridge), 1e-6]
    for _ in range(25):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - labels)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5.0 / max(np.abs(x @ step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


class Chains:
    """Documents of a training sample, longest first, so that step t of all that have one is a slice."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[self.order]
        longest = int(sizes.max())
        self.active = [int((sizes[self.order] > t).sum()) for t in range(longest)]
        self.at = [starts[: self.active[t]] + t for t in range(longest)]

    def run(self, odds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all lines, and the expected number of each pair of labels."""
        forward, back = np.empty(len(odds)), np.zeros(len(odds))
        for t, at in enumerate(self.at):
            own = odds[at]
            if t:
                own = own + passed_on(forward[self.at[t - 1][: len(at)]], table)
            forward[at] = np.clip(own, -FAR, FAR)
        pairs = np.zeros((2, 2))
        for t in range(len(self.at) - 1, 0, -1):
            at, before = self.at[t], self.at[t - 1][: self.active[t]]
            later = np.clip(back[at] + odds[at], -FAR, FAR)
            back[before] = passed_on(later, table.T)
            joint = np.empty((2, 2, len(at)))
            for i in (0, 1):
                for j in (0, 1):
                    joint[i, j] = table[i, j] + i * forward[before] + j * later
            joint = np.exp(joint - joint.max((0, 1)))
            pairs += (joint / joint.sum((0, 1))).sum(2)
        return sigmoid(forward + back), pairs


def fit_chain(rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights (bias last) and transitions that make the given labels of the lines likely: the gradient of the
    conditional likelihood from marginals and pair counts, followed by Adam for a fixed number of steps."""
    chains = Chains(sizes)
    starts = np.cumsum(sizes) - sizes
    is_first = np.zeros(len(rows), bool)
    is_first[starts] = True
    seen = np.zeros((2, 2))
    later = np.flatnonzero(~is_first)
    np.add.at(seen, (labels[later - 1].astype(int), labels[later].astype(int)), 1)
    x = np.c_[rows, np.ones(len(rows))].astype(np.float64)
    wide = x.shape[1]
    w, mean, square = np.zeros(wide + 4), np.zeros(wide + 4), np.zeros(wide + 4)
    for step in range(1, STEPS + 1):
        table = w[wide:].reshape(2, 2)
        good, pairs = chains.run(np.clip(x @ w[:wide], -FAR, FAR), table)
        slope = np.r_[x.T @ (good - labels), (pairs - seen).ravel()] / len(rows) + RIDGE * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        w = w - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w[:wide], w[wide:].reshape(2, 2)


def train(samples: list[tuple[list[str], int]], sizes_of_labels: dict[int, int]) -> Model:
    """Fits the model on documents as lists of lines with labels 0 and 1.

    Only documents are labelled, so lines are labelled first: a logistic regression takes each
    line for as good as its document, and in bad documents the lines that it finds more likely good
    become good, but for the worst of each. The chain is then fitted on these labels, and the share of good text
    of each document is mapped to the probability of label 1 by a logistic curve whose rows weigh as
    much as their label has among all learned labels.
    """
    number = {k: sizes_of_labels.get(k, 0) for k in (0, 1)}
    share = (number[1] + 1) / (number[0] + number[1] + 2)
    bare = [y for lines, y in samples if not lines]
    empty = (sum(bare) + share) / (len(bare) + 1)
    filled = [(lines, y) for lines, y in samples if lines]
    target = np.array([y for _, y in filled], np.float64)
    if not 0 < target.sum() < len(target):
        return Model(None, 0.0, [[0.0, 0.0], [0.0, 0.0]], 0.0, 0.0, empty, share)
    features = LineFeatures()
    sizes = np.array([len(lines) for lines, _ in filled])
    owner = np.repeat(np.arange(len(filled)), sizes)
    lines = [line for own, _ in filled for line in own]
    previous = [p for own, _ in filled for p in [None, *own[:-1]]]
    own = np.concatenate(list(features.blocks(lines, previous)))
    first, last = np.r_[True, owner[1:] != owner[:-1]], np.r_[owner[1:] != owner[:-1], True]
    chars = np.array([len(line) for line in lines], np.float64)
    document = target[owner]
    # both labels weigh the same, and lines by the root of their length
    heavy = np.sqrt(chars)
    heavy /= np.where(document == 1, heavy[document == 1].sum(), heavy[document == 0].sum())
    centre, spread = own.mean(0), own.std(0) + 1e-3
    guess = np.c_[(own - centre) / spread, np.ones(len(own))] @ fit_odds((own - centre) / spread, document, heavy)
    labels = np.where((document == 0) & (guess > 0), 1.0, document)
    worst = np.lexsort((guess, owner))[np.flatnonzero(first)]  # of each document
    labels[worst] = document[worst]
    rows = around(own, first, last)
    centre, spread = rows.mean(0), rows.std(0) + 1e-3
    weights, table = fit_chain((rows - centre) / spread, sizes, labels)
    model = Model(
        (weights[:-1] / spread).astype(np.float64),
        float(weights[-1] - (weights[:-1] / spread * centre).sum()),
        [[float(x) for x in row] for row in table], 0.0, 0.0, empty, share,
    )
    scorer = Scorer(model)
    shares = np.array(scorer.shares(["\n".join(own) for own, _ in filled]))
    drawn = {k: int((target == k).sum()) for k in (0, 1)}
    # no label is taken for certain: each counts as one row short of all of its own
    soft = np.where(target == 1, (drawn[1] + 1) / (drawn[1] + 2), 1 / (drawn[0] + 2))
    weight = np.array([max(number[k], 1) / drawn[k] for k in (0, 1)])[target.astype(int)]
    model.slope, model.level = (float(v) for v in fit_odds(shares[:, None], soft, weight, 1e-5))
    return model


def fit(docs: DataFrame, known: DataFrame, rows: int = ROWS) -> Model:
    """Fits the model on documents (id, text) and labels (id, label).

    Labels other than 0 and 1, null ids, and labelled ids without a document are left out. Up to ``rows``
    ids of each label are drawn by a digest of the id; of several documents with one id the smallest text
    counts, of several labels the smaller. Of the drawn documents, those of at most FIT_CHARS characters and
    FIT_LINES line breaks are brought to the driver, which bounds what it gets; a null text is empty.
    With only one label, or none, there is no model and every text gets that label's share.
    """
    known = known.where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.min("label").cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    drawn = draw(known, "label", F.lit(rows))
    text = F.coalesce("text", F.lit(""))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    fitting = docs.select("id", text.alias("text")).where((F.length(text) <= FIT_CHARS) & (breaks <= FIT_LINES))
    found = fitting.join(F.broadcast(drawn), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    samples = [(r["text"], r["label"]) for r in found.collect()]  # at most 2 * rows of FIT_CHARS
    samples.sort()
    return train([(lines_of(t), y) for t, y in samples], sizes)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score) for every document, over whole texts.

    Each line gets the probability that it is good, from its own figures, those of the lines before and
    after it, and the chain; the score is a logistic curve of their mean, weighted by length.
    Null texts count as empty; a text without a line that is more than white space has no chain and gets the share
    of label 1 among such texts of the sample, drawn to that of all labels. There is no shuffle.
    A text is held with its lines and three numbers a line, features of a million characters at a time; a line of
    over LINE_CHARS characters counts as several. Repeated rows score alike; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model.weights is not None else None
        for batch in chunks(batches, "text"):
            found = texts(batch, "text")
            values = scorer.scores(found) if scorer else [model.share if lines_of(t) else model.empty for t in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(values, pa.float64())], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, score double")
