"""Toxicity by compression distance: two zstandard dictionaries, windows, a calibrated threshold."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.batches import chunks, texts
from tabscope.llm.common import draw, written

WINDOW = 64  # bytes of a window, cut at white space
GRAM = 5  # bytes of the strings that are counted, and of the shortest match
CONTEXT = 9  # bytes on either side that make two occurrences different ones
BASE = 2048  # bytes of the dictionary of ordinary text
MARKS = 1024  # bytes of toxic strings put after it
FIT_ROWS = (3000, 1500)  # ordinary and toxic rows that the dictionaries are trained on
FIT_CHARS = 20_000  # rows with longer texts are not drawn for that
FIT_WINDOWS = 20_000  # windows that the ordinary dictionary is trained on, evenly from all drawn rows
CALIBRATION_ROWS = 4000  # of each label, whole texts


@dataclass
class Model:
    """Everything that scoring needs: two dictionaries, a known tail, a logistic function."""

    ordinary: bytes
    toxic: bytes
    tail: bytes
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    constant: float | None = None  # the score of every text where one label is missing


def fold(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode().split()) + b" "


def windows(folded: bytes) -> list[bytes]:
    cut, start = [], 0
    while len(folded) - start > WINDOW:
        end = folded.rfind(b" ", start + WINDOW // 2, start + WINDOW)
        end = start + WINDOW if end < 0 else end
        cut.append(folded[start:end])
        start = end
    cut.append(folded[start:])
    return cut


def _grams(folded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The text as one array with gaps, and the number that stands for the string at each place."""
    gap = b" " * CONTEXT
    data = np.frombuffer(gap + gap.join(folded) + gap + gap, np.uint8)
    codes = np.zeros(len(data) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        codes = (codes << np.uint64(8)) | data[k : len(data) - GRAM + 1 + k]
    return data, codes


def _count(folded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct surroundings of every string: copies of a passage count once."""
    _, codes = _grams(folded)
    mixed, step = np.zeros(len(codes) - 2 * CONTEXT, np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for k in range(0, 2 * CONTEXT + 1, GRAM - 1):  # windows of GRAM bytes overlap by one
        mixed = (mixed ^ codes[k : k + len(mixed)]) * step
        mixed ^= mixed >> np.uint64(29)
    _, first = np.unique(mixed, return_index=True)
    return np.unique(codes[first + CONTEXT], return_counts=True)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], 0)


def toxic_strings(ordinary: list[bytes], toxic: list[bytes]) -> bytes:
    """The content that sets toxic text apart, the most frequent strings last.

    A string of GRAM bytes counts as toxic if its rate is over eight times that in ordinary
    text and eight deviations above it; runs of such strings are taken where they are about
    as frequent as their neighbours, so that a word is taken and not what stands around it.
    """
    keys, counts = _count(toxic)
    base_keys, base_counts = _count(ordinary)
    expected = (_look_up(base_keys, base_counts, keys) + 0.5) * len(toxic) / len(ordinary)
    marks = (counts > 8 * expected) & (counts - expected > 8 * np.sqrt(1 + expected))
    data, codes = _grams(toxic)
    here = _look_up(keys[marks], counts[marks], codes)
    around = np.pad(here, GRAM)
    highest = np.max([around[k : k + len(here)] for k in range(2 * GRAM + 1)], axis=0)
    covered = np.zeros(len(data) + 1, np.int64)
    chosen = np.flatnonzero((here > 0) & (here >= 0.4 * highest))
    np.add.at(covered, chosen, 1)
    np.add.at(covered, chosen + GRAM, -1)
    inside = np.concatenate([[0], (np.cumsum(covered) > 0).astype(np.int8)])
    edges = np.flatnonzero(np.diff(inside))
    raw = data.tobytes()
    found = Counter(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
    content = b""
    for string, times in sorted(found.items(), key=lambda x: (-x[1], x[0])):
        if times < max(3, 0.004 * len(toxic)) or len(content) > MARKS:
            break
        if string not in content:
            content = b"\n" + string + content
    return content


class Scorer:
    """Compresses windows with both dictionaries.

    A window is compressed with a tail that both dictionaries hold, so that it is always
    written as matches and plain bytes and the two lengths differ only by what the toxic strings
    save. The dictionaries are read in once, not for every window.
    """

    def __init__(self, model: Model):
        self.model = model
        self.tail = model.tail
        self.pair = [self._compressor(d + model.tail) for d in (model.ordinary, model.toxic)]

    @staticmethod
    def _compressor(content: bytes) -> zstd.ZstdCompressor:
        params = zstd.ZstdCompressionParameters(
            window_log=18, chain_log=17, hash_log=17, search_log=6, min_match=GRAM, target_length=1,
            strategy=zstd.STRATEGY_FAST, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        held = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=params)
        return zstd.ZstdCompressor(dict_data=held, compression_params=params)

    def features(self, text: str) -> list[float]:
        plain, marked = self.pair[0].compress, self.pair[1].compress
        cut = [w + self.tail for w in windows(fold(text))]
        saved = np.array([len(plain(w)) - len(marked(w)) for w in cut], float)
        excess, hits = np.clip(saved - 1, 0, 8), int((saved >= 2).sum())
        return [
            min(saved.max(), 8.0), np.log1p(excess.sum()), min(1.0, excess.mean()), hits / len(saved),
            float(hits > 0), np.log1p(len(saved)) / (1 + hits),
        ]

    def score(self, batch: list[str]) -> np.ndarray:
        model = self.model
        if model.constant is not None:
            return np.full(len(batch), model.constant)
        return logistic(model, np.array([self.features(t) for t in batch]).reshape(len(batch), -1))


def logistic(model: Model, features: np.ndarray) -> np.ndarray:
    scaled = np.c_[(features - model.mean) / model.spread, np.ones(len(features))]
    return 1 / (1 + np.exp(-np.clip(scaled @ model.weights, -30, 30)))


def calibrate(model: Model, features: np.ndarray, labels: np.ndarray) -> None:
    """Fits the logistic function by Newton's steps with a small penalty.

    The rarer label weighs more, by the root of the ratio of their numbers, so that the
    threshold lies between finding all toxic rows and the share that labels happen to have.
    """
    weight = np.where(labels == 1, np.sqrt(((labels == 0).sum() + 1) / ((labels == 1).sum() + 1)), 1.0)
    model.mean, model.spread = features.mean(0), features.std(0) + 1e-9
    scaled = np.c_[(features - model.mean) / model.spread, np.ones(len(features))]
    model.weights = np.zeros(scaled.shape[1])
    penalty = 0.01 * np.eye(scaled.shape[1])
    for _ in range(50):
        share = 1 / (1 + np.exp(-np.clip(scaled @ model.weights, -30, 30)))
        slope = scaled.T @ (weight * (share - labels)) + penalty @ model.weights
        bend = (scaled.T * (weight * share * (1 - share) + 1e-9)) @ scaled + penalty
        model.weights = model.weights - np.linalg.solve(bend, slope)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Trains the model on documents (id, text) and labels (id, label), 1 for toxic, 0 for ordinary.

    The ids are drawn from the labels, and only these few documents are fetched. The
    dictionaries are made on the driver from up to FIT_ROWS of their texts, of which those over
    FIT_CHARS characters are left out; the ordinary one from every k-th of their windows, the smallest k
    that leaves at most FIT_WINDOWS. The threshold is calibrated on up to CALIBRATION_ROWS other rows of each label; their
    whole texts are compressed in tasks and six numbers a row come back. Both bounds are
    constants. Which rows are drawn depends on their ids alone. Without rows of both labels
    every text scores 1 or 0, as the only label has it (0 without any).
    """
    labels = labels.where("label IN (0, 1)")
    third = F.pmod(F.xxhash64(F.lit("calibration"), "id"), F.lit(3)) == 0
    docs = docs.select("id", F.coalesce("text", F.lit("")).alias("text"))

    def some(pool: DataFrame, limit: Column) -> DataFrame:
        # bounded by the limits: at most so many ids of two labels
        return docs.join(F.broadcast(written(draw(pool, "label", limit), "toxicity-rows")), "id")

    limit = F.when(F.col("label") == 1, FIT_ROWS[1]).otherwise(FIT_ROWS[0])
    drawn = some(labels.where(~third), limit).where(F.length("text") <= FIT_CHARS).collect()
    drawn.sort(key=lambda r: (r["id"], r["text"]))
    ordinary = [fold(r["text"]) for r in drawn if r["label"] == 0]
    toxic = [fold(r["text"]) for r in drawn if r["label"] == 1]
    tail = np.random.default_rng(3).integers(128, 256, 48, dtype=np.uint8).tobytes()
    if not ordinary or not toxic:
        return Model(b"", b"", tail, constant=float(bool(toxic)))
    samples = [w for t in ordinary for w in windows(t) if len(w) >= 32]
    even = samples[:: max(1, -(-len(samples) // FIT_WINDOWS))]
    try:
        base = zstd.train_dictionary(BASE, even, k=64, d=6).as_bytes()
    except zstd.ZstdError:  # too little text to train on
        base = b"".join(samples)[-BASE:]
    marks = toxic_strings(ordinary, toxic)
    # as many bytes that no text holds keep both dictionaries' distances alike
    blank = np.random.default_rng(5).integers(128, 192, len(marks), dtype=np.uint8).tobytes()
    model = Model(base + blank, base + marks, tail)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in chunks(batches, "text"):
            found = [scorer.features(t) for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column("label")], ["f", "label"])

    chosen = some(labels.where(third), F.lit(CALIBRATION_ROWS)).select("text", "label")
    rows = chosen.mapInArrow(measure, "f array<double>, label int").collect()
    labels = np.array([r["label"] for r in rows], float)
    if labels.size == 0 or labels.min() == labels.max():
        model.constant = float(bool(labels.size) and bool(labels.max()))
    else:
        calibrate(model, np.array([r["f"] for r in rows]), labels)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, score) for every document: whole texts, null as empty, from 0 to 1.

    There is no shuffle; a task holds a few megabytes of text at a time, or one longer text. Equal texts
    score alike; a text far longer than all that the threshold was calibrated on is extrapolated; columns other than the two named are not read; a table
    without rows gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in chunks(batches, "text"):
            found = pa.array(scorer.score(texts(batch, "text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), found], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"id {kind}, score double")
