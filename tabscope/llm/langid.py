"""Language identification by string kernels with Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabscope.llm.batches import chunks, texts
from tabscope.llm.common import draw

UNKNOWN = "und"
ORDERS = (1, 2, 3)  # lengths of the strings whose presence is compared
WIDTH = 1 << 14  # places that strings are hashed to
ROWS = 300  # labelled rows per language that the model is fitted on
LANDMARKS = 64  # of these, per language
PIECES = (3, 8, 25)  # words of the short pieces of each fitted row that are fitted as well
RIDGE = 1e-3
BLOCK = 64  # texts whose presence is held as one matrix


def letters() -> np.ndarray:
    """Whether a code point is a letter, over all of Unicode."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Presence:
    """Which strings of one to three letters a text holds, as rows of zeros and ones.

    Texts are lower-cased; all that is no letter counts as one kind of space.
    """

    def __init__(self):
        self.letter = letters()

    def blocks(self, batch: list[str]) -> Iterable[tuple[np.ndarray, np.ndarray]]:
        """Matrices of up to BLOCK texts, and whether each text has a letter."""
        for start in range(0, len(batch), BLOCK):
            yield self.matrix([t.lower() for t in batch[start : start + BLOCK]])

    def matrix(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(t) for t in batch], np.int64)
        held = np.zeros((len(batch), WIDTH), np.float32)
        codes = np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(batch)), sizes)
        word = self.letter[codes]
        any_letter = np.zeros(len(batch), bool)
        any_letter[owner[word]] = True
        codes = np.where(word, codes, 32).astype(np.uint64)
        mixed = np.zeros(len(codes), np.uint64)
        for order in ORDERS:
            n = len(codes) - order + 1
            if n <= 0:
                break
            mixed = (mixed[:n] * np.uint64(0x100000001B3) + codes[order - 1 :] + np.uint64(1)) * np.uint64(
                0x9E3779B97F4A7C15
            )
            place = (mixed ^ np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(50)
            whole = owner[:n] == owner[order - 1 :]
            held[owner[:n][whole], place[whole].astype(np.int64)] = 1
        return held, any_letter


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # places x languages
    bias: np.ndarray


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Shared strings over the geometric mean of both numbers of strings."""
    return unit(rows) @ unit(landmarks).T


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))


def pieces(text: str, key: int) -> list[str]:
    """The text and a short piece of each length, from a place that depends on the row's key."""
    words = text.split()
    cut = [text]
    for n in PIECES:
        if len(words) > n:
            start = (key + 7919 * n) % (len(words) - n)
            cut.append(" ".join(words[start : start + n]))
    return cut


def fit(labelled: DataFrame, rows_per_language: int = ROWS) -> Model:
    """Fits the model on rows (id, text, lang) with lang not null.

    Up to ``rows_per_language`` rows of each language are drawn by a digest of the id. Tasks
    turn their whole texts, and short pieces of them, into presence bits of fixed length, so that the
    driver gets 2 KB for each whatever the length of the texts. There the kernel against the landmarks,
    the Nyström map from the landmarks' own kernel, and ridge regression with one column per
    language are dense matrix products. As all steps after the presence rows are linear, they are
    multiplied into one matrix, places by languages.
    """
    labelled = labelled.where("lang IS NOT NULL")
    drawn = draw(labelled, "lang", F.lit(rows_per_language))  # bounded for each language
    chosen = labelled.join(F.broadcast(drawn), ["id", "lang"], "left_semi")
    chosen = chosen.select(F.xxhash64("id").alias("key"), "lang", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for batch in chunks(batches, "text"):
            keys, langs = batch.column("key").to_pylist(), batch.column("lang").to_pylist()
            cut = [
                (key, lang, n, piece)
                for key, lang, text in zip(keys, langs, texts(batch, "text"))
                for n, piece in enumerate(pieces(text, key % (1 << 31)))
            ]
            bits = [
                np.packbits(row > 0).tobytes() if ok else None
                for held, known in presence.blocks([c[3] for c in cut])
                for row, ok in zip(held, known)
            ]
            names = ["key", "lang", "part", "bits"]
            columns = [[c[0] for c in cut], [c[1] for c in cut], [c[2] for c in cut], bits]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = chosen.mapInArrow(run, "key bigint, lang string, part int, bits binary").where("bits IS NOT NULL").collect()
    rows.sort(key=lambda r: (r["key"], r["lang"], r["part"], bytes(r["bits"])))
    languages = sorted({r["lang"] for r in rows})
    if len(languages) < 2:
        return Model(languages, np.zeros((WIDTH, len(languages)), np.float32), np.ones(len(languages)))
    taken: dict[str, int] = dict.fromkeys(languages, 0)
    marks = []
    for r in rows:
        if r["part"] == 0 and taken[r["lang"]] < LANDMARKS:
            taken[r["lang"]] += 1
            marks.append(r)

    def unpack(some: list) -> np.ndarray:
        bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in some), np.uint8).reshape(len(some), -1)
        return np.unpackbits(bits, axis=1).astype(np.float32)

    landmarks = unpack(marks)
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    safe = values > 1e-6 * values.max()
    nystrom = vectors[:, safe] / np.sqrt(values[safe])
    wide = nystrom.shape[1] + 1
    square, right = np.zeros((wide, wide)), np.zeros((wide, len(languages)))
    for start in range(0, len(rows), 512):
        some = rows[start : start + 512]
        mapped = np.c_[kernel(unpack(some), landmarks) @ nystrom, np.ones(len(some))]
        wanted = np.array([[float(r["lang"] == x) for x in languages] for r in some])
        square += mapped.T @ mapped
        right += mapped.T @ wanted
    ridge = RIDGE * len(rows) * np.eye(wide)
    ridge[-1, -1] = 0
    solved = np.linalg.solve(square + ridge, right)
    weights = unit(landmarks).T.astype(np.float64) @ (nystrom @ solved[:-1])
    return Model(languages, weights.astype(np.float32), solved[-1])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, lang_pred, score) for every document.

    Whole texts are scored, in blocks of texts by one product of their presence matrix and the
    model. The score is the highest output, cut to 0 to 1. A text that is null or has no
    letter is ``und`` with score 0, and so is every text if the model knows no language. Ties go to the
    first language by name; repeated rows score alike; columns other than the two named are not read; a
    table without rows gives none. There is no shuffle. A very long text is a block with few others and
    held whole, with about thirty bytes for each of its characters while it is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for batch in chunks(batches, "text"):
            names, scores = [], []
            for held, known in presence.blocks(texts(batch, "text")):
                found, best = _best(unit(held), known, model)
                names += found
                scores.append(best)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                ["id", "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double")


def identify_rows(docs: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """The documents with all their columns and one more, the language found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for batch in chunks(batches, text_col):
            names = []
            for held, known in presence.blocks(texts(batch, text_col)):
                names += _best(unit(held), known, model)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string())], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, StringType())]))


def _best(rows: np.ndarray, known: np.ndarray, model: Model) -> tuple[list[str], np.ndarray]:
    if not model.languages:
        return [UNKNOWN] * len(rows), np.zeros(len(rows))
    outputs = rows @ model.weights + model.bias
    top = outputs.argmax(1)
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(top, known)]
    return names, np.where(known, np.clip(outputs.max(1), 0, 1), 0.0).astype(np.float64)
