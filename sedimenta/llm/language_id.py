"""Language identification with a small convolutional network over bytes.

Windows of WINDOW bytes go through a learned byte embedding, filters of several widths, a maximum over
the window, and a softmax. It is trained in numpy, on the driver, from at most PER_LANGUAGE documents
of each labelled language and at most PER_DOCUMENT windows of each: the documented bound of the sample.
Every window of every whole text is then scored; a text gets the language with the largest mean
probability, windows weighing as much as they have bytes.

For scoring, embedding and filters are multiplied out into tables over byte pairs, so a window is a few table reads.
Bytes count by class: letters regardless of case, all digits as one, other ASCII as one, bytes beyond ASCII each.

Defined results: a null text, one without a letter, and any text when nothing is labelled give ``und``
with score 0. A null id counts as empty text when documents are split (not held out). Null labels are not
learned from. Equal probabilities give the language first in the alphabet. Repeated rows give one row
each. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.batches import Made, Texts, map_texts
from sedimenta.session import materialize

WINDOW = 256
PER_LANGUAGE = 400
PER_DOCUMENT = 6
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
_PAD, _OTHER, _DIGIT, _ALPHA = 0, 1, 2, 3
_CHUNK = 256


def _classes() -> np.ndarray:
    table = np.full(256, _OTHER, dtype=np.int64)
    for i, letter in enumerate(string.ascii_lowercase):
        table[ord(letter)] = table[ord(letter.upper())] = _ALPHA + i
    table[ord("0") : ord("9") + 1] = _DIGIT
    table[128:] = np.arange(128) + _ALPHA + 26
    return table


_CLASS_OF = _classes()
_N_CLASSES = int(_CLASS_OF.max()) + 1


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def windows_of(data: bytes) -> np.ndarray:
    """Byte classes of all windows of a text; the last one is padded."""
    codes = _CLASS_OF[np.frombuffer(data, dtype=np.uint8)]
    return np.pad(codes, (0, -len(codes) % WINDOW)).reshape(-1, WINDOW)


@dataclass(frozen=True)
class Network:
    languages: tuple[str, ...]
    embedding: np.ndarray
    filters: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]
    dense: np.ndarray
    offset: np.ndarray

    def tables(self) -> Tables:
        """Embedding times filters, by byte class and by pair of classes."""
        parts = [np.einsum("ce,kef->kcf", self.embedding, f) for f in self.filters]
        pairs = [(t[0][:, None] + t[1][None, :]).reshape(_N_CLASSES**2, -1) for t in parts]
        return Tables(
            np.concatenate(pairs, axis=1).astype(np.float32),
            parts[1][2].astype(np.float32),
            (parts[2][2][:, None] + parts[2][3][None, :]).reshape(_N_CLASSES**2, -1).astype(np.float32),
            np.concatenate(self.biases).astype(np.float32),
            self.dense.astype(np.float32),
            self.offset.astype(np.float32),
        )


@dataclass(frozen=True)
class Tables:
    first: np.ndarray
    third: np.ndarray
    second_pair: np.ndarray
    biases: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pairs = windows[:, :-1] * _N_CLASSES + windows[:, 1:]
        first = self.first[pairs]
        three = first[:, :-1, FILTERS : 2 * FILTERS] + self.third[windows[:, 2:]]
        four = first[:, :-2, 2 * FILTERS :] + self.second_pair[pairs[:, 2:]]
        peaks = np.concatenate([first[:, :, :FILTERS].max(1), three.max(1), four.max(1)], axis=1) + self.biases
        return _softmax(np.maximum(peaks, 0) @ self.dense + self.offset)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], epochs: int = 4, rate: float = 0.01, seed: int = 7
) -> Network:
    """Adam on the cross-entropy; classes weigh alike however many windows they have."""
    draw = np.random.default_rng(seed)
    shapes = [(_N_CLASSES, EMBEDDING), *((w, EMBEDDING, FILTERS) for w in WIDTHS), *((FILTERS,) for _ in WIDTHS)]
    shapes += [(FILTERS * len(WIDTHS), len(languages)), (len(languages),)]
    values = [draw.normal(0, 0.3, shape) if len(shape) > 1 else np.zeros(shape) for shape in shapes]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    share = np.bincount(labels, minlength=len(languages)) / len(labels)
    importance = (1 / np.maximum(share, 1e-9) / len(languages))[labels]
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            step += 1
            for i, slope in enumerate(_slopes(values, windows[chosen], labels[chosen], importance[chosen])):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                values[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    n = len(WIDTHS)
    return Network(languages, values[0], tuple(values[1 : 1 + n]), tuple(values[1 + n : 1 + 2 * n]), values[-2], values[-1])


def _slopes(values: list[np.ndarray], windows: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean loss over one batch, in the order of ``values``."""
    n, rows = len(WIDTHS), np.arange(len(labels))
    embedding, filters, biases, dense, offset = values[0], values[1 : 1 + n], values[1 + n : 1 + 2 * n], values[-2], values[-1]
    embedded = embedding[windows]
    peaks, places = [], []
    for width, kernel, bias in zip(WIDTHS, filters, biases):
        span = WINDOW - width + 1
        response = sum(embedded[:, k : k + span] @ kernel[k] for k in range(width))
        place = response.argmax(axis=1)
        places.append(place)
        peaks.append(np.take_along_axis(response, place[:, None], axis=1)[:, 0] + bias)
    hidden = np.concatenate(peaks, axis=1)
    active = np.maximum(hidden, 0)
    error = _softmax(active @ dense + offset)
    error[rows, labels] -= 1
    error *= (importance / len(labels))[:, None]
    back = (error @ dense.T) * (hidden > 0)
    slopes = [np.zeros_like(v) for v in values]
    slopes[-2], slopes[-1] = active.T @ error, error.sum(axis=0)
    for i, width in enumerate(WIDTHS):
        part = back[:, i * FILTERS : (i + 1) * FILTERS]
        slopes[1 + n + i] = part.sum(axis=0)
        for k in range(width):
            codes = np.take_along_axis(windows, places[i] + k, axis=1)  # the byte under each filter's peak
            slopes[1 + i][k] = np.einsum("bfe,bf->ef", embedding[codes], part)
            np.add.at(slopes[0], codes, part[:, :, None] * filters[i][k].T[None])
    return slopes


def _sample(labelled: DataFrame) -> DataFrame:
    """At most PER_LANGUAGE documents per language, chosen by a hash of their ids and texts."""
    ids = labelled.select("doc_id", "lang", F.xxhash64("doc_id", "lang").alias("draw"))
    first = Window.partitionBy("lang").orderBy("draw", "doc_id")
    chosen = ids.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= PER_LANGUAGE)
    few = materialize(chosen.select("doc_id", "lang").distinct(), "chosen")  # PER_LANGUAGE rows per language at most
    texts = labelled.join(F.broadcast(few), ["doc_id", "lang"])
    again = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "text"))
    return texts.withColumn("nth", F.row_number().over(again)).filter(F.col("nth") <= PER_LANGUAGE)


def _training_windows(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    def prepare() -> Callable[[Texts], Made]:
        def cut(texts: Texts) -> Made:
            owners, windows = [], []
            for at, text in enumerate(texts):
                data = text.encode("utf-8", "replace")
                count = -(-len(data) // WINDOW)
                for i in sorted({int(x) for x in np.linspace(0, count - 1, min(count, PER_DOCUMENT))}):
                    owners.append(at)
                    windows.append(data[i * WINDOW : (i + 1) * WINDOW])
            return owners, [pa.array(windows, pa.binary())]

        return cut

    rows = map_texts(_sample(labelled), "data binary", prepare, keep=["lang"]).select("lang", "data").toArrow()
    order = sorted(zip(rows["lang"].to_pylist(), rows["data"].to_pylist()))  # the same network, however rows arrive
    draw = np.random.default_rng(3)
    # half of the windows are cut short, for short texts
    cut = [data[: draw.integers(24, WINDOW + 1)] if draw.random() < 0.5 else data for _, data in order]
    windows = [windows_of(data) for data in cut]
    return [lang for lang, _ in order], np.concatenate(windows) if windows else np.empty((0, WINDOW), np.int64)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network trained on labelled documents outside the held-out fold; None if there are none."""
    labelled = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"), docs[lang].cast("string").alias("lang")).filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    names, windows = _training_windows(labelled)
    if not names:
        return None
    languages = tuple(sorted(set(names)))
    number = {name: i for i, name in enumerate(languages)}
    return train(windows, np.array([number[name] for name in names]), languages)


def predict(docs: DataFrame, network: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``held_out``, ``lang_pred`` and ``score``."""

    def prepare() -> Callable[[Texts], Made]:
        tables = network.tables() if network else None

        def work(texts: Texts) -> Made:
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if tables is None:
                return None, [pa.array(names), pa.array(scores)]
            sums = np.zeros((len(texts), len(network.languages)))
            for owners, windows, sizes in _chunks(texts):
                np.add.at(sums, owners, tables.probabilities(windows) * sizes[:, None])
            for at, row in enumerate(sums):
                if total := row.sum():
                    best = int(row.argmax())
                    names[at], scores[at] = network.languages[best], min(1.0, float(row[best] / total))
            return None, [pa.array(names), pa.array(scores)]

        return work

    named = docs.select(docs[key].alias("doc_id"), docs[text].alias("text")).withColumn("held_out", held_out(F.col("doc_id")))
    return map_texts(named, "lang_pred string, score double", prepare, keep=["held_out"])


def _chunks(texts: Texts):  # noqa: ANN202
    """(document, windows, bytes in each) for all windows of all texts with a letter, some windows at a time."""
    owners, windows, sizes, held = [], [], [], 0
    for at, text in enumerate(texts):
        if not text or not any(map(str.isalpha, text)):
            continue
        data = text.encode("utf-8", "replace")
        for start in range(0, len(data), WINDOW * _CHUNK):
            part = data[start : start + WINDOW * _CHUNK]
            made = windows_of(part)
            owners.append(np.full(len(made), at))
            sizes.append(np.minimum(len(part) - np.arange(len(made)) * WINDOW, WINDOW))
            windows.append(made)
            held += len(made)
            if held >= _CHUNK:
                yield np.concatenate(owners), np.concatenate(windows), np.concatenate(sizes)
                owners, windows, sizes, held = [], [], [], 0
    if held:
        yield np.concatenate(owners), np.concatenate(windows), np.concatenate(sizes)


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled part, predict every document."""
    return predict(docs, fit(docs))
