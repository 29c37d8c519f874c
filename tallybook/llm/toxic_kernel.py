"""Toxic documents by a support vector machine on a subsequence string kernel.

The kernel compares two words by the subsequences of three characters they share, gaps
allowed: a subsequence spread over more characters weighs less, and none spreads over more than
six. So "i-d-i-o-t", "idxiot" and "idioot" stay close to "idiot". Letters set apart one by one
are read as one word.

A sentence is a bag of words and a document a bag of sentences. A toxic document has some toxic
sentence, a clean one none: training marks, in turns, the sentences of toxic documents that the
machine finds worst, and trains on their worst words against the words of clean sentences. The
kernel is approximated by Nystroem's method from landmark words. A sum over landmarks is a table
of weights of subsequences, so that scoring a text takes a few look-ups for each character,
however many landmarks there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.chunks import Words, mixed, slices
from tallybook.llm.shared import per_batch, require_columns

SYMBOLS = 64
_START, _END = 60, 61
#: What a byte counts as: letters without case, digits that stand for letters as these, two-byte
#: letters by their last byte, in which case is one bit; everything else is left out.
SYMBOL = np.zeros(256, dtype=np.int32)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[48:58] = 27
for _digit, _letter in zip("013457@$", "oieastas", strict=True):
    SYMBOL[ord(_digit)] = ord(_letter) - 96
SYMBOL[0x80:0xC0] = 28 + (np.arange(0x80, 0xC0) & 0x1F)
#: Ends of sentences.
_STOPS = np.zeros(256, dtype=bool)
_STOPS[[0x0A, 0x21, 0x2E, 0x3F]] = True


@dataclass(frozen=True)
class Kernel:
    """decay: weight of a subsequence for each character that it spreads further.

    spread: characters a subsequence spreads over at most. toxic_rows, clean_rows: how many
    different labelled texts, of any length, training reads at most, drawn by a hash of the text.
    landmarks, rounds, ridge: of the machine.
    """

    decay: float = 0.7
    spread: int = 6
    toxic_rows: int = 1200
    clean_rows: int = 2400
    landmarks: int = 320
    rounds: int = 5
    ridge: float = 1e-3
    seed: int = 3


class Tokens:
    """The words of texts as one stream of symbols, each between a start and an end."""

    def __init__(self, texts: pa.Array) -> None:
        words = Words(texts, hashes=False)
        symbol = SYMBOL[words.data]
        at = np.flatnonzero(symbol)
        word = np.searchsorted(words.start, at, side="right") - 1
        n = len(words.start)
        length = np.bincount(word, minlength=n)
        document = np.searchsorted(words.first, np.arange(n), side="right") - 1
        # Single letters in a row are one word.
        joined = np.zeros(n, dtype=bool)
        joined[1:] = (length[1:] == 1) & (length[:-1] == 1) & (document[1:] == document[:-1])
        group = np.cumsum(~joined) - 1 if n else np.empty(0, dtype=np.int64)
        token = group[word]
        size = np.bincount(token, minlength=int(group[-1]) + 1 if n else 0)
        some = np.flatnonzero(size)
        first_word = np.flatnonzero(~joined)[some]
        self.size = size[some]
        self.document = document[first_word]
        self.texts = len(words)
        self.first = np.insert(np.cumsum(self.size + 2), 0, 0)
        dense = np.zeros(len(size), dtype=np.int64)
        dense[some] = np.arange(len(some))
        token = dense[token]
        rank = np.arange(len(at)) - np.insert(np.cumsum(self.size), 0, 0)[token]
        self.stream = np.empty(self.first[-1], dtype=np.int32)
        self.stream[self.first[:-1]] = _START
        self.stream[self.first[1:] - 1] = _END
        self.stream[self.first[token] + 1 + rank] = symbol[at]
        self.of = np.repeat(np.arange(len(some)), self.size + 2)
        stops = np.insert(np.cumsum(_STOPS[words.data]), 0, 0)
        ends = stops[words.start[first_word]] if n else np.empty(0, dtype=np.int64)
        # Sentences are numbered through all the texts.
        self.sentence = ends + self.document

    def __len__(self) -> int:
        return len(self.size)

    def spelling(self) -> np.ndarray:
        """A hash of each word's symbols."""
        if not len(self):
            return np.empty(0, dtype=np.uint64)
        rank = np.arange(len(self.stream)) - self.first[:-1][self.of]
        return np.add.reduceat(
            mixed(self.stream.astype(np.uint64) + rank.astype(np.uint64) * np.uint64(SYMBOLS)),
            self.first[:-1],
        )

    def subsequences(self, kernel: Kernel):
        """Per offset pair: the place of the first symbol, the code, and the weight."""
        s = self.stream
        for far in range(2, kernel.spread):
            if len(s) <= far:
                return
            inside = np.flatnonzero(self.of[far:] == self.of[:-far])
            ends = (s[inside] << 12) | s[inside + far]
            for near in range(1, far):
                yield inside, ends | (s[inside + near] << 6), kernel.decay ** (far - 2)

    def scores(self, weights: np.ndarray, kernel: Kernel) -> np.ndarray:
        """The weighted sum of each word's subsequences, for its length."""
        if not len(self):
            return np.empty(0)
        total = np.zeros(len(self.stream))
        for place, code, weight in self.subsequences(kernel):
            total[place] += weights[code] * weight
        return np.add.reduceat(total, self.first[:-1]) / _norms(self.size, kernel)

    def features(self, chosen: np.ndarray, kernel: Kernel) -> tuple[np.ndarray, ...]:
        """(row, code, value) of the subsequences of some words."""
        row_of = np.full(len(self), -1)
        row_of[chosen] = np.arange(len(chosen))
        rows, codes, values = [], [], []
        norms = _norms(self.size, kernel)
        for place, code, weight in self.subsequences(kernel):
            token = self.of[place]
            keep = row_of[token] >= 0
            rows.append(row_of[token[keep]])
            codes.append(code[keep])
            values.append(weight / norms[token[keep]])
        return np.concatenate(rows), np.concatenate(codes), np.concatenate(values)


def _norms(size: np.ndarray, kernel: Kernel) -> np.ndarray:
    """Lengths of the feature vectors of words of so many symbols, all different."""
    square = np.zeros(len(size))
    for far in range(2, kernel.spread):
        square += (far - 1) * np.maximum(size + 2 - far, 0) * kernel.decay ** (2 * (far - 2))
    return np.sqrt(np.maximum(square, 1e-9))


class Sample:
    """Texts to learn from. Their tokens are made anew, some texts at a time, for every look,
    so that training holds little more than the texts."""

    def __init__(self, texts: list[str], at_once: int = 64, characters: int = 200_000) -> None:
        self.texts = len(texts)
        self._parts, start, held = [], 0, 0
        for i, text in enumerate(texts, 1):
            held += len(text)
            if i == len(texts) or i - start == at_once or held > characters:
                self._parts.append((start, pa.array(texts[start:i], pa.string())))
                start, held = i, 0
        documents, sentences, spelled, first_sentence = [], [], [], 0
        for (start, _), part in zip(self._parts, self.parts(), strict=True):
            documents.append((part.document + start).astype(np.int32))
            sentences.append((part.sentence + first_sentence).astype(np.int32))
            spelled.append(part.spelling())
            first_sentence += int(part.sentence.max(initial=0)) + 1
        self.document, self.sentence = np.concatenate(documents), np.concatenate(sentences)
        self.spelling = np.concatenate(spelled)
        self.start = np.insert(np.cumsum([len(x) for x in documents]), 0, 0)

    def parts(self):
        return (Tokens(texts) for _, texts in self._parts)

    def scores(self, weights: np.ndarray, kernel: Kernel) -> np.ndarray:
        return np.concatenate([part.scores(weights, kernel) for part in self.parts()])

    def features(self, chosen: np.ndarray, kernel: Kernel) -> tuple[np.ndarray, ...]:
        """(row, code, value) of the subsequences of some words, sorted by row."""
        found = []
        for i, part in enumerate(self.parts()):
            rows = np.flatnonzero((chosen >= self.start[i]) & (chosen < self.start[i + 1]))
            if len(rows):
                row, code, value = part.features(chosen[rows] - self.start[i], kernel)
                found.append((rows[row].astype(np.int32), code.astype(np.int32), value))
        row, code, value = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(row, kind="stable")
        return row[order], code[order], value[order]


def _nystroem(sample: Sample, landmarks: np.ndarray, chosen: np.ndarray, kernel: Kernel):
    """Feature map of the chosen words, and the table of weights that each feature stands for."""
    row, code, value = sample.features(landmarks, kernel)
    used, column = np.unique(code, return_inverse=True)
    basis = np.zeros((len(landmarks), len(used)), dtype=np.float32)
    np.add.at(basis, (row, column), value)
    eigen, vectors = np.linalg.eigh((basis @ basis.T).astype(np.float64))
    kept = eigen > 1e-5 * eigen.max()
    root = vectors[:, kept] / np.sqrt(eigen[kept])
    table = root.T.astype(np.float32) @ basis
    mapped = np.zeros((len(chosen), table.shape[0]))
    row, code, value = sample.features(chosen, kernel)
    place = np.minimum(np.searchsorted(used, code), len(used) - 1)
    known = used[place] == code
    row, place, value = row[known], place[known], value[known]
    for start in range(0, len(chosen), 128):
        a, b = np.searchsorted(row, [start, start + 128])
        part = np.zeros((min(128, len(chosen) - start), len(used)), dtype=np.float32)
        np.add.at(part, (row[a:b] - start, place[a:b]), value[a:b])
        mapped[start : start + 128] = part @ table.T
    return mapped, used, table


def _svm(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights and, last, the bias of a machine with squared hinge loss, by Newton's method.

    Classes weigh the same, however many examples they have.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    flat = np.full(x.shape[1], ridge)
    flat[-1] = 1e-9
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = y * (x @ w) < 1
        xa, sa = x[active], share[active]
        new = np.linalg.solve(xa.T @ (xa * sa[:, None]) + np.diag(flat), xa.T @ (sa * y[active]))
        step, w = np.abs(new - w).max(), new
        if step < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Model:
    """weights: of subsequences. bias: of the machine. level: from a document's words to odds."""

    weights: np.ndarray
    bias: float
    level: np.ndarray
    kernel: Kernel

    def document_scores(self, tokens: Tokens) -> np.ndarray:
        found = tokens.scores(self.weights, self.kernel) + self.bias
        odds = _document_features(tokens, found) @ self.level
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _document_features(tokens: Tokens | Sample, found: np.ndarray) -> np.ndarray:
    """Of each document: the worst word, and what all words above the margin add up to."""
    worst = np.full(tokens.texts, -2.0)
    np.maximum.at(worst, tokens.document, found)
    above = np.bincount(tokens.document, np.maximum(found, 0), minlength=tokens.texts)
    return np.stack([worst, np.log1p(above), np.ones(tokens.texts)], axis=1)


def train(texts: list[str], toxic: np.ndarray, kernel: Kernel) -> Model:
    """The machine on labelled texts; the last third only sets the level of the scores."""
    rng = np.random.default_rng(kernel.seed)
    order = rng.permutation(len(texts))
    tokens = Sample([texts[i] for i in order])
    label = toxic[order].astype(bool)
    learns = np.arange(len(label)) < -(-2 * len(label) // 3)
    bad = label[tokens.document] & learns[tokens.document]
    good = ~label[tokens.document] & learns[tokens.document]
    # Of the clean words, each once.
    spelling = tokens.spelling
    once = np.flatnonzero(good)
    once = once[np.unique(spelling[once], return_index=True)[1]]
    found = tokens.scores(_log_odds(tokens, bad, good, kernel), kernel)
    weights, bias = np.zeros(SYMBOLS**3), 0.0
    for _ in range(kernel.rounds):
        witnesses = _witnesses(tokens, found, bad)
        strong = once[np.argsort(-found[once], kind="stable")[: 8 * kernel.landmarks]]
        others = rng.choice(once, min(4000, len(once)), replace=False)
        clean = np.unique(np.concatenate([strong, others]))
        half = kernel.landmarks // 2
        landmarks = np.concatenate(
            [_different(spelling, witnesses, half, rng), _different(spelling, clean, half, rng)]
        )
        chosen = np.concatenate([witnesses, clean])
        mapped, used, table = _nystroem(tokens, landmarks, chosen, kernel)
        y = np.repeat([1.0, -1.0], [len(witnesses), len(clean)])
        w = _svm(mapped, y, kernel.ridge)
        weights, bias = np.zeros(SYMBOLS**3), float(w[-1])
        weights[used] = w[:-1] @ table
        found = tokens.scores(weights, kernel) + bias
    level = _logistic(_document_features(tokens, found)[~learns], label[~learns])
    return Model(weights.astype(np.float32), bias, level, kernel)


def _log_odds(sample: Sample, bad: np.ndarray, good: np.ndarray, kernel: Kernel) -> np.ndarray:
    """How much more often a subsequence is in toxic documents' words, for a first guess."""
    counts = np.zeros((2, SYMBOLS**3))
    for part, start in zip(sample.parts(), sample.start, strict=False):
        for place, code, _ in part.subsequences(kernel):
            token = part.of[place] + start
            for side, chosen in enumerate((bad, good)):
                counts[side] += np.bincount(code[chosen[token]], minlength=SYMBOLS**3)
    share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * SYMBOLS**3)
    return np.log(share[0] / share[1])


def _witnesses(tokens: Sample, found: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The worst word of the worst sentence of each toxic document."""
    at = np.flatnonzero(bad)
    order = at[np.lexsort((-found[at], tokens.sentence[at]))]
    worst = order[np.insert(np.diff(tokens.sentence[order]) != 0, 0, True)]
    order = worst[np.lexsort((-found[worst], tokens.document[worst]))]
    return order[np.insert(np.diff(tokens.document[order]) != 0, 0, True)]


def _different(spelling: np.ndarray, chosen: np.ndarray, most: int, rng) -> np.ndarray:
    """At most so many of the words, no two alike."""
    shuffled = rng.permutation(chosen)
    _, first = np.unique(spelling[shuffled], return_index=True)
    return shuffled[np.sort(first)[:most]]


def _logistic(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Coefficients of the odds, by Newton's method with a little shrinkage."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - label) + 0.01 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, kernel: Kernel) -> DataFrame:
    """(_hash, _toxic, text) to train on; the number of rows is bounded.

    Only ids whose crc32, as text, is no multiple of 5 are drawn. A text counts once for each
    label, and which ones are drawn depends on the hash of the text alone.
    """
    marked = labels.where("toxic in (0, 1) and crc32(string(doc_id)) % 5 <> 0").select(
        F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic")
    )
    slim = docs.where("text <> ''").select("doc_id", F.xxhash64("text").alias("_hash"))
    drawn = (
        slim.join(marked, slim["doc_id"] == marked["_id"])
        .groupBy("_hash", "_toxic")
        .agg(F.min("doc_id").alias("_id"))
    )
    chosen = None
    for value, most in ((1, kernel.toxic_rows), (0, kernel.clean_rows)):
        part = drawn.where(F.col("_toxic") == value).orderBy("_hash").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", "text").join(
        chosen, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    )
    return rows.groupBy("_hash", "_toxic").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, kernel: Kernel = Kernel()) -> Model | None:
    """The machine for the labels (doc_id, toxic) of some documents; None without both labels."""
    require_columns(docs, "doc_id", "text")
    require_columns(labels, "doc_id", "toxic")
    # The sample is bounded, so one task holds it; the driver gets the weights, about 1 MB.
    rows = labelled_sample(docs, labels, kernel).repartition(1).sortWithinPartitions("_hash", "_toxic")
    found = rows.mapInArrow(
        lambda batches: _trained(batches, kernel), "weights binary, bias double, level array<double>"
    ).collect()
    if not found:
        return None
    weights = np.frombuffer(found[0]["weights"], dtype=np.float32)
    return Model(weights, found[0]["bias"], np.array(found[0]["level"]), kernel)


def _trained(batches: Iterator[pa.RecordBatch], kernel: Kernel) -> Iterator[pa.RecordBatch]:
    """One row, the machine; none without some texts of both labels."""
    texts, toxic = [], []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        toxic += batch.column("_toxic").to_pylist()
    # Three of each, so that both the words and the level have some to learn from.
    if min(sum(toxic), len(toxic) - sum(toxic)) < 3:
        return
    model = train(texts, np.array(toxic, dtype=bool), kernel)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([model.weights.tobytes()], pa.binary()),
            pa.array([model.bias], pa.float64()),
            pa.array([model.level.tolist()], pa.list_(pa.float64())),
        ],
        names=["weights", "bias", "level"],
    )


def _score_batch(batch: pa.RecordBatch, model: Model | None, name: str) -> pa.RecordBatch:
    text = batch.column("text")
    scores = np.zeros(len(text))
    if model is not None:
        for a, b in slices(text):
            scores[a:b] = model.document_scores(Tokens(text[a:b]))
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(scores, pa.float64())],
        names=[*batch.schema.names, name],
    )


def score_documents(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """The documents, with all their columns, and their score: 0 to 1, higher is more toxic.

    Whole texts are scored, by their words alone. A null or empty text scores as one without
    bad words, and without a model all score 0. Rows that repeat and null ids are scored like
    any others, an empty table gives no rows, and a column that has the score's name is
    replaced.
    """
    require_columns(docs, "text")
    kept = docs.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    return kept.mapInArrow(per_batch(lambda batch: _score_batch(batch, model, name)), schema)
