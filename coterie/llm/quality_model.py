"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is encoded: counts of hashed pairs of bytes and some
ratios, then one hidden layer. A gated attention, tanh(V h) * sigmoid(U h), weighs the passages of a bag, and the weighted sum of
their representations is scored. Encoder, attention and scorer are learned together.

The model is fitted on a bounded sample of labelled rows, ``SAMPLE`` of them and ``BAG`` passages of each, and is a few
hundred kilobytes. Scoring reads every passage of every text in one pass without a shuffle, a bounded piece at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Scratch

# One document in FOLDS is held out: those whose checksum leaves this remainder.
FOLDS, HELD_OUT = 4, 2
# Labelled rows to learn from, and passages of each; what is fitted does not grow with the corpus.
SAMPLE, BAG = 4_000, 16
# Words of a passage. Longer texts are cut into pieces, at white space, before they are cut into passages.
PASSAGE, PIECE = 64, 1 << 18
THRESHOLD = 0.7
HASHED, HIDDEN, GATE = 512, 24, 16
ROUNDS, RATE, DECAY, BATCH = 30, 0.01, 1e-4, 200
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_KIND = np.zeros(256, np.int64)  # letters, capitals, digits, beyond ASCII, white space, line ends, other signs
_KIND[33:127] = 6
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:], _KIND[:33], _KIND[10] = 0, 1, 2, 3, 4, 5
_KINDS, _RATIOS = 7, 4
WIDTH = HASHED + _KINDS + _RATIOS


def held_out(doc_id: int | None) -> bool:
    """By the CRC-32 of the id as text; a null id has the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def pieces(text: bytes) -> Iterator[bytes]:
    """Cut before the first white space beyond each ``PIECE`` bytes, or inside a word that has none for as long again."""
    at = 0
    while at < len(text):
        to = at + PIECE
        while to < min(len(text), at + 2 * PIECE) and not _WHITE[text[to]]:
            to += 1
        yield text[at:to]
        at = to


def passages(piece: bytes) -> np.ndarray:
    """One row of ``WIDTH`` features for each passage of a piece; one row of zeros for a piece without words."""
    raw = np.frombuffer(piece, np.uint8)
    white = np.concatenate([[True], _WHITE[raw], [True]])
    edges = np.flatnonzero(white[1:] != white[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros((1, WIDTH), np.float32)
    first = start[::PASSAGE]
    n = len(first)
    of_byte = np.repeat(np.arange(n), np.diff(np.append(first, len(raw))))
    raw = raw[first[0] :].astype(np.int64)
    size = np.bincount(of_byte, minlength=n).astype(np.float32)
    pair = (raw[:-1] * 31 + raw[1:] * 257) % HASHED
    hashed = np.bincount(of_byte[:-1] * HASHED + pair, minlength=n * HASHED).reshape(n, HASHED)
    kinds = np.bincount(of_byte * _KINDS + _KIND[raw], minlength=n * _KINDS).reshape(n, _KINDS)
    # Words told apart by length, ends and sum of bytes: enough to see repetition.
    start, end = start - first[0], end - first[0]
    sums = np.concatenate([[0], np.cumsum(raw)])
    word = (sums[end] - sums[start]) * 65536 + raw[start] * 256 + raw[end - 1]
    of_word = np.arange(len(word)) // PASSAGE
    count = np.bincount(of_word, minlength=n)
    distinct = np.bincount(np.unique(of_word << 40 | word & (1 << 40) - 1) >> 40, minlength=n)
    short = np.bincount(of_word, end - start <= 3, minlength=n)
    ratios = np.stack([distinct / count, np.log(size / count), np.log(count), short / count], axis=1)
    return np.concatenate([np.sqrt(hashed / size[:, None]), np.sqrt(kinds / size[:, None]), ratios], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class Model:
    """Weights: features are shifted and scaled, encoded (w, b), weighed by gated attention (v, u, a) and scored (c, d)."""

    shift: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def encode(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The representation and the attention logit of each passage."""
        x, m = (features - self.shift) * self.scale, self.weights
        hidden = np.tanh(x @ m["w"] + m["b"])
        return hidden, (np.tanh(hidden @ m["v"]) * _sigmoid(hidden @ m["u"])) @ m["a"]

    def score(self, text: bytes) -> float:
        """One text, a piece at a time: the softmax over all its passages is summed up with a running maximum."""
        top, norm, total = -np.inf, 0.0, np.zeros(HIDDEN)
        for piece in pieces(text) if text else [b""]:
            hidden, logit = self.encode(passages(piece))
            most = max(top, float(logit.max()))
            old, weight = np.exp(top - most), np.exp(logit - most)
            top, norm, total = most, norm * old + float(weight.sum()), total * old + weight @ hidden
        return float(_sigmoid(total / norm @ self.weights["c"] + self.weights["d"][0]))


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Learn from bags of passages; labels are 0 or 1. Without any label the score is one half, with one class that class."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    m = {"w": draw(WIDTH, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "v": draw(HIDDEN, GATE), "u": draw(HIDDEN, GATE),
         "a": draw(GATE), "c": draw(HIDDEN), "d": np.zeros(1, np.float32)}
    if not bags:
        m["c"][:] = 0
        return Model(np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32), m)
    every = np.concatenate(bags)
    shift = every.mean(0)
    model = Model(shift, 1 / np.maximum(every.std(0), 0.02), m)
    first, second = ({k: np.zeros_like(x) for k, x in m.items()} for _ in range(2))
    step = 0
    for _ in range(ROUNDS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            for name, grad in _gradients(model, [bags[i] for i in some], labels[some].astype(np.float32)).items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad * grad
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                m[name] -= rate * (first[name] / (np.sqrt(second[name]) + 1e-8) + DECAY * m[name])
    return model


def _gradients(model: Model, bags: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy over some bags."""
    m = model.weights
    sizes = np.array([len(b) for b in bags])
    starts = np.cumsum(sizes) - sizes
    bag = np.repeat(np.arange(len(bags)), sizes)
    x = (np.concatenate(bags) - model.shift) * model.scale
    h = np.tanh(x @ m["w"] + m["b"])
    tv, su = np.tanh(h @ m["v"]), _sigmoid(h @ m["u"])
    logit = (tv * su) @ m["a"]
    weight = np.exp(logit - np.maximum.reduceat(logit, starts)[bag])
    weight /= np.add.reduceat(weight, starts)[bag]
    z = np.add.reduceat(weight[:, None] * h, starts)
    wrong = (_sigmoid(z @ m["c"] + m["d"][0]) - labels) / len(bags)
    dz = wrong[:, None] * m["c"]
    along = (dz[bag] * h).sum(1)
    dlogit = weight * (along - np.add.reduceat(weight * along, starts)[bag])
    dgate = dlogit[:, None] * m["a"]
    dv, du = dgate * su * (1 - tv * tv), dgate * tv * su * (1 - su)
    dh = (weight[:, None] * dz[bag] + dv @ m["v"].T + du @ m["u"].T) * (1 - h * h)
    return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dv, "u": h.T @ du, "a": (tv * su).T @ dlogit,
            "c": z.T @ wrong, "d": wrong.sum(keepdims=True)}


def _bag(text: str | None) -> np.ndarray:
    """The passages of a text to learn from: all, or ``BAG`` at even distances."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    rows, held = [], 0
    for piece in pieces(raw) if raw else [b""]:
        rows.append(passages(piece))
        held += len(rows[-1])
        if held > 64 * BAG:  # keep what is held bounded: every second passage so far
            rows = [np.concatenate(rows)[::2]]
            held = len(rows[0])
    every = np.concatenate(rows)
    return every[np.linspace(0, len(every) - 1, min(BAG, len(every))).astype(int)]


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for one in batch.to_pylist():
            bag = _bag(one["text"])
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([one["key"]], pa.int64()), "label": pa.array([one["label"]], pa.int32()),
                "bag": pa.array([bag.astype(np.float16).tobytes()], pa.binary()),
            })


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``(key, label, text)``: at most ``sample`` rows that may be learned from, the first by a hash of id and text.

    An id with labels of both kinds is left out, and so is one without a label; copies of a row count once.
    """
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    clear = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
        .where(fold != HELD_OUT)
    )
    # Ids are chosen before texts are read, so the join below has a small side of a known size.
    present = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().join(clear, "doc_id")
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = texts.join(F.broadcast(chosen), "doc_id").withColumn("key", F.xxhash64("doc_id", "text"))
    # One row of each id, so that repeated rows do not crowd out others.
    return keyed.groupBy("doc_id", "label").agg(F.min(F.struct("key", "text")).alias("one")).select("one.key", "label", "one.text")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows; their features, not their texts, reach the driver."""
    rows = labelled_sample(docs, labels, sample).mapInArrow(_bags, "key long, label int, bag binary").toPandas()
    rows = rows.sort_values(["key", "label"], kind="stable")
    bags = [np.frombuffer(b, np.float16).reshape(-1, WIDTH).astype(np.float32) for b in rows["bag"]]
    return fit(bags, rows["label"].to_numpy(np.int64))


def _scorer(model: Model):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            scores = np.array([model.score(t.as_py() or b"") for t in batch.column("text").cast(pa.large_binary())], np.float64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array([held_out(i) for i in ids], pa.bool_()),
                "score": pa.array(scores, pa.float64()), "predicted": pa.array(scores >= THRESHOLD, pa.bool_()).cast(pa.int32()),
            })

    return scored


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row for each row of ``docs (doc_id, text)``.

    ``labels (doc_id, quality)`` says 1 or 0; other values, null ids, ids without a document and ids with both labels are not
    learned from, and neither are held-out ids. The score is that of the whole text, between 0 and 1, and ``predicted`` is 1 from
    0.7. Null and empty texts are one empty passage and get its score. Without usable labels every score is one half.
    Equal texts get equal scores, an empty table gives an empty result. Other columns are ignored.
    """
    if sample < 1:
        raise ValueError("sample must be at least 1")
    with Scratch(docs.sparkSession) as scratch:
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        model = train(docs, labels, sample)
        return scratch.save(
            rows.mapInArrow(_scorer(model), "doc_id long, held_out boolean, score double, predicted int"), keep=True
        ).df
