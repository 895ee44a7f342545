"""Scores of texts under a smoothed word model, by a weighted backoff automaton.

A state is the word read last. Its arcs are the words seen after it in training, with their smoothed log
probabilities; any other word takes the failure arc, whose weight is the state's backoff, to the root, whose arcs
are single words. Nothing is cut from the model, so it grows with the corpus and no task could hold it. Each
block of documents asks for the counts of its own words and word pairs and builds the part of the automaton that its texts
can reach.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Scratch
from .blocks import packed, unpacked
from .exchange import OWNER_KEYS, REQUEST, answered, expand, request, request_batch, totals_of
from .repeats import together
from .substring_dedup import word_hashes

# One document in FOLDS is held out: those whose checksum leaves this remainder.
FOLDS, HELD_OUT = 5, 1
# Pseudo-counts: of every word and the unknown one, and of the single words behind a state.
ADDED = 0.5
STRENGTH = 1000.0
_END, _START = np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)
# Bytes of text in a block; its pairs of words and their arcs have to fit a task.
_BLOCK = 6 << 20


def held_out(doc_id: int | None) -> bool:
    """By the CRC-32 of the id as text; a null id has the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


class Tokens:
    """The tokens of a block's texts in one array: the words in lower case and one end for each text."""

    def __init__(self, ids: pa.Array, texts: list[bytes]):
        parts = []
        for text in texts:
            parts += [word_hashes(text.lower()), np.array([_END])]
        self.ids = ids
        self.tokens = np.concatenate(parts)
        self.sizes = np.array([len(p) + 1 for p in parts[::2]], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.held_out = np.array([held_out(i) for i in ids.to_pylist()], bool)
        before = np.roll(self.tokens, 1)
        before[self.starts] = _START
        self.before = before
        self.pairs = together(before, self.tokens)

    def counted(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, their counts in training texts, and the place of each key."""
        distinct, place = np.unique(keys, return_inverse=True)
        train = np.repeat(~self.held_out, self.sizes)
        return distinct, np.bincount(place[train], minlength=len(distinct)), place


def _ask(pairs: bool, owners: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                tokens = Tokens(*unpacked(data.as_py()))
                keys, counts, _ = tokens.counted(tokens.pairs if pairs else tokens.tokens)
                yield request_batch([request(block, keys, counts, None, owners)])

    return ask


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = v = 0
        for code, bits in zip(batch.column("totals").to_pylist(), batch.column("first").to_pylist()):
            totals = expand(code, np.int64)
            own = totals[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(totals)).astype(bool)]
            n, v = n + int(own.sum(dtype=np.int64)), v + int((own > 0).sum())
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "v": pa.array([v], pa.int64())})


class Automaton:
    """The states and arcs that the texts of one block can reach, in log10.

    Words are numbered by the block; number -1 is the start of a text. A state stands for a word seen in training; the
    root has no number and is where unseen words lead.
    """

    def __init__(self, words: int, n: int, v: int, strength: float):
        self.words, self.strength = words, strength
        self.whole = n + ADDED * (v + 1)

    def build(self, counts: np.ndarray, arcs: np.ndarray, arc_counts: np.ndarray, starts: int) -> "Automaton":
        """``arcs`` are ascending ``state * words + word`` with state 0 for the start, word w's state w + 1."""
        history = np.append(starts, counts).astype(np.float64)
        self.root = np.log10((counts + ADDED) / self.whole)
        self.fail = np.log10(self.strength / (history + self.strength))
        seen = arc_counts > 0
        self.arcs, word = arcs[seen], arcs[seen] % self.words
        single = (counts[word] + ADDED) / self.whole
        self.weights = np.log10((arc_counts[seen] + self.strength * single) / (history[self.arcs // self.words] + self.strength))
        return self

    def traverse(self, tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log probability of each step of the texts that begin at ``starts``, read left to right.

        The state carried into a step is that of the token before it (a word never seen has the weightless failure
        arc of the root), so the steps of all texts are taken together.
        """
        state = np.roll(tokens, 1) + 1
        state[starts] = 0
        arc = state * self.words + tokens
        at = np.searchsorted(self.arcs, arc)
        at[at == len(self.arcs)] = 0
        taken = self.arcs[at] == arc if len(self.arcs) else np.zeros(len(arc), bool)
        out = self.fail[state] + self.root[tokens]
        out[taken] = self.weights[at[taken]]
        return out


def _score(n: int, v: int, strength: float, word_owners: int, pair_owners: int):
    def score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        of_pairs = pa.compute.equal(answers["level"], 2)
        for data in blocks["data"]:
            tokens = Tokens(*unpacked(data.as_py()))
            words, _, place = tokens.counted(tokens.tokens)
            counts, _ = totals_of(words, answers.filter(pa.compute.invert(of_pairs)), word_owners)
            pairs, where = np.unique(tokens.pairs, return_index=True)
            pair_counts, _ = totals_of(pairs, answers.filter(of_pairs), pair_owners)
            before = np.roll(place, 1) + 1
            before[tokens.starts] = 0
            arcs = before[where] * len(words) + place[where]
            by = np.argsort(arcs)
            ends = int(counts[np.searchsorted(words, _END)])
            automaton = Automaton(len(words), n, v, strength).build(counts, arcs[by], pair_counts[by], ends)
            steps = automaton.traverse(place, tokens.starts)
            base, known = automaton.root[place], (counts[place] > 0).astype(np.int64)
            out.append(pa.table({
                "doc_id": tokens.ids, "held_out": pa.array(tokens.held_out), "n_tokens": pa.array(tokens.sizes),
                "n_known": pa.array(np.add.reduceat(known, tokens.starts)),
                "train_tokens": pa.array(np.full(len(tokens.sizes), n, np.int64)),
                "base_score": pa.array(np.add.reduceat(base, tokens.starts)),
                "score": pa.array(np.add.reduceat(steps, tokens.starts)),
            }))
        return pa.concat_tables(out)

    return score


def score(docs: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row for each row of ``docs (doc_id, text)``.

    The model learns from the texts that are not held out. The probability of a word w after h is
    ``(count(h w) + strength * P(w)) / (count(h) + strength)``, P being that of the base score, so the
    probabilities after any h sum to one. Null and empty texts are one end. Equal rows count as
    often as they are there. Other columns are ignored.
    """
    with Scratch(docs.sparkSession) as scratch:
        blocks = packed(docs, scratch, _BLOCK)
        size = blocks.metrics["size"] or 0
        owners = max(1, -(-(size // 10) // OWNER_KEYS))
        word_owners = max(1, owners // 3)
        blobs = blocks.df.select("block", "data")
        words = scratch.save(answered(blobs.mapInArrow(_ask(False, word_owners), REQUEST)))
        totals = scratch.save(words.df.mapInArrow(_sums, "n long, v long"), n=F.sum("n"), v=F.sum("v")).metrics
        pairs = scratch.save(answered(blobs.mapInArrow(_ask(True, owners), REQUEST)))
        answers = words.df.withColumn("level", F.lit(1)).unionByName(pairs.df.withColumn("level", F.lit(2)))
        return scratch.save(
            blobs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
                _score(totals["n"] or 0, totals["v"] or 0, strength, word_owners, owners),
                "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
            ),
            keep=True,
        ).df
