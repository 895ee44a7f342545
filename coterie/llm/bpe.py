"""BPE encoding and decoding with a lexicon of the corpus's frequent words.

Words are counted over all texts; the most frequent ones are merged once and compiled into a minimal acyclic
transducer that every task maps. A word that is not in it is merged exactly: the pair of lowest rank first,
the leftmost of equal ones.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..plans.scratch import Scratch
from .lexicon import Transducer, compile_words

# Words compiled into the transducer: the most frequent ones. It bounds the broadcast, not the result.
LEXICON_WORDS = 60_000
# Words that a task keeps looked up with their ids, and counts before it sends them on; with their text it keeps twice as many.
HELD_WORDS = 250_000
# Bytes of results that a task sends on together.
_SENT_BYTES = 4 << 20
# Code points of the words that are counted, compiled and kept; longer ones are merged whenever they come.
LONGEST = 64
# Blocks of Unicode on which the regex and unicodedata modules agree with the tokenizer's own tables (tested for
# every code point); a text with any other character is normalised and split by the tokenizer's parts.
_COMMON = regex.compile("[\\x00-ԯ‐-‧€]*+")


def read_file(path: str) -> str:
    """The description of a tokenizer; the driver reads it and sends it to the tasks."""
    return Path(path).read_text(encoding="utf-8")


class _Held:
    """At most ``words`` words with what was found for them, in two halves: a word that comes again moves to the new one."""

    def __init__(self, words: int):
        self.half, self.new, self.old = words // 2, {}, {}

    def get(self, word: str):
        found = self.new.get(word)
        if found is None and (found := self.old.get(word)) is not None:
            self.put(word, found)
        return found

    def put(self, word: str, found):
        if len(word) <= LONGEST:
            if len(self.new) >= self.half:
                self.new, self.old = {}, self.new
            self.new[word] = found
        return found


class WordBpe:
    """A BPE model with word ends, from the JSON description of a tokenizer."""

    def __init__(self, description: str, code: bytes | None = None):
        parts = json.loads(description)
        model, steps = parts["model"], parts["pre_tokenizer"]["pretokenizers"]
        self.vocab = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.added = {a["content"]: a["id"] for a in parts["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.added.items()]}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {
            (self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        self._find = regex.compile(steps[0]["pattern"]["Regex"]).findall
        self._added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")")
        whole = Tokenizer.from_str(description)
        self._normalizer, self._splitter = whole.normalizer, whole.pre_tokenizer
        # The usual printable stand-ins for the 256 bytes.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in set(plain))
        self._byte = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}
        self._lexicon = Transducer(code) if code else None
        # Of words seen: the ids, and those with the text that they decode to.
        self._ids_held, self._both_held = _Held(HELD_WORDS), _Held(2 * HELD_WORDS)

    def words(self, piece: str) -> list[str]:
        """The words of a text without added tokens, normalised."""
        if _COMMON.fullmatch(piece):
            # No word holds white space, so it need not be made one blank first.
            line = unicodedata.normalize("NFC", piece)
            # Letter by letter: lower() alone treats a final sigma by its place.
            line = "".join(c.lower() for c in line) if "Σ" in line else line.lower()
            return self._find(line)
        line = self._normalizer.normalize_str(piece)
        return [line[i:j] for _, (i, j) in self._splitter.pre_tokenize_str(line)]

    def pieces(self, text: str) -> list[str]:
        """The text cut at added tokens, which have the odd places."""
        return self._added.split(text) if any(token in text for token in self.added) else [text]

    def merge(self, word: str) -> list[int]:
        """The ids of one word by its merges."""
        symbols = [self._byte[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.end
        ids = [self.vocab[s] for s in symbols]
        ranks = self.ranks
        while len(ids) > 1:
            best, at = None, 0
            for k in range(len(ids) - 1):
                found = ranks.get((ids[k], ids[k + 1]))
                if found is not None and (best is None or found < best):
                    best, at = found, k
            if best is None:
                break
            ids[at : at + 2] = [best[1]]
        return ids

    def _both(self, ids: array) -> tuple[bytes, bytes]:
        return ids.tobytes(), self.decode(ids).encode("utf-8", "surrogatepass")

    def _word(self, word: str) -> array:
        ids = self._lexicon.get(word.encode("utf-8", "surrogatepass")) if self._lexicon else None
        return array("I", self.merge_long(word) if ids is None else ids)

    def _look_up(self, word: str) -> tuple[bytes, bytes]:
        return self._both_held.get(word) or self._both_held.put(word, self._both(self._word(word)))

    def _look_up_ids(self, word: str) -> bytes:
        return self._ids_held.get(word) or self._ids_held.put(word, self._word(word).tobytes())

    def merge_long(self, word: str) -> list[int]:
        """As merge(); a long word goes through a heap, whose work grows with n log n only."""
        if len(word) <= 40:
            return self.merge(word)


        symbols = [self._byte[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.end
        ids = [self.vocab[s] for s in symbols]
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = []
        for k in range(len(ids) - 1):
            if found := self.ranks.get((ids[k], ids[k + 1])):
                heap.append((found[0], k, ids[k], ids[k + 1], found[1]))
        heapify(heap)
        while heap:
            _, k, left, right, made = heappop(heap)
            n = after[k]
            if ids[k] != left or n < 0 or ids[n] != right:
                continue
            ids[k], ids[n] = made, -1
            after[k] = after[n]
            if after[n] >= 0:
                before[after[n]] = k
                if found := self.ranks.get((made, ids[after[k]])):
                    heappush(heap, (found[0], k, made, ids[after[k]], found[1]))
            if (p := before[k]) >= 0 and (found := self.ranks.get((ids[p], made))):
                heappush(heap, (found[0], p, ids[p], made, found[1]))
        return [i for i in ids if i >= 0]

    def both(self, text: str) -> tuple[bytes, bytes]:
        """The ids of a text as little-endian unsigned 32-bit integers, and the UTF-8 text that they decode to.

        Decoding joins tokens by spaces, so it joins what the words decode to.
        """
        held, look_up = self._both_held.new, self._look_up
        out = []
        for k, piece in enumerate(self.pieces(text)):
            if k % 2:
                out.append(self._both(array("I", [self.added[piece]])))
            else:
                out += [held[w] if w in held else look_up(w) for w in self.words(piece)]
        return b"".join([ids for ids, _ in out]), b" ".join([decoded for _, decoded in out])

    def ids(self, text: str) -> bytes:
        """The first of both()."""
        held, look_up = self._ids_held.new, self._look_up_ids
        out = []
        for k, piece in enumerate(self.pieces(text)):
            if k % 2:
                out.append(array("I", [self.added[piece]]).tobytes())
            else:
                out += [held[w] if w in held else look_up(w) for w in self.words(piece)]
        return b"".join(out)

    def encode(self, text: str) -> array:
        return array("I", self.ids(text))

    def decode(self, ids: array) -> str:
        """The tokens joined by spaces: the description names no decoder."""
        return " ".join(map(self.names.__getitem__, ids))


_last: tuple = (None, None)


def _model(description: str, code: bytes | None = None) -> WordBpe:
    """The model of a Python worker: tasks that follow each other go on with what is looked up already."""
    global _last
    key = (hash(description), hash(code))
    if _last[0] != key:
        _last = (key, WordBpe(description, code))
    return _last[1]


def _counted(description):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = _model(description.value), Counter()

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(list(seen)), "n": pa.array(list(seen.values()), pa.int64())})

        for batch in batches:
            for text in batch.column("text"):
                for piece in model.pieces(text.as_py() or "")[::2]:
                    seen.update(model.words(piece))
                if len(seen) > HELD_WORDS:
                    yield out()
                    seen.clear()
        yield out()

    return count


def build_lexicon(docs: DataFrame, description: str, size: int = LEXICON_WORDS) -> bytes:
    """The transducer of the most frequent words of all texts, by levels of frequency: at most ``size`` words."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(description)
    with Scratch(spark) as scratch:
        counts = scratch.save(
            docs.select("text").mapInArrow(_counted(sent), "word string, n long").where(F.length("word") <= LONGEST).groupBy("word").agg(F.sum("n").alias("n"))
            .withColumn("level", F.floor(F.log2("n") * 64))
        )
        # At most 64 levels per doubling, so the driver sees a few thousand sums before it asks for words.
        levels = sorted(counts.df.groupBy("level").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)
        least, held = float("inf"), 0
        for level, n in levels:
            held += n
            if held > size:
                break
            least = level
        top = counts.df.where(F.col("level") >= least).select("word").collect()
    model = WordBpe(description)
    found = {r["word"].encode("utf-8", "surrogatepass"): r["word"] for r in top}
    return compile_words((w, model.merge_long(found[w])) for w in sorted(found))


def _encoded(description, code, decoded: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(description.value, code.value)
        find = model.both if decoded else lambda text: (model.ids(text), b"")
        for batch in batches:
            found, size, sent = [], 0, 0
            for k, text in enumerate(batch.column("text"), 1):
                found.append(find(text.as_py() or ""))
                size += sum(map(len, found[-1]))
                if size < _SENT_BYTES and k < batch.num_rows:
                    continue
                out = {"doc_id": batch.column("doc_id").slice(sent, k - sent), "ids": pa.array([ids for ids, _ in found], pa.binary())}
                if decoded:
                    out["decoded"] = pa.array([text for _, text in found], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(out)
                found, size, sent = [], 0, k

    return encode


def _digested(description, code):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(description.value, code.value)
        for batch in batches:
            counts, ids_sha, decoded_sha = [], [], []
            for text in batch.column("text"):
                ids, decoded = model.both(text.as_py() or "")
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                decoded_sha.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(decoded_sha, pa.string()),
            })

    return digest


def encode(docs: DataFrame, path: str, size: int = LEXICON_WORDS, decoded: bool = True) -> DataFrame:
    """``(doc_id, ids, decoded)``: token ids as little-endian unsigned 32-bit integers, and the text they decode to.

    One row for each row of ``docs (doc_id, text)``; null and empty texts have no ids. Strings of added tokens in
    a text become those tokens. ``path`` is the description of the tokenizer, which only the driver reads. Other
    columns are ignored.
    """
    schema = "doc_id long, ids binary" + ", decoded string" * decoded
    return _over(docs, path, size, lambda *sent: _encoded(*sent, decoded), schema)


def token_digests(docs: DataFrame, path: str, size: int = LEXICON_WORDS) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of encode(), made in the same task as the ids."""
    return _over(docs, path, size, _digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _over(docs: DataFrame, path: str, size: int, work, schema: str) -> DataFrame:
    context = docs.sparkSession.sparkContext
    description = read_file(path)
    code = build_lexicon(docs, description, size)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        work(context.broadcast(description), context.broadcast(code)), schema
    )
