"""Phrases, the quality model and the divergence of sources against plain versions, on the rows of the other operators."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from coterie.llm import divergence, phrases, quality_model

SCHEMA = "doc_id long, text string, lang string, source string, phrase string, held long, block string, value int, rank int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _corpus():
    rng = random.Random(11)
    vocabulary = [w + e for w in ("ab", "Ce", "é", "ß9", "x\x00y", "İ") for e in ("", "n", "S", "-")]
    word = lambda: rng.choices(vocabulary, range(len(vocabulary), 0, -1))[0]
    texts = [None, "", " \t\n", "...", "one", "in fact. In\tfact, in  fact\x0bin fact; fact in", "New York City " * 30, "new york\nnew york " * 9]
    texts += [" ".join(word() + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(rng.randint(1, 150))) for _ in range(50)]
    langs, sources = ["en", "de", None, "", "und"], ["a", "b", None, "", "é", "c"]
    rows = [(k, t, langs[k % 5], sources[k % 6]) for k, t in enumerate(texts)]
    return rows + [(None, None, "lone", "only"), (None, "in fact " * 6, None, None), rows[-1], rows[-1], (7, "x", "two", "p"), (8, "y", "two", "q")]


@pytest.fixture(scope="module")
def rows():
    return _corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "b", 2, 3) for r in rows], SCHEMA).repartition(3).persist()


def _phrases(rows, longest, least, top):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, held in counts.items():
        found = {w: a for w, a in held.items() if len(w) > 1 and a >= least}
        scored = []
        for w, a in found.items():
            within = lambda v: any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
            if any(len(v) > len(w) and within(v) and 100 * b >= 50 * a for v, b in found.items()):
                continue
            cuts = [(10**6 * a * a // (held[w[:k]] * held[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(w).encode(), held[w[:k]], held[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("longest, least, top", [(3, 10, 2000), (5, 3, 7), (2, 1, 1000)])
def test_phrases(docs, rows, monkeypatch, longest, least, top):
    monkeypatch.setattr(phrases, "BLOCK_TOKENS", 60)
    monkeypatch.setattr(phrases, "_CHUNK", 40)
    found = phrases.collocations(docs, longest, least, top)
    expected = _phrases(rows, longest, least, top)
    assert sorted(map(tuple, found.collect())) == expected and expected


def test_grams_of_a_block_come_in_short_rows(monkeypatch):
    """However many grams a block has, no row holds more than one of them and no batch more than ``_SENT``."""
    monkeypatch.setattr(phrases, "_SENT", 5)
    codes = np.array([0, 1, 2, 3, 0, 1, 2, 0, 1, 0, 0, 3, 2, 1, 2, 3, 4], np.int32)
    places = np.delete(np.arange(18, dtype=np.int32), 9)
    relation = pa.table({"block": [7], "places": [phrases.squeeze(places)], "codes": [phrases.squeeze(codes)]})
    frequent = pa.table({"block": [7] * 4, "code": pa.array(range(4), pa.int32()), "id": [10, 11, 12, 13]})
    made = phrases._extend((), relation, frequent)
    assert not any(pa.types.is_nested(field.type) for field in made.schema)
    assert max(b.num_rows for b in made.to_batches()) <= 5
    head, *grams = made.to_pylist()
    at = [k for k in range(16) if places[k + 1] == places[k] + 1 and codes[k] < 4 and codes[k + 1] < 4]
    pairs = Counter((10 + int(codes[k]), 10 + int(codes[k + 1])) for k in at)
    assert {(g["firsts"], g["seconds"]): g["counts"] for g in grams} == dict(pairs) and len(grams) == len(pairs) > 5
    assert phrases.expand(head["places"], np.int32).tolist() == [int(places[k]) for k in at]
    of = {256 * g["high"] + g["low"]: (g["firsts"], g["seconds"]) for g in grams}
    assert [of[c] for c in phrases.expand(head["codes"], np.int32).tolist()] == [(10 + int(codes[k]), 10 + int(codes[k + 1])) for k in at]


def test_phrases_in_slices(docs, rows, limits):
    with limits(rowsPerTask=2, broadcastRows=0, hotKeys=4):
        assert sorted(map(tuple, phrases.collocations(docs, 3, 4, 5).collect())) == _phrases(rows, 3, 4, 5)


def test_phrase_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 3 * 10**13, 7 * 10**14 + 1, 5 * 10**13 + 3
    df = spark.createDataFrame([(a, [left, left], [right, right])], "a long, prefixes array<long>, suffixes array<long>")
    best = df.select(phrases._shortest_cut().alias("best")).select(F.col("best.*")).first()
    assert tuple(best) == (10**6 * a * a // (left * right), 1, left, right)


def _divergence(rows, least, top):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    groups, counts, whole, docs = set(), defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source, found = lang or "", source or "", terms(text)
        groups.add((lang, source))
        counts[lang, source].update(found)
        whole[lang].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, d in docs[lang].items() if d >= least]
        share = lambda c: [1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept]
        p, every = share(counts[lang, source]), share(whole[lang])
        pairs = []
        for other in (s for g, s in groups if g == lang and s != source):
            pairs.append((-sum((x - y) ** 2 // y for x, y in zip(p, share(counts[lang, other]))), other))
        best = [(-((x - y) ** 2 // y), t) for t, x, y in zip(kept, p, every) if counts[lang, source][t] and x > y]
        for part, ranked in (("pair", sorted(pairs)), ("term", sorted(best)[:top])):
            out += [(lang, source, part, item, -value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("least, top, small", [(3, 200, False), (1, 4, True), (2, 3, True)])
def test_divergence(docs, rows, monkeypatch, limits, least, top, small):
    if small:
        monkeypatch.setattr(divergence, "CHUNK_TERMS", 5)
        monkeypatch.setattr(divergence, "SOURCE_BLOCK", 2)
        monkeypatch.setattr(divergence, "MERGE_ROWS", 6)
        monkeypatch.setattr(divergence, "_HELD", 10)
        monkeypatch.setattr(divergence, "_PIECE", 30)
    with limits(**({"rowsPerTask": 3, "broadcastRows": 0, "hotKeys": 4} if small else {})):
        found = sorted(map(tuple, divergence.divergence(docs, least, top).collect()))
    assert found == _divergence(rows, least, top)


def test_shares_are_exact():
    counts, total, kept = np.array([0, 10**13, 2 * 10**13]), 2 * 10**13, 10**9 + 7
    expected = [1 + 10**9 * (int(c) + 1) // (total + kept) for c in counts]
    assert divergence.shares(counts, total, kept).tolist() == expected


def test_skyband_keeps_what_fewer_than_k_dominate():
    rng = np.random.default_rng(3)
    for n, k in ((0, 2), (1, 1), (700, 1), (1500, 5)):
        held, total, name = rng.integers(1, 30, n), rng.integers(1, 30, n), rng.permutation(n)
        over = (held[:, None] >= held) & (total[:, None] <= total) & (name[:, None] < name)
        assert sorted(divergence.skyband(held, total, name, k)) == np.flatnonzero(over.sum(0) < k).tolist()


def test_empty_tables(spark, docs):
    empty = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert phrases.collocations(empty).collect() == divergence.divergence(empty).collect() == []
    assert quality_model.quality_scores(empty, labels).collect() == []
    assert {r.score for r in quality_model.quality_scores(docs, labels).collect()} == {0.5}


def test_passages_are_of_the_whole_text():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    text = " ".join(words).encode()
    rows = quality_model.passages(text)
    assert rows.shape == (-(-400 // quality_model.PASSAGE), quality_model.WIDTH)
    assert len(quality_model.passages(b" \n")) == 1 and b"".join(quality_model.pieces(text * 2000)) == text * 2000
    # The last passage holds the last words only, so it changes with them and the others do not.
    other = quality_model.passages(" ".join([*words[:-1], "zzz!!!"]).encode())
    assert (rows[:-1] == other[:-1]).all() and (rows[-1] != other[-1]).any()


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    bags = [rng.random((n, quality_model.WIDTH)).astype(np.float32) for n in (1, 3, 5, 2)]
    labels = np.array([0, 1, 1, 0])
    model = quality_model.fit(bags[:2], labels[:2])
    model.weights = {k: v.astype(np.float64) + 0.01 * rng.standard_normal(v.shape) for k, v in model.weights.items()}

    def loss():
        total = 0.0
        for bag, label in zip(bags, labels):
            hidden, logit = model.encode(bag.astype(np.float64))
            weight = np.exp(logit - logit.max())
            p = quality_model._sigmoid(weight @ hidden / weight.sum() @ model.weights["c"] + model.weights["d"][0])
            total -= np.log(p if label else 1 - p) / len(bags)
        return total

    grads = quality_model._gradients(model, bags, labels)
    for name, value in model.weights.items():
        at = tuple(0 for _ in value.shape)
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        assert grads[name][at] == pytest.approx((up - loss()) / 2e-5, rel=1e-2, abs=1e-6)
        value[at] += 1e-5


def test_one_bad_passage_in_a_long_text_counts(spark):
    """Labels are of documents only; a few noisy passages among plain ones have to be found by attention."""
    rng = random.Random(2)
    plain = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))
    noise = lambda n: " ".join(rng.choice(["$$$", "###x", "|", "%%9"]) for _ in range(n))
    made = []
    for k in range(400):
        text = plain(rng.randint(20, 400))
        made.append((k, text if k % 3 else f"{text} {noise(80)} {plain(100)}", int(k % 3 > 0)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in made] + [(None, None), (None, plain(3000) + "\n" + noise(90))], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in made] + [(0, 1), (9999, 0), (None, 1), (3, None)], "doc_id long, quality int")
    found = quality_model.quality_scores(docs, labels).collect()
    want = {k: y for k, _, y in made}
    held = [r for r in found if r.held_out]
    assert len(found) == 402 and {r.held_out for r in found} == {True, False}
    assert sum(r.predicted == want[r.doc_id] for r in held) > 0.97 * len(held) > 50
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    # A text scores the same piece by piece, and copies score alike.
    again = quality_model.quality_scores(docs.unionByName(docs).repartition(2), labels).collect()
    assert {(r.doc_id, round(r.score, 6)) for r in again} == {(r.doc_id, round(r.score, 6)) for r in found}


def test_no_label_of_a_held_out_row_is_learned_from(spark):
    docs = spark.createDataFrame([(k, f"text {k} " * 20) for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int")
    turned = spark.createDataFrame([(k, 1 - k % 2 if quality_model.held_out(k) else k % 2) for k in range(200)], "doc_id long, quality int")
    one, other = (quality_model.quality_scores(docs, x).collect() for x in (labels, turned))
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))
    keys = quality_model.labelled_sample(docs, labels, 10)
    assert keys.count() == 10
