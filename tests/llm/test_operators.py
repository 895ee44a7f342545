"""Every operator against a plain version, on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import pytest
import xxhash

from coterie.llm import blocks, exchange, levels, line_dedup, mixing, pii, quality, scoring, simhash, substring_dedup, suffix_dedup
from coterie.llm.bpe import WordBpe, encode, read_file, token_digests
from coterie.llm.exact_dedup import exact_dedup, golomb_decode, golomb_encode
from coterie.llm.lexicon import Transducer, compile_words
from coterie.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, source string, kept string, fp int, block string, w int, size double, row int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def _corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6)))
    line = lambda n: " ".join(word() for _ in range(n))
    shared, long = line(60), "\n".join(line(40) for _ in range(300))
    near = line(80).split()
    texts = [None, "", " \t\n", "a", "a b", "A  B", shared, shared, " " + shared + "\n", line(30) + " " + shared + " " + line(30)]
    texts += [shared + "\n" + shared, long, long[:9000] + line(10), "x" * 3000, "x" * 500, "spam " * 60, "é" * 250]
    texts += [" ".join(near[:i] + [word()] + near[i + 1 :]) for i in range(6)] + [line(rng.randint(1, 120)) for _ in range(25)]
    sources = ["b", "a", None, "c", "é", "big", "big", "big"]
    rows = [(k, t, sources[k % 8]) for k, t in enumerate(texts)]
    return rows + [(None, shared, "a"), (None, None, None), rows[7], rows[12]]


@pytest.fixture(scope="module")
def rows():
    return _corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "no", 1, "x", 2, 3.0, 4) for r in rows], SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_empty_tables_give_empty_results(empty):
    operators = (
        line_dedup.line_dedup, suffix_dedup.suffix_dedup, scoring.score, pii.personal_data, quality.quality,
        substring_dedup.substring_dedup, exact_dedup, mixing.mix, simhash.simhash_dedup,
        lambda d: token_digests(d, tokenizer_path()),
    )
    for operator in operators:
        assert operator(empty).collect() == []


def test_line_dedup(docs, rows):
    sets, firsts, expected = {}, [], []
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        n = gone = links = 0
        for line in (text or "").split("\n"):
            s = frozenset(WORD.findall(line))
            if not s:
                continue
            n += 1
            if s not in sets:
                sets[s] = (len(firsts), sum(10 * len(s & o) >= 8 * len(s | o) for o in firsts))
                firsts.append(s)
                gone += sets[s][1] > 0
            else:
                gone += 1
            links += sets[s][1]
        expected.append((doc, n, gone, links))
    # Rows with the same id may come in either order.
    found = _rows(line_dedup.line_dedup(docs), "doc_id", "n_lines", "n_removed", "n_links")
    assert Counter(r[:2] for r in found) == Counter(r[:2] for r in expected)
    assert [sum(r[k] or 0 for r in found) for k in (1, 2, 3)] == [sum(r[k] for r in expected) for k in (1, 2, 3)]
    assert [r for r in found if r[0] not in (None, 7, 12)] == sorted((r for r in expected if r[0] not in (None, 7, 12)), key=str)


def test_removed_lines_and_kept_texts(docs, rows):
    def digest(pos, line):
        of_line = xxhash.xxh64_intdigest(line.encode(), seed=42)
        return xxhash.xxh64_intdigest(struct.pack("<Q", of_line), seed=xxhash.xxh64_intdigest(struct.pack("<i", pos), seed=42))

    firsts, gone, texts, digests, links = {}, [], [], [], []
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        kept, of_row = [], 0
        for pos, line in enumerate((text or "").split("\n")):
            s = frozenset(WORD.findall(line))
            if not s:
                kept.append(line)
                continue
            if s in firsts:
                own, similar = firsts[s]
                gone.append((doc, pos, own, *(similar[0] if similar else own), len(similar)))
            else:
                similar = [p for o, (p, _) in firsts.items() if 10 * len(s & o) >= 8 * len(s | o)]
                firsts[s] = ((doc, pos), similar)
                links += [(doc, pos, *p) for p in similar]
                if similar:
                    gone.append((doc, pos, (doc, pos), *similar[0], len(similar)))
                else:
                    kept.append(line)
                    of_row ^= digest(pos, line)
        texts.append((doc, None if text is None else "\n".join(kept)))
        digests.append((doc, of_row - (1 << 64) if of_row >> 63 else of_row))
    assert links and any(g[5] for g in gone)

    pairs = line_dedup.line_links(docs).collect()
    assert sorted((r.doc_id, r.pos, r.match_doc, r.match_pos) for r in pairs) == sorted(links)
    lines = line_dedup.removed_lines(docs).collect()
    flat = [(d, p, *match, n) for d, p, _, *match, n in gone]
    assert sorted(((r.doc_id, r.pos, r.match_doc, r.match_pos, r.n_links) for r in lines), key=str) == sorted(flat, key=str)
    # One class id for each set of words.
    named = {(r.doc_id, r.pos): r.class_id for r in pairs} | {(r.match_doc, r.match_pos): r.match_id for r in pairs}
    named |= {(r.match_doc, r.match_pos): r.match_id for r in lines}
    assert len(set(named.values())) == len(named)
    own = Counter((d, p, named[c]) for d, p, c, *_ in gone)
    assert Counter((r.doc_id, r.pos, r.class_id) for r in lines) == own
    assert _rows(line_dedup.without_removed_lines(docs), "doc_id", "text") == sorted(texts, key=str)

    found = line_dedup.line_dedup(docs).collect()
    assert sorted(((r.doc_id, r.kept_digest) for r in found), key=str) == sorted(digests, key=str)
    empty = lambda x: "" if x is None else x
    told = Counter((empty(r.doc_id), *part.split(":")) for r in found for part in r.removed.split(",") if part)
    assert told == Counter(
        (empty(r.doc_id), str(r.pos), str(r.class_id), str(r.match_id), str(empty(r.match_doc)), str(r.match_pos)) for r in lines
    )


def test_suffix_dedup(docs, rows):
    texts = [(d, (t or "").encode()) for d, t, _ in rows]
    starts = Counter(t[p : p + 200] for _, t in texts for p in range(len(t) - 199))
    expected = []
    for doc, text in texts:
        mask = bytearray(len(text))
        for p in range(len(text) - 199):
            if starts[text[p : p + 200]] > 1:
                mask[p : p + 200] = b"\1" * 200
        kept = bytes(b for b, m in zip(text, mask) if not m)
        expected.append((doc, len(text), sum(mask), len(re.findall(b"\1+", bytes(mask))), _sha(kept)))
    found = _rows(suffix_dedup.suffix_dedup(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == sorted(expected, key=str)
    assert sum(r.end - r.start for r in suffix_dedup.repeated_spans(docs).collect()) == sum(r[2] for r in expected)


def test_substring_dedup(docs, rows):
    seen, expected = set(), []
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for p in range(len(words) - 19):
            window = tuple(words[p : p + 20])
            if window in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        expected.append((doc, len(words), sum(gone), _sha(kept)))
    assert _rows(substring_dedup.substring_dedup(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(expected, key=str)


def _plain_removed(texts, window):
    """Per text, the words that lie in windows that start earlier."""
    seen, out = set(), []
    for text in texts:
        words = text.split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in seen:
                gone[p : p + window] = [True] * window
            seen.add(key)
        out.append(" ".join(w for w, g in zip(words, gone) if not g))
    return out


@pytest.mark.parametrize("window", [2, 3, 8, 9, 17, 80])
def test_windows_of_any_length(spark, window):
    """Few different words, so that many windows survive the short lengths and fail at a longer one."""
    rng = random.Random(window)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 200))) for _ in range(12)]
    passage = " ".join(rng.choice("abc") for _ in range(90))
    texts += [passage[:170], "x " + passage + " y", passage, passage + " " + passage]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.text for r in substring_dedup.without_repeats(df, window).collect()}
    assert [found[k] for k in range(len(texts))] == _plain_removed(texts, window)


def test_lengths_double():
    assert levels.lengths_to(20) == [5, 10, 20]
    assert levels.lengths_to(80) == [5, 10, 20, 40, 80]
    assert levels.lengths_to(17) == [5, 9, 17] and levels.lengths_to(8) == [8]


@pytest.mark.parametrize("repeated, steps_run", [(0, 1), (7, 1), (12, 2), (25, 3), (50, 4), (100, 4)])
def test_levels_end_when_no_candidates_survive(spark, monkeypatch, repeated, steps_run):
    """Each level is looked up only where the one before left two halves that are found twice."""
    rounds, steps = [], levels._ask_next
    monkeypatch.setattr(levels, "_ask_next", lambda level, how: rounds.append(level) or steps(level, how))
    common = [f"c{k}" for k in range(repeated)]
    rows = [(d, " ".join([f"a{d}_{k}" for k in range(90)] + common + [f"b{d}_{k}" for k in range(90)])) for d in (1, 2)]
    found = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 80).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (2, repeated if repeated >= 80 else 0)]
    # The step that finds no candidates is the last one.
    assert rounds == list(range(1, steps_run + 1))


def test_later_windows_of_long_texts(spark):
    """Texts of more words than a piece: windows at its ends, and a first one in another piece of the same text."""
    rng = random.Random(4)
    words = [str(rng.randrange(10**5)) for _ in range(2_200_000)]
    end = levels.PIECE
    words[2_199_000:2_199_500] = words[end - 200 : end + 300]
    copy = ["z"] * 5 + words[end - 20 : end + 10] + ["y"] * 5
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(copy))], "doc_id long, text string")
    found = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(df).collect()}
    assert found == {1: 500, 2: 30}


def test_packed_keys():
    import numpy as np

    rng = np.random.default_rng(5)
    for n, top in ((1, 1), (1, 1 << 26), (5000, 1 << 26), (5000, 1 << 13)):
        keys = np.unique(rng.integers(0, top, n).astype(np.uint64))
        assert levels._unpack(levels._pack(keys)).tolist() == keys.tolist()


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    rng = random.Random(3)
    text = bytes(rng.choice(b"abcd ") for _ in range(300_000)).decode()
    df = spark.createDataFrame([(1, text), (2, text[100_000:290_000])], "doc_id long, text string")
    found = {r.doc_id: r for r in suffix_dedup.suffix_dedup(df).collect()}
    assert (found[1].n_removed, found[1].n_spans) == (190_000, 1)
    assert found[2].n_removed == 190_000 and found[2].kept_sha256 == _sha("")


def test_blocks_hold_every_row(spark, docs, rows):
    from coterie.plans.scratch import Scratch

    with Scratch(spark) as scratch:
        saved = blocks.packed(docs, scratch, block_bytes=4000)
        got = []
        for r in saved.df.collect():
            ids, texts = blocks.unpacked(bytes(r.data))
            got += zip(ids.to_pylist(), texts)
        assert saved.rows > 3 and sorted(got, key=str) == sorted(((d, (t or "").encode()) for d, t, _ in rows), key=str)


def test_bpe_is_the_library(docs, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    texts = ["it's <|endoftext|> ΑΣ Σ 12", "İstanbul ǅ é", "\x1c\x85 a_b--c", "ჰელო 𝒜ß ½²", "x" * 400, "'re'LL I'm", "<|start <|startoftext|><|endoftext|>"]
    model = WordBpe(read_file(tokenizer_path()))
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(model.encode(text)) == ids and model.decode(model.encode(text)) == library.decode(ids, skip_special_tokens=False)
    expected = []
    for doc, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), _sha(struct.pack(f"<{len(ids)}I", *ids)), _sha(back)))
    found = token_digests(docs, tokenizer_path(), size=50)
    assert _rows(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=str)
    assert {len(r.ids) // 4 for r in encode(docs, tokenizer_path(), size=50).collect()} == {r[1] for r in expected}


def test_bpe_holds_few_words_and_sends_small_batches(monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa

    from coterie.llm import bpe

    monkeypatch.setattr(bpe, "HELD_WORDS", 20)
    monkeypatch.setattr(bpe, "_SENT_BYTES", 400, raising=False)
    description = read_file(tokenizer_path())
    texts = [" ".join(f"often w{k}x{i}" for i in range(12)) for k in range(50)] + [None, ""]
    whole, model = WordBpe(description), WordBpe(description)
    monkeypatch.setattr(bpe, "_model", lambda *_: model)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    for decoded in (False, True):
        sent = list(bpe._encoded(SimpleNamespace(value=description), SimpleNamespace(value=b""), decoded)(iter([batch])))
        rows = [r for b in sent for r in b.to_pylist()]
        assert [r["doc_id"] for r in rows] == batch["doc_id"].to_pylist()
        assert [r["ids"] for r in rows] == [whole.both(t or "")[0] for t in texts]
        assert not decoded or [r["decoded"].encode() for r in rows] == [whole.both(t or "")[1] for t in texts]
        # No batch passes the limit by more than its last text.
        assert len(sent) > 5 and all(sum(len(r["ids"]) for r in b.to_pylist()[:-1]) < 400 for b in sent)
    for held, most in ((model._ids_held, 20), (model._both_held, 40)):
        assert "often" in held.new or "often" in held.old
        assert len(held.new) + len(held.old) <= most


def test_common_characters_agree_with_the_tokenizer():
    from coterie.llm.bpe import _COMMON

    model = WordBpe(read_file(tokenizer_path()))
    for code in range(0x2100):
        if _COMMON.fullmatch(chr(code)):
            text = f"a{chr(code)}B{chr(code)}1"
            line = model._normalizer.normalize_str(text)
            assert model.words(text) == [line[i:j] for _, (i, j) in model._splitter.pre_tokenize_str(line)], code


def test_transducer_shares_suffixes():
    entries = {b"nation": [1, 2], b"station": [3], b"ration": [4, 5, 6], b"rat": [7], "é".encode(): [8]}
    code = compile_words(sorted(entries.items()))
    found = Transducer(code)
    assert all(list(found.get(w)) == ids for w, ids in entries.items())
    assert [found.get(w) for w in (b"", b"na", b"rations", b"x")] == [None] * 4
    assert struct.unpack_from("<q", code)[0] < sum(map(len, entries))
    assert Transducer(compile_words([])).get(b"a") is None


def test_scores_and_held_out_gain(docs, rows):
    tokens = [(d, [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]) for d, t, _ in rows]
    out = [zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1 for d, _ in tokens]
    words, pairs = Counter(), Counter()
    for (_, t), held in zip(tokens, out):
        if not held:
            words.update(t)
            pairs.update(zip(["^", *t[:-1]], t))
    n, v = sum(words.values()), len(words)
    single = lambda w: (words[w] + 0.5) / (n + 0.5 * (v + 1))
    expected = []
    for (d, t), held in zip(tokens, out):
        score = 0.0
        for h, w in zip(["^", *t[:-1]], t):
            seen = words[None] if h == "^" else words[h]
            score += math.log10((pairs[h, w] + scoring.STRENGTH * single(w)) / (seen + scoring.STRENGTH))
        base = sum(math.log10(single(w)) for w in t)
        expected.append((d, held, len(t), sum(words[w] > 0 for w in t), n, round(base, 6), round(score, 6)))
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in scoring.score(docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_totals_beyond_32_bits():
    import numpy as np
    import pyarrow as pa

    keys = np.array([3, 1 << 63], np.uint64)
    asked = [exchange.request(block, keys, np.array([3_000_000_000, 1]), None, 1) for block in (0, 1)]
    answers = exchange._answer(pa.Table.from_batches([exchange.request_batch(asked)]))
    for block, first in ((0, True), (1, False)):
        own = answers.filter(pa.compute.equal(answers["block"], block))
        totals, firsts = exchange.totals_of(keys, own, 1)
        assert totals.tolist() == [6_000_000_000, 2] and firsts.tolist() == [first] * 2
    sums = [b.to_pylist() for b in scoring._sums(answers.to_batches())]
    assert sum(r["n"] for rows in sums for r in rows) == 6_000_000_002


def test_probabilities_sum_to_one():
    import numpy as np

    counts = np.array([5, 3, 0, 2])
    arcs, arc_counts = np.array([0, 5, 7, 9]), np.array([2, 3, 2, 3])
    automaton = scoring.Automaton(4, int(counts.sum()), 3, 7.0).build(counts, arcs, arc_counts, 2)
    unknown = 0.5 / automaton.whole
    for state, word in ((0, None), (1, 0), (2, 1)):
        steps = [automaton.traverse(np.array([w] if word is None else [word, w]), np.array([0]))[-1] for w in (0, 1, 3)]
        assert abs(sum(10**s for s in steps) + unknown * 10 ** automaton.fail[state] - 1) < 1e-12


@pytest.mark.parametrize("text, spans", [
    ("mail a.b@c-d.org, 10.0.0.256 10.0.0.25", "email:5:16,ip:29:38"),
    ("a@b.c.d%x@e.f", "email:0:7,email:7:13"),
    ("card 4111 1111 1111 1111 and +49 (30) 901820-00", "card:5:24,phone:29:47"),
    ("john [at] mail [dot] org", "email:0:24"),
    ("see john at mail dot org now", "email:4:24"),
    ("jоhn@mаil.org", "email:0:13"),
    ("１０．０．０．１", "ip:0:8"),
    ("plus four nine three zero nine zero one eight two zero", "phone:0:54"),
    ("we met at noon, one two three and dot", ""),
    ("x" * 5000 + "@", ""), ("1" * 5000 + ".", ""), ("", ""),
    ("john [at] mail dot org", "email:0:22"),
    ("john at mail [dot] org", "email:0:22"),
    ("to john@mail dot org", "email:3:20"),
    ("john @ mail (dot) co dot uk", "email:0:27"),
    ("john dot smith at mail dot org", "email:0:30"),
    ("look at mail.org, a dot and john@mail.org", "email:28:41"),
    ("10 dot 0 dot 0 dot 1", "ip:0:20"),
    ("10.0 dot 0 [dot] 1", "ip:0:18"),
    ("one nine two dot one six eight dot one dot one", "ip:0:46"),
    ("10.zero.zero.one", "ip:0:16"),
    ("+49 three zero 901820", "phone:0:21"),
    ("plus four nine (three zero) 901820", "phone:0:34"),
    ("four 111 1111 1111 1111", "card:0:23"),
    ("one dot at two points, plus one", ""),
])
def test_personal_data_spans(text, spans):
    assert pii.as_text(pii.find(text)[1]) == spans


def test_plain_spans_stay_as_the_patterns_say(docs, rows):
    rng = random.Random(5)
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for _ in range(3000):
        text = "".join(rng.choice("a1.@+ -2(0") for _ in range(rng.randint(0, 40)))
        spans = []
        for k, (kind, pattern) in enumerate(patterns.items()):
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m[0])
                good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                        "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
                if good:
                    spans.append((m.start(), k, m.end()))
        assert pii.plain_spans(text) == [(i, j, k) for i, k, j in sorted(spans)], text
    assert pii.personal_data(docs).count() == len(rows)


def test_quality(docs, rows):
    expected = []
    for doc, text, _ in rows:
        words = WORD.findall(text or "")
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        held, covered = Counter(windows), set()
        for i, w in enumerate(windows):
            if held[w] > 1:
                covered.update(range(i, i + 5))
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        expected.append((doc, len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(covered), failed))
    found = quality.quality(docs)
    assert _rows(found, "doc_id", "n_words", "word_chars", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(expected, key=str)
    assert not [r for r in found.collect() if r.kept and r.base_failed]


def test_hosts_with_few_documents_are_drawn_to_the_mean(spark):
    data = [("good", False)] * 200 + [("bad", True)] * 190 + [("bad", False)] * 10 + [("new", True)]
    found = {r.host: r for r in quality.host_verdicts(spark.createDataFrame(data, "host string, failed boolean")).collect()}
    assert found["bad"].bad and not found["good"].bad and 0.5 < found["new"].shrunk_rate < 1


def test_exact_dedup(docs, rows):
    groups = {}
    for doc, text, _ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc))
    found = exact_dedup(docs).collect()
    for bare, members in groups.items():
        own = [r for r in found if r.text_sha256 == _sha(bare)]
        assert len(own) == len(members) and {r.group_size for r in own} == {len(members)}
        assert {r.keep_id for r in own} == {min(members, key=lambda m: (m[:2], m[2] or 0))[2]}
        assert sum(r.kept for r in own) == 1
    assert len(found) == len(rows)


def test_golomb_round_trip():
    import numpy as np

    rng = np.random.default_rng(1)
    for values in ([], [5], [2**64 - 1], [0, 1, 2, 3], rng.integers(0, 2**63, 1000), [0, 2**64 - 1]):
        values = np.unique(np.array(values, np.uint64))
        assert golomb_decode(golomb_encode(values)).tolist() == values.tolist()


def test_mix(docs, rows):
    found = mixing.mix(docs).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=str)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
    target = {s: 2.0 * sizes[s] if s in full else share[s] for s in order}
    assert sorted({(r.source_size, round(r.target, 6)) for r in found}) == sorted({(sizes[s], round(target[s], 6)) for s in order})
    assert all(r.taken <= 2 * r["size"] for r in found) and len(found) == len(rows)


def test_mix_meets_its_targets_with_many_equal_rows(spark):
    rows = [(None, "one two three", "a")] * 600 + [(k, "four five", "a") for k in range(60)]
    head = "x" * 80
    rows += [(None, f"{head} {k:04}", "b") for k in range(600)] + [(None, "six", None)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for share in (0.4, 0.7, 1.3):
        found = mixing.mix(docs, share=share).collect()
        assert len(found) == len(rows)
        for target in {(r.source_size, r.target) for r in found}:
            taken = sum(r.taken for r in found if (r.source_size, r.target) == target)
            assert abs(taken - target[1]) <= 8, (share, target, taken)
        again = mixing.mix(docs.repartition(7), share=share).collect()
        assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)


def test_simhash(docs, rows, monkeypatch):
    prints = []
    for doc, text, _ in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append((doc, sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))))
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = {}
    for (doc, _), g in zip(prints, group):
        least[g] = min((x for x in (doc, least.get(g)) if x is not None), default=None)
    expected = sorted(((d, f"{p:016x}", least[g]) for (d, p), g in zip(prints, group)), key=str)
    assert _rows(simhash.simhash_dedup(docs), "doc_id", "fingerprint", "component_id") == expected
    monkeypatch.setattr(simhash, "FILE_ROWS", 2)
    assert _rows(simhash.simhash_dedup(docs), "doc_id", "fingerprint", "component_id") == expected


def test_bit_sliced_distances():
    import numpy as np

    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**63, 300).astype(np.uint64)
    values[100:] = values[:200] ^ (np.uint64(1) << rng.integers(0, 63, 200).astype(np.uint64))
    exact = {(i, j) for j in range(300) for i in range(j) if int(values[i] ^ values[j]).bit_count() <= 3}
    assert set(zip(*(x.tolist() for x in simhash._links_of_large(values)))) == exact
    for radius in (1, 2, 3, 5):
        hits = simhash._lanes(simhash.within_radius(simhash._planes(values), radius), 300)
        assert hits.tolist() == [k for k, v in enumerate(values) if int(v).bit_count() <= radius]


def _built_words(length):
    """Two words that differ in every letter and that sums of powers of an odd base modulo 2^64 take for one."""
    bits = [bin(k).count("1") % 2 for k in range(length)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("length", [1024, 2048, 4096])
def test_built_words_are_told_apart(spark, length):
    one, other = _built_words(length)
    common = " ".join(f"w{k}" for k in range(19))
    rows = [(1, f"{common} {one}"), (2, f"{common} {other}"), (3, f"{common} {one}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_removed for r in sorted(substring_dedup.substring_dedup(docs).collect())] == [0, 0, 20]
    ids = [k for k in range(99) if not scoring.held_out(k)][:1] + [k for k in range(99) if scoring.held_out(k)][:2]
    docs = spark.createDataFrame(list(zip(ids, (one, other, one))), "doc_id long, text string")
    assert {r.doc_id: r.n_known for r in scoring.score(docs).collect()} == {ids[0]: 2, ids[1]: 1, ids[2]: 2}


def test_exact_dedup_of_the_smallest_id(spark):
    low = -(1 << 63)
    docs = spark.createDataFrame([(5, "a b"), (low, "ab "), (None, "a b"), (low, "x")], "doc_id long, text string")
    found = _rows(exact_dedup(docs), "doc_id", "keep_id", "kept")
    assert sorted(found, key=str) == sorted([(5, low, False), (low, low, True), (None, low, False), (low, low, True)], key=str)


def test_symbols_and_verdicts_of_hosts(spark):
    """Counts of symbols, and ``kept`` against a plain version of the shrunk rates."""
    rng = random.Random(4)
    plain = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(3, 8))) for _ in range(n))
    rows = []
    for host, share, n in (("bad", 0.9, 30), ("good", 0.1, 30), (None, 0.8, 10), ("tiny", 1.0, 1), ("clean", 0.0, 25)):
        for k in range(n):
            noisy = k < share * n
            noise = "".join(" " + "".join(rng.choices("#*$%&|<>", k=4)) for _ in range(12))
            rows.append((len(rows), plain(30) + (noise if noisy else "") if k else "short #", host))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    soft, hosts = {}, {}
    for doc, text, host in rows:
        words = WORD.findall(text)
        symbols = sum(c in "#*$%&|<>" for c in text)
        soft[doc] = (len(words) < 10, symbols * 10 > len(words), symbols)
        hosts.setdefault(host, []).append(any(soft[doc][:2]))
    n, k = sum(map(len, hosts.values())), sum(map(sum, hosts.values()))
    mean = k / n
    squares, sizes = sum(sum(h) ** 2 / len(h) for h in hosts.values()), sum(len(h) ** 2 for h in hosts.values())
    between = squares - n * mean * mean - (len(hosts) - 1) * mean * (1 - mean)
    spread = max(between / max(n - sizes / n, 1e-9), 1e-9)
    strength = max(1.0, min(1e6, mean * (1 - mean) / spread - 1))
    bad = {host for host, h in hosts.items() if (sum(h) + mean * strength) / (len(h) + strength) > 0.5}
    assert "bad" in bad and "good" not in bad
    expected = {doc: (soft[doc][2], not (soft[doc][0] or (soft[doc][1] and host in bad))) for doc, _, host in rows}
    assert {r.doc_id: (r.n_symbols, r.kept) for r in quality.quality(docs).collect()} == expected
