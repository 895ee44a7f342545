"""The pipeline's stages on small rows: decisions take effect and columns stay."""

import corpus_pipeline


def test_stages(spark):
    text = " ".join(f"word{k}" for k in range(60))
    other = " ".join(f"term{k}" for k in range(60))
    rows = [
        (0, text, "en", "a", 1, "x"), (1, " " + text, "en", "a", 1, "x"), (2, text, "en", "b", 1, "x"), (2, text, "en", "b", 1, "x"),
        (3, other, "en", "b", 1, "x"), (4, None, "en", "c", 1, "x"), (5, "short", None, None, None, "x"), (6, "same words " * 50, "en", "a", 1, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    kept = stages[names[0]](spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 2, 3] and kept.columns == docs.columns
    kept = stages[names[1]](spark, kept, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    kept = stages[names[2]](spark, kept, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and kept.columns == docs.columns
    mixed = stages[names[3]](spark, kept, "")
    assert set(mixed.columns) == set(docs.columns) and {r.doc_id for r in mixed.collect()} <= {1, 3}
    ids = stages[names[4]](spark, mixed, "").collect()
    assert len(ids) == mixed.count() and all(len(r.ids) == 4 * r.n_tokens > 0 for r in ids)
    assert stages[names[0]](spark, docs.limit(0), "").collect() == []


def test_one_of_each_near_group_stays(spark):
    words = [f"w{k}" for k in range(400)]
    near = [" ".join(words[:-1] + [f"x{k}"]) for k in range(3)]
    docs = spark.createDataFrame([(k + 5, t) for k, t in enumerate(near)] + [(1, "other " * 3)], "doc_id long, text string")
    from coterie.llm.simhash import simhash_dedup

    groups = {r.component_id for r in simhash_dedup(docs).collect()}
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == groups


NAMES = "keep_doc string, keep_sha string, __sha string, __time string, __copies string, __doc string, row string, id string, `a.b` string"


def test_columns_of_any_name_stay(spark):
    text = " ".join(f"word{k}" for k in range(60))
    own = tuple("abcdefghi")
    rows = [(1, text, "s", *own), (2, text + " more", "s", *own), (None, text.upper() + " other", None, *own)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, {NAMES}")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        found = {tuple(r) for r in out.collect()}
        assert found and found <= set(rows)


def test_stages_on_empty_and_null_tables(spark):
    schema = "doc_id long, text string, source string"
    for rows in ([], [(None, None, None)] * 2 + [(1, "", "a")]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "").collect()
            if name == "quality rules" or not rows:
                assert out == []
            elif name in ("exact dedup", "SimHash near-dedup"):
                assert len(out) == 1
            elif name == "mixing sources":
                assert out == []
            else:
                assert [r.n_tokens for r in out] == [0, 0, 0]


def test_one_of_equal_rows_is_always_the_same(spark):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(1, text, "a", k) for k in range(6)]
    found = set()
    for parts in (1, 3):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(parts)
        found |= {tuple(r) for r in corpus_pipeline.exact_copies(spark, docs, "").collect()}
    assert len(found) == 1


def test_copies_stay_with_their_source(spark):
    text = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "b")], "doc_id long, text string, source string")
    from coterie.llm.mixing import mix

    expected = sorted((r.source for r in mix(docs, with_raw=True).collect() for _ in range(r.copies)))
    assert sorted(r.source for r in corpus_pipeline.mixed_sources(spark, docs, "").collect()) == expected
    assert set(expected) == {"a", "b"}


def test_the_whole_chain(spark, tmp_path):
    """run() gives what its stages give one after the other, and its ids are those of the tokenizer."""
    import struct

    from tokenizers import Tokenizer

    from coterie.llm.queries import tokenizer_path

    texts = [" ".join(f"word{k}{j}" for k in range(30)) for j in range(12)]
    rows = [(k, t, "en", "ab"[k % 2], len(t or "")) for k, t in enumerate(texts + texts[:4] + ["short", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    step = docs
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, str(tmp_path))
    found = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert found == sorted(map(tuple, step.collect())) and found
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for doc, n, ids in found:
        assert doc < 12 and list(struct.unpack(f"<{n}I", ids)) == tokenizer.encode(texts[doc], add_special_tokens=False).ids


def test_the_last_stage_decodes_too(spark, monkeypatch):
    """The stage takes its ids from the whole operator, which decodes what it encodes, for every row."""
    taken, encode = [], corpus_pipeline.encode

    def seen(*args, **kinds):
        taken.append(encode(*args, **kinds))
        return taken[-1]

    monkeypatch.setattr(corpus_pipeline, "encode", seen)
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "  Three ")], "doc_id long, text string")
    ids = {r.doc_id: bytes(r.ids) for r in corpus_pipeline.token_ids(spark, docs, "").collect()}
    (whole,) = taken
    assert whole.columns == ["doc_id", "ids", "decoded"]
    assert {r.doc_id: (bytes(r.ids), r.decoded) for r in whole.collect()} == {
        1: (ids[1], "one</w> two</w>"), 2: (b"", ""), 3: (ids[3], "three</w>")
    }
