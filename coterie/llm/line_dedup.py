"""Line deduplication by an exact set-similarity join, in built-in functions only.

A line is the set of its words. Words are put in one order from rare to frequent, so that two lines with a
Jaccard similarity of at least t share a word among the first ``n - ceil(t n) + 1`` of each. Pairs that do are
cut by length, by how much can still be shared behind the common word and by a bound on the words that only one has (the
parities of 128 classes of words), then verified on the whole sets. A word is its 64-bit hash: two words of a pair of lines are taken for one
with a probability of about n^2 / 2^65.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.limits import limit
from ..plans.scratch import Saved, Scratch, remove
from .text import whole

# Least similarity, in hundredths.
SIMILAR = 80
# Words are counted in this many hash buckets: a fixed number, so the counts of any corpus are one short array.
_BITS = 16


def _rarity(taken: Saved, scratch: Scratch) -> Column:
    """A literal array: what to XOR to a word's hash, by its top bits, to put the bucket's place from rare to frequent there."""
    buckets = 1 << _BITS
    bucket = F.shiftrightunsigned("w", 64 - _BITS).cast("int")
    counts = taken.df.select(F.explode("words").alias("w")).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    rows = {r["bucket"]: r["n"] for r in counts.collect()}  # 2^16 rows at most, whatever the corpus
    turned = [0] * buckets
    for place, held in enumerate(sorted(range(buckets), key=lambda k: (rows.get(k, 0), k))):
        top = ((place - (buckets >> 1)) & (buckets - 1)) ^ held
        turned[held] = (top - buckets if top >= buckets >> 1 else top) << (64 - _BITS)
    return F.split(F.lit(",".join(map(str, turned))), ",").cast("array<bigint>")


def _enough(shared: Column, n: Column, m: Column, similar: int) -> Column:
    """Whether that many shared words make sets of n and m words similar."""
    return shared * (100 + similar) >= similar * (n + m)


def _lines(docs: DataFrame, *carried: Column) -> DataFrame:
    # A row's number is drawn before its lines are made.
    rows = docs.select(*carried, whole().alias("t"))
    return rows.select(*rows.columns[:-1], F.posexplode(F.split("t", "\n")).alias("pos", "line"))


def _words(blank: Column) -> Column:
    """The distinct words of ``line`` as hashes; ``blank``: whether it may have white space other than a space."""
    # Splitting at a plain character is fast, so the pattern is for texts with other white space only.
    split = F.when(blank, F.split("line", "[\\x20\\x09-\\x0D]+")).otherwise(F.split("line", " "))
    # White space that is doubled or at an end leaves an empty word.
    return F.array_remove(F.array_distinct(F.transform(split, lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _candidates(firsts: Saved, similar: int) -> DataFrame:
    """``(set, other)`` with ``set < other``: pairs that share a prefix word and pass the filters."""
    # Both sides are one exchange, used twice.
    prefixes = firsts.df.select("set", "n", "odd", "upper", F.posexplode("prefix").alias("k", "word")).select(
        "word", "set", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("k")).alias("nk"), "odd", "upper"
    )
    a, b = prefixes.alias("a"), prefixes.alias("b")
    n, m = F.shiftright("a.nk", 32), F.shiftright("b.nk", 32)
    low = F.lit((1 << 32) - 1)
    # At the first word that a pair shares, all others it shares lie behind.
    behind = F.least(n - F.col("a.nk").bitwiseAND(low), m - F.col("b.nk").bitwiseAND(low))
    # Of each class of words whose numbers differ in parity, one is in one line only; there are 128, 64 with the upper bit.
    upper = F.col("a.upper").bitwiseXOR(F.col("b.upper"))
    lower = F.col("a.odd").bitwiseXOR(F.col("b.odd")).bitwiseXOR(upper)
    apart = F.bit_count(upper) + F.bit_count(lower)
    return (
        a.join(b, F.col("a.word") == F.col("b.word"))
        .where(
            (F.col("a.set") < F.col("b.set")) & (100 * F.least(n, m) >= similar * F.greatest(n, m))
            & _enough(behind, n, m, similar) & ((n + m - apart) * (100 + similar) >= 2 * similar * (n + m))
        )
        .select(F.col("a.set").alias("set"), F.col("b.set").alias("other")).distinct()
    )


def _pairs(docs: DataFrame, firsts: Saved, similar: int, scratch: Scratch) -> DataFrame:
    """``(set, place, match, match_place)``: each set with each earlier one that is similar on their whole words."""
    pairs = scratch.save(_candidates(firsts, similar))
    asked = scratch.save(pairs.df.select(F.explode(F.array("set", "other")).alias("set")).distinct())
    places = firsts.df.select("set", "lh", F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row", "pos").alias("place"))
    named = scratch.save(places.join(_checked(asked, scratch), "set"))
    # Only lines that are in a pair are taken apart again, which needs less room than to keep the words of all.
    found = _lines(docs).select(F.xxhash64("line").alias("lh"), "line").join(_checked(named, scratch), "lh")
    texts = found.groupBy("set").agg(F.first("line").alias("line"), F.first("place").alias("place"))
    sets = scratch.save(texts.select("set", "place", _words(F.lit(True)).alias("words")))
    both = pairs.df.join(sets.df, "set").join(
        sets.df.select(F.col("set").alias("other"), F.col("place").alias("place2"), F.col("words").alias("words2")), "other"
    )
    shared = F.size(F.array_intersect("words", "words2"))
    later = F.col("place") >= F.col("place2")
    return both.where(_enough(shared, F.size("words"), F.size("words2"), similar)).select(
        F.when(later, F.col("set")).otherwise(F.col("other")).alias("set"),
        F.greatest("place", "place2").alias("place"),
        F.when(later, F.col("other")).otherwise(F.col("set")).alias("match"),
        F.least("place", "place2").alias("match_place"),
    )


def _checked(table: Saved, scratch: Scratch) -> DataFrame:
    """The table, to be broadcast if it was counted to be small; its keys are unique, so no key is hot beyond."""
    return F.broadcast(table.df) if table.rows <= limit(scratch.spark, "broadcastRows") else table.df


def _sets(docs: DataFrame, similar: int, scratch: Scratch, row: Column | None = None) -> tuple[Saved, Saved]:
    """Every line with a word, and for each set of words its earliest line and whether there are others."""
    carried = [
        F.col("doc_id").cast("long").alias("doc_id"), (F.monotonically_increasing_id() if row is None else row).alias("row"),
        whole().rlike("[\\x09\\x0B-\\x0D]").alias("blank"),
    ]
    # Texts are taken apart once; from here on a word is its hash.
    taken = scratch.save(
        _lines(docs, *carried).select(
            "doc_id", "row", "pos", F.xxhash64("line").alias("lh"),
            _words(F.col("blank")).alias("words"),
        ).where(F.size("words") > 0)
    )
    turned = _rarity(taken, scratch)
    keys = F.sort_array(F.transform("words", lambda h: h.bitwiseXOR(turned[F.shiftrightunsigned(h, 64 - _BITS)])))
    n = F.size("words")
    lines = scratch.save(
        taken.df.select("doc_id", "row", "pos", "lh", "words", keys.alias("keys")).select(
            "doc_id", "row", "pos", "lh", F.xxhash64("keys").alias("set"), n.alias("n"), _parity(False).alias("odd"), _parity(True).alias("upper"),
            F.transform(F.slice("keys", 1, n - F.ceil(n * similar / 100).cast("int") + 1), lambda k: F.hash(k)).alias("prefix"),
        )
    )
    remove(scratch.spark, taken.path)
    # Copies of a set are folded before the shuffle; the earliest line stands for it.
    held = ["doc_id", "row", "pos", "lh", "n", "odd", "upper", "prefix"]
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), *held)).alias("p")
    firsts = scratch.save(
        lines.df.groupBy("set").agg(first, (F.count(F.lit(1)) > 1).alias("copied")).select("set", "copied", *[f"p.{c}" for c in held])
    )
    return lines, firsts


def _judged(docs: DataFrame, similar: int, scratch: Scratch, row: Column | None = None) -> DataFrame:
    """Every line with a word: ``(doc_id, row, pos, lh, set, gone, links, match)``, match being null for a line that stays."""
    lines, firsts = _sets(docs, similar, scratch, row)
    earliest = F.min(F.struct("match_place", "match")).alias("m")
    links = _pairs(docs, firsts, similar, scratch).groupBy("set").agg(F.count(F.lit(1)).alias("links"), earliest).select(
        "set", "links",
        F.struct(F.col("m.match").alias("set"), F.col("m.match_place.doc_id").alias("doc"), F.col("m.match_place.pos").alias("pos")).alias("similar"),
    )
    # Sets with one line need its place only where they are linked, to be read off the others.
    own = F.when(F.col("copied"), F.struct("set", F.col("doc_id").alias("doc"), "pos"))
    of_set = scratch.save(
        firsts.df.select("set", F.when(F.col("copied"), F.col("row")).alias("first_row"), own.alias("own")).join(links, "set", "left")
    )
    copy = F.col("own").isNotNull() & ((F.col("row") != F.col("first_row")) | (F.col("pos") != F.col("own.pos")))
    return lines.df.select("doc_id", "row", "pos", "lh", "set").join(of_set.df, "set").select(
        "doc_id", "row", "pos", "lh", "set", (copy | F.col("links").isNotNull()).alias("gone"),
        F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("similar", F.when(copy, F.col("own"))).alias("match"),
    )


def _parity(upper: bool) -> Column:
    """For each value of six bits of a hash, whether an odd number of the words has it; ``upper`` counts those with the next bit set."""
    def bit(h: Column) -> Column:
        counted = F.shiftright(h, 6).bitwiseAND(1) if upper else F.lit(1).cast("long")
        return F.call_function("shiftleft", counted, h.bitwiseAND(63).cast("int"))

    return F.aggregate("words", F.lit(0).cast("long"), lambda odd, h: odd.bitwiseXOR(bit(h)))


def _as_text(x: Column) -> Column:
    match = x["match"]
    parts = x["pos"], x["set"], match["set"], match["doc"], match["pos"]
    return F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def line_links(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """``(class_id, doc_id, pos, match_id, match_doc, match_pos)``, one row for each two similar, different sets of words.

    A class is a set of words, named by a hash and found first at the given place; the class that it matches comes
    earlier. With the classes of ``removed_lines`` that says of every line what it is linked with.
    """
    with Scratch(docs.sparkSession) as scratch:
        _, firsts = _sets(docs, similar, scratch)
        return scratch.save(
            _pairs(docs, firsts, similar, scratch).select(
                F.col("set").alias("class_id"), "place.doc_id", "place.pos",
                F.col("match").alias("match_id"), F.col("match_place.doc_id").alias("match_doc"), F.col("match_place.pos").alias("match_pos"),
            ),
            keep=True,
        ).df


def removed_lines(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """``(doc_id, pos, class_id, match_id, match_doc, match_pos, n_links)``, one row for each line that goes.

    ``class_id`` names the line's own set of words, ``match_id`` the earliest set that it matches (its own for a mere copy),
    which is found first in line ``match_pos`` of ``match_doc``.
    """
    with Scratch(docs.sparkSession) as scratch:
        return scratch.save(
            _judged(docs, similar, scratch).where("gone").select(
                "doc_id", "pos", F.col("set").alias("class_id"), F.col("match.set").alias("match_id"), F.col("match.doc").alias("match_doc"),
                F.col("match.pos").alias("match_pos"), F.col("links").alias("n_links"),
            ),
            keep=True,
        ).df


def without_removed_lines(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """``(doc_id, text)``, one row for each row of ``docs``, without the lines that go; null texts stay null."""
    with Scratch(docs.sparkSession) as scratch:
        # The rows are written with their number, so that it is the same in both readings.
        held = scratch.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row")))
        gone = _judged(held.df, similar, scratch, F.col("row")).where("gone").groupBy("row").agg(F.collect_list("pos").alias("gone"))
        split = F.split("text", "\n")
        kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
        text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda k: F.get(F.col("parts"), k)), "\n"))
        return scratch.save(
            held.df.withColumn("parts", split).join(gone, "row", "left").select("doc_id", text.alias("text")), keep=True
        ).df


def line_dedup(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """``(doc_id, n_lines, n_removed, n_links, kept_digest, removed)``, one row for each row of ``docs (doc_id, text)``.

    Lines are cut at newlines; those without a word are neither counted nor removed. A line goes when an earlier line (by id, a
    null one last, then by its place in the text) has a set of words with a Jaccard similarity of ``similar``
    hundredths or more, equal lines among them. ``n_links`` counts, over the lines of the row, the earlier
    different sets of words that they match. The digest is the bitwise XOR of ``xxhash64(place, xxhash64(line))`` over the lines that
    stay (0 for none). ``removed`` has ``pos:class_id:match_id:match_doc:match_pos`` of the lines that go, as in ``removed_lines``,
    by place, with commas between; a null id is empty. Null and empty texts have no lines. Other columns are ignored.
    """
    with Scratch(docs.sparkSession) as scratch:
        judged = _judged(docs, similar, scratch)
        kept = F.when(~F.col("gone"), F.xxhash64("pos", "lh"))
        fate = F.when(F.col("gone"), F.struct("pos", "set", "match"))
        rows = judged.groupBy("row").agg(
            F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("gone").cast("long")).alias("n_removed"),
            F.sum("links").alias("n_links"), F.coalesce(F.bit_xor(kept), F.lit(0)).alias("kept_digest"), F.first("doc_id").alias("doc_id"),
            F.array_join(F.transform(F.sort_array(F.collect_list(fate)), _as_text), ",").alias("removed"),
        )
        found = scratch.save(rows)
        # Rows without any line, by what the others leave of each id.
        every = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.sum((~whole().rlike("[^\\x20\\x09-\\x0D]")).cast("long")).alias("empty")
        )
        none = every.where("empty > 0").select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), "empty"))).select(
            "doc_id", *[F.lit(0).cast("long").alias(c) for c in ("n_lines", "n_removed", "n_links", "kept_digest")], F.lit("").alias("removed")
        )
        return scratch.save(found.df.drop("row").unionByName(none), keep=True).df
