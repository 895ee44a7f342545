"""Registered queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import token_digests
from .divergence import divergence
from .exact_dedup import exact_dedup
from .line_dedup import line_dedup
from .mixing import mix
from .phrases import collocations
from .pii import personal_data
from .quality import quality
from .quality_model import quality_scores
from .scoring import score
from .simhash import simhash_dedup
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .text import documents

# The public tokenizer's description, installed beside the library that reads it.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _op1(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(documents(spark, folder))


def _op2(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup(documents(spark, folder))


def _op3(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(documents(spark, folder), tokenizer_path())


def _op4(spark: SparkSession, folder: str) -> DataFrame:
    return score(documents(spark, folder))


def _op5(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(documents(spark, folder))


def _op6(spark: SparkSession, folder: str) -> DataFrame:
    return quality(documents(spark, folder))


def _op7(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(documents(spark, folder))


def _op8(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(documents(spark, folder))


def _op9(spark: SparkSession, folder: str) -> DataFrame:
    return mix(documents(spark, folder))


def _op10(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup(documents(spark, folder))


def _op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(documents(spark, folder))


def _op12(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def _op13(spark: SparkSession, folder: str) -> DataFrame:
    return divergence(documents(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": _op1,
        "op2_suffix_dedup": _op2,
        "op3_bpe": _op3,
        "op4_lm_scoring": _op4,
        "op5_pii": _op5,
        "op6_quality_rules": _op6,
        "op7_substring_dedup": _op7,
        "op8_exact_dedup": _op8,
        "op9_mixing": _op9,
        "op10_simhash_dedup": _op10,
        "op11_phrases": _op11,
        "op12_quality_model": _op12,
        "op13_divergence": _op13,
    }


_BARE = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"
_OP8 = f"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, sha256({_BARE}) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) = 1 AS kept, text_sha256 FROM d"""

_OP11 = r"""WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, k, phrase, a, unnest(range(1, k)) AS cut, array_to_string(ws[:cut], ' ') AS head, array_to_string(ws[cut + 1:], ' ') AS tail FROM c),
scored AS (
  SELECT u.lang, u.phrase, u.a, u.cut, x.f AS l, y.f AS r, ((1000000::HUGEINT * u.a * u.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = u.head AND x.k = u.cut
  JOIN f y ON y.lang = u.lang AND y.phrase = u.tail AND y.k = u.k - u.cut),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase, a FROM c WHERE k = 3),
longer AS (SELECT lang, phrase, max(a) AS longer FROM around GROUP BY ALL),
ranked AS (
  SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN longer o USING (lang, phrase) WHERE o.longer IS NULL OR 100 * o.longer < 50 * b.a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
_OP13 = r"""WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
o AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM o GROUP BY ALL HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM o JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL) USING (lang, source)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (g.n + v.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 1)) // (v.n + v.v) AS q
  FROM g JOIN v USING (lang) JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""


def oracle_sql() -> dict[str, str]:
    return {"op8_exact_dedup": _OP8, "op11_phrases": _OP11, "op13_divergence": _OP13}
