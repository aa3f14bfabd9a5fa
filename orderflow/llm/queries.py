"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
import pathlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import (
    chat,
    decontamination,
    htmltext,
    mixing,
    neardup,
    phrases,
    quality,
    sharding,
    spellings,
    substrings,
    tokencounts,
    tokenfiles,
    toxicity,
)
from orderflow.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from the perspective of each of its speakers."""
    found = chat.perspectives(table(spark, sf_dir, "conversations"))
    mask = F.expr("transform(masks, m -> concat(m.begin, ':', m.end))")
    return found.withColumn("masks", F.array_join(mask, ","))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the tokens of each document stand, read back from the files."""
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which benchmark items each document holds."""
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in passages of an earlier one, and the hash of the rest."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal counts, in random order."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_rows(documents).select(
        "row.doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality statistics and verdict of every document."""
    judged = quality.statistics_and_verdict(table(spark, sf_dir, "documents"), "doc_id")
    return judged.select(
        F.col("key").alias("doc_id"),
        "s.n_words",
        "s.word_chars",
        "s.n_symbols",
        "s.n_dup_lines",
        "s.n_repeat_words",
        "base_failed",
        "kept",
        "posterior",
    )


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.size(mixing.words_of(mixing.text_of("text"))).cast("long").alias("size")
    )
    mixed = mixing.mix(documents, text=None, size=F.col("row.size"))
    return mixed.select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens each document has, and whether they pass 1,024."""
    found = tokencounts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return found.withColumn("over_limit", F.col("n_tokens") > 1024)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, with the forms that variants go to."""
    return spellings.variants(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language by how much they exceed chance."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline, all stages."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (
    op1_chat_perspectives,
    op2_main_text,
    op3_token_files,
    op4_benchmark_leaks,
    op5_repeated_passages,
    op6_toxicity,
    op7_uniform_shards,
    op8_quality_votes,
    op9_near_duplicates,
    op10_mixed_sources,
    op11_token_counts,
    op12_spelling_variants,
    op13_collocations,
    pipeline,
)


def reachable(query: Callable) -> Callable:
    """Python workers of the driver's machine find this package where the driver found it."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = str(pathlib.Path(__file__).resolve().parents[2])
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: reachable(query) for query in QUERIES}


_OP1 = """
WITH rows AS (
  SELECT conv_id AS d, coalesce(turn, 4611686018427387904) AS n, coalesce(role, 'unknown') AS s,
         coalesce(text, '') AS t, coalesce(turn // 256, 4611686018427387904) AS p
  FROM conversations),
speakers AS (SELECT DISTINCT d, s AS me FROM rows WHERE s <> 'system'),
seen AS (
  SELECT r.d, me, p, n, r.s, t,
         CASE WHEN r.s = 'system' THEN '<|system|>' WHEN r.s = me THEN '<|assistant|>'
              ELSE '<|user name=' || r.s || '|>' END || chr(10) AS head
  FROM rows r JOIN speakers q ON r.d IS NOT DISTINCT FROM q.d),
placed AS (
  SELECT *, t || '<|end|>' AS body,
         coalesce(sum(length(head) + length(t) + 8) OVER (
           PARTITION BY d, me, p ORDER BY n, s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + length(head) AS begin
  FROM seen),
parts AS (
  SELECT d, me, p, count(*) AS n_turns,
         string_agg(head || body || chr(10), '' ORDER BY n, s, t) AS text,
         coalesce(string_agg(CASE WHEN s = me THEN CAST(begin AS BIGINT) || ':' || CAST(begin + length(body) AS BIGINT) END, ','
                    ORDER BY n, s, t), '') AS masks,
         coalesce(sum(CASE WHEN s = me THEN length(body) END), 0) AS n_trained
  FROM placed GROUP BY d, me, p)
SELECT d AS conv_id, me AS perspective,
       CAST(row_number() OVER w - 1 AS INTEGER) AS part,
       CAST(coalesce(sum(length(text)) OVER (PARTITION BY d, me ORDER BY p
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
       CAST(n_turns AS INTEGER) AS n_turns, text, masks, CAST(n_trained AS BIGINT) AS n_trained
FROM parts WINDOW w AS (PARTITION BY d, me ORDER BY p)
"""

_OP10 = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws(' ', 'mix', CAST(doc_id AS VARCHAR))) AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::HUGEINT AS source_size, count(*) AS n,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left,
         sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
         sum(n) OVER () AS n_all, row_number() OVER f AS place
  FROM sources WINDOW f AS (ORDER BY source_size * (6 // weight), CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END)),
level AS (
  SELECT words_left AS words, weight_left AS weights FROM filled
  WHERE 3 * source_size * weight_left > weight * words_left ORDER BY place LIMIT 1),
rated AS (
  SELECT source, source_size, n_all,
         full_up, CASE WHEN full_up THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(weight * words AS DOUBLE) / weights END AS target,
         CAST(CASE WHEN full_up THEN 3 * source_size ELSE weight * words END AS HUGEINT) AS num,
         CAST(CASE WHEN full_up THEN source_size ELSE weights * source_size END AS HUGEINT) AS den
  FROM (SELECT *, 3 * source_size * weight_left <= weight * words_left AS full_up FROM filled) LEFT JOIN level ON true),
shifted AS (
  SELECT *, (CAST('0x' || substr(md5('mix' || CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END), 1, 8) AS BIGINT) * den) // 4294967296 AS shift
  FROM rated),
placed AS (
  SELECT s.*, source_size, target, num, den, shift,
         length(bin(size)) * 8 + (((size * 16) >> length(bin(size))) & 7) AS class,
         CAST('0x' || substr(h, 9, 7) AS BIGINT) % (1 + n_all // 100000) AS block
  FROM sized s JOIN shifted r ON s.source IS NOT DISTINCT FROM r.source),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, block, size, h, doc_id)::HUGEINT AS k FROM placed)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(CASE WHEN den = 0 THEN 0 ELSE (k * num + shift) // den - ((k - 1) * num + shift) // den END * size AS BIGINT) AS taken
FROM ranked
"""


_OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs),
worded AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded WHERE len(w) > 0),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM starts, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w)),
counts AS (SELECT lang, m, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM worded GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m >= 2),
held AS (
  SELECT lang, phrase, max(a) AS over FROM (
    SELECT lang, array_to_string(w[1:m - 1], ' ') AS phrase, a FROM candidates WHERE m > 2
    UNION ALL SELECT lang, array_to_string(w[2:m], ' '), a FROM candidates WHERE m > 2) GROUP BY ALL),
cuts AS (
  SELECT c.*, k, x.f AS l, y.f AS r, n, 1000 * a * n // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.m], ' ')
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT lang, phrase, a, l, r, n, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
  FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
  WHERE over IS NULL OR 100 * over < 100 * a)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_perspectives": _OP1, "op10_mixed_sources": _OP10, "op13_collocations": _OP13}
