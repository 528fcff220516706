"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers as vocab
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.llm import (
    bpe,
    fill_in_middle,
    filter_audit,
    language,
    near_dup,
    packing,
    quality_model,
    quality_rules,
    sharding,
    token_count,
    token_files,
    vector_search,
    warc_records,
)
from crawlweave.llm.common import table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dup.near_duplicate_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size")


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.rate(docs, model, ["doc_id"])


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files_round_trip(table(spark, sf_dir, "documents"), vocab.path("byte_bpe_50k.json"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), vocab.path("byte_bpe_50k.json"))
    # Spark's own CRC-32 of the ids' bytes: nothing goes through Python again
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "sequence_tokens", "padded_tokens")


def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.cascade(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[F.col(f"measures.{c}") for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


def op8_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), vocab.path("byte_bpe_50k.tiktoken"),
                                 vocab.PATTERN)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), vocab.path("piece_bpe_32k.model"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = fill_in_middle.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
                       F.col("middle_units").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored, 256).alias("restored_sha256"))


def op12_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc_records.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit.select("part", "filter_order", "step", *filter_audit.COUNTS, "shapley")


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_quality_model": op2_quality_model,
    "op3_language": op3_language,
    "op4_token_files": op4_token_files,
    "op5_packing": op5_packing,
    "op6_vector_search": op6_vector_search,
    "op7_quality_rules": op7_quality_rules,
    "op8_byte_shards": op8_byte_shards,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_token_counts": op10_token_counts,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_warc_records": op12_warc_records,
    "op13_filter_audit": op13_filter_audit,
}

#: DuckDB twins, for the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op7_quality_rules": r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         string_split(coalesce(text, ''), chr(10)) AS all_lines
  FROM documents),
windows AS (
  SELECT rid, pos, words[pos] AS a, words[pos + 1] AS b, words[pos + 2] AS c
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS pos FROM base WHERE len(words) >= 3)),
repeated AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT rid, count(DISTINCT place) AS n
  FROM (SELECT rid, unnest([pos, pos + 1, pos + 2]) AS place FROM repeated) GROUP BY rid),
measured AS (
  SELECT b.doc_id, b.text, b.all_lines, len(b.words) AS n_words,
         length(regexp_replace(b.text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(b.text) - length(regexp_replace(b.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(b.all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
         - len(list_distinct(list_filter(b.all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM base b LEFT JOIN covered c USING (rid)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR n_symbols * 20 > word_chars
            OR n_dup_lines * 2 > len(all_lines)
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > letters
            OR 10 * len(list_filter(all_lines, lambda x: ends_with(rtrim(x), '...'))) > 3 * len(all_lines)
            OR 2 * letters < word_chars) AS kept
FROM judged
""",
    "op11_fill_in_middle": r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM base),
cut AS (
  SELECT *, substr(text, 1, least(c1, c2)) AS a, substr(text, least(c1, c2) + 1, abs(c1 - c2)) AS b,
         substr(text, greatest(c1, c2) + 1) AS c
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(c1 - c2) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
                        ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
""",
    "op12_warc_records": r"""
WITH base AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
best AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS largest FROM base)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN largest IS NOT NULL AND page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM best
""",
    "op13_filter_audit": r"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-]+'), lambda x: x <> '') AS words
  FROM documents),
marked AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failing AS (
  SELECT b.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
  FROM base b LEFT JOIN marked m USING (doc_id)),
cells AS (SELECT part, failed, good, toxic, count(*) AS n FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.l <> a.l AND c.l NOT IN (a.l, b.l) AND d.l NOT IN (a.l, b.l, c.l) AND e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS letter,
         substr(filter_order, 1, step - 1) AS earlier
  FROM orders, range(1, 6) AS r(step)),
told AS (
  SELECT part, filter_order, step, letter, n, good, toxic, contains(failed, letter) AS fails,
         failed = letter AS only_this, len(list_filter(string_split(failed, ''), lambda x: x <> '' AND contains(earlier, x))) > 0 AS gone
  FROM cells, steps),
summed AS (
  SELECT part, filter_order, step, letter,
         CAST(sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN only_this THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN fails AND NOT gone THEN n * good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN fails AND NOT gone THEN n * toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM told GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
""",
}
