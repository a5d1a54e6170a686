"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from loglark.llm import (byte_shards, chat_format, collocations, conversation_repair, decontamination, language_id, line_chunks, mixing, paragraph_minhash, posting_lists,
                         simhash_vptree, token_counts, token_output)
from loglark.llm.common import saved, table

#: Id of the token that ends each document in the binary output.
END_ID = 1


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def mixing_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_by_source(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_minhash.repeated_paragraphs(table(spark, sf_dir, "documents")).drop("row")


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.encode_corpus(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), END_ID)


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language_id.fit(language_id.labelled(docs))
    if model is None:
        return spark.createDataFrame([], "doc_id long, page_id long, lang string, posterior double, accepted boolean")
    rows = language_id.document_evidence(docs).unionByName(language_id.page_evidence(pages))
    return language_id.identify(rows, model)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents"))


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return chat_format.digest(saved(chat_format.format_conversations(rows.unionByName(probe)), "chat"))


def transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def posting_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(table(spark, sf_dir, "embeddings"), "id % 50 = 0")


def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.near_duplicates(table(spark, sf_dir, "documents"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversation_repair.damaged(conversations), conversations)


def byte_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards.shard_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mixing_flow": mixing_flow,
    "op2_paragraph_dedup": paragraph_dedup,
    "op3_benchmark_leaks": benchmark_leaks,
    "op4_token_ids": token_ids,
    "op5_language": language,
    "op6_line_dedup": line_dedup,
    "op7_chat": chat,
    "op8_token_counts": transducer_counts,
    "op9_posting_search": posting_search,
    "op10_simhash": simhash_dedup,
    "op11_collocations": phrase_collocations,
    "op12_conversation_repair": repair,
    "op13_byte_shards": byte_sharding,
    "pipeline": corpus_pipeline.run,
}

_ESC = "replace(replace(replace({0}, '\\', '\\\\'), '##', '#\\#'), '</turn>', '<\\/turn>')"
_ROLE = "replace(replace(" + _ESC.format("role") + ", ':', '\\:'), chr(10), '\\' || chr(10))"


def _crc32_table() -> str:
    """The 256 remainders of the reflected polynomial 0xEDB88320, as an SQL list."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ 0xEDB88320 * (value & 1)
        out.append(value)
    return f"{out}::BIGINT[]"


_CRC32 = (f"xor(list_reduce([4294967295] || [CAST('0x' || hex(text)[i : i + 1] AS BIGINT) FOR i IN range(1, 2 * strlen(text), 2)], "
          f"lambda r, b: xor(r >> 8, ({_crc32_table()})[xor(r & 255, b) + 1])), 4294967295)")

ORACLE = {
    "op7_chat": rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
said AS (
    SELECT *, CASE WHEN contains(text, '\') OR contains(text, '###') OR contains(text, '</turn>')
                   THEN {_ESC.format("text")} ELSE text END AS body, {_ROLE} AS head FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + length(head) + 14) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id""",
    "op11_collocations": r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
said AS (SELECT lang, [x FOR x IN string_split(replace(piece, chr(9), ' '), ' ') IF x <> ''] AS w FROM pieces),
grams AS (
    SELECT lang, 1 AS words, unnest(w) AS phrase FROM said
    UNION ALL SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM said
    UNION ALL SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM said),
total AS (SELECT lang, count(*) AS n FROM grams WHERE words = 1 GROUP BY lang),
f AS (SELECT lang, words, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10),
cut AS (
    SELECT lang, phrase, a, words, k, string_split(phrase, ' ') AS w FROM f, range(1, 3) AS t(k) WHERE k < words),
sides AS (
    SELECT c.lang, c.phrase, c.a, c.words, c.k, l.a AS l, r.a AS r,
           CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
    FROM cut c
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
worst AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
    SELECT lang, phrase, max(a) AS around FROM (
        SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, a
        FROM f WHERE words = 3) GROUP BY ALL),
kept AS (
    SELECT w.* FROM worst w LEFT JOIN longer g ON g.lang = w.lang AND g.phrase = w.phrase
    WHERE w.words = 3 OR g.around IS NULL OR 100 * g.around < 50 * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000""",
    "op13_byte_shards": f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, coalesce({_CRC32}, 0) AS text_crc32 FROM documents),
o AS (
    SELECT *, sum(size) OVER () AS whole, sum(size) OVER w AS upto, row_number() OVER w AS place FROM d
    WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, CAST((2 * upto - size) * 8 // (2 * whole) AS INTEGER) AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, place - min(place) OVER (PARTITION BY shard) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM s""",
    "op12_conversation_repair": rf"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS text FROM conversations),
hurt AS (SELECT conv_id, turn, role, body, {_CRC32} % 20 AS how FROM named),
said AS (
    SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
           CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS text,
           unnest(CASE WHEN how = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hurt WHERE how <> 0),
turns AS (
    SELECT *, role[1:1] AS initial, row_number() OVER w AS i, lag(role[1:1]) OVER w AS before,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
    FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (
    SELECT *, CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
    FROM turns),
inserts(q, n, upto) AS (VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (2, 2, 2), (3, 0, 3), (3, 1, 2), (3, 2, 3)),
edits(q, letter, initial, price, upto) AS (
    VALUES (0, 'D', '', 2, 0), (1, 'D', '', 2, 1), (2, 'D', '', 2, 2), (3, 'D', '', 2, 3),
        (0, 'R', '', 1, 2), (1, 'R', '', 1, 2), (3, 'R', '', 1, 2), (2, 'R', '', 1, 3),
        (0, 'K', 's', 0, 1), (0, 'K', 'u', 0, 2), (1, 'K', 'u', 0, 2), (3, 'K', 'u', 0, 2), (2, 'K', 'a', 0, 3)),
best(conv_id, i, q, cost, audit) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), '' FROM f
    UNION ALL
    SELECT conv_id, i, q, cost, audit FROM (
        SELECT b.conv_id, f.i, CAST(e.upto AS BIGINT) AS q, b.audit || repeat('I', n) || letter AS audit,
               CAST(b.cost + 5 * n + price + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS BIGINT) AS cost
        FROM best b JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1
        JOIN inserts s ON s.q = b.q
        JOIN edits e ON e.q = s.upto AND (letter = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (letter <> 'K' OR e.initial = f.initial))
    QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
ends AS (
    SELECT b.conv_id, CAST(cost + 5 * n AS BIGINT) AS cost, audit || repeat('I', n) AS audit
    FROM best b JOIN (SELECT conv_id, max(i) AS i FROM f GROUP BY conv_id) m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i
    JOIN inserts s ON s.q = b.q AND s.upto IN (0, 3)
    QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + 5 * n, audit || repeat('I', n)) = 1),
letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS j FROM ends WHERE audit <> ''),
placed AS (
    SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS nth
    FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j ROWS UNBOUNDED PRECEDING)),
shown AS (
    SELECT p.conv_id, p.j, p.letter, p.nth, f.role, f.text,
           max(CASE WHEN p.nth = 1 AND p.letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS s
    FROM placed p LEFT JOIN f ON p.letter <> 'I' AND f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i
    WHERE p.letter <> 'D'),
lines AS (
    SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (nth - s) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS whole
    FROM shown GROUP BY conv_id),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id""",
}
