"""Registered queries of the operators, and the SQL twins of those SQL can express.

``public_tokenizers`` names the vocabulary files; every operator takes their path as a
parameter.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm import (
    bit_slices,
    byte_bpe,
    exact,
    fill_middle,
    id_files,
    language,
    lines,
    minhash,
    packing,
    quality,
    resampling,
    simhash,
    warc,
)
from quarterdeck.llm.shared import scratch

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_byte_bpe(spark, sf):
    encoded = byte_bpe.encode_documents(table(spark, sf, "documents"), BYTE_RANKS)
    decoded = byte_bpe.decode_documents(encoded, BYTE_RANKS)
    return decoded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_line_dedup(spark, sf):
    cleaned = lines.remove_repeated_passages(table(spark, sf, "documents"))
    return cleaned.select(
        "doc_id",
        "removed_chunks",
        "removed_lines",
        F.length("clean_text").cast("long").alias("clean_chars"),
        F.sha2("clean_text", 256).alias("clean_sha256"),
        F.to_json("removed_spans").alias("removed_spans"),
    )


@query
def op3_warc(spark, sf):
    out = scratch(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), out, nameless=True)
    return warc.read_records(spark, out)


@query
def op4_packing(spark, sf):
    pieces = packing.pack_documents(table(spark, sf, "documents"), WORD_FILE, END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op5_bit_sliced_top_k(spark, sf):
    return bit_slices.top_k(table(spark, sf, "embeddings"), F.col("id") % 100 == 0, k=10)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


@query
def op6_language(spark, sf):
    docs = table(spark, sf, "documents")
    model = language.learn(docs.filter(~held_out()))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op7_id_files(spark, sf):
    out = scratch(spark, "ids")
    id_files.write_documents(table(spark, sf, "documents"), out, WORD_FILE, END_ID, nameless=True)
    rows = id_files.read_segments(spark, out)
    checked = rows.withColumn("ids_crc32", F.crc32("token_ids")).drop("token_ids")
    return id_files.with_starts(checked, spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op8_exact_dedup(spark, sf):
    return exact.exact_duplicates(table(spark, sf, "documents"))


ORACLES["op8_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op9_quality(spark, sf):
    docs = table(spark, sf, "documents")
    model = quality.learn(docs, table(spark, sf, "labels"))
    return quality.score_documents(docs, model)


@query
def op10_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op11_minhash(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"))


ORACLES["op11_minhash"] = """
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w
    FROM documents
), placed_words AS (
    SELECT row_no, unnest(w) AS word, unnest(range(len(w))) AS place FROM words WHERE len(w) >= 4
), shingles AS (
    SELECT row_no, word || ' ' || lead(word, 1) OVER doc || ' ' || lead(word, 2) OVER doc || ' ' || lead(word, 3) OVER doc AS item
    FROM placed_words
    WINDOW doc AS (PARTITION BY row_no ORDER BY place)
    UNION ALL
    SELECT row_no, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 3
), listed AS (
    SELECT row_no, list_sort(list(DISTINCT hash(item))) AS s FROM shingles WHERE item IS NOT NULL GROUP BY row_no
), sets AS (
    SELECT doc_id, coalesce(s, []) AS s FROM words LEFT JOIN listed USING (row_no)
), classes AS (
    SELECT row_number() OVER () AS class, s, len(s) AS n, least_id
    FROM (SELECT s, min(doc_id) AS least_id FROM sets WHERE len(s) > 0 AND doc_id IS NOT NULL GROUP BY s)
), items AS (
    -- Sets that share four fifths share one of the first items, in any common order.
    SELECT class, n, unnest(s[1:n - (80 * n + 99) // 100 + 1]) AS item FROM classes
), met AS (
    SELECT DISTINCT a.class AS a, b.class AS b
    FROM items a JOIN items b ON a.item = b.item AND a.class < b.class
         AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), confirmed AS (
    SELECT met.a, met.b, len(list_intersect(x.s, y.s)) AS shared, x.n + y.n AS total
    FROM met JOIN classes x ON met.a = x.class JOIN classes y ON met.b = y.class
), shared AS (
    SELECT a, b FROM confirmed WHERE 100 * shared >= 80 * (total - shared)
    UNION ALL
    SELECT b, a FROM confirmed WHERE 100 * shared >= 80 * (total - shared)
), reached(class, other) AS (
    SELECT class, class FROM classes
    UNION
    SELECT r.class, s.b FROM reached r JOIN shared s ON r.other = s.a
), named AS (
    SELECT r.class, min(c.least_id) AS component_id FROM reached r JOIN classes c ON r.other = c.class GROUP BY r.class
), placed AS (
    SELECT sets.doc_id, len(sets.s) AS n_shingles,
           CASE WHEN sets.doc_id IS NOT NULL THEN coalesce(named.component_id, sets.doc_id) END AS component_id
    FROM sets LEFT JOIN classes USING (s) LEFT JOIN named USING (class)
)
SELECT doc_id, n_shingles, component_id, coalesce(doc_id = component_id, TRUE) AS kept FROM placed
"""


@query
def op12_fill_middle(spark, sf):
    cut = fill_middle.with_restored(fill_middle.fill_in_middle(table(spark, sf, "documents")))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


ORACLES["op12_fill_middle"] = """
WITH parted AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n,
           list_transform(range(4), lambda i: ('0x' || substr(h, (8 * i + 1)::BIGINT, 8))::BIGINT) AS draws
    FROM parted
), ranked AS (
    SELECT *, least(draws[1] % (n + 1), draws[2] % (n + 1)) AS a, greatest(draws[1] % (n + 1), draws[2] % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR draws[3] % 100 >= 90 THEN 'plain'
                WHEN draws[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), cut AS (
    SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
           array_to_string(units[b + 1:], '') AS suffix
    FROM ranked
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


@query
def op13_resampling(spark, sf):
    return resampling.importance_resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLES["op13_resampling"] = """
WITH divided AS (
    -- crc32 of every byte, bit by bit.
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
               CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, b::BIGINT)) AS steps
), words AS (
    SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS row_no, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS found
    FROM documents
    UNION ALL
    SELECT 't', item_id, row_number() OVER (), regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    FROM benchmark
), counted AS (
    SELECT side, row_no, word, count(*) AS n
    FROM (SELECT side, row_no, unnest(found) AS word FROM words) GROUP BY ALL
), hashed AS (
    SELECT word, xor(list_reduce(list_transform(range(strlen(word)), lambda i:
                   ('0x' || substr(hex(encode(word)), (2 * i + 1)::BIGINT, 2))::BIGINT),
               lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT word FROM counted), divided
), buckets AS (
    SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 't') AS t
    FROM counted JOIN hashed USING (word) GROUP BY bucket
), totals AS (
    SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM buckets
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + 10000)
                                   / ((coalesce(s, 0)::DOUBLE + 1) * (all_t + 10000))))::BIGINT AS gain
    FROM buckets, totals
), weights AS (
    SELECT row_no, sum(n * gain)::BIGINT AS weight
    FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row_no
), scored AS (
    SELECT id AS doc_id, row_no, len(found) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT
                                                       + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (row_no) WHERE side = 'd'
), ranked AS (
    SELECT *, n_features >= 20 AS able,
           row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
           count(*) FILTER (n_features >= 20) OVER () AS of_all
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= of_all * 10 // 100 THEN place END AS rank
FROM ranked
"""


ORACLES["op3_warc"] = """
WITH sized AS (
    SELECT page_id, coalesce(html, '') AS html FROM pages
), owned AS (
    SELECT page_id, html, min(page_id) OVER (PARTITION BY html) AS owner FROM sized
), hashed AS (
    SELECT page_id, owner, strlen(html) AS payload_bytes, unhex(sha1(html)) AS digest FROM owned
), digits AS (
    -- 160 bits are 32 digits of 5 bits; each digit lies in at most two bytes.
    SELECT page_id, owner, payload_bytes,
           list_transform(range(32), lambda i:
               ((('0x' || hex(digest[(5 * i) // 8 + 1 : (5 * i) // 8 + 1]))::INTEGER * 256
                 + CASE WHEN (5 * i) // 8 + 1 < 20
                        THEN ('0x' || hex(digest[(5 * i) // 8 + 2 : (5 * i) // 8 + 2]))::INTEGER ELSE 0 END)
                >> (11 - (5 * i) % 8)) & 31) AS parts
    FROM hashed
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(parts, lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', d + 1, 1)), '')
           AS payload_digest,
       CASE WHEN owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN owner = page_id THEN NULL ELSE owner END AS refers_to
FROM digits
"""

ORACLES["op5_bit_sliced_top_k"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      -- Longer ones could have scores beyond 64 bits.
      AND list_sum(list_transform(embedding, lambda x: pow(1024 * x::DOUBLE, 2))) <= 4611686018427387904::DOUBLE
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
