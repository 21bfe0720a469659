"""The registered queries of the training-data operators, and their SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import byte_bpe
from .exact_dedup import exact_dedup
from .hilbert import hilbert_shards
from .importance import importance
from . import pii_crf, quality_model, vector_codes
from .minhash import minhash_documents
from .mixing import mixture
from .quality_rules import RULES, quality_rules
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .warc import warc_round_trip

VOCABULARY, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc_round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = pii_crf.find_pii(docs, pii_crf.train(docs))
    told = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    counts = [F.expr(f"bigint(size(filter(base, x -> x.kind = '{k}')))").alias(f"n_{k}") for k in pii_crf.KINDS]
    return out.select(F.col("id").alias("doc_id"), *counts, F.sha2(told("base"), 256).alias("base_sha256"), told("spans").alias("spans"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(F.col("id").alias("doc_id"), *base, F.round("posterior", 6).alias("posterior"), *(f"vote_{k}" for k in RULES))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture(table(spark, sf_dir, "documents"))
    return out.withColumnRenamed("id", "doc_id").withColumns({c: F.round(c, 9) for c in ("weight", "exponent")})


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN, keep=["doc_id"])
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model, keep=["doc_id"])


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hilbert_shards(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("id", "vec_id").withColumn("codebooks_sha256", F.lit(vector_codes.books_digest(books)))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash_documents(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def _lloyd_sql(rounds: int, wide: int) -> str:
    """CTEs from parts (vec_id, p, x) and b0 (p, j, c), the first codebooks, to a<rounds>, the last assignment, and b<rounds>."""
    steps = []
    for r in range(rounds + 1):
        far = "list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)"
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, x, min({{'d': {far}, 'j': j}}) AS m FROM parts JOIN b{r} USING (p) GROUP BY vec_id, p, x)")
        if r < rounds:
            means = ", ".join(f"floor(sum(x[{k}]) / count(*))" for k in range(1, wide + 1))
            steps.append(f"n{r} AS (SELECT p, m.j AS j, [{means}] AS c FROM a{r} GROUP BY p, m.j)")
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT p, j, coalesce(n{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN n{r} USING (p, j))")
    return ", ".join(steps)


def _curve_sql(dims: int, bits: int) -> str:
    """CTEs from `cells` (x0, x1, ...) to `curved` (curve), a step each; operands are the columns of the step before."""
    xs = [f"x{i}" for i in range(dims)]
    steps, last = [], "cells"

    def step(change: str) -> None:
        nonlocal last
        steps.append(f"h{len(steps)} AS (SELECT * REPLACE ({change}) FROM {last})")
        last = f"h{len(steps) - 1}"

    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for x in xs:
            swap = f"(xor(x0, {x}) & {low})"
            both = "" if x == "x0" else f", CASE WHEN ({x} & {low + 1}) > 0 THEN {x} ELSE xor({x}, {swap}) END AS {x}"
            step(f"CASE WHEN ({x} & {low + 1}) > 0 THEN xor(x0, {low}) ELSE xor(x0, {swap}) END AS x0{both}")
    for a, x in zip(xs, xs[1:], strict=False):
        step(f"xor({a}, {x}) AS {x}")
    flip = "0"
    for b in range(1, bits):
        flip = f"xor({flip}, CASE WHEN ({xs[-1]} & {1 << b}) > 0 THEN {(1 << b) - 1} ELSE 0 END)"
    digits = [f"(((xor({x}, flip) >> {b}) & 1) << {b * dims + dims - 1 - i})" for b in range(bits) for i, x in enumerate(xs)]
    return ", ".join([*steps, f"flipped AS (SELECT *, {flip} AS flip FROM {last})", f"curved AS (SELECT *, {' + '.join(digits)} AS curve FROM flipped)"])


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_simhash, op3_warc, op4_pii, op5_quality_rules, op6_mixing, op7_exact_dedup, op8_byte_bpe, op9_quality_model, op10_hilbert_shards, op11_vector_codes, op12_minhash, op13_importance)}

#: CTEs of the checksums' table (crc) and an expression for the checksum of a list of byte values after 2^32 - 1.
_CRC = """bytes AS (SELECT i, list_reduce([i] || range(0, 8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v FROM range(0, 256) r(i)),
        crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS tab FROM bytes)"""
_CRC_OF = "xor(list_reduce({b}, lambda v, x: xor(v >> 8, tab[(xor(v, x) & 255) + 1])), 4294967295)"

ORACLE_SQL = {
    "op12_minhash": """
        WITH RECURSIVE t AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
        sets AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM t),
        items AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
              GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        least_ids AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id <= coalesce(b, doc_id) AS kept FROM sets LEFT JOIN least_ids ON a = doc_id""",
    "op13_importance": f"""
        WITH {_CRC},
        texts AS (SELECT doc_id, true AS own, text FROM documents UNION ALL SELECT NULL, false, text FROM benchmark),
        words AS MATERIALIZED (SELECT doc_id, own, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM texts),
        kinds AS (SELECT w, [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM (SELECT DISTINCT w FROM words)),
        places AS MATERIALIZED (SELECT w, {_CRC_OF.format(b="b")} % 10000 AS bucket FROM kinds, crc),
        sums AS (SELECT bucket, count_if(own) AS s, count_if(NOT own) AS t FROM words JOIN places USING (w) GROUP BY bucket),
        totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
        gain AS MATERIALIZED (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS g FROM sums, totals),
        per AS (SELECT doc_id, count(*) AS n, sum(g)::BIGINT AS weight FROM words JOIN places USING (w) JOIN gain USING (bucket) WHERE own GROUP BY doc_id),
        scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM documents LEFT JOIN per USING (doc_id)),
        able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN able USING (doc_id)""",
    "op1_suffix_dedup": """
        WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
        places AS (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d WHERE n >= 50),
        starts AS (SELECT doc_id, p, substring(h, 2 * p + 1, 100) AS s FROM places),
        hits AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS first_id FROM starts) WHERE doc_id > first_id),
        marked AS (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS opens FROM hits),
        runs AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
        spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, run),
        told AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
        cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_b, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
              FROM told JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(head, '') || substring(h, 2 * coalesce(last_b, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN cut USING (doc_id)""",
    "op10_hilbert_shards": f"""
        WITH {_CRC},
        d AS (SELECT doc_id, lang, source, strlen(coalesce(text, '')) + 1 AS size,
              [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM documents),
        langs AS (SELECT lang, (row_number() OVER (ORDER BY lang) - 1) * 16 // count(*) OVER () AS x FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
        sources AS (SELECT source, (row_number() OVER (ORDER BY source) - 1) * 16 // count(*) OVER () AS x FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)),
        ids AS (SELECT min(doc_id) AS low, max(doc_id) - min(doc_id) + 1 AS wide FROM documents),
        cells AS (SELECT doc_id, size, {_CRC_OF.format(b="b")} AS text_crc32,
              coalesce(langs.x, 0)::BIGINT AS x0, coalesce(sources.x, 0)::BIGINT AS x1, least(15, length(bin(size)) - 1)::BIGINT AS x2,
              coalesce(least(15, floor((doc_id - low)::DOUBLE / wide::DOUBLE * 16)), 0)::BIGINT AS x3
              FROM d CROSS JOIN crc CROSS JOIN ids LEFT JOIN langs USING (lang) LEFT JOIN sources USING (source)),
        {_curve_sql(4, 4)},
        placed AS (SELECT *, row_number() OVER (ORDER BY curve, text_crc32, doc_id NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM curved),
        cut AS (SELECT *, (rank * 8 + 7) // n AS shard FROM placed)
        SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard, rank - shard * n // 8 AS slot, NULL::INT AS grown_shard, curve FROM cut""",
    "op11_vector_codes": f"""
        WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS e FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (SELECT vec_id, p, e[p * 16 + 1 : p * 16 + 16] AS x FROM v, range(0, 4) r(p)),
        b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS j, x AS c FROM parts QUALIFY j < 256),
        {_lloyd_sql(4, 16)},
        told AS (SELECT vec_id, string_agg(lower(lpad(to_hex(m.j), 2, '0')), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a4 GROUP BY vec_id),
        digest AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM b4)
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM told JOIN v USING (vec_id), digest""",
    "op7_exact_dedup": """
        WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op3_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to FROM q""",
}
