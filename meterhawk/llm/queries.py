"""The operators applied to the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk.llm import bpe, chat, exact_dedup, merkle, mixing, near_dedup, pair_search, quality, search, secrets, sharding, token_counts, toxicity
from meterhawk.llm.common import read_table

# Fixed value: the extra conversation of the chat query.
EXTRA_CONVERSATION = (-7, "\\### Assistant: </turn> ok")

MIXTURE = mixing.Mixture(
    domains={"domain0": 3.0, "domain1": 2.0, "domain2": 2.0, "domain3": 1.0},
    langs={"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0},
)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return token_counts.document_tokens(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op3_top_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    # The stated query set: every row whose id is divisible by 100, against all rows.
    queries = docs.where(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search.top_documents(docs, queries)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(read_table(spark, sf_dir, "documents"))
    return placed.drop("row_number")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_copies(read_table(spark, sf_dir, "documents"))


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.encode_and_decode(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, said = EXTRA_CONVERSATION
    extra = spark.createDataFrame([(conv_id, 0, "user", said), (conv_id, 1, "assistant", said)], given.schema)
    return chat.digest(chat.format_conversations(given.unionByName(extra)))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), MIXTURE)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return pair_search.top_documents(read_table(spark, sf_dir, "documents"), items).withColumnRenamed("query_id", "item_id")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    # Fixed value: the ids whose rows are tampered with.
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.manifest(merkle.document_leaves(docs, tampered)).withColumnRenamed("id", "doc_id")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    return secrets.digest(paths)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_top_search": op3_top_search,
    "op4_quality": op4_quality,
    "op5_sharding": op5_sharding,
    "op6_toxicity": op6_toxicity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_mixing": op10_mixing,
    "op11_ranked_search": op11_ranked_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_secret_scan": op13_secret_scan,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op7_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_chat_formatting": r"""
        WITH every AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, n, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)
        ), sized AS (
            SELECT *,
                   CASE WHEN regexp_replace(text, '(?s)\\(.)', '\1', 'g') <> text OR text LIKE '%### %' OR text LIKE '%</turn>%'
                        THEN replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ')
                        ELSE text END AS body
            FROM every
        )
        SELECT conv_id,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('### ' || role || ': ') + length(body) + length('</turn>' || chr(10)))::BIGINT AS formatted_chars
        FROM sized
        GROUP BY conv_id
    """,
    "op11_ranked_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), asked AS (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
        lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
        corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM counts, corpus GROUP BY term
        ), scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // terms)))))::BIGINT AS score
            FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), corpus
            GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
    "op12_merkle_manifest": r"""
        WITH RECURSIVE fields AS (
            SELECT doc_id, coalesce('=' || lang, '-') AS tree, n_chars,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                       || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS tail,
                   xor(4294967295, list_reduce(
                       [4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                       lambda crc, b: list_reduce([xor(crc, b)] || range(8),
                                               lambda c, i: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)))) AS crc
            FROM documents
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
            FROM (
                SELECT doc_id, tree, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                       CASE WHEN crc % 7 = 0
                            THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS altered
                FROM fields
            )
        ), nodes AS (
            SELECT tree, 0 AS lvl, pos AS idx, n, leaf AS h FROM leaves
            UNION ALL
            SELECT tree, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
            FROM nodes WHERE n > 1 GROUP BY tree, lvl, n, idx // 2
        ), subroots AS (
            SELECT tree, h AS subroot, lvl AS height, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
        ), tops AS (
            SELECT 0 AS lvl, pos AS idx, n, subroot AS h FROM subroots
            UNION ALL
            SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, n, idx // 2
        ), steps AS (
            SELECT l.tree, l.pos, o.lvl AS step, o.idx % 2 AS odd, s.h AS sibling
            FROM leaves l JOIN nodes o ON o.tree = l.tree AND o.idx = l.pos >> o.lvl AND o.n > 1
            LEFT JOIN nodes s ON s.tree = o.tree AND s.lvl = o.lvl AND s.idx = xor(o.idx, 1)
            UNION ALL
            SELECT l.tree, l.pos, r.height + o.lvl, o.idx % 2, s.h
            FROM leaves l JOIN subroots r USING (tree) JOIN tops o ON o.idx = r.pos >> o.lvl AND o.n > 1
            LEFT JOIN tops s ON s.lvl = o.lvl AND s.idx = xor(o.idx, 1)
        ), proofs AS (
            SELECT tree, pos, sha256(string_agg(coalesce(sibling, ''), '' ORDER BY step)) AS proof_sha256, count(*) AS steps FROM steps GROUP BY tree, pos
        ), folds AS (
            SELECT tree, pos, 0 AS step, coalesce(altered, leaf) AS h FROM leaves
            UNION ALL
            SELECT f.tree, f.pos, f.step + 1, sha256(CASE WHEN odd = 1 THEN coalesce(sibling, '') || h ELSE h || coalesce(sibling, '') END)
            FROM folds f JOIN steps USING (tree, pos, step)
        )
        SELECT doc_id, leaf, subroot, t.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
        FROM leaves JOIN subroots USING (tree) JOIN tops t ON t.n = 1 LEFT JOIN proofs p ON p.tree = leaves.tree AND p.pos = leaves.pos
        JOIN folds f ON f.tree = leaves.tree AND f.pos = leaves.pos AND f.step = coalesce(p.steps, 0)
    """,
    "op13_secret_scan": r"""
        WITH rules(place, kind, pattern, least, part) AS (
            VALUES (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 8, 2),
                   (1, 'access', 'AKIA[A-Z0-9]+', 16, 0),
                   (2, 'hex', '[0-9a-f]+', 32, 0),
                   (3, 'private_key', '-----BEGIN [A-Z ]*PRIVATE KEY-----', 1, 0),
                   (4, 'forge', 'gh[pousr]_[A-Za-z0-9]{36,}', 1, 0)
        ), cut AS (
            SELECT doc_id, place, kind, least, part,
                   regexp_extract_all(coalesce(text, ''), pattern) AS matches, string_split_regex(coalesce(text, ''), pattern) AS gaps
            FROM documents, rules
        ), placed AS (
            SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY doc_id, place ORDER BY i) - length(match) AS start
            FROM (
                SELECT doc_id, place, kind, least, part, unnest(matches) AS match, unnest(gaps[:len(matches)]) AS gap, unnest(range(len(matches))) AS i
                FROM cut
            )
        ), found AS (
            SELECT doc_id, place, kind, start, kind || ':' || start || ':' || (start + length(match)) AS span
            FROM placed
            WHERE CASE WHEN part = 2
                       THEN length(regexp_extract(match, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2))
                       ELSE length(match) END >= least
        )
        SELECT doc_id,
               count(*) FILTER (kind = 'assign') AS n_assign,
               count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (place < 3), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans
        FROM documents LEFT JOIN found USING (doc_id)
        GROUP BY doc_id
    """,
}
