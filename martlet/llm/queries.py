"""The operators' queries over the given tables, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martlet.llm import (
    chat_format,
    collocations,
    decontaminate,
    line_dedup,
    packing,
    privacy,
    quality_rules,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
    token_store,
)
from martlet.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(read_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_digest(read_table(spark, sf_dir, "documents"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(read_table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    columns = ["conv_id", "turn", "role", "text"]
    return chat_format.chat_digest(conversations.select(columns).unionByName(chat_format.marked_conversation(spark)))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.decontamination_digest(documents, benchmark)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digest(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding_digest(read_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.privacy_digest(read_table(spark, sf_dir, "documents"))


# Words of a text between ASCII white space, and a document's lines, as DuckDB sees them.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL = {
    "op2_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
        p AS (SELECT doc_id, w, len(w) AS n, unnest(range(len(w))) AS i FROM d),
        five AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i + 1 : i + 5]) AS k FROM p WHERE i + 5 <= n),
        ten AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i + 1 : i + 10]) AS k FROM p WHERE i + 10 <= n),
        repeats AS (SELECT doc_id, count(DISTINCT i + o) AS c FROM five, range(5) AS t(o) WHERE k > 1 GROUP BY doc_id),
        covers AS (SELECT doc_id, count(DISTINCT i + o) AS c FROM ten, range(10) AS t(o) WHERE k > 1 GROUP BY doc_id),
        over_limit AS (
            SELECT DISTINCT doc_id FROM (
                SELECT doc_id, count(*) OVER (PARTITION BY doc_id, w[i + 1 : i + limit_]) AS k
                FROM (SELECT *, greatest(10, 3 * n // 100) + 1 AS limit_ FROM p) WHERE i + limit_ <= n
            ) WHERE k > 1
        ),
        dup_lines AS (
            SELECT doc_id, count(*) - count(DISTINCT line) AS c
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
        ),
        m AS (
            SELECT d.doc_id, len(w) AS n_words,
                length(coalesce(array_to_string(w, ''), '')) AS word_chars,
                len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                coalesce(l.c, 0) AS n_dup_lines, coalesce(r.c, 0) AS n_repeat_words, coalesce(c.c, 0) AS n_covered_words,
                o.doc_id IS NOT NULL AS long_repeat
            FROM d LEFT JOIN dup_lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)
            LEFT JOIN covers c USING (doc_id) LEFT JOIN over_limit o USING (doc_id)
        ),
        f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words, base_failed,
            NOT (base_failed OR 100 * n_covered_words > 10 * n_words OR long_repeat) AS kept
        FROM f
    """,
    "op4_line_dedup": r"""
        WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
        w AS (
            SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM l
        ),
        s AS (
            SELECT doc_id, pos, row_number() OVER (PARTITION BY line, after ORDER BY doc_id, pos) > 1 AS later
            FROM w WHERE after IS NOT NULL AND regexp_matches(line || after, '[^\x20\x09-\x0D]')
        ),
        long_lines AS (
            SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) > 1 AS later
            FROM l WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 20
        ),
        gone AS (
            SELECT doc_id, pos + o AS pos FROM s, range(2) AS t(o) WHERE later
            UNION SELECT doc_id, pos FROM long_lines WHERE later
        ),
        k AS (
            SELECT doc_id, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY pos) AS kept
            FROM l ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(lines) END AS n_lines,
            CASE WHEN text IS NULL THEN 0 ELSE len(lines) - coalesce(n_kept, 0) END AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op5_chat_formatting": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        e AS (
            SELECT *, role = 'assistant' AS trained,
                regexp_replace(replace(text, '\', '\\'),
                    '(<)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|s>|/s>|<SYS>>|</SYS>>)', '\1\\\2', 'g') AS half
            FROM c
        ),
        x AS (SELECT *, regexp_replace(half, '(\[)(INST\]|/INST\])', '\1\\\2', 'g') AS escaped FROM e)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (trained), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (trained), '')) AS loss_sha256,
            CAST(sum(length(role) + length(escaped) + 24) AS BIGINT) AS formatted_chars
        FROM x GROUP BY conv_id
    """,
    "op6_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
        b AS (SELECT item_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)),
        windows AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i + 1 : i + 10], ' ') AS words
            FROM (SELECT item_id, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)
        ),
        sizes AS (SELECT DISTINCT size FROM windows),
        p AS (SELECT doc_id, size, i, array_to_string(w[i + 1 : i + size], ' ') AS words
            FROM (SELECT doc_id, w, size, unnest(range(greatest(0, len(w) - size + 1))) AS i FROM d, sizes)),
        hits AS (SELECT doc_id, i, size, item_id FROM p JOIN windows USING (size, words)),
        hit_words AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM (SELECT doc_id, i, unnest(range(size)) AS o FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM hits GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN items t USING (doc_id)
    """,
    "op7_substring_dedup": rf"""
        WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
        p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
        s AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 13], ' ') AS words
            FROM (SELECT doc_id, w, unnest(range(greatest(0, len(w) - 12))) AS i FROM d)),
        f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY words) < doc_id AS again FROM s),
        gone AS (SELECT DISTINCT doc_id, i + o AS i FROM f, range(13) AS t(o) WHERE again),
        k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM p ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op11_collocations": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ),
        pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        f AS (
            SELECT lang, size, array_to_string(w[i + 1 : i + size], ' ') AS phrase, count(*) AS f
            FROM (SELECT lang, w, size, unnest(range(greatest(0, len(w) - size + 1))) AS i FROM w, range(1, 6) AS t(size))
            GROUP BY ALL HAVING count(*) >= 100
        ),
        c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE size > 1),
        cut AS (
            SELECT lang, phrase, a, p, k, array_to_string(p[1 : k], ' ') AS front, array_to_string(p[k + 1 : size], ' ') AS back
            FROM (SELECT *, unnest(range(1, size)) AS k FROM c)
        ),
        scored AS (
            SELECT cut.lang, cut.phrase, a, k, l.f AS l, r.f AS r, n,
                CAST((1000 * CAST(a AS HUGEINT) * CAST(n AS HUGEINT)) // (CAST(l.f AS HUGEINT) * CAST(r.f AS HUGEINT)) AS BIGINT) AS score
            FROM cut JOIN f AS l ON l.lang = cut.lang AND l.phrase = front
            JOIN f AS r ON r.lang = cut.lang AND r.phrase = back JOIN totals ON totals.lang = cut.lang
        ),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        gone AS (
            SELECT DISTINCT inner_.lang, inner_.phrase
            FROM (SELECT lang, a, size, p, unnest(range(2, size)) AS part FROM c) AS outer_, range(4) AS t(i), c AS inner_
            WHERE i + part <= outer_.size AND inner_.lang = outer_.lang
                AND inner_.phrase = array_to_string(outer_.p[i + 1 : i + part], ' ') AND 100 * outer_.a >= 100 * inner_.a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM best ANTI JOIN gone USING (lang, phrase)
        QUALIFY rank <= 2000
    """,
}


def queries() -> dict[str, Query]:
    found = (
        op1_simhash, op2_quality_rules, op3_token_store, op4_line_dedup, op5_chat_formatting,
        op6_decontamination, op7_substring_dedup, op8_packing, op9_sharding, op10_token_counts,
        op11_collocations, op12_spelling_variants, op13_privacy,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
