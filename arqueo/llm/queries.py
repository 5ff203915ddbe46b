"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arqueo.llm import bpe, chat, collocations, decontaminate, jaccard_join, minhash, page_text, prefix_trie
from arqueo.llm import quality_classifier, quality_rules, token_counts, token_files, toxicity
from arqueo.llm.common import materialize, table

RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


#: The id that ends a document in op2's files.
END_ID = 2


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.read(spark, token_files.write(docs, public_tokenizers.path(WORD_BPE), END_ID))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("text")


#: Text of both turns of the conversation that op4 adds.
PROBE = "\\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id bigint, turn bigint, role string, text string"
    )
    log = chat.events_of_turns(turns.unionByName(probe))
    return chat.digest(materialize(chat.render(chat.messages(log))))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).drop("text")


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(table(spark, sf_dir, "pages")).drop("n_repeated")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.lengths(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return token_counts.by_limit(materialize(token_counts.histogram(counted)))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contained_items(docs, items)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality_rules.judge(docs, keep=["doc_id"]).select("doc_id", *counts, "base_failed", "kept", "quality_probability")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.components(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"), rebuild=True)


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_token_files": op2_token_files,
    "op3_toxicity": op3_toxicity,
    "op4_chat_format": op4_chat_format,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_page_text": op6_page_text,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_token_counts": op8_token_counts,
    "op9_decontamination": op9_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_collocations": op11_collocations,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

_SHINGLES = r"""
    SELECT {id} AS id, w, len(w) AS n FROM (
        SELECT {id}, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
        FROM {table}
    ) WHERE len(w) > 0
"""

ORACLES: dict[str, str] = {
    "op6_page_text": r"""
        WITH article AS (
            SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS a FROM pages
        ), plain AS (
            SELECT page_id, url, regexp_replace(regexp_replace(a, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS p FROM article
        ), decoded AS (
            SELECT page_id, url, regexp_replace(replace(p, '&quot;', '"'), '&amp;?', '&', 'g') AS d FROM plain
        ), spaced AS (
            SELECT page_id, url, trim(regexp_replace(d, '\s+', ' ', 'g')) AS text FROM decoded
        )
        SELECT page_id, url, text, length(text) AS n_chars FROM spaced
    """,
    "op7_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\x0c\r]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS s FROM w WHERE len(w) > 0
        ), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        near AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
        ), edge AS (
            SELECT u, v FROM near JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v WHERE 100 * c >= 90 * (x.n + y.n - c)
        ), reach AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.v, r.root FROM reach r JOIN edge e ON e.u = r.id),
        least AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
        FROM documents d LEFT JOIN size USING (doc_id) JOIN least ON least.id = d.doc_id
    """,
    "op11_collocations": r"""
        WITH piece AS (
            SELECT coalesce(lang, 'und') AS lang,
                unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS p
            FROM documents
        ), words AS (
            SELECT lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') AS w FROM piece
        ), size AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
        part AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
            FROM words, range(1, 5) AS ks(k) WHERE len(w) >= k
        ), f AS (SELECT lang, k, phrase, count(*) AS f FROM part GROUP BY ALL HAVING count(*) >= 30),
        longer AS (
            SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:k - 1], ' '), array_to_string(string_split(phrase, ' ')[2:k], ' ')]) AS phrase, f
            FROM f WHERE k > 2
        ), above AS (SELECT lang, phrase, max(f) AS g FROM longer GROUP BY ALL),
        cut AS (
            SELECT f.*, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS head, array_to_string(string_split(phrase, ' ')[c + 1:k], ' ') AS tail
            FROM f LEFT JOIN above USING (lang, phrase), range(1, 4) AS cs(c)
            WHERE k > 1 AND c < k AND (g IS NULL OR 100 * g < 80 * f)
        ), scored AS (
            SELECT cut.lang, cut.phrase, cut.f AS a, c, x.f AS l, y.f AS r, ((2000000::HUGEINT * cut.f) // (x.f + y.f))::BIGINT AS score
            FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = tail
        ), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM best JOIN size USING (lang) QUALIFY rank <= 2000
    """,
    "op12_minhash_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\x0c\r]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0
        ), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        near AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
        ), edge AS (
            SELECT u, v FROM near JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)
        ), reach AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.v, r.root FROM reach r JOIN edge e ON e.u = r.id),
        least AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d LEFT JOIN size USING (doc_id) JOIN least ON least.id = d.doc_id
    """,
    "op13_prefix_trie": r"""
        WITH RECURSIVE turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
                coalesce(role, '') AS role, coalesce(text, '') AS txt
            FROM conversations WHERE conv_id IS NOT NULL
        ), crc AS (
            SELECT conv_id, 4294967295::BIGINT AS c, conv_id::VARCHAR AS left_over, 0 AS bit FROM (SELECT DISTINCT conv_id FROM turns)
            UNION ALL
            SELECT conv_id,
                CASE WHEN bit > 0 THEN xor(c >> 1, (c & 1) * 3988292384) ELSE xor(c, ascii(left_over)) END,
                CASE WHEN bit = 8 THEN left_over[2:] ELSE left_over END, (bit + 1) % 9
            FROM crc WHERE left_over <> ''
        ), conv AS (
            SELECT conv_id, xor(c, 4294967295) % 6 AS h, conv_id - conv_id % 100 AS head FROM crc WHERE left_over = ''
        ), step AS (
            SELECT conv.conv_id, place, role, txt FROM conv JOIN turns ON turns.conv_id = head AND place < h
            UNION ALL SELECT conv.conv_id, place, role, txt FROM conv JOIN turns ON turns.conv_id = conv.conv_id AND place >= h
        ), whole AS (
            SELECT conv_id, coalesce(list({'r': role, 't': txt} ORDER BY place) FILTER (WHERE place IS NOT NULL), []) AS s
            FROM conv LEFT JOIN step USING (conv_id) GROUP BY conv_id
        ), member AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM whole),
        node AS (
            SELECT s[1:d] AS p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(CASE WHEN d > 0 THEN length(s[d].t) ELSE 0 END) AS chars,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(s) = d), '')) AS ends_sha256
            FROM member GROUP BY ALL
        ), kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
        full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (p)),
        upward AS (SELECT p[1:d] AS p, n_children, (n_convs - 1) * chars AS own FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_node)),
        total AS (SELECT p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own)::BIGINT AS saved_tokens FROM upward GROUP BY p)
        SELECT a.conv_id, a.depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens, a.ends_sha256
        FROM full_node a JOIN total USING (p) LEFT JOIN full_node b ON a.depth > 0 AND b.p = a.p[1:a.depth - 1] AND b.depth = a.depth - 1
    """,
    "op9_decontamination": f"""
        WITH d AS ({_SHINGLES.format(id='doc_id', table='documents')}),
        b AS ({_SHINGLES.format(id='item_id', table='benchmark')}),
        ds AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(n - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d),
        bs AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(n - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b),
        size AS (SELECT id, count(*)::INT AS item_size FROM bs GROUP BY id)
        SELECT ds.id AS doc_id, bs.id AS item_id, count(*) AS n_shared, any_value(item_size) AS item_size,
            count(*) / any_value(item_size) AS containment
        FROM bs JOIN ds USING (s) JOIN size ON size.id = bs.id
        GROUP BY ds.id, bs.id HAVING 5 * count(*) >= 4 * any_value(item_size)
    """,
    "op4_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), escaped AS (
            SELECT *, length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), '</role>', '<\/role>'))
                    + length(replace(replace(replace(replace(txt, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), '</role>', '<\/role>'))
                    + length('### ') + length('</role>') + length('</turn>') + 1 AS size
            FROM turns
        )
        SELECT conv_id,
            count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || txt || chr(10), '' ORDER BY turn, role, txt)) AS turns_sha256,
            coalesce(sum(length(txt)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(txt, '' ORDER BY turn, role, txt) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            sum(size)::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
}
