"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from hotrank.llm.ann import op2_nearest
from hotrank.llm.bpe import op10_bpe
from hotrank.llm.chat import op5_chat_format
from hotrank.llm.collocations import op11_collocations
from hotrank.llm.licenses import op1_license_scan
from hotrank.llm.divergence import op12_source_divergence
from hotrank.llm.exact_dedup import op13_exact_dedup
from hotrank.llm.lm import op6_lm_scores
from hotrank.llm.mixing import op7_mix_sources
from hotrank.llm.near_dedup import op9_near_dedup
from hotrank.llm.substring_dedup import op8_substring_dedup
from hotrank.llm.topk import op3_top_products
from hotrank.llm.toxicity import op4_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_nearest, op3_top_products, op4_toxicity, op5_chat_format,
        op6_lm_scores, op7_mix_sources, op8_substring_dedup, op9_near_dedup, op10_bpe, op11_collocations, op12_source_divergence,
        op13_exact_dedup,
    )
}

_TOP_PRODUCTS = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_inner_product(q.w::DOUBLE[], c.w::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
       AS rank, vec_id, score
FROM s
QUALIFY rank <= 20
"""

# Marks are 5+6 characters for a user, 7+8 for the system, 3+4 for an assistant.
_CHAT = r"""
WITH t AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn))
           AS loss_sha256,
       sum(length(text) + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 ELSE 7 END
           + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]|\[:\]')))::BIGINT
           AS formatted_chars
FROM t GROUP BY conv_id
"""

_SUBSTRINGS = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), later AS (
    SELECT doc_id, i FROM s
    QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_DIVERGENCE = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), t AS (
    SELECT id, lang, source, unnest(w) AS term FROM d
), kept AS (
    SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3
), langs AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), c AS (
    SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT lang, source, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM d)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
    FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), ranked AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 200
"""

_COPIES = """
WITH d AS (
    SELECT doc_id, sha256(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
    FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h)
"""

# Each phrase's counts come from all runs of one to four words within a piece.
_PHRASES = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS id, lang, piece FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), words AS (
    SELECT id, lang, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i
    FROM (SELECT id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces)
), next AS (
    SELECT lang, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
    FROM words WINDOW p AS (PARTITION BY id ORDER BY i)
), runs AS (
    SELECT lang, [w] AS words, count(*) AS f FROM next GROUP BY lang, w
    UNION ALL
    SELECT lang, [w, w2], count(*) FROM next WHERE w2 IS NOT NULL GROUP BY lang, w, w2 HAVING count(*) >= 30
    UNION ALL
    SELECT lang, [w, w2, w3], count(*) FROM next WHERE w3 IS NOT NULL
    GROUP BY lang, w, w2, w3 HAVING count(*) >= 30
    UNION ALL
    SELECT lang, [w, w2, w3, w4], count(*) FROM next WHERE w4 IS NOT NULL
    GROUP BY lang, w, w2, w3, w4 HAVING count(*) >= 30
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM runs WHERE len(words) = 1 GROUP BY lang
), found AS (
    SELECT lang, words, f AS a FROM runs WHERE len(words) > 1 AND f >= 30
), cut AS (
    SELECT c.lang, c.words, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
    FROM found c, (VALUES (1), (2), (3)) AS cuts(k)
    JOIN runs x ON x.lang = c.lang AND x.words = c.words[:k]
    JOIN runs y ON y.lang = c.lang AND y.words = c.words[k + 1 :]
    WHERE k < len(c.words)
), scored AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), held AS (
    SELECT DISTINCT s.lang, s.words
    FROM found s JOIN (
        SELECT lang, words, a, unnest(range(1, len(words))) AS i FROM found WHERE len(words) > 2
    ) b ON b.lang = s.lang AND len(b.words) > len(s.words)
       AND b.words[i : i + len(s.words) - 1] = s.words AND 100 * b.a >= 80 * s.a
), ranked AS (
    SELECT lang, row_number() OVER (
               PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' '))::BIGINT AS rank,
           array_to_string(words, ' ') AS phrase, a, l, r, score::BIGINT AS score
    FROM scored ANTI JOIN held USING (lang, words)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op3_top_products": _TOP_PRODUCTS,
    "op5_chat_format": _CHAT,
    "op8_substring_dedup": _SUBSTRINGS,
    "op11_collocations": _PHRASES,
    "op12_source_divergence": _DIVERGENCE,
    "op13_exact_dedup": _COPIES,
}
