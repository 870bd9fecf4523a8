"""Registered queries of the training-data operators: thin calls with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from captally.llm import chat_format, collocations, decontamination, language_id, license_scan, lm_scoring, mixing, pii, prefix_trie, quality_rules, simhash_dedup, suffix_dedup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of all sources takes of every document."""
    return mixing.mix_report(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings that repeat."""
    return suffix_dedup.repeat_report(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language_id.identify_languages(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality_rules.quality_verdicts(documents(spark, sf_dir))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered turns of the conversations that are no prefix of another."""
    return chat_format.chat_format(table(spark, sf_dir, "conversations"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word unigram and subword lattice log10 probabilities of every document."""
    return lm_scoring.score_texts(documents(spark, sf_dir))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash_dedup.near_duplicates(documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with a verified overlap."""
    found = decontamination.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_matches", "n_overlap", "first_word")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts and digest, and all spans."""
    return pii.find_pii(documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the rebuilt conversations, a row per node."""
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie_report(prefix_trie.rebuilt(turns))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages written as WARC archives and read back."""
    return warc.page_report(table(spark, sf_dir, "pages"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-scoring phrases of each language."""
    return collocations.collocations(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_suffix_dedup,
        op3_language_id,
        op4_quality_rules,
        op5_chat_format,
        op6_lm_scoring,
        op7_simhash_dedup,
        op8_decontamination,
        op9_license_scan,
        op10_pii,
        op11_prefix_trie,
        op12_warc,
        op13_collocations,
    )
}

# SQL states the operators whose result is defined by the rows alone; the
# others are compared with brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op2_suffix_dedup": """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT rid, p, md5(substr(h, 2 * p + 1, 400)) AS s
  FROM (SELECT rid, h, unnest(range(len(h) // 2 - 199)) AS p FROM d WHERE len(h) >= 400)
), r AS (
  SELECT s FROM w GROUP BY s HAVING count(*) > 1
), g AS (
  SELECT rid, p, CASE WHEN p - lag(p) OVER (PARTITION BY rid ORDER BY p) <= 200 THEN 0 ELSE 1 END AS new
  FROM w SEMI JOIN r USING (s)
), i AS (
  SELECT rid, p, sum(new) OVER (PARTITION BY rid ORDER BY p) AS k FROM g
), spans AS (
  SELECT rid, min(p) AS lo, max(p) + 200 AS hi FROM i GROUP BY rid, k
), pieces AS (
  SELECT rid, lo, hi, coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0) AS before FROM spans
), cut AS (
  SELECT p.rid, count(*) AS n_spans, sum(p.hi - p.lo) AS n_removed, max(p.hi) AS last,
         string_agg(substr(d.h, 2 * p.before + 1, 2 * (p.lo - p.before)), '' ORDER BY p.lo) AS kept
  FROM pieces p JOIN d USING (rid) GROUP BY p.rid
)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(c.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(c.kept, '') || substr(d.h, 2 * coalesce(c.last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut c USING (rid)
""",
    "op5_chat_format": """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), p AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM t
), c AS (
  SELECT conv_id, count(*) AS n_turns, list(role || chr(31) || text ORDER BY pos) AS turns FROM p GROUP BY conv_id
), k AS (
  SELECT a.conv_id, a.n_turns FROM c a
  WHERE NOT EXISTS (
    SELECT 1 FROM c b
    WHERE b.turns[1] = a.turns[1] AND b.n_turns >= a.n_turns AND b.turns[1:a.n_turns] = a.turns
      AND (b.n_turns > a.n_turns OR b.conv_id < a.conv_id)
  )
)
SELECT p.conv_id, p.pos, k.n_turns, p.turn,
       '<|im_start|>' || p.role || chr(10) || p.text || '<|im_end|>' || chr(10) AS rendered
FROM p JOIN k ON k.conv_id = p.conv_id
""",
    "op11_prefix_trie": """
WITH RECURSIVE crc_bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_bits WHERE k < 8
), crc_table AS (
  SELECT i, v FROM crc_bits WHERE k = 8
), own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, count(*) AS n FROM own GROUP BY conv_id
), crc(conv_id, s, k, v) AS (
  SELECT conv_id, s, 0, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT c.conv_id, c.s, c.k + 1, xor(c.v >> 8, t.v)
  FROM crc c JOIN crc_table t ON t.i = xor(c.v, ascii(substr(c.s, c.k + 1, 1))) & 255 WHERE c.k < len(c.s)
), hs AS (
  SELECT conv_id, xor(v, 4294967295) % 9 AS h, conv_id - conv_id % 5 AS base FROM crc WHERE k = len(s)
), rows_ AS (
  SELECT hs.conv_id, 0 AS side, o.pos, o.role, o.text FROM hs JOIN own o ON o.conv_id = hs.base AND o.pos < hs.h
  UNION ALL
  SELECT hs.conv_id, 1, o.pos, o.role, o.text FROM hs JOIN own o ON o.conv_id = hs.conv_id AND o.pos >= hs.h
), seqs AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY side, pos) AS q FROM rows_ GROUP BY conv_id
), convs AS (
  SELECT ids.conv_id, coalesce(q, []) AS q FROM ids LEFT JOIN seqs USING (conv_id)
), members AS (
  SELECT conv_id, d AS depth, q[1:d] AS path, len(q) = d AS ended FROM (SELECT conv_id, q, unnest(range(len(q) + 1)) AS d FROM convs)
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '') AS ends
  FROM members GROUP BY path, depth
), kids AS (
  SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), full_ AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.path[n.depth].t) END AS saved
  FROM nodes n LEFT JOIN kids k ON k.path = n.path AND k.depth = n.depth
), up AS (
  SELECT path[1:d] AS path, d AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_) GROUP BY ALL
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_ f JOIN up u ON u.path = f.path AND u.depth = f.depth
LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.path = f.path[1:f.depth - 1]
""",
    "op12_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages
), m AS (
  SELECT h, max(page_id) AS first_id FROM p GROUP BY h
)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT) >> s) & 31 AS INTEGER), 1)),
         'string_agg', '')), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id < first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first_id THEN first_id END AS refers_to
FROM p JOIN m USING (h)
""",
    "op13_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS did,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), w AS (
  SELECT lang, did, pid, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
  FROM (SELECT lang, did, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pid FROM p)
), tot AS (
  SELECT lang, CAST(sum(len(ws)) AS HUGEINT) AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) v(k))
), f AS (
  SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), cand AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS t, f AS a FROM f WHERE k >= 2
), cuts AS (
  SELECT c.lang, c.phrase, c.a, tot.n, j, x.f AS l, y.f AS r, 1000 * c.a * tot.n // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.t[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.t[j + 1:], ' ')
  JOIN tot ON tot.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_ AS (
  SELECT lang, array_to_string(t[i:i + s - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT lang, t, a, s, unnest(range(1, k - s + 2)) AS i FROM cand, (VALUES (2), (3), (4)) v(s) WHERE s < k)
  GROUP BY ALL
), kept AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN inner_ i USING (lang, phrase) WHERE i.around IS NULL OR 100 * i.around < 100 * b.a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score FROM kept WHERE rank <= 2000
""",
}
