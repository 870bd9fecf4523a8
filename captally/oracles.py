"""DuckDB statements that compute the same results as ``captally.queries``.

They are the correctness oracle: the driver runs each one on the same
parquet tables and compares row count, schema and values with the Spark
result.  The stand-in captioner's rule and the fixture's files are stated in
SQL too, so every query has an entry.
"""

from __future__ import annotations

# Python's str.isspace() set as an RE2 class (same text as the Spark side).
WS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _ws_tokens(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WS}+'), lambda w: w <> '')"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def _first_sentence(c: str) -> str:
    return f"(CASE WHEN strpos({c}, '.') > 0 THEN split_part({c}, '.', 1) || '.' ELSE {c} END)"


def _lcs(c: str, r: str) -> str:
    """LCS length of token lists c and r: one DP row per token of r.

    new[i] = max(old[i], old[k-1] + 1) with k the last match of the token at
    or before i (rows are non-decreasing, so that is the whole recurrence).
    """
    return (
        f"list_reduce({r}, lambda a, tok: CASE WHEN NOT list_contains({c}, tok) THEN a ELSE "
        f"(list_transform([list_filter(range(1, len({c}) + 1), lambda k: {c}[k] = tok)], lambda P: "
        f"[0] || list_transform(range(1, len({c}) + 1), lambda i: greatest(a[i + 1], "
        f"coalesce(a[list_max(list_filter(P, lambda k: k <= i))] + 1, 0)))))[1] END, "
        f"list_transform(range(len({c}) + 1), lambda x: 0))[len({c}) + 1]"
    )


def _ngrams(t: str) -> str:
    return f"unnest(list_transform(range(1, len({t}) - n + 2), lambda i: array_to_string({t}[i:i + n - 1], ' ')))"


DOCS = r"""
docs AS (
  SELECT doc_id, lang, text,
         list_filter(list_transform(regexp_split_to_array(text, '[.\n]'), lambda s: trim(s)), lambda s: s <> '') AS sents
  FROM documents),
arr AS (
  SELECT doc_id, 'img' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.jpg' AS image, sents
  FROM docs WHERE len(sents) >= 1),
refs AS (SELECT image, unnest(range(len(sents))) AS pos, unnest(sents) AS caption FROM arr),
raw AS (
  SELECT image, doc_id, sents,
         ' ' || array_to_string(list_filter(string_split(sents[1], ' '), lambda t, i: (i - 1) % 5 <> 4), ' ')
         || '. ' || coalesce(sents[2], '') || '. ' AS raw
  FROM arr)
"""

PREDS = f"""
stripped AS (SELECT image, doc_id, sents, {_strip('raw')} AS s FROM raw),
preds AS (SELECT image, doc_id, {_first_sentence('s')} AS caption FROM stripped),
beam AS (SELECT image, s AS caption FROM stripped),
spreds AS (SELECT image, regexp_replace(caption, '[.]$', '') AS caption FROM preds)
"""

MANIFEST = r"""
man AS (
  SELECT 'img' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.jpg' AS image,
         CASE lang WHEN 'en' THEN 'train' WHEN 'es' THEN 'val' WHEN 'fr' THEN 'test' WHEN 'de' THEN 'test' END AS split,
         sents
  FROM docs)
"""

POSITIONAL = """
imgs AS (SELECT DISTINCT image FROM refs),
nimgs AS (SELECT count(*) AS n FROM imgs),
ranked AS (SELECT image, row_number() OVER (ORDER BY image) - 1 AS ordinal FROM imgs),
plabels AS (
  SELECT image, ordinal,
         CASE WHEN ordinal < (SELECT n * 6 // 10 FROM nimgs) THEN 'train'
              WHEN ordinal < (SELECT n * 6 // 10 + n * 2 // 10 FROM nimgs) THEN 'val'
              ELSE 'test' END AS split
  FROM ranked)
"""


def _metric_ctes(pred_cte: str, refs_cte: str = "refs") -> str:
    """Per-image BLEU, ROUGE-L and CIDEr statistics for predictions in ``pred_cte``."""
    return f"""
cand AS (SELECT image, {_ws_tokens('caption')} AS t, string_split(caption, ' ') AS ts FROM {pred_cte}
         WHERE image IN (SELECT image FROM {refs_cte})),
rtok AS (SELECT image, pos, {_ws_tokens('caption')} AS t, string_split(caption, ' ') AS ts FROM {refs_cte}
         WHERE image IN (SELECT image FROM cand)),
cg AS (SELECT image, n, g, count(*) AS cnt
       FROM (SELECT image, n, {_ngrams('t')} AS g FROM cand, (VALUES (1), (2), (3), (4)) v(n)) GROUP BY ALL),
rg AS (SELECT image, pos, n, g, count(*) AS cnt
       FROM (SELECT image, pos, n, {_ngrams('t')} AS g FROM rtok, (VALUES (1), (2), (3), (4)) v(n)) GROUP BY ALL),
rmax AS (SELECT image, n, g, max(cnt) AS mx, count(*) AS nref FROM rg GROUP BY ALL),
clip AS (
  SELECT c.image,
         sum(CASE WHEN c.n = 1 THEN least(c.cnt, r.mx) END) AS c1,
         sum(CASE WHEN c.n = 2 THEN least(c.cnt, r.mx) END) AS c2,
         sum(CASE WHEN c.n = 3 THEN least(c.cnt, r.mx) END) AS c3,
         sum(CASE WHEN c.n = 4 THEN least(c.cnt, r.mx) END) AS c4
  FROM cg c JOIN rmax r USING (image, n, g) GROUP BY c.image),
pairs AS (
  SELECT r.image, r.pos, len(c.t) AS clen, len(r.t) AS rlen, len(c.ts) AS cs, len(r.ts) AS rs,
         {_lcs('c.ts', 'r.ts')} AS lcs
  FROM rtok r JOIN cand c USING (image)),
pstat AS (
  SELECT image, count(*) AS nrefs, max(clen) AS clen, min({{'d': abs(rlen - clen), 'l': rlen}}).l AS closest,
         max(lcs / cs) AS pm, max(lcs / rs) AS rm
  FROM pairs GROUP BY image),
stat AS (
  SELECT p.image, p.nrefs, p.clen, p.closest, p.pm, p.rm,
         CAST(coalesce(k.c1, 0) AS DOUBLE) AS c1, CAST(coalesce(k.c2, 0) AS DOUBLE) AS c2,
         CAST(coalesce(k.c3, 0) AS DOUBLE) AS c3, CAST(coalesce(k.c4, 0) AS DOUBLE) AS c4,
         CAST(greatest(p.clen, 0) AS DOUBLE) AS g1, CAST(greatest(p.clen - 1, 0) AS DOUBLE) AS g2,
         CAST(greatest(p.clen - 2, 0) AS DOUBLE) AS g3, CAST(greatest(p.clen - 3, 0) AS DOUBLE) AS g4
  FROM pstat p LEFT JOIN clip k USING (image)),
nimg AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM cand),
dfq AS (SELECT n, g, count(*) AS df FROM rmax GROUP BY n, g),
cvec AS (SELECT c.image, c.n, c.g, c.cnt * (ln((SELECT n FROM nimg)) - ln(greatest(coalesce(d.df, 0), 1))) AS wc
         FROM cg c LEFT JOIN dfq d USING (n, g)),
cnorm AS (SELECT image, n, sqrt(sum(wc * wc)) AS nc FROM cvec GROUP BY ALL),
rvec AS (SELECT r.image, r.pos, r.n, r.g, r.cnt * (ln((SELECT n FROM nimg)) - ln(greatest(d.df, 1))) AS wr
         FROM rg r JOIN dfq d USING (n, g)),
rnorm AS (SELECT image, pos, n, sqrt(sum(wr * wr)) AS nr FROM rvec GROUP BY ALL),
num AS (SELECT r.image, r.pos, r.n, sum(least(c.wc, r.wr) * r.wr) AS num
        FROM rvec r JOIN cvec c USING (image, n, g) GROUP BY ALL),
vals AS (
  SELECT rn.image, rn.pos,
         sum(CASE WHEN coalesce(nm.num, 0) > 0 THEN nm.num / (cn.nc * rn.nr) ELSE 0 END) AS v
  FROM rnorm rn LEFT JOIN num nm USING (image, pos, n) LEFT JOIN cnorm cn USING (image, n) GROUP BY ALL),
cref AS (
  SELECT p.image, coalesce(v.v, 0) / 4 * exp(-power(greatest(p.clen - 1, 0) - greatest(p.rlen - 1, 0), 2) / 72.0) AS s
  FROM pairs p LEFT JOIN vals v USING (image, pos)),
cider_img AS (SELECT image, sum(s) AS cs FROM cref GROUP BY image),
per AS (
  SELECT s.*, CAST(s.clen AS DOUBLE) AS tl, CAST(s.closest AS DOUBLE) AS rl,
         CASE WHEN s.pm <> 0 AND s.rm <> 0 THEN (1 + 1.44) * s.pm * s.rm / (s.rm + 1.44 * s.pm) ELSE 0 END AS rouge_l,
         coalesce(c.cs, 0) / s.nrefs * 10.0 AS cider
  FROM stat s LEFT JOIN cider_img c USING (image))
"""


def _bleu_exprs(c, g, tl, rl) -> list[str]:
    ratio = f"((({tl}) + 1e-15) / (({rl}) + 1e-9))"
    bp = f"(CASE WHEN {ratio} < 1 THEN exp(1 - 1 / {ratio}) ELSE 1.0 END)"
    out, prod = [], "1.0"
    for k in range(1, 5):
        prod = f"{prod} * (({c(k)}) + 1e-15) / (({g(k)}) + 1e-9)"
        out.append(f"pow({prod}, 1.0 / {k}) * {bp}")
    return out


_PER_IMAGE_BLEU = _bleu_exprs(lambda k: f"c{k}", lambda k: f"g{k}", "tl", "rl")

CORPUS = """
tot AS (
  SELECT sum(c1) AS c1, sum(c2) AS c2, sum(c3) AS c3, sum(c4) AS c4,
         sum(g1) AS g1, sum(g2) AS g2, sum(g3) AS g3, sum(g4) AS g4,
         CAST(sum(clen) AS DOUBLE) AS tl, CAST(sum(closest) AS DOUBLE) AS rl,
         avg(rouge_l) AS rouge_l, avg(cider) AS cider
  FROM per),
corpus AS (
  SELECT metric, score FROM (
    SELECT {b1} AS Bleu_1, {b2} AS Bleu_2, {b3} AS Bleu_3, {b4} AS Bleu_4, rouge_l AS ROUGE_L, cider AS CIDEr FROM tot
  ) UNPIVOT (score FOR metric IN (Bleu_1, Bleu_2, Bleu_3, Bleu_4, ROUGE_L, CIDEr)))
""".format(**{f"b{k}": e for k, e in zip(range(1, 5), _bleu_exprs(lambda k: f"c{k}", lambda k: f"g{k}", "tl", "rl"))})


# The same without ROUGE-L, for statements that need no LCS.
CORPUS_OF_GRAMS = CORPUS.replace(",\n         avg(rouge_l) AS rouge_l, avg(cider)", ",\n         avg(cider)").replace("rouge_l AS ROUGE_L, ", "").replace("ROUGE_L, ", "")


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts)


def _metrics(pred_cte: str = "spreds") -> str:
    return _with(DOCS, PREDS, _metric_ctes(pred_cte), CORPUS)


def _gram_metrics(pred_cte: str = "spreds") -> str:
    return _with(DOCS, PREDS, _metric_ctes(pred_cte), CORPUS_OF_GRAMS)


# Caption tokens (STR-7) stated on their own, as ordered alternatives for RE2: the
# engine itself walks a transition table.  Cut-off suffixes get a U+0001 for
# their apostrophe first, so a stray quote is never read as one.
_A = r"[\p{L}\p{N}\p{M}]"
_NOT_A = r"[^\p{L}\p{N}\p{M}]"
_CUT_WORDS = ["can not", "gon na", "got ta", "wan na", "gim me", "lem me"]
_ABBREVIATED = (
    "mr|mrs|ms|dr|prof|st|jr|sr|gen|col|sgt|capt|lt|cmdr|gov|sen|rep|rev|hon|pres|inc|corp|ltd|bros|ave|blvd|rd|vs|etc|approx|dept|est|"
    "al|jan|feb|apr|aug|sept|oct|nov|dec"
)
_TOKEN = "|".join(
    [
        r"(?:https?://|www\.)[\p{L}\p{N}\p{M}.,:\-&@/_+?=%#~$*]*[\p{L}\p{N}\p{M}/]",
        r"[\p{L}\p{N}\p{M}][\p{L}\p{N}\p{M}._+\-]*@[\p{L}\p{N}\p{M}]+(?:[-.][\p{L}\p{N}\p{M}]+)+",
        r"n\x{1}t|\x{1}(?:s|re|ve|ll|d|m)",
        r"(?:[a-z]\.)+[a-z]\b\.?",
        rf"(?:{_ABBREVIATED})\.",
        r"[0-9]+(?:[.,:][0-9]+)+",
        rf"{_A}+(?:[-&]{_A}+)*(?:'{_A}+)*",
        r"""[^\p{L}\p{N}\p{M}\p{Z}\p{C}'.,:\-?!;"`()\[\]{}…–—“”„«»‘]""",
    ]
)


def _quoted(t: str) -> str:
    return t.replace("'", "''")


def _caption_tokens(c: str) -> str:
    text = f"replace(lower({c}), '’', chr(39))"
    for two in _CUT_WORDS * 2:  # twice: a match takes the character after it, so it hides a next one
        whole = rf"(^|[^\p{{L}}\p{{N}}\p{{M}}&'-]){two.replace(' ', '')}({_NOT_A}|$)"
        text = f"regexp_replace({text}, '{_quoted(whole)}', '\\1{two}\\2', 'g')"
    text = f"regexp_replace({text}, '{_quoted(rf"({_A})n't({_NOT_A}|$)")}', '\\1 n' || chr(1) || 't \\2', 'g')"
    text = f"regexp_replace({text}, '{_quoted(rf"({_A})'(s|re|ve|ll|d|m)({_NOT_A}|$)")}', '\\1 ' || chr(1) || '\\2 \\3', 'g')"
    return f"list_transform(regexp_extract_all({text}, '{_quoted(_TOKEN)}'), lambda t: replace(t, chr(1), chr(39)))"


def _caption_ctes(pred_cte: str = "spreds", refs_cte: str = "refs") -> str:
    """The same over space-joined caption tokens, made once."""
    ctes = _metric_ctes("c_preds", "c_refs")
    joined = f"array_to_string({_caption_tokens('caption')}, ' ') AS caption"
    return f"""
c_preds AS MATERIALIZED (SELECT image, {joined} FROM {pred_cte}),
c_refs AS MATERIALIZED (SELECT image, pos, {joined} FROM {refs_cte}),
{ctes.strip()}"""


def _caption_metrics() -> str:
    return _with(DOCS, PREDS, _caption_ctes(), CORPUS)


# Status of each document's image file, by its labels (fixtures.image_status).
STATUS = """
st AS (
  SELECT 'img' || lpad(CAST(d.doc_id AS VARCHAR), 8, '0') || '.jpg' AS image, d.text,
         CASE WHEN l.quality = 0 THEN 'missing' WHEN l.toxic = 1 THEN 'error' ELSE 'ok' END AS status
  FROM documents d LEFT JOIN labels l USING (doc_id))
"""

ORACLES: dict[str, str] = {
    "captions_grouped": _with(DOCS) + """
SELECT image, CAST(pos // 64 AS BIGINT) AS chunk, count(*) AS n_captions,
       string_agg(caption, chr(10) ORDER BY pos) AS captions, '/data/images/' || image AS path
FROM refs GROUP BY image, pos // 64""",
    "first_captions": _with(DOCS, MANIFEST) + """
SELECT image, sents[1] AS first_caption, CAST(len(sents) AS BIGINT) AS n_refs FROM man""",
    "positional_split_counts": _with(DOCS, POSITIONAL) + """
SELECT l.split, count(DISTINCT l.image) AS n_images, count(*) AS n_captions
FROM plabels l JOIN refs r USING (image) GROUP BY l.split""",
    "test_split_captions": _with(DOCS, POSITIONAL) + """
SELECT r.image, r.pos, r.caption FROM refs r JOIN plabels l USING (image) WHERE l.split = 'test'""",
    "unique_images": _with(DOCS) + """
SELECT DISTINCT image FROM refs""",
    "image_slice": _with(DOCS, POSITIONAL) + """
SELECT image, ordinal FROM ranked
WHERE ordinal >= (SELECT n // 10 FROM nimgs) AND ordinal < (SELECT n // 5 FROM nimgs)""",
    "caption_token_file": _with(DOCS) + """
SELECT image, pos, caption FROM refs""",
    "split_manifest_file": _with(DOCS, MANIFEST) + """
SELECT image AS filename, split, array_to_string(sents, chr(10)) AS refs, CAST(len(sents) AS BIGINT) AS n_refs FROM man""",
    "caption_csv": _with(DOCS) + """
SELECT image, count(*) AS n_captions, CAST(sum(length(caption)) AS BIGINT) AS n_chars FROM refs GROUP BY image""",
    "json_captions": _with(DOCS, PREDS) + """
SELECT image, CAST(to_json({'image': image, 'captions': [caption || '</s>']}) AS VARCHAR) AS json FROM preds""",
    "image_listing": _with(STATUS) + """
SELECT image, CASE WHEN status = 'ok' THEN 5 ELSE strlen(text) + 1 END AS length FROM st WHERE status <> 'missing'""",
    "image_validity": _with(STATUS) + """
SELECT image, status = 'ok' AS ok, CASE WHEN status = 'ok' THEN 8 ELSE -1 END AS width,
       CASE WHEN status = 'ok' THEN 1 ELSE -1 END AS height FROM st WHERE status <> 'missing'""",
    "image_presence": _with(STATUS) + """
SELECT image, status <> 'missing' AS present FROM st""",
    "duplicate_predictions": _with(DOCS) + """
SELECT image, 2 AS n_predictions FROM arr WHERE len(sents) % 2 = 0""",
    "prediction_id_check": _with(DOCS, STATUS) + """,
known AS (SELECT a.image, s.status <> 'missing' AS k FROM arr a JOIN st s USING (image))
SELECT 'predictions' AS figure, count(*) AS n FROM known
UNION ALL SELECT 'unknown_ids', count(*) FROM known WHERE NOT k
UNION ALL SELECT 'id_collisions', count(*) FROM (
  SELECT substr(sha256(image), 1, 13) AS id FROM known GROUP BY id HAVING count(DISTINCT image) > 1)""",
    "score_coverage": _with(DOCS, STATUS) + """,
ok AS (SELECT 'img' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.jpg' AS image FROM labels
       WHERE quality = 1 AND toxic = 0),
sides AS (SELECT a.image, a.image IN (SELECT image FROM ok) AS p, s.status <> 'missing' AS r FROM arr a JOIN st s USING (image))
SELECT count(*) FILTER (p AND r) AS scored_images, count(*) FILTER (p AND NOT r) AS unreferenced_predictions,
       count(*) FILTER (r AND NOT p) AS unpredicted_images FROM sides""",
    "failed_images": _with(STATUS) + """
SELECT image, status FROM st WHERE status <> 'ok'""",
    "manifest_split_rows": _with(DOCS, MANIFEST) + """
SELECT image, split, CAST(len(sents) AS BIGINT) AS n_refs FROM man WHERE split = 'test'""",
    "image_ordinals": _with(DOCS, POSITIONAL) + """
SELECT image, split, row_number() OVER (PARTITION BY split ORDER BY image) - 1 AS ordinal FROM plabels""",
    "annotation_rows": _with(DOCS) + """
SELECT CAST(('0x' || substr(sha256(image), 1, 13)) AS BIGINT) AS image_id,
       row_number() OVER (ORDER BY image, pos) - 1 AS id, caption FROM refs""",
    "clean_captions": _with(DOCS, PREDS) + """
SELECT image, caption FROM preds""",
    "token_key_split": _with(DOCS) + """,
lines AS (SELECT image || '#' || CAST(pos AS VARCHAR) || chr(9) || caption AS value FROM refs)
SELECT split_part(split_part(value, chr(9), 1), '#', 1) AS image,
       CAST(split_part(split_part(value, chr(9), 1), '#', 2) AS BIGINT) AS pos,
       substr(value, strpos(value, chr(9)) + 1) AS caption
FROM lines""",
    "latest_predictions": _with(DOCS, PREDS) + """,
att AS (
  SELECT image, 0 AS pos, s AS caption FROM stripped
  UNION ALL
  SELECT p.image, 1 AS pos, p.caption FROM preds p JOIN arr a USING (image) WHERE len(a.sents) % 2 = 0)
SELECT image, arg_max(caption, pos) AS caption, count(*) AS attempts FROM att GROUP BY image""",
    "paired_captions": _with(DOCS, PREDS) + """
SELECT r.image, r.pos, r.caption, p.caption AS prediction FROM refs r JOIN spreds p USING (image)""",
    "references_for_predicted": _with(DOCS, PREDS) + """,
ok AS (SELECT 'img' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.jpg' AS image FROM labels
       WHERE quality = 1 AND toxic = 0)
SELECT image, pos, caption FROM refs
WHERE image IN (SELECT image FROM preds WHERE image IN (SELECT image FROM ok))""",
    "unknown_prediction_ids": _with(DOCS, STATUS) + """
SELECT CAST(('0x' || substr(sha256(image), 1, 13)) AS BIGINT) AS image_id, image
FROM arr JOIN st USING (image) WHERE status = 'missing'""",
    "caption_tokens": _with(DOCS) + f""",
tk AS (SELECT image, pos, {_caption_tokens('caption')} AS t FROM refs)
SELECT image, pos, array_to_string(t, ' ') AS tokens, CAST(len(t) AS BIGINT) AS n_tokens FROM tk""",
    "document_tokens": f"""
WITH tk AS (SELECT doc_id, {_caption_tokens("coalesce(text, '')")} AS t FROM documents
            UNION ALL SELECT -1 - item_id, {_caption_tokens("coalesce(text, '')")} FROM benchmark
            UNION ALL SELECT -1000000000 - conv_id * 1000 - turn, {_caption_tokens("coalesce(text, '')")} FROM conversations)
SELECT doc_id, array_to_string(t, ' ') AS tokens, CAST(len(t) AS BIGINT) AS n_tokens FROM tk""",
    "failures_by_status": """
WITH st AS (
  SELECT CASE WHEN l.quality = 0 THEN 'missing' WHEN l.toxic = 1 THEN 'error' ELSE 'ok' END AS status
  FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT status, count(*) AS n FROM st GROUP BY status""",
    "caption_images_stub": f"""
WITH st AS (
  SELECT 'img' || lpad(CAST(d.doc_id AS VARCHAR), 8, '0') || '.jpg' AS image, d.text,
         CASE WHEN l.quality = 0 THEN 'missing' WHEN l.toxic = 1 THEN 'error' ELSE 'ok' END AS status
  FROM documents d LEFT JOIN labels l USING (doc_id)),
head AS (SELECT image, status, {_strip("split_part(replace(text, chr(10), ' '), '.', 1)")} || '.' AS h FROM st)
SELECT image, CASE WHEN status = 'ok' THEN {_first_sentence(_strip('h'))} END AS caption, status FROM head""",
    "ngram_counts": _metrics() + """
SELECT image, 'candidate' AS side, CAST(NULL AS BIGINT) AS pos, CAST(n AS BIGINT) AS n, g, cnt FROM cg
UNION ALL SELECT image, 'reference', pos, n, g, cnt FROM rg""",
    "document_frequency": _metrics() + """
SELECT CAST(n AS BIGINT) AS n, g, df FROM dfq""",
    "bleu_corpus": _gram_metrics() + """
SELECT metric, round(score, 6) AS score FROM corpus WHERE metric LIKE 'Bleu_%'""",
    "bleu_per_image": _metrics() + "\nSELECT image, "
    + ", ".join(f"round({e}, 6) AS bleu_{k}" for k, e in zip(range(1, 5), _PER_IMAGE_BLEU))
    + " FROM per",
    "rouge_l_per_image": _metrics() + """
SELECT image, round(rouge_l, 6) AS rouge_l FROM per""",
    "rouge_l_corpus": _metrics() + """
SELECT metric, round(score, 6) AS score FROM corpus WHERE metric = 'ROUGE_L'""",
    "cider_per_image": _metrics() + """
SELECT image, round(cider, 6) AS cider FROM per""",
    "cider_corpus": _gram_metrics() + """
SELECT metric, round(score, 6) AS score FROM corpus WHERE metric = 'CIDEr'""",
    "caption_scores": _metrics() + """
SELECT metric, round(score, 6) AS score FROM corpus""",
    "caption_scores_ptb": _caption_metrics() + """
SELECT metric, round(score, 6) AS score FROM corpus""",
    "score_lines": _gram_metrics() + """
SELECT metric, round(score * 100, 2) AS value, metric || ': ' || printf('%.2f', round(score * 100, 2)) AS line FROM corpus""",
    "qualitative_rows": _with(DOCS, PREDS, POSITIONAL) + """,
test AS (SELECT image, row_number() OVER (ORDER BY image) - 1 AS idx FROM plabels WHERE split = 'test'),
size AS (SELECT count(*) AS n FROM test),
wanted AS (SELECT n * 3 // 4 AS idx, 0 AS slot FROM size UNION ALL SELECT n // 10, 1 FROM size
           UNION ALL SELECT n // 2, 2 FROM size UNION ALL SELECT n, 3 FROM size),
firstref AS (SELECT image, arg_min(caption, pos) AS reference FROM refs GROUP BY image)
SELECT CAST(w.slot AS BIGINT) AS slot, CAST(w.idx AS BIGINT) AS idx, t.image IS NOT NULL AS found, t.image, f.reference,
       p.caption AS prediction,
       'ID: ' || CAST(w.idx AS VARCHAR) || chr(10) || 'Pred: ' || coalesce(p.caption, 'null') AS title
FROM wanted w LEFT JOIN test t ON t.idx = w.idx LEFT JOIN firstref f USING (image) LEFT JOIN preds p USING (image)""",
}


def _training_sql() -> str:
    prompt_tokens = "['Write', 'a', 'short', 'description', 'for', 'the', 'image.']"
    return _with(DOCS, MANIFEST, STATUS) + f""",
train AS (SELECT man.image, sents[1] AS caption FROM man JOIN st USING (image)
          WHERE split = 'train' AND sents[1] IS NOT NULL AND status = 'ok'),
vocab AS (SELECT token, CAST(dense_rank() OVER (ORDER BY token) + 2 AS INTEGER) AS id
          FROM (SELECT DISTINCT unnest({_ws_tokens('caption')}) AS token FROM train)),
ctok AS (SELECT image, unnest(range(len(t))) AS i, unnest(t) AS token
         FROM (SELECT image, {_ws_tokens('caption')} AS t FROM train)),
cids AS (SELECT c.image, list(coalesce(v.id, 0) ORDER BY c.i) AS ids FROM ctok c LEFT JOIN vocab v USING (token)
         GROUP BY c.image),
cap AS (SELECT t.image, [1] || coalesce(c.ids, []) || [2] AS cap FROM train t LEFT JOIN cids c USING (image)),
ptok AS (SELECT unnest(range(len(t))) AS i, unnest(t) AS token FROM (SELECT {prompt_tokens} AS t)),
pids AS (SELECT [1] || list(coalesce(v.id, 0) ORDER BY p.i) AS p FROM ptok p LEFT JOIN vocab v USING (token)),
ex AS (
  SELECT image, p,
         p || cap[1:32] || list_transform(range(greatest(32 - len(cap), 0)), lambda x: 2) AS input_ids,
         list_transform(range(len(p)), lambda x: 1) || list_transform(range(least(len(cap), 32)), lambda x: 1)
           || list_transform(range(greatest(32 - len(cap), 0)), lambda x: 0) AS attention_mask
  FROM cap, pids),
examples AS (
  SELECT image, input_ids, attention_mask,
         list_transform(input_ids, lambda x, i: CASE WHEN i - 1 < len(p) OR x = 2 THEN -100 ELSE x END) AS labels,
         list_transform(input_ids, lambda x, i: CASE WHEN i - 1 < len(p) OR attention_mask[i] = 0 THEN -100 ELSE x END) AS end_labels
  FROM ex)
"""


ORACLES["training_examples"] = _training_sql() + """
SELECT image, array_to_string(input_ids, ',') AS input_ids, array_to_string(attention_mask, ',') AS attention_mask,
       array_to_string(labels, ',') AS labels FROM examples"""
ORACLES["usable_samples"] = _training_sql() + """
SELECT image, caption FROM train"""
ORACLES["training_labels_with_end"] = _training_sql() + """
SELECT image, array_to_string(end_labels, ',') AS labels FROM examples"""
ORACLES["training_batches"] = _training_sql() + """,
ord AS (SELECT image, row_number() OVER (ORDER BY image) - 1 AS o FROM examples)
SELECT CAST(o // 4 AS BIGINT) AS batch_id, count(*) AS n_examples, string_agg(image, ',' ORDER BY image) AS images
FROM ord GROUP BY o // 4"""
ORACLES["stacked_batches"] = _training_sql() + """,
ord AS (SELECT *, row_number() OVER (ORDER BY image) - 1 AS o FROM examples)
SELECT CAST(o // 4 AS BIGINT) AS batch_id, string_agg(image, ',' ORDER BY o) AS images,
       string_agg(array_to_string(input_ids, ','), ';' ORDER BY o) AS input_ids,
       string_agg(array_to_string(attention_mask, ','), ';' ORDER BY o) AS attention_mask,
       string_agg(array_to_string(labels, ','), ';' ORDER BY o) AS labels
FROM ord GROUP BY o // 4"""
# Encoding and decoding give the text back, in no more tokens than bytes.
ORACLES["subword_round_trip"] = "SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, true AS no_longer_than_bytes FROM documents"
ORACLES["subword_training_texts"] = _training_sql() + """
SELECT image, caption FROM train WHERE strlen(caption) < 512"""
ORACLES["step_plan"] = _training_sql() + """
SELECT count(*) AS n_examples, CAST(ceil(count(*) / 4) AS BIGINT) AS batches_per_epoch,
       CAST(greatest(floor(ceil(count(*) / 4) / 4), 1) AS BIGINT) AS steps_per_epoch,
       CAST(greatest(floor(ceil(count(*) / 4) / 4), 1) * 3 AS BIGINT) AS total_steps
FROM examples"""
# The settings of the two presets that are compared.
_SETTINGS = {
    "greedy": "1 AS num_beams, 30 AS max_length, 5 AS min_length, 2.0::DOUBLE AS repetition_penalty, true AS first_sentence",
    "beam": "5 AS num_beams, 60 AS max_length, 5 AS min_length, 1.5::DOUBLE AS repetition_penalty, false AS first_sentence",
}
ORACLES["preset_comparison"] = " UNION ALL ".join(
    f"""SELECT * FROM ({_with(DOCS, PREDS, _metric_ctes(cte), CORPUS)}
SELECT '{name}' AS preset, metric, round(score, 6) AS score, 'Describe this image.' AS prompt,
       {_SETTINGS[name]}, 1.0::DOUBLE AS length_penalty FROM corpus
WHERE metric IN ('Bleu_4', 'ROUGE_L', 'CIDEr'))"""
    for name, cte in (("greedy", "spreds"), ("beam", "beam"))
)
# The settings of all presets.
_ALL_SETTINGS = """(VALUES
  ('zero_shot', 'Write a short description for the image.', 5, 30, NULL, 8, 1.5::DOUBLE, 1.0::DOUBLE, false),
  ('tuned_short', 'Write a short description for the image.', 5, 20, NULL, 5, 1.5::DOUBLE, NULL, false),
  ('beam', 'Describe this image.', 5, NULL, 60, 5, 1.5::DOUBLE, 1.0::DOUBLE, false),
  ('greedy', 'Describe this image.', 1, NULL, 30, 5, 2.0::DOUBLE, 1.0::DOUBLE, true),
  ('qualitative', 'Describe this image.', 1, NULL, 30, 5, 2.0::DOUBLE, 1.0::DOUBLE, true)
) s(name, prompt, num_beams, max_new_tokens, max_length, min_length, repetition_penalty, length_penalty, first_sentence)"""
ORACLES["preset_captions"] = f"""
WITH st AS (
  SELECT 'img' || lpad(CAST(d.doc_id AS VARCHAR), 8, '0') || '.jpg' AS image,
         {_strip("split_part(replace(text, chr(10), ' '), '.', 1)")} AS head,
         CASE WHEN l.quality = 0 THEN 'missing' WHEN l.toxic = 1 THEN 'error' ELSE 'ok' END AS status
  FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT s.*, st.image, CASE WHEN s.first_sentence THEN st.head || '.' ELSE st.head END AS caption
FROM st, {_ALL_SETTINGS} WHERE st.status = 'ok'"""
ORACLES["batched_captions"] = ORACLES["caption_images_stub"]
ORACLES["resumed_captions"] = (
    "SELECT image, caption, status, CASE WHEN status = 'missing' THEN 0 ELSE 1 END AS n_asked FROM (" + ORACLES["caption_images_stub"] + ")"
)
ORACLES["picture_check"] = """
WITH k AS (
  SELECT 'img' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.jpg' AS image, doc_id % 4 AS kind_no, (doc_id // 4) % 5 = 0 AS cut FROM documents
), f AS (
  SELECT * FROM (VALUES (0, 'rgb', 'png', 2, 2, 3, 8), (1, 'grey16', 'png', 2, 2, 1, 16), (2, 'palette', 'png', 2, 2, 1, 8),
                        (3, 'cmyk', 'jpeg', 8, 8, 4, 8)) f(kind_no, kind, format, width, height, n_channels, bits)
)
SELECT image, kind, format, CASE WHEN cut THEN -1 ELSE width END AS width, CASE WHEN cut THEN -1 ELSE height END AS height,
       CASE WHEN cut THEN -1 ELSE n_channels END AS n_channels, CASE WHEN cut THEN -1 ELSE bits END AS bits,
       CASE WHEN cut THEN 'truncated' END AS problem, NOT cut AS ok
FROM k JOIN f USING (kind_no)"""
ORACLES["csv_documents"] = """
SELECT 'img' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.jpg' AS image, length(text) AS n_chars, sha256(text) AS text_sha256
FROM documents WHERE text <> ''"""
ORACLES["coco_round_trip"] = _with(DOCS, PREDS) + """
SELECT CAST(('0x' || substr(sha256(p.image), 1, 13)) AS BIGINT) AS image_id, p.caption, count(*) AS n_refs
FROM preds p JOIN refs r USING (image) GROUP BY p.image, p.caption"""


# The stand-in captioner (operators/captioner.py::text_captioner) answers the
# first sentence of the document text, so its output can be stated in SQL;
# generation status follows the labels as in fixtures.image_content.
GENERATIONS = f"""
gen AS (
  SELECT 'img' || lpad(CAST(d.doc_id AS VARCHAR), 8, '0') || '.jpg' AS image,
         {_strip("split_part(replace(d.text, chr(10), ' '), '.', 1)")} AS head,
         CASE WHEN l.quality = 0 THEN 'missing' WHEN l.toxic = 1 THEN 'error' ELSE 'ok' END AS status
  FROM documents d LEFT JOIN labels l USING (doc_id))
"""

ORACLES["evaluate_manifest"] = _with(DOCS, MANIFEST, GENERATIONS) + f""",
mpreds AS (SELECT g.image, {_strip('g.head')} AS caption FROM gen g JOIN man m USING (image)
           WHERE m.split = 'test' AND g.status = 'ok'),
mrefs AS (SELECT image, unnest(range(len(sents))) AS pos, unnest(sents) AS caption FROM man WHERE split = 'test'),
{_metric_ctes('mpreds', 'mrefs').strip().rstrip(',')},
{CORPUS.strip()}
SELECT metric, round(score, 6) AS score FROM corpus"""

ORACLES["evaluate_manifest_coverage"] = _with(DOCS, MANIFEST, GENERATIONS) + """,
rows_ AS (SELECT man.image, len(sents) > 0 AS r, gen.status FROM man JOIN gen USING (image) WHERE split = 'test')
SELECT 'status_' || status AS figure, count(*) AS n FROM rows_ GROUP BY status
UNION ALL SELECT 'scored_images', count(*) FROM rows_ WHERE r AND status = 'ok'
UNION ALL SELECT 'unreferenced_predictions', count(*) FROM rows_ WHERE NOT r AND status = 'ok'
UNION ALL SELECT 'unpredicted_images', count(*) FROM rows_ WHERE r AND status <> 'ok'"""

ORACLES["evaluate_captions"] = _with(DOCS, POSITIONAL, GENERATIONS) + f""",
cpreds AS (SELECT g.image, g.head || '.' AS caption FROM gen g JOIN labels_t t USING (image) WHERE g.status = 'ok'),
crefs AS (SELECT r.image, r.pos, r.caption FROM refs r JOIN labels_t t USING (image)),
{_caption_ctes('cpreds', 'crefs').strip().rstrip(',')},
{CORPUS.strip()}
SELECT metric, round(score, 6) AS score FROM corpus""".replace(
    "cpreds AS", "labels_t AS (SELECT image FROM plabels WHERE split = 'test'),\ncpreds AS", 1
)
