"""PII by weak supervision, in DataFrame functions only.

Patterns propose candidate spans; regex, gazetteer, context and shape
labelers vote on each (+1, 0, -1).  The vote patterns of the whole corpus are
counted (at most ``len(KINDS) * 3**4`` different ones), expectation-
maximisation on those counts estimates how reliable each labeler is, and a
logistic span classifier is trained on the resulting probabilities.  Spans
that satisfy a base rule always stay; the classifier adds others.

Positions come from the pieces between matches (``split``) and the matches
themselves, summed in blocks, so the work is linear in the text however many
spans it has.  No shuffle carries texts.

The patterns are the stated ones with possessive quantifiers and a
look-behind in place of restarts inside a run of the same characters, which
changes no match and keeps the search linear and free of deep recursion.

Defined results: null and empty texts have no spans; repeated rows get the
same spans; a kind without candidates (an empty table) has an untrained classifier
(base spans only); spans of several kinds may overlap and all are reported, by
kind, then start; ties in the classifier (score zero) are no spans.  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captally.operators.materialize import cut

#: Base kinds in their fixed order, then the kinds that the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "person", "secret")
LABELERS = ("regex", "gazetteer", "context", "shape")

# The candidate pattern of each kind.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "person": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Sr|Sra|Don|Doña)\.?\x20\p{Lu}\p{Ll}{1,30}+",
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z_]{3,20}+\x20?[=:]\x20?\"[A-Za-z0-9+/_-]{16,}+\"",
}
#: Cheap tests that a text with a match must pass.
GUARDS = {"email": "@", "phone": "+", "secret": '"', "person": " "}

# Gazetteers.  Top domains are the generic ones and every two-letter country code.
TOP_DOMAINS = "com org net edu gov mil int arpa info biz name pro aero coop museum jobs mobi tel travel app dev cloud online site shop xyz [a-z]{2}".split()
CARD_PREFIXES = "34 35 36 37 4 51 52 53 54 55 60 62 65 22 23 24 25 26 27".split()
# The calling codes in use: one, two or three digits.
CALLING_CODES = (
    "1 7 20 27 30 31 32 33 34 36 39 4[013-9] 5[1-8] 6[0-6] 81 82 84 86 9[0-58] "
    "21[1-368] 22[0-9] 23[0-9] 24[0-9] 25[0-8] 26[0-9] 29[01789] 35[0-9] 37[0-9] 38[0-25-79] 42[013] "
    "50[0-9] 59[0-9] 67[02-9] 68[0-35-9] 69[0-2] 85[02356] 88[06] 96[0-8] 97[0-7] 99[2-68]"
).split()
SECRET_NAMES = "token secret password passwd api_key apikey access_key auth key".split()
CONTEXT_WORDS = {
    "email": "email e-mail mail contact write correo courriel".split(),
    "ip": "ip host server address adresse addr from".split(),
    "card": "card visa mastercard credit account carte tarjeta karte".split(),
    "phone": "phone tel call mobile fax telefon teléfono téléphone".split(),
    "person": "by from dear name author".split(),
    "secret": "key token secret auth login".split(),
}

SPAN = "struct<kind:string, start:bigint, end:bigint, base:boolean, regex:int, gazetteer:int, context:int, shape:int>"
BLOCK = 256
CELL_CHARS = 4096


def _vote(test: Column) -> Column:
    return F.when(test, F.lit(1)).otherwise(F.lit(-1))


def _luhn(digits: Column) -> Column:
    """Luhn test of a digit string of 13 to 19 characters."""
    n = F.length(digits)

    def digit(i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, doubled).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + digit(i))
    return F.when(n.between(13, 19), total % 10 == 0).otherwise(F.lit(False))


def _any_of(words) -> str:
    return "(?:" + "|".join(words) + ")"


def _rules(kind: str, m: Column, before: Column) -> tuple[Column, Column, Column]:
    """(regex, gazetteer and context votes) on a match ``m`` after the text ``before``."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    octet = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
    regex = {
        "email": lambda: F.lit(True),
        "ip": lambda: m.rlike(rf"^{octet}(?:\.{octet}){{3}}$"),
        "card": lambda: _luhn(digits),
        "phone": lambda: F.length(digits).between(9, 15),
        "person": lambda: m.rlike(r"\p{Ll}{2,}$"),
        "secret": lambda: m.rlike(r"(?i)\"[0-9a-f]{32,}\"$"),
    }[kind]()
    gazetteer = {
        "email": lambda: m.rlike(rf"(?i)\.{_any_of(TOP_DOMAINS)}$"),
        "ip": lambda: ~m.rlike(r"^(?:0|127|25[0-9]|24[0-9]|23[0-9]|22[4-9])\."),
        "card": lambda: digits.rlike(rf"^{_any_of(CARD_PREFIXES)}"),
        "phone": lambda: digits.rlike(rf"^{_any_of(CALLING_CODES)}"),
        "person": lambda: m.rlike(r"^(?:Mr|Mrs|Ms|Dr|Prof)\."),
        "secret": lambda: m.rlike(rf"(?i)^{_any_of(SECRET_NAMES)}\x20?[=:]"),
    }[kind]()
    context = F.when(before.rlike(rf"(?i)\b{_any_of(CONTEXT_WORDS[kind])}\b[^\p{{L}}]*(?:\p{{L}}{{1,4}}[^\p{{L}}]*)?$"), F.lit(1)).otherwise(F.lit(0))
    return regex, gazetteer, context


def _running(lengths: Column) -> Column:
    """Exclusive running sums of an array column (two steps of blocks, so linear)."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(lengths) / BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK),
    )
    empty = F.expr("named_struct('sums', cast(array() as array<bigint>), 'total', 0L)")

    def push(acc, x):
        return F.struct(F.concat(acc["sums"], F.array(acc["total"])).alias("sums"), (acc["total"] + x).alias("total"))

    return F.transform(blocks, lambda block: F.aggregate(block, empty, push))


def with_candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``cands``: per kind the candidate spans with their votes.

    Adds only columns that start with ``pii_`` besides, for the caller to drop.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    has_digit = body.rlike("[0-9]")
    for kind in KINDS:
        guard = body.contains(GUARDS[kind]) if kind in GUARDS else has_digit
        if kind in ("phone", "secret"):
            guard = guard & has_digit
        pattern = PATTERNS[kind]
        none = F.expr("cast(array() as array<string>)")
        found = F.when(guard, F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(none)
        df = df.withColumn(f"pii_{kind}_m", found)
        some = F.size(f"pii_{kind}_m") > 0
        df = df.withColumn(f"pii_{kind}_g", F.when(some, F.split(body, pattern, -1)).otherwise(none))
        gaps, matches = F.col(f"pii_{kind}_g"), F.col(f"pii_{kind}_m")
        lengths = F.transform(
            F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("g"), matches.alias("m")),
            lambda x: (F.length(x["g"]) + F.length(x["m"])).cast("long"),
        )
        df = df.withColumn(f"pii_{kind}_l", lengths)
        df = df.withColumn(f"pii_{kind}_s", _running(F.col(f"pii_{kind}_l")))
        empty = F.expr("named_struct('sums', cast(array() as array<bigint>), 'total', 0L)")
        bases = F.aggregate(
            F.col(f"pii_{kind}_s"),
            empty,
            lambda acc, x: F.struct(F.concat(acc["sums"], F.array(acc["total"])).alias("sums"), (acc["total"] + x["total"]).alias("total")),
        )["sums"]
        offsets = F.flatten(F.zip_with(F.col(f"pii_{kind}_s"), bases, lambda x, base: F.transform(x["sums"], lambda s: s + base)))
        df = df.withColumn(f"pii_{kind}_o", offsets)
        zipped = F.arrays_zip(
            matches.alias("m"),
            F.slice(gaps, 1, F.size(matches)).alias("g"),
            F.slice(gaps, 2, F.size(matches)).alias("next"),
            F.col(f"pii_{kind}_o").alias("o"),
        )

        def span(x):
            before = F.substring(x["g"], -32, 32)
            regex, gazetteer, context = _rules(kind, x["m"], before)
            glued = before.rlike(r"[\p{L}0-9]$") | x["next"].rlike(r"^[\p{L}0-9]")
            start = x["o"] + F.length(x["g"])
            return F.struct(
                F.lit(kind).alias("kind"),
                start.alias("start"),
                (start + F.length(x["m"])).alias("end"),
                (regex if kind in BASE_KINDS else F.lit(False)).alias("base"),
                _vote(regex).alias("regex"),
                _vote(gazetteer).alias("gazetteer"),
                context.alias("context"),
                F.when(glued, F.lit(-1)).otherwise(F.lit(1)).alias("shape"),
            )

        spans = F.transform(zipped, span).cast(f"array<{SPAN}>")
        df = df.withColumn(f"pii_{kind}", F.when(F.size(matches) > 0, spans).otherwise(F.expr(f"cast(array() as array<{SPAN}>)")))
    return df


def vote_counts(df: DataFrame) -> list[tuple]:
    """(kind, votes..., n) over all candidates of ``with_candidates``: a bounded table."""
    spans = F.explode(F.concat(*(F.col(f"pii_{k}") for k in KINDS))).alias("x")
    cols = ["kind", *LABELERS]
    rows = df.select(spans).select(*(F.col(f"x.{c}") for c in cols)).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted(tuple(r) for r in rows)


#: Pseudo-votes of the opening beliefs, per kind, class and labeler: real votes beyond them decide.
PRIOR_VOTES = 50
#: Opening beliefs, votes -1, 0, +1 out of ten for (false, true) spans.
BELIEFS = {
    "regex": ([8, 1, 1], [1, 1, 8]),
    "gazetteer": ([5, 1, 4], [2, 1, 7]),
    "context": ([1, 8, 1], [1, 6, 3]),
    "shape": ([5, 1, 4], [1, 1, 8]),
}


def reliabilities(counts: list[tuple], rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM over vote patterns: (per-kind prior, vote probabilities [kind, class, labeler, vote], posterior per pattern).

    A labeler's vote is independent of the others given kind and truth.  It
    opens with beliefs that it is right more often than not, which weigh as
    much as ``PRIOR_VOTES`` votes however many there are: they keep the two
    classes from changing places where votes are few, and give way to the
    votes where these are many.
    """
    kind = np.array([KINDS.index(c[0]) for c in counts], int)
    votes = np.array([c[1:-1] for c in counts], int).reshape(len(counts), len(LABELERS)) + 1
    n = np.array([c[-1] for c in counts], float)
    belief = np.array([[BELIEFS[x][y] for x in LABELERS] for y in (0, 1)], float) / 10
    pseudo = np.tile(belief * PRIOR_VOTES, (len(KINDS), 1, 1, 1))
    labeler = np.arange(len(LABELERS))
    prior = np.full(len(KINDS), 0.5)
    table = pseudo / pseudo.sum(3, keepdims=True)
    post = np.zeros(len(counts))
    for _ in range(rounds if len(counts) else 0):
        like = [np.prod(table[kind[:, None], y, labeler, votes], axis=1) for y in (0, 1)]
        true = prior[kind] * like[1]
        before, post = post, true / (true + (1 - prior[kind]) * like[0])
        if np.abs(post - before).max() < 1e-9:
            break
        total = np.bincount(kind, n, len(KINDS))
        prior = (1 + np.bincount(kind, n * post, len(KINDS))) / (2 + total)
        table = pseudo.copy()
        for y, w in ((0, n * (1 - post)), (1, n * post)):
            np.add.at(table, (kind[:, None], y, labeler, votes), w[:, None])
        table /= table.sum(3, keepdims=True)
    return prior, table, post


def train(counts: list[tuple], ridge: float = 1.0, rounds: int = 50) -> dict[str, list[float]]:
    """Logistic span classifier of each kind, fitted to the EM posteriors: kind -> intercept and a weight per labeler.

    The ridge holds a labeler whose vote never changes at no weight.  A kind
    without candidates accepts nothing.
    """
    p = len(LABELERS)
    weights = {}
    post = reliabilities(counts)[2]
    for kind in KINDS:
        at = [i for i, c in enumerate(counts) if c[0] == kind]
        if not at:
            weights[kind] = [-10.0] + [0.0] * p
            continue
        n = np.array([counts[i][-1] for i in at], float)
        x = np.array([(1, *counts[i][1:-1]) for i in at], float)
        w = np.zeros(1 + p)
        for _ in range(rounds):
            mu = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (n * (post[at] - mu)) - ridge * w
            hessian = (x * (n * mu * (1 - mu))[:, None]).T @ x + ridge * np.eye(1 + p)
            step = np.linalg.solve(hessian, gradient)
            w += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        weights[kind] = list(map(float, w))
    return weights


def accepted(span: Column, kind: str, weights: dict[str, list[float]]) -> Column:
    bias, *per_vote = weights[kind]
    score = reduce(lambda a, b: a + b, (F.lit(w) * span[v] for w, v in zip(per_vote, LABELERS, strict=True)), F.lit(bias))
    return span["base"] | (score > 0)


def _accepted_spans(kind: str, weights: dict[str, list[float]]) -> Column:
    return F.filter(F.col(f"pii_{kind}"), lambda s: accepted(s, kind, weights))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_sha256 and all spans of every document."""
    found = with_candidates(docs.select("doc_id", "text"))
    found = cut(found.select("doc_id", *(f"pii_{k}" for k in KINDS)), "pii-candidates")
    weights = train(vote_counts(found))
    base = {k: F.filter(F.col(f"pii_{k}"), lambda s: s["base"]) for k in BASE_KINDS}
    every = [_accepted_spans(k, weights) for k in KINDS]
    return found.select(
        "doc_id",
        *(F.size(base[k]).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(_joined(F.concat(*base.values())), 256).alias("base_sha256"),
        _joined(F.concat(*every)).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by ``<KIND>``; other columns stay as they are.

    The classifier is trained on all rows.  Spans are those of ``find_pii`` on
    the given text; overlapping ones are merged and replaced once, by the kind
    of the one that starts first (ties: the first kind), so no character of a
    found span stays.  Null texts stay null.
    """
    weights = train(vote_counts(with_candidates(docs.select("text"))))
    found = with_candidates(docs.select(F.struct("*").alias("whole"), F.col("text").alias("text")))
    spans = F.concat(*(_ranged(kind, weights) for kind in KINDS))
    found = found.select("whole", "text", F.array_sort(spans).alias("spans"))
    found = found.withColumn("reach", _reach(F.transform("spans", lambda s: s["end"])))
    # A span that starts at or past the reach of all before it opens a merged range, which ends at the reach of the next such span.
    reached = F.zip_with("spans", "reach", lambda s, r: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), r.alias("reach")))
    found = found.withColumn("opens", F.filter(reached, lambda x: x["start"] >= x["reach"]))
    last = F.array(F.array_max(F.transform("spans", lambda s: s["end"])))
    found = found.withColumn("ends", F.concat(F.transform(F.slice("opens", 2, F.size("opens")), lambda x: x["reach"]), last))
    found = found.withColumn("cells", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CELL_CHARS}}}+"), F.lit(0)))
    names = F.array(*(F.lit(f"<{kind.upper()}>") for kind in KINDS))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.col("ends"))
    gaps = F.zip_with("opens", F.slice(starts, 1, F.size("opens")), lambda x, at: F.concat(_between(at, x["start"]), F.element_at(names, x["kind"] + 1)))
    changed = F.concat(F.array_join(gaps, ""), _between(F.element_at("ends", -1), F.length("text").cast("long")))
    text = F.when(F.size("spans") > 0, changed).otherwise(F.col("text"))
    return found.select(F.col("whole").withField("text", text).alias("whole")).select("whole.*")


def _ranged(kind: str, weights: dict[str, list[float]]) -> Column:
    """(start, kind's number, end) of the accepted spans of a kind."""
    number = F.lit(KINDS.index(kind)).alias("kind")
    return F.transform(_accepted_spans(kind, weights), lambda s: F.struct(s["start"].alias("start"), number, s["end"].alias("end")))


def _reach(ends: Column) -> Column:
    """Exclusive running maximum of an array column, 0 at first (two steps of blocks, so linear)."""
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(ends) / BLOCK).cast("int")), lambda b: F.slice(ends, b * BLOCK + 1, BLOCK))
    empty = F.expr("named_struct('upto', cast(array() as array<bigint>), 'top', 0L)")

    def push(acc, x):
        return F.struct(F.concat(acc["upto"], F.array(acc["top"])).alias("upto"), F.greatest(acc["top"], x).alias("top"))

    inside = F.transform(blocks, lambda block: F.aggregate(block, empty, push))
    before = F.aggregate(F.transform(inside, lambda x: x["top"]), empty, push)["upto"]
    return F.flatten(F.zip_with(inside, before, lambda x, top: F.transform(x["upto"], lambda r: F.greatest(r, top))))


def _between(start: Column, end: Column) -> Column:
    """Characters [start, end) of the text, read from the one or more ``cells`` that hold them."""
    first, last = F.floor(start / CELL_CHARS), F.floor((end - 1) / CELL_CHARS)
    held = F.array_join(F.slice("cells", (first + 1).cast("int"), (last - first + 1).cast("int")), "")
    return F.when(end > start, F.substring(held, (start % CELL_CHARS + 1).cast("int"), (end - start).cast("int"))).otherwise(F.lit(""))
