"""Plain readings of the operators' contracts, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def low(text) -> bytes:
    return (text or "").encode().translate(LOWER)


def spaced(data: bytes) -> list[bytes]:
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", data) if w]


def alnum(data: bytes) -> list[bytes]:
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", data)


def targets(sizes: dict, weights=(1, 2, 3), cap=3) -> dict:
    """Source sizes to targets: share by weight, stop at cap times the size, reshare the excess."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    full = set()
    while True:
        left = sum(sizes.values()) - sum(cap * sizes[n] for n in full)
        total = sum(weight[n] for n in names if n not in full)
        goal = {n: cap * sizes[n] if n in full else left * weight[n] / total for n in names}
        over = {n for n in names if n not in full and goal[n] > cap * sizes[n]}
        if not over:
            return goal
        full |= over


def repeats(texts: list, length: int = 200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + length] for t in data for p in range(len(t) - length + 1))
    out = []
    for t in data:
        cover = np.zeros(len(t) + 1, int)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        cut = np.cumsum(cover[:-1]) > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~cut])
        spans = int((np.diff(np.concatenate(([0], cut.astype(int)))) == 1).sum())
        out.append((len(t), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def quality(text) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    wins = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if wins[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def word_scores(rows: list) -> list:
    """(doc_id, text) to (held_out, n_tokens, n_known, N, base score)."""
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows if i is not None}
    count: Counter = Counter()
    for i, t in rows:
        if i is not None and not held[i]:
            count.update([*spaced(low(t)), None])
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        tokens = [*spaced(low(t)), None]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((held.get(i, False), len(tokens), sum(count[w] > 0 for w in tokens), n, base))
    return out


def fingerprint(text) -> int:
    words = spaced(low(text))
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    ones = np.zeros(64, int)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        ones += np.array([h >> b & 1 for b in range(64)])
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def near_components(fingerprints: list[int], distance: int = 3) -> list[int]:
    """Component number (smallest index) of each fingerprint."""
    f = np.array(fingerprints, np.uint64)
    label = np.arange(len(f))
    near = [np.flatnonzero(np.bitwise_count(f ^ x) <= distance) for x in f]
    while True:
        new = np.array([label[a].min() for a in near])
        if (new == label).all():
            return label.tolist()
        label = new


def overlaps(docs: list, items: list, least: int = 10) -> set:
    """(doc_id, item_id) with ``least`` equal tokens in a row."""
    grams: dict = {}
    for i, t in items:
        w = alnum(low(t))
        for k in range(len(w) - least + 1):
            grams.setdefault(tuple(w[k : k + least]), set()).add(i)
    found = set()
    for d, t in docs:
        w = alnum(low(t))
        for k in range(len(w) - least + 1):
            found |= {(d, i) for i in grams.get(tuple(w[k : k + least]), ())}
    return found


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def license_base(text) -> tuple:
    words = [w.decode() for w in alnum(low(text))]
    places = [(i, name) for p, name in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in places}))


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text) -> list[str]:
    def good(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in PII.items() for m in re.finditer(p, text or "") if good(k, m.group())]
