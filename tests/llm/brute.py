"""Plain versions of the operators' contracts, for small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRETS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii_ok(kind, m):
    digits = re.sub(r"\D", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def spans(text, kinds, ok):
    rank = list(kinds)
    out = [(m.start(), rank.index(k), k, m.end()) for k, p in kinds.items() for m in re.finditer(p, text or "", re.ASCII) if ok(k, m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def pii(text):
    return spans(text, PII, lambda k, m: pii_ok(k, m[0]))


def secrets(text):
    return spans(text, SECRETS, lambda k, m: len(m[2] if k == "assign" else m[0]) >= {"assign": 12, "access": 18, "hex": 16}[k])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, linked):
    """The smallest id reachable from each; ids may be null."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(i)
    least = {r: min((ids[i] for i in g if ids[i] is not None), default=None) for r, g in groups.items()}
    return [least[find(i)] for i in range(len(ids))]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc(pages):
    """(page_id, bytes, digest, type, refers_to) of each page."""
    bodies = [(p, (h or "").encode()) for p, h in pages]
    keep = {}
    for p, b in bodies:
        keep[b] = max(keep.get(b, p), p)
    return [(p, len(b), digest(b), "response" if keep[b] == p else "revisit", None if keep[b] == p else keep[b]) for p, b in bodies]


def targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held, out = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(cap * sizes[s] for s in held)
        free = sum(w[s] for s in names if s not in held)
        out = {s: cap * sizes[s] if s in held else rest * w[s] / free for s in names}
        more = {s for s in names if s not in held and out[s] > cap * sizes[s]}
        if not more:
            return out
        held |= more


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(ws, k):
    k = min(k, len(ws))
    return Counter(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)) if ws else Counter()


def weighted_jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a or b else 0.0


def contaminated(doc, item, least=0.8):
    """The best similarity of an item-sized window, if it is high enough."""
    d, i = words(doc), words(item)
    if not d or not i:
        return None
    n = min(len(i), len(d))
    k = min(5, len(i))
    if n < k:
        return None
    own = shingles(i, 5)
    best = max(weighted_jaccard(Counter(tuple(d[s : s + n][j : j + k]) for j in range(n - k + 1)), own) for s in range(len(d) - n + 1))
    return best if best >= least else None
