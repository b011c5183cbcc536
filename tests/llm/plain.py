"""Brute-force versions of the operators, in plain Python over small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def quality(text: str | None) -> dict:
    """The base counts of a text."""
    ws = words(text)
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    often = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(marked),
        "base_failed": len(ws) < 50 or 100 * len(marked) > 50 * len(ws),
    }


def targets(sizes: dict) -> dict:
    """Source targets by capping and resharing until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    goal, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = goal - sum(capped.values())
        whole = sum(weight[x] for x in free)
        share = {s: left * weight[s] / whole for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 2.0 * sizes[s] for s in over}


def fingerprint(text: str | None) -> int:
    ws = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n: int, linked) -> list[int]:
    """Component (its least member) of each of ``n`` items; ``linked(i, j)`` tells."""
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i + 1, n):
            if linked(i, j):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    out = []
    for k, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def url_parts(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def viterbi(word: str, scores: dict[str, float], spell) -> tuple[float, int]:
    """Best segmentation of one word: (score, tokens), by the full table."""
    best = [(0.0, 0)]
    for i in range(1, len(word) + 1):
        found = []
        for j in range(i):
            s = scores.get(word[j:i])
            if s is not None:
                found.append((best[j][0] + s, best[j][1] + 1))
            elif i - j == 1:
                a, n = spell(word[j:i])
                found.append((best[j][0] + a, best[j][1] + n))
        best.append(max(found, key=lambda x: (x[0], -x[1])))
    return best[-1]
