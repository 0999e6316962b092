"""Plain Python versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reach(ids, pairs) -> dict:
    """Smallest id reachable from each id."""
    near = {i: set() for i in ids}
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out


def fingerprint(text) -> int:
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs: list[tuple]) -> dict:
    """id -> (fingerprint, component), all pairs compared."""
    fps = {d: fingerprint(t) for d, t in docs}
    ids = list(fps)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fps[a] ^ fps[b]).bit_count() <= 2]
    top = reach(ids, pairs)
    return {d: (f"{fps[d]:016x}", top[d]) for d in ids}


def vectors(rows: list[tuple], limit: float = 0.9) -> dict:
    """id -> (links, component), all pairs compared in double precision."""
    def good(v):
        return v is not None and len(v) and None not in v and all(map(math.isfinite, v)) and any(v)

    ok = [(i, np.array(v, float)) for i, v in rows if good(v)]
    pairs = [(a, b) for k, (a, x) in enumerate(ok) for b, y in ok[:k]
             if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= limit]
    top, n = reach([i for i, _ in rows], pairs), Counter(x for p in pairs for x in p)
    return {i: (n[i], top[i]) for i, _ in rows}


def base_counts(text) -> dict:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": dup, "n_repeat_words": len(inside),
            "base_failed": len(words) < 20 or 100 * len(inside) > 30 * len(words)}


def turns_digest(turns: list[tuple[str, str]]) -> tuple:
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
