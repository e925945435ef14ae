"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import itertools
import re


def shingle_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def near_components(rows):
    sets = {doc: shingle_set(text) for doc, text in rows}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((doc, len(s), find(doc)) for doc, s in sets.items())


def suffix_order(text):
    return sorted(range(len(text)), key=lambda i: bytes(text[i:]))


def repeats_removed(rows, window):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of the rest) of each row."""
    import hashlib
    from collections import Counter

    raw = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(t[i : i + window] for _, t in raw for i in range(len(t) - window + 1))
    out = []
    for doc, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        spans = len(re.findall(b"\1+", bytes(gone)))
        rest = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def base_scores(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of each row."""
    import math
    import zlib
    from collections import Counter

    def tokens(text):
        return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")), None]

    held = [zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2 for doc, _ in rows]
    count = Counter(t for (_, text), h in zip(rows, held, strict=True) if not h for t in tokens(text))
    total, different = sum(count.values()), len(count)
    return [
        (doc, h, len(tokens(text)), sum(count[t] > 0 for t in tokens(text)), total, sum(math.log10((count[t] + 1) / (total + different + 1)) for t in tokens(text)))
        for (doc, text), h in zip(rows, held, strict=True)
    ]
