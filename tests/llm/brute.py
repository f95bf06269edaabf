"""Plain versions of the operators, for small inputs."""

import hashlib
import re

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def shingles(text, n=3):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components(ids, links):
    root = {i: i for i in ids}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    links, index = [], {}
    for i, own in sets.items():
        for s in own:
            index.setdefault(s, []).append(i)
    near = {(a, b) for group in index.values() for a in group for b in group if a < b}
    for a, b in near:
        if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
            links.append((a, b))
    return sets, components(list(sets), links)


def repeats(rows, size=200):
    """{doc_id: (n_bytes, n_removed, n_spans, kept sha256)}"""
    texts = {i: (t or "").encode() for i, t in rows}
    seen = {}
    for b in texts.values():
        for k in range(len(b) - size + 1):
            seen[b[k:k + size]] = seen.get(b[k:k + size], 0) + 1
    out = {}
    for i, b in texts.items():
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if seen[b[k:k + size]] > 1:
                gone[k:k + size] = b"\1" * size
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), spans, sha(kept))
    return out
