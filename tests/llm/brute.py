"""Brute-force versions of the operators, over plain Python values."""

import hashlib
import re

A_Z = {c: c + 32 for c in range(65, 91)}
WHITE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def similarity_classes(rows, words, percent):
    """{doc_id: (n_shingles, component_id, n_links)} for distinct ids."""
    sets = {}
    for i, t in rows:
        w = WHITE_WORD.findall((t or "").translate(A_Z))
        sets[i] = ({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words
                   else {tuple(w)} if w else set())
    near = {i: {j for j in sets if j != i and sets[i] & sets[j]
                and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])} for i in sets}
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(sets[i]), min(seen), len(near[i]))
    return out


def contamination(docs, items, size=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}."""
    cut = []
    for item, text in items:
        w = TERM.findall((text or "").translate(A_Z))
        if w:
            cut += [(str(item), tuple(w[k:k + size])) for k in range(max(1, len(w) - size + 1))]
    out = {}
    for i, text in docs:
        w = TERM.findall((text or "").translate(A_Z))
        hit, found = set(), set()
        for item, win in cut:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found.add(item)
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit))
    return out


def cut_repeats(docs, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}."""
    first, out = {}, {}
    raws = sorted((i, (t or "").encode()) for i, t in docs)
    gone = {i: bytearray(len(r)) for i, r in raws}
    for i, r in raws:
        for s in range(len(r) - length + 1):
            w = r[s:s + length]
            if w in first:
                gone[i][s:s + length] = b"\1" * length
            else:
                first[w] = (i, s)
    for i, r in raws:
        g = gone[i]
        spans = sum(g[k] and (k == 0 or not g[k - 1]) for k in range(len(g)))
        out[i] = (len(r), sum(g), spans, sha(bytes(b for b, x in zip(r, g) if not x)))
    return out


def secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)."""
    text = text or ""
    kinds = ("assign", "access", "hex")
    spans = []
    pattern = r"""(?ai:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
    spans += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text) if len(m[1]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    spans.sort()
    count = [sum(k == x for _, k, _ in spans) for x in range(3)]
    return (*count, sha(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans).encode()))


def piece_count(word: bytes, vocabulary: set, marker=b" "):
    """Greedy longest-match pieces of marker + word, None if it cannot be cut."""
    rest, n = marker + word, 0
    while rest:
        for k in range(len(rest), 0, -1):
            if rest[:k] in vocabulary:
                rest, n = rest[k:], n + 1
                break
        else:
            return None
    return n
