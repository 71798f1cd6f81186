"""Plain Python versions of the operators, for small tables."""

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def simhash(text, shingle=4):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    pieces = [" ".join(found[k : k + shingle]) for k in range(len(found) - shingle + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=4):
    """{key: fingerprint} to {key: root}, roots being arbitrary members."""
    keys = list(prints)
    values = np.array([prints[k] for k in keys], np.uint64)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(values[k + 1 :] ^ values[k]) <= distance) + k + 1:
            parent[find(int(j))] = find(k)
    return {key: keys[find(k)] for k, key in enumerate(keys)}


def near_unique(rows):
    """(doc_id, text) to the ids that stay."""
    roots = components({i: simhash(t) for i, t in rows})
    smallest = {}
    for i, root in roots.items():
        smallest[root] = min(i, smallest.get(root, i))
    return {i for i, _ in rows if smallest[roots[i]] == i}


def removed(rows, length=50):
    """(doc_id, text) to a list of (doc_id, bytes, mask of what goes)."""
    first, out = {}, []
    texts = [(i, (t or "").encode()) for i, t in rows]
    rank = lambda i: -(1 << 63) if i is None else i
    for i, text in texts:
        for k in range(len(text) - length + 1):
            piece = text[k : k + length]
            first[piece] = min(rank(i), first.get(piece, rank(i)))
    for i, text in texts:
        mask = np.zeros(len(text), bool)
        for k in range(len(text) - length + 1):
            if first[text[k : k + length]] < rank(i):
                mask[k : k + length] = True
        out.append((i, text, mask))
    return out


def removal_rows(rows):
    out = []
    for i, text, mask in removed(rows):
        kept = bytes(np.frombuffer(text, np.uint8)[~mask]) if text else b""
        spans = int(np.count_nonzero(np.diff(np.r_[0, mask.astype(int)]) == 1))
        out.append((i, len(text), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def without_repeats(rows):
    return {
        i: bytes(np.frombuffer(text, np.uint8)[~mask]).decode("utf-8", "ignore") if text else ""
        for i, text, mask in removed(rows)
    }


def measures(text):
    text = text or ""
    found = words(text)
    n = len(found)
    windows = [tuple(found[k : k + 5]) for k in range(n - 4)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        n,
        sum(map(len, found)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


# -- piecewise fingerprints, byte by byte

MASK = (1 << 64) - 1


def _mixed(x):
    x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD & MASK
    x = (x ^ (x >> 29)) * 0xC4CEB9FE1A85EC53 & MASK
    return x ^ (x >> 32)


def _hash(values, base, piece):
    """Bytes as digits of a number, the first one lowest."""
    total = 0
    for byte in reversed(piece):
        total = (total * base + values[byte]) & MASK
    return _mixed(total)


def piecewise(text, values, base, letters, roll=7, signature=64, enough=32):
    data = (text or "").encode()
    if not data:
        return "1::"
    triggers = {}
    for end in range(roll, len(data) + 1):
        h = _hash(values, base, data[end - roll : end])
        triggers[end] = (h & -h).bit_length() - 1 if h else -1
    block = 1
    while block * signature < len(data):
        block *= 2
    while block > 1 and sum(1 << z >= block for z in triggers.values() if z >= 0) < enough:
        block //= 2
    marks = []
    for size in (block, 2 * block):
        said, start = "", 0
        for end in range(1, len(data) + 1):
            cut = triggers.get(end, -1) >= 0 and 1 << triggers[end] >= size and len(said) < signature - 1
            if end == len(data) or cut:
                said += letters[_hash(values, base, data[start:end]) >> 58]
                start = end
        marks.append(said)
    return f"{block}:{marks[0]}:{marks[1]}"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def likeness(one, other, common=7):
    if one == other:
        return 1.0

    def short(said):
        out = ""
        for c in said:
            if out[-3:] != c * 3:
                out += c
        return out

    def alike(a, b):
        shorter = min(len(a), len(b))
        need = min(common, max(1, shorter // 2))
        if not shorter or not any(a[i : i + need] in b for i in range(len(a) - need + 1)):
            return 0.0
        return 1 - edit_distance(a, b) / max(len(a), len(b))

    (n, *a), (m, *b) = one.split(":"), other.split(":")
    n, m, a, b = int(n), int(m), list(map(short, a)), list(map(short, b))
    if n == m:
        return max(alike(a[0], b[0]), alike(a[1], b[1]))
    return alike(a[0], b[1]) if n == 2 * m else alike(a[1], b[0]) if m == 2 * n else 0.0
