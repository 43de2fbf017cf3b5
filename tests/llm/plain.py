"""Plain versions of the operators: one document or pair at a time, for small inputs."""

import hashlib
import re

import numpy as np


def ascii_lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def components(docs, words, similarity=80):
    """id -> (shingles, smallest id reachable) for (id, text) rows with distinct ids."""
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or ""))
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and find(x) != find(y):
                common = len(sets[x] & sets[y])
                if 100 * common >= similarity * (len(sets[x]) + len(sets[y]) - common):
                    a, b = sorted((find(x), find(y)))
                    root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def removed(rows, length=50):
    """Per (id, bytes) row: id, bytes, removed, spans, digest of what stays."""
    first = {}
    for d, t in rows:
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            first[s] = min(d, first.get(s, d))
    out = []
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def feistel_numbers(key, kind, left, right, a, b, rounds=8):
    for k in range(rounds):
        other = right if k % 2 == 0 else left
        h = int(hashlib.sha256(f"{key}:{kind}:{k}:{other}".encode()).hexdigest()[:12], 16)
        if k % 2 == 0:
            left = (left + h) % a
        else:
            right = (right + h) % b
    return left, right


def feistel_chars(key, kind, s, rounds=8):
    left, right = s[: len(s) // 2], s[len(s) // 2 :]

    def shift(half, other, k):
        h = hashlib.sha512(f"{key}:{kind}:{k}:{other}".encode()).hexdigest()
        out = ""
        for i, c in enumerate(half):
            v = int(h[4 * (i % 32) : 4 * (i % 32) + 4], 16)
            base, size = ("0", 10) if c.isdigit() else ("a", 26) if "a" <= c <= "z" else (c, 1)
            out += chr(ord(base) + (ord(c) - ord(base) + v) % size)
        return out

    for k in range(rounds):
        if k % 2 == 0:
            left = shift(left, right, k)
        else:
            right = shift(right, left, k)
    return left + right


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def card(key, digits):
    p = feistel_chars(key, "card", digits[:-1])
    return next(p + str(c) for c in range(10) if luhn_ok(p + str(c)))
