"""Plain versions of what the operators compute."""

import re
import zlib

LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text, kind=SPACED):
    return re.findall(kind, lower(text))


def held_out(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod == 0


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def grouped(texts, k, percent):
    """The smallest id of each text's component; texts by id."""
    sets, low = {i: shingles(t, k) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                low[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}
