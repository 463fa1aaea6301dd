"""Vectorised word and shingle hashing shared by the text operators.

One pass over a block of texts works on the code points of the whole block in
NumPy: a table lookup finds the letters and digits, run boundaries give the
words, a polynomial prefix sum gives every word a 64-bit hash, and three (or k)
neighbouring word hashes are mixed into a shingle hash.  No Python loop runs per
word.  A word is a maximal run of letters or digits of the lower-cased text; the
underscore is no word character.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
#: Characters hashed in one vectorised step: bounds the scratch arrays of a block to about 50 MB.
BLOCK_CHARS = 600_000

_tables: dict[str, np.ndarray] = {}


def _alnum() -> np.ndarray:
    """Is the code point a letter or digit?  Built once a process."""
    if "alnum" not in _tables:
        t = np.zeros(0x110000, dtype=bool)
        for c in [*range(0x32400), *range(0xE0000, 0xE01F0)]:
            if chr(c).isalnum():
                t[c] = True
        _tables["alnum"] = t
    return _tables["alnum"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "pow" not in _tables or len(_tables["pow"]) < n:
        for name, base in (("pow", _BASE), ("inv", _INV)):
            p = np.full(n, base, dtype=_U)
            p[:1] = 1
            _tables[name] = np.cumprod(p, dtype=_U)
    return _tables["pow"], _tables["inv"]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def distinct_values(x: np.ndarray) -> np.ndarray:
    """The distinct values in order, by one sort: for integers faster than a hash table."""
    x = np.sort(x)
    return x[np.concatenate((np.ones(min(1, len(x)), bool), x[1:] != x[:-1]))]


def blocks(texts: list, limit: int = BLOCK_CHARS):
    """Ranges (lo, hi) of texts of about ``limit`` characters; a longer text is a block of its own."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and (size + n > limit or i - lo >= 65_536):
            yield lo, i
            lo, size = i, 0
        size += n + 1
    if lo < len(texts):
        yield lo, len(texts)


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every word of a block of texts, in order.  Null texts have no words."""
    lowered = [t.lower() if t else "" for t in texts]
    cp = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(cp):
        return np.empty(0, _U), np.empty(0, np.int64)
    edge = np.diff(np.concatenate(([0], _alnum()[cp].view(np.int8), [0])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(cp) + 1)
    prefix = np.zeros(len(cp) + 1, dtype=_U)
    np.cumsum((cp.astype(_U) + _U(7)) * power[: len(cp)], out=prefix[1:])
    h = mix((prefix[end] - prefix[start]) * inverse[start])
    offsets = np.cumsum([0] + [len(t) + 1 for t in lowered[:-1]])
    return h, np.searchsorted(offsets, start, side="right") - 1


def shingle_hashes(words: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every run of k consecutive words of one text, in order."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, _U), np.empty(0, np.int64)
    h = np.zeros(n, dtype=_U)
    for j in range(k):
        h = mix(h * _U(_BASE) + words[j : j + n] + _U(j + 1))
    same = doc[:n] == doc[k - 1 :]
    return h[same], doc[:n][same]


#: Bits of a shingle hash that sets keep; the text's index in its block takes the rest of a 64-bit sort key.
HASH_BITS = 48
_LOW = _U((1 << HASH_BITS) - 1)


def distinct(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, 48-bit hash) pairs of a block of at most 65,536 texts, sorted by text, then hash: one integer sort."""
    key = np.sort((doc.astype(_U) << _U(HASH_BITS)) | (h >> _U(64 - HASH_BITS)))
    keep = np.ones(len(key), dtype=bool)
    keep[1:] = key[1:] != key[:-1]
    key = key[keep]
    return key & _LOW, (key >> _U(HASH_BITS)).astype(np.int64)


def shingle_sets(texts: list, k: int):
    """Yields (index of the first text, hashes, text index in the block, number of texts) of each block: distinct, sorted."""
    for lo, hi in blocks(texts):
        w, d = word_hashes(texts[lo:hi])
        h, d = distinct(*shingle_hashes(w, d, k))
        yield lo, h, d, hi - lo


def _kinds() -> np.ndarray:
    """Kind of a code point in bits: 1 letter, 2 ends a sentence before white space, 4 white space, 8 ends a sentence at once, 16 a letter that is a word of its own."""
    if "kinds" not in _tables:
        t = np.zeros(0x110000, dtype=np.uint8)
        for c in [*range(0x32400), *range(0xE0000, 0xE01F0)]:
            t[c] = chr(c).isalpha() | 4 * chr(c).isspace()
        t[[ord(c) for c in ".!?"]] |= 2
        t[[ord(c) for c in "。！？\n"]] |= 8
        for lo, hi in ((0x3040, 0x3100), (0x3400, 0xA000), (0x20000, 0x32400)):
            t[lo:hi] |= 16 * (t[lo:hi] & 1)
        _tables["kinds"] = t
    return _tables["kinds"]


def sentence_terms(texts: list, least: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of texts: hash of every term in order, number of its sentence, text index of every sentence.

    Terms are runs of two or more letters of the lower-cased text, and single characters of scripts without spaces; digits and all else
    separate.  A sentence ends after . ! ? before white space, after their wide forms and at line ends; it counts with ``least`` terms.
    """
    lowered = [t.lower() if t else "" for t in texts]
    cp = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    none = np.empty(0, np.int64)
    if not len(cp):
        return np.empty(0, _U), none, none
    kind = _kinds()[cp]
    letter, alone = (kind & 1) > 0, (kind & 16) > 0
    before, solo = np.concatenate(([False], letter[:-1])), np.concatenate(([False], alone[:-1]))
    first = letter & (~before | alone | solo)
    start = np.flatnonzero(first)
    stop = np.flatnonzero(np.concatenate((before & (~letter | first), [letter[-1]])))
    keep = (stop - start > 1) | alone[start]
    start, stop = start[keep], stop[keep]
    power, inverse = _powers(len(cp) + 1)
    prefix = np.zeros(len(cp) + 1, dtype=_U)
    np.cumsum((cp.astype(_U) + _U(7)) * power[: len(cp)], out=prefix[1:])
    h = mix((prefix[stop] - prefix[start]) * inverse[start])
    ends = (kind & 8) > 0
    ends[:-1] |= ((kind[:-1] & 2) > 0) & ((kind[1:] & 4) > 0)
    sentence = np.cumsum(ends)[start]
    _, sentence, count = np.unique(sentence, return_inverse=True, return_counts=True)
    keep = (count >= least)[sentence]
    h, start = h[keep], start[keep]
    _, at, sentence = np.unique(sentence[keep], return_index=True, return_inverse=True)
    offsets = np.cumsum([0] + [len(t) + 1 for t in lowered[:-1]])
    return h, sentence, np.searchsorted(offsets, start[at], side="right") - 1
