"""Encoding of a whole corpus with a public byte-level BPE tokenizer, by a prefix-sharing trie traversal.

A text is split into words by the tokenizer's public pattern.  The distinct words of a batch, sorted by
their bytes, are a trie in depth-first order: the common prefix of a word with the one before it is the
path both share.  Along the path every node holds the *last token* of the encoding of its prefix; the
last token of a longer prefix is the longest vocabulary entry that ends there and may follow the last
token of what is before it.  So a shared prefix is computed once, and an encoding is read off by walking
back from a word's end.  Whether one token may follow another is decided by undoing merges on both sides
of their border, and is remembered.

No document text leaves its partition: there is no shuffle.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.workspace import spread

#: Remembered words, and remembered pairs of tokens, of one Python worker; beyond it the memory is emptied and fills again (speed only, never results).
WORDS_KEPT, PAIRS_KEPT = 400_000, 2_000_000


def _byte_names() -> dict[str, int]:
    """The printable names of bytes in the public vocabulary file: printable bytes name themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    """The encoder of one vocabulary file (kind: byte-level BPE, JSON)."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        names = _byte_names()
        raw = lambda t: bytes(names[c] for c in t)
        self.split = regex.compile(pattern).findall
        self.vocab = {raw(t): i for t, i in model["vocab"].items() if all(c in names for c in t)}
        self.longest = max(map(len, self.vocab))
        self.length = {i: len(t) for t, i in self.vocab.items()}
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for n, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pair, made = (model["vocab"][a], model["vocab"][b]), model["vocab"][a + b]
            self.merged.setdefault(pair, made)
            if made not in self.rank:
                self.rank[made], self.halves[made] = n, pair
        self.follows: dict[tuple[int, int], bool] = {}
        self.known: dict[str, list[int]] = {}

    def _may_follow(self, x: int, y: int) -> bool:
        """Does merging the bytes of x and y keep the border between them?

        Going back in time from the finished tokens, the later merge of the two sides is undone first; if at any
        time the two tokens at the border form a pair whose merge comes before the merge that was undone last, that pair would have been merged.
        """
        rank, halves, none = self.rank, self.halves, -1
        before = len(rank) + 1
        while True:
            made = self.merged.get((x, y))
            if made is not None and rank[made] < before:
                return False
            rx, ry = rank.get(x, none), rank.get(y, none)
            if rx == none and ry == none:
                return True
            if rx > ry:
                before, x = rx, halves[x][1]
            else:
                # At equal rank the left one is merged first, so a pair with the same rank across the border wins against y.
                before, y = ry + 1, halves[y][0]

    def encode_words(self, words) -> None:
        """Add the encodings of distinct words to ``known``."""
        vocab, longest, follows, length = self.vocab, self.longest, self.follows, self.length
        last: list[int] = []  # of every prefix of the current path
        path = b""
        for raw, word in sorted((w.encode("utf-8", "replace"), w) for w in words):
            shared, most = 0, min(len(raw), len(path))
            while shared < most and raw[shared] == path[shared]:
                shared += 1
            del last[shared:]
            path = raw
            for end in range(shared + 1, len(raw) + 1):
                for start in range(max(0, end - longest), end):
                    token = vocab.get(raw[start:end])
                    if token is None:
                        continue
                    if start == 0:
                        break
                    pair = (last[start - 1], token)
                    fits = follows.get(pair)
                    if fits is None:
                        fits = follows[pair] = self._may_follow(*pair)
                    if fits:
                        break
                last.append(token)
            ids, at = [], len(raw)
            while at:
                ids.append(last[at - 1])
                at -= length[ids[-1]]
            ids.reverse()
            self.known[word] = ids

    def encode(self, texts: list) -> list[list[int]]:
        """Ids of every text; null and empty texts give an empty list."""
        cut = [self.split(t) if t else [] for t in texts]
        fresh = set(chain.from_iterable(cut)).difference(self.known)
        if len(self.known) + len(fresh) > WORDS_KEPT:
            self.known.clear()
            fresh = set(chain.from_iterable(cut))
        if len(self.follows) > PAIRS_KEPT:
            self.follows.clear()
        self.encode_words(fresh)
        get = self.known.__getitem__
        return [list(chain.from_iterable(map(get, words))) for words in cut]


_made: dict[tuple[str, str], TrieEncoder] = {}


def default_vocabulary() -> tuple[str, str]:
    """Path and pattern of byte_bpe_50k where the public vocabularies are installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def encode_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Token ids of every text: (id, ids array<int>), one row for every row of ``docs``.

    vocabulary: path of the vocabulary file on the executors and the split pattern.  Null and empty texts give an
    empty list; strings of special tokens are ordinary text; white space, long words and repeated rows are encoded as they are.
    """
    path, pattern = vocabulary or default_vocabulary()

    def run(batches):
        if (path, pattern) not in _made:
            _made[path, pattern] = TrieEncoder(path, pattern)
        encoder = _made[path, pattern]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lo = 0
            while lo < len(texts):  # about 1 M characters at a time bound the scratch lists
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size < 1_000_000):
                    size += len(texts[hi] or "")
                    hi += 1
                ids = encoder.encode(texts[lo:hi])
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(offsets[-1]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[id_col, "ids"])
                lo = hi

    kind = docs.schema[id_col].dataType.simpleString()
    return spread(docs.select(id_col, F.col(text_col).cast("string").alias("text"))).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")
