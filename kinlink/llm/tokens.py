"""Encoding texts with a public byte-level BPE by prefix dynamic programming.

For a byte string under a given list of merges, every prefix has one encoding, and its last
token is the one fact needed to extend it: a token may follow the last token of a shorter
prefix exactly if the two, encoded together, stay two. So a table of the last token of each
prefix gives every encoding by walking back, grows by exact appends, and is right up to the
place of an edit. The table is filled per word of the tokenizer's word pattern, as no token
crosses a word's border; words recur, so each worker fills a word's table once.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Fixed value: the word pattern of the public byte-level BPE of 50,257 ids.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZERS = "/opt/tokenizers"
BYTE_BPE_50K = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


class Vocabulary:
    """Tokens with their ranks; a rank is both the id and the order of its merge. Single bytes rank before all others."""

    PAIRS = 1_000_000  # pairs kept by stays_two and crosses, which then begin anew

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        self.bytes_of = {r: t for t, r in ranks.items()}
        # tokens by their last bytes: step[node, byte before] and the token that a node spells from its end
        self.step: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        for t, r in ranks.items():
            node = 0
            for x in reversed(t):
                node = self.step.setdefault(node << 8 | x, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = r
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._stays: dict[tuple[int, int], bool] = {}
        self._crosses: dict[str, bool] = {}
        self._seams = {seam for t in ranks for seam in _seams(t)}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())})

    def merged(self, parts: list[bytes], least: int = 1) -> list[bytes]:
        """Byte-pair merging by definition: the leftmost pair of least rank first, until least parts are left. For short strings."""
        parts = list(parts)
        while len(parts) > least:
            at = min(range(len(parts) - 1), key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i))
            if parts[at] + parts[at + 1] not in self.ranks:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for a single byte, and for one that merging never makes."""
        if token not in self._halves:
            two = self.merged([bytes([x]) for x in self.bytes_of[token]], 2)
            self._halves[token] = (self.ranks[two[0]], self.ranks[two[1]]) if len(two) == 2 else None
        return self._halves[token]

    def stays_two(self, a: int, b: int) -> bool:
        """Whether token a before token b encodes as exactly these two.

        Merges are undone at the border, the latest first: a pair there that merges earlier than the token it is part of would
        have been made instead.
        """
        known = self._stays.get((a, b))
        if known is not None:
            return known
        x, y, before = a, b, 1 << 60
        while True:
            m = self.ranks.get(self.bytes_of[x] + self.bytes_of[y])
            if m is not None and m < before:
                out = False
                break
            # the later merge is undone first; of equal ones (x == y) the right one, as the leftmost pair merges first
            of_x, of_y = self.halves(x), self.halves(y)
            if of_x and (x > y or not of_y):
                before, x = x, of_x[1]
            elif of_y:
                before, y = y + 1, of_y[0]
            else:
                out = True
                break
        if len(self._stays) >= self.PAIRS:
            self._stays.clear()
        self._stays[a, b] = out
        return out

    def crosses(self, pair: str) -> bool:
        """Whether any token spans the border of two letters. If none does, what stands on either side encodes by itself."""
        known = self._crosses.get(pair)
        if known is None:
            a, b = (c.encode("utf-8", "surrogatepass") for c in pair)
            known = any((a[i:], b[:j]) in self._seams for i in range(len(a)) for j in range(1, len(b) + 1))
            if len(self._crosses) >= self.PAIRS:
                self._crosses.clear()
            self._crosses[pair] = known
        return known


def _seams(token: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Of each border of letters within a token, what it has of the letter before and of that behind."""
    starts = [i for i, x in enumerate(token) if x & 0xC0 != 0x80]
    for k, i in enumerate(starts):
        if i:
            yield token[starts[k - 1] if k else 0 : i], token[i : starts[k + 1] if k + 1 < len(starts) else len(token)]


class PrefixTable:
    """The last token of every prefix of a byte string: last[i] ends prefix i (last[0] is -1)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the string; the table of what is there stays as it is."""
        step, token_at, stays, last = self.v.step, self.v.token_at, self.v.stays_two, self.last
        start, self.data = len(self.data), self.data + more
        data = self.data
        for end in range(start + 1, len(data) + 1):
            # only tokens that end here are looked at, by the bytes before the end; one of them is valid
            node, i = 0, end
            while i:
                i -= 1
                node = step.get(node << 8 | data[i])
                if node is None:
                    raise ValueError(f"byte {data[end - 1]} is no token")
                token = token_at[node]
                if token >= 0 and (not i or stays(last[i], token)):
                    last.append(token)
                    break

    def splice(self, at: int, removed: int, inserted: bytes) -> None:
        """Replace removed bytes from at on. Entries before at are kept; after the edit the table
        is refilled only until longest entries in a row agree with the old ones, which fixes the rest."""
        old, tail = self.last, self.data[at + removed :]
        self.data, self.last = self.data[:at], old[: at + 1]
        self.append(inserted)
        agree = 0
        for k in range(len(tail)):
            if agree >= self.v.longest:
                self.data, self.last = self.data + tail[k:], self.last + old[at + removed + k + 1 :]
                return
            self.append(tail[k : k + 1])
            agree = agree + 1 if self.last[-1] == old[at + removed + k + 1] else 0

    def ids(self) -> list[int]:
        out, i = [], len(self.data)
        while i:
            out.append(self.last[i])
            i -= len(self.v.bytes_of[self.last[i]])
        return out[::-1]


class Encoder(dict):
    """word -> ids, filled on first sight. It is emptied at most words entries, so memory is bounded.

    Words with letters beyond ASCII, which in scripts without blanks are whole sentences, are cut where no token spans
    the border of two letters; the pieces recur and are kept like words.
    """

    def __init__(self, path: str = BYTE_BPE_50K, words: int = 500_000):
        self.vocabulary, self.words = Vocabulary.read(path), words
        self.split = regex.compile(WORDS).findall

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(word) > 1 and not word.isascii():
            crosses, cuts = self.vocabulary.crosses, [0]
            cuts += [i for i in range(1, len(word)) if not crosses(word[i - 1 : i + 1])]
            if len(cuts) > 1:
                ids = tuple(itertools.chain.from_iterable(self[word[a:b]] for a, b in zip(cuts, [*cuts[1:], len(word)])))
                return self._kept(word, ids)
        return self._kept(word, tuple(PrefixTable(self.vocabulary, word.encode("utf-8", "surrogatepass")).ids()))

    def _kept(self, word: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(word) <= 64:
            if len(self) >= self.words:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        return list(itertools.chain.from_iterable(map(self.__getitem__, self.split(text)))) if text else []


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker and vocabulary file."""
    return Encoder(path)


def encoded(df: DataFrame, id_col: str, text_col: str, path: str = BYTE_BPE_50K) -> DataFrame:
    """(id_col, ids): the ids of every text without special tokens.

    Null and empty texts give an empty list; strings of special tokens are ordinary text. Rows
    stay where they are: no shuffle, one Arrow batch of texts in memory at a time. path names
    the vocabulary file on every machine.
    """
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = part.column(1).to_pylist()
                ids, ends = [], np.zeros(len(texts) + 1, dtype=np.int32)
                for k, t in enumerate(texts):
                    if t:
                        ids.extend(itertools.chain.from_iterable(map(e.__getitem__, e.split(t))))
                    ends[k + 1] = len(ids)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(ids, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], [id_col, "ids"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def token_counts(df: DataFrame, id_col: str, text_col: str, path: str = BYTE_BPE_50K) -> DataFrame:
    """(id_col, n_tokens bigint): the number of ids of every text, 0 for null and empty ones."""
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            sizes = [sum(map(len, map(e.__getitem__, e.split(t)))) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], [id_col, "n_tokens"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint")
