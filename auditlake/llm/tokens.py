"""Problem 7: encoding texts with a public byte-level BPE vocabulary by prefix dynamic programming.

Every byte prefix of a piece of text has exactly one last token with which its encoding ends (a later merge can't
undo it), so one array of last tokens describes the encodings of all prefixes at once. It grows by appending bytes,
and after an edit only the stretch between the edit and the next common piece boundary is computed again.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from auditlake.runtime import SLICE_ROWS


#: Fixed value: the pattern that splits text before the merges of the byte-level vocabularies.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pieces whose ids a worker remembers; at the bound it forgets all of them, so memory doesn't grow with the corpus.
MEMO_PIECES = 200_000
#: A piece's end depends on at most so many characters behind it (contractions and the look-ahead for blanks).
LOOK_AHEAD = 3


class Vocabulary:
    """Ranks of a byte-level BPE with, per token, the two tokens it was merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.trie: dict = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            node = self.trie
            for byte in token:
                node = node.setdefault(byte, {})
            node[-1] = rank
            self.split[rank] = (rank, rank)
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None and max(left, right) < rank and self.joins(left, right):
                    self.split[rank], self.merge[left, right] = (left, right), rank
                    break

    def joins(self, left: int, right: int) -> bool:
        """Whether the two tokens can stand side by side in an encoding.

        Walks down the seam between them, always undoing the merge made last; a merge across the seam that would
        have come earlier than both sides were complete proves that they can't.
        """
        bound = len(self.ranks) + 1
        while True:
            if self.merge.get((left, right), bound) < bound:
                return False
            if left > right:
                bound, inner = left, self.split[left][1]
                if inner != left:
                    left = inner
                    continue
                bound, inner = right + 1, self.split[right][0]
                if inner == right:
                    return True
                right = inner
            else:
                bound, inner = right + 1, self.split[right][0]
                if inner != right:
                    right = inner
                    continue
                bound, inner = left, self.split[left][1]
                if inner == left:
                    return True
                left = inner

    def extend(self, data: bytes, last: list[int], sizes: list[int]) -> None:
        """Fill the last token (and its length) of every prefix of data beyond those that are known.

        last[i] and sizes[i] belong to the prefix of i bytes, index 0 being the empty prefix. A token that starts
        before the known end may reach beyond it, so the walk resumes one longest token earlier.
        """
        n, known = len(data), len(last) - 1
        last.extend([-1] * (n - known))
        sizes.extend([0] * (n - known))
        trie, joins = self.trie, self.joins
        for start in range(max(0, known - self.longest), n):
            node, before = trie, last[start]
            for end in range(start, n):
                node = node.get(data[end])
                if node is None:
                    break
                token = node.get(-1)
                if token is not None and end >= known and last[end + 1] < 0 and (start == 0 or joins(before, token)):
                    last[end + 1], sizes[end + 1] = token, end + 1 - start

    @property
    def longest(self) -> int:
        if "_longest" not in self.__dict__:
            self._longest = max(map(len, self.ranks))
        return self._longest

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last, sizes = [-1], [0]
        self.extend(data, last, sizes)
        return _walk_back(last, sizes)


def _walk_back(last: list[int], sizes: list[int]) -> list[int]:
    ids, at = [], len(last) - 1
    while at > 0:
        ids.append(last[at])
        at -= sizes[at]
    return ids[::-1]


@lru_cache(maxsize=4)
def vocabulary(content: bytes) -> Vocabulary:
    """Vocabulary from the content of a rank file; built once per process."""
    return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a})


class Encoding:
    """A text with the prefix tables of its pieces, open for appends and edits."""

    def __init__(self, vocab: Vocabulary, text: str = ""):
        self.vocab, self.text = vocab, text
        self.starts: list[int] = []
        self.tables: list[tuple[list[int], list[int]]] = []
        self.recomputed = 0
        self._scan(0, [], [], None, {})

    def _table(self, piece: str, grown: tuple[str, tuple] | None) -> tuple[list[int], list[int]]:
        """Tables of a piece; one that continues ``grown`` only gets the entries of its new bytes."""
        last, sizes = [-1], [0]
        if grown and piece.startswith(grown[0]):
            last, sizes = list(grown[1][0]), list(grown[1][1])
        self.vocab.extend(piece.encode("utf-8", "replace"), last, sizes)
        self.recomputed += 1
        return last, sizes

    def _scan(self, at: int, starts: list, tables: list, grown: tuple[str, tuple] | None, rest: dict[int, int]) -> None:
        """Cut and encode from ``at``; stop where a piece starts at a boundary in ``rest`` (new start -> old index)."""
        for m in regex.compile(PIECES).finditer(self.text, at):
            if m.start() in rest:
                k = rest[m.start()]
                shift = m.start() - self.starts[k]
                starts += [s + shift for s in self.starts[k:]]
                tables += self.tables[k:]
                break
            starts.append(m.start())
            tables.append(self._table(m.group(), grown))
            grown = None
        self.starts, self.tables = starts, tables

    def replace(self, start: int, end: int, new: str) -> None:
        """Put new in place of text[start:end]; pieces before and behind keep their tables."""
        ends = [*self.starts[1:], len(self.text)]
        keep = bisect.bisect_right(ends, start - LOOK_AHEAD, hi=len(self.starts))
        shift, resume = len(new) - (end - start), bisect.bisect_left(self.starts, end, lo=keep)
        rest = {self.starts[k] + shift: k for k in range(resume, len(self.starts))}
        at, grown = len(self.text), None
        if keep < len(self.starts):
            at, grown = self.starts[keep], (self.text[self.starts[keep] : ends[keep]], self.tables[keep])
        self.text = self.text[:start] + new + self.text[end:]
        self.recomputed = 0
        self._scan(at, self.starts[:keep], self.tables[:keep], grown, rest)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def ids(self) -> list[int]:
        return [i for table in self.tables for i in _walk_back(*table)]

    def prefix_ids(self, piece: int, size: int) -> list[int]:
        """Ids of the first ``size`` bytes of a piece, read off its table without encoding anything."""
        last, sizes = self.tables[piece]
        return _walk_back(last[: size + 1], sizes[: size + 1])


class Encoder:
    """Whole texts to ids with a bounded memory of pieces."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.find, self.memo = vocab, regex.compile(PIECES).findall, {}

    def __call__(self, text: str | None) -> list[int]:
        if not text:
            return []
        memo, ids = self.memo, []
        for piece in self.find(text):
            got = memo.get(piece)
            if got is None:
                if len(memo) >= MEMO_PIECES:
                    memo.clear()
                got = memo[piece] = self.vocab.encode_piece(piece.encode("utf-8", "replace"))
            ids += got
        return ids


def encode_texts(df: DataFrame, text: str = "text", into: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """df with the token ids of ``text`` in ``into`` (array<int>, replacing a column of that name).

    Strings that look like special tokens are ordinary text. Null and empty texts give an empty list, never null.
    No shuffle: one pass, the vocabulary (under 1 MB, fixed by its file) goes to the executors as a broadcast.
    """
    spark = df.sparkSession
    with open(path, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())

    @F.pandas_udf(ArrayType(IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = Encoder(vocabulary(content.value))
        for texts in batches:
            for k in range(0, len(texts), SLICE_ROWS):
                yield pd.Series([encode(t) for t in texts.iloc[k : k + SLICE_ROWS]], dtype=object)

    return df.withColumn(into, ids(F.col(text)))
