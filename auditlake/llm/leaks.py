"""Problem 8: passages of held-out evaluation items in corpus documents.

The items are a small set; hashes of all their word n-grams go to every task. One pass over the corpus looks up the
word windows of a whole slice of documents at once, and every region with hits is verified by local alignment before
it counts. Positions are those of the text as stored, so that what is cut out leaves the rest untouched.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain, groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.llm.lookalikes import INVISIBLE, JOINER, transducer
from auditlake.runtime import in_slices

#: Words of a passage that a document must hold, in order and close together.
LEAST_WORDS = 20
#: Most changed and surplus words for each word that matches; above it, the words in common are those of a shared
#: style, not of the passage. So in the least leak four words may be touched.
EDITS = 0.22
#: Window size. Four touched words leave six windows of three among twenty words, but maybe none of five.
WINDOW = 3
#: Dense stretches of hits closer than this are one region, which is verified with so many words on either side.
GAP = 12
#: Costs of a changed or surplus word, tried in turn: a higher one parts stretches that a surplus between them joins.
COSTS = (1, 2, 4)
#: Bytes of evaluation text that go to every task at once; more is looked up in blocks of that size.
BLOCK_BYTES = 64 << 20
#: Regions aligned in one vector operation.
ALIGNED = 128
MEMO_WORDS = 300_000
_LATIN = re.compile("[A-Za-z]")
_A, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x165667B19E3779F9)


@lru_cache(maxsize=1)
def word_pattern() -> re.Pattern:
    """Runs of letters, digits, marks and invisible signs: everything else ends a word."""
    inside = set(INVISIBLE + JOINER)
    ends = [c for c in range(0x10000) if not (chr(c).isalnum() or unicodedata.category(chr(c))[0] == "M" or chr(c) in inside)]
    ranges = [(c, c) for c in ends[:1]]
    for c in ends[1:]:
        ranges[-1:] = [(ranges[-1][0], c)] if c == ranges[-1][1] + 1 else [ranges[-1], (c, c)]
    listed = "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges)
    return re.compile(f"[^{listed}\\U0001f000-\\U0001fbff]+")


class Words(dict):
    """64-bit codes of words as they stand in a text, equal for words that differ in case, marks of emphasis or forms
    of characters only; 0 for runs without a letter or digit."""

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        if word.isascii():
            plain = word.lower()
        else:  # look-alikes are told by their case in words with Latin letters; in others case goes first
            plain = transducer().run(word if _LATIN.search(word) else word.lower())
            plain = unicodedata.normalize("NFKC", plain).casefold()
        raw = "".join(c for c in plain if c.isalnum() or unicodedata.category(c)[0] == "M").encode()
        code = self[word] = (zlib.crc32(raw) << 32 | zlib.crc32(raw[::-1] + b"#" + raw) | 1) if raw else 0
        return code

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(codes, text numbers) of all words."""
        found = list(map(word_pattern().findall, texts))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        codes = np.fromiter(map(self.__getitem__, chain.from_iterable(found)), np.uint64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts)), sizes)
        return codes[codes != 0], owner[codes != 0]

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in word_pattern().finditer(text) if self[m.group()]]


def passage_of(text: str | None) -> str:
    """The second paragraph of an item; empty if it has none."""
    parts = [p for p in re.split(r"\r?\n[ \t]*\r?\n", text or "") if p.strip()]
    return parts[1] if len(parts) > 1 else ""


def windows(codes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first places) of all runs of ``size`` words inside one text."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    key = np.zeros(n, np.uint64)
    for k in range(size):
        key = (key ^ codes[k : k + n]) * _A
        key = (key ^ (key >> np.uint64(29))) * _C
    whole = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return key[whole], whole


def common_words(a: list[int], places: dict[int, int], size: int) -> int:
    """Length of the longest common subsequence of words of a passage with it; its words' places are bit masks."""
    row = full = (1 << size) - 1
    for w in a:
        hit = row & places[w]
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def aligned_stretches(texts: list[np.ndarray], goals: list[np.ndarray], cost: int = 1) -> np.ndarray:
    """(edits, matches, start, end in the text) of the best local alignment of each text with its goal.

    A match counts 1, a changed or surplus word -cost. A cell packs score, matches and start into one integer, so one
    word of all texts at once is a few vector operations.
    """
    one, match, low = 1 << 42, 1 << 21, (1 << 21) - 1
    a, b = (np.full((len(x), max(map(len, x))), fill, np.uint64) for x, fill in ((texts, 0), (goals, 2)))
    for rows, parts in ((a, texts), (b, goals)):
        for row, part in zip(rows, parts):
            row[: len(part)] = part
    slope = cost * one * np.arange(b.shape[1], dtype=np.int64)
    before = np.zeros((len(a), b.shape[1] + 1), np.int64)
    best, until = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for i in range(a.shape[1]):
        diagonal = before[:, :-1]
        cell = np.where(b == a[:, i : i + 1], np.where(diagonal > 0, diagonal, low - i) + (one + match), diagonal - cost * one)
        np.maximum(cell, before[:, 1:] - cost * one, out=cell)
        cell[cell < one] = 0
        cell += slope
        np.maximum.accumulate(cell, axis=1, out=cell)
        cell -= slope
        cell[cell < one] = 0
        before[:, 1:] = cell
        top = cell.max(axis=1)
        better = top > best
        best[better], until[better] = top[better], i + 1
    matches = best >> 21 & low
    return np.c_[(matches - (best >> 42)) // cost, matches, np.where(best > 0, low - (best & low), 0), until]


class LeakIndex:
    """Word windows of all distinct passages, each with the item ids that share it."""

    def __init__(self, items: list[tuple[object, str]], least: int = LEAST_WORDS, window: int = WINDOW, edits: float = EDITS):
        self.least, self.window, self.edits, self.words = least, window, edits, Words()
        self.touched = int(edits * least)
        shared: dict[tuple, set] = defaultdict(set)
        for item, passage in items:
            shared[tuple(self.words.of([passage])[0].tolist())].add(item)
        kept = [(p, sorted(ids)) for p, ids in sorted(shared.items()) if len(p) >= least]
        self.passages = [(np.array(p, np.uint64), ids) for p, ids in kept]
        self.places = []
        pairs = set()
        for k, (p, _) in enumerate(self.passages):
            masks: dict[int, int] = defaultdict(int)
            for j, w in enumerate(p.tolist()):
                masks[w] |= 1 << j
            self.places.append(dict(masks))
            pairs |= {(g, k) for g in windows(p, np.zeros(len(p), np.int64), window)[0].tolist()}
        ordered = sorted(pairs)
        self.grams, self.first = np.unique(np.array([g for g, _ in ordered], np.uint64), return_index=True)
        self.first = np.r_[self.first, len(ordered)]
        self.holders = np.array([k for _, k in ordered], np.int64)

    def hits(self, codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, passage, place) of every window that a passage holds, in that order."""
        keys, at = windows(codes, owner, self.window)
        if not len(keys) or not len(self.grams):
            return (np.empty(0, np.int64),) * 3
        gram = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
        found = self.grams[gram] == keys
        gram, at = gram[found], at[found]
        n = self.first[gram + 1] - self.first[gram]
        at = np.repeat(at, n)
        passage = self.holders[np.repeat(self.first[gram] - np.cumsum(n) + n, n) + np.arange(len(at))]
        order = np.lexsort((at, passage, owner[at]))
        return owner[at][order], passage[order], at[order]

    def __call__(self, texts: list[str]) -> Iterator[tuple[int, object, int, int, int]]:
        """(text number, item, matched words, start, end) of every leaked stretch; positions count in the text as it is."""
        codes, owner = self.words.of(texts)
        text, passage, at = self.hits(codes, owner)
        need = max(1, self.least - self.window + 1 - self.window * self.touched)
        if len(at) < need:
            return
        # dense enough for a leak of the least length: ``need`` hits of one passage within so many words
        a, b = slice(0, len(at) - need + 1), slice(need - 1, len(at))
        dense = np.flatnonzero((text[a] == text[b]) & (passage[a] == passage[b]) & (at[b] - at[a] <= self.least + self.touched))
        begins = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        found = self.regions(text[dense].tolist(), passage[dense].tolist(), at[dense].tolist(), at[dense + need - 1].tolist())
        todo = [(t, k, max(begins[t], low - GAP), min(begins[t + 1], high + self.window + GAP), 0) for t, k, low, high in found]
        spans: dict[int, list[tuple[int, int]]] = {}
        while todo:
            now, todo = sorted((x for x in todo if x[4] or self.may_hold(codes[x[2] : x[3]], x[1])), key=lambda x: (x[4], x[3] - x[2])), []
            for cost, same in groupby(now, key=lambda x: x[4]):
                same = list(same)
                for first in range(0, len(same), ALIGNED):
                    some = same[first : first + ALIGNED]
                    got = aligned_stretches([codes[a:b] for _, _, a, b, _ in some], [self.passages[k][0] for _, k, *_ in some], COSTS[cost])
                    for (t, k, a, b, _), (edits, matches, start, end) in zip(some, got.tolist()):
                        if matches < self.least:
                            continue
                        if edits > self.edits * matches:
                            todo += [(t, k, a, b, cost + 1)] if cost + 1 < len(COSTS) else []
                            continue
                        todo += [(t, k, x, y, 0) for x, y in ((a, a + start), (a + end, b)) if y - x >= self.least]  # what is left beside it
                        if t not in spans:
                            spans[t] = self.words.spans(texts[t])
                        low, high = spans[t][a + start - begins[t]][0], spans[t][a + end - 1 - begins[t]][1]
                        yield from ((t, item, matches, low, high) for item in self.passages[k][1])

    @staticmethod
    def regions(text: list[int], passage: list[int], low: list[int], high: list[int]) -> Iterator[tuple[int, int, int, int]]:
        """(text, passage, first, last hit) of dense runs of hits, those closer than GAP as one."""
        now: tuple[int, int, int, int] | None = None
        for t, k, a, b in zip(text, passage, low, high):
            if now is not None and (t, k) == now[:2] and a - now[3] <= GAP:
                now = t, k, now[2], b
                continue
            if now is not None:
                yield now
            now = t, k, a, b
        if now is not None:
            yield now

    def may_hold(self, words: np.ndarray, k: int) -> bool:
        """Whether enough words of the passage stand here in their order."""
        places = self.places[k]
        known = [w for w in words.tolist() if w in places]
        return len(known) >= self.least and common_words(known, places, len(self.passages[k][0])) >= self.least


def find_leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    least: int = LEAST_WORDS, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(key, item_key, words, start_pos, end_pos), one row for each stretch of a document that holds an item's passage.

    Items without a second paragraph, or with one shorter than ``least`` words, can't leak. Null and empty documents
    hold nothing. Items that share a passage are all reported. The corpus is read once and never shuffled; items of
    more than ``block_bytes`` are parted by their texts into blocks of about that size, and the corpus is read once
    for each block.
    """
    spark = docs.sparkSession
    chosen = items.select(item_key, item_text).where(F.col(item_text).isNotNull() & F.col(item_key).isNotNull()).distinct()
    size, n = chosen.agg(F.coalesce(F.sum(F.octet_length(item_text)), F.lit(0)), F.count("*")).first()
    blocks = max(1, min(-(-size // block_bytes), n))
    corpus = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null and k is not null")
    kind = f"`{key}` {docs.schema[key].dataType.simpleString()}, `{item_key}` {items.schema[item_key].dataType.simpleString()}, words int, start_pos int, end_pos int"

    def looked_up(block: DataFrame) -> DataFrame:
        shared = spark.sparkContext.broadcast([(r[0], passage_of(r[1])) for r in block.collect()])

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = LeakIndex(shared.value, least, window)
            for part in in_slices(batches):
                keys = list(part["k"])
                yield pd.DataFrame([(keys[t], *leak) for t, *leak in index(list(part["t"]))], columns=[key, item_key, "words", "start_pos", "end_pos"])

        return corpus.mapInPandas(scan, kind)

    place = F.pmod(F.xxhash64(item_text), F.lit(blocks))
    return reduce(DataFrame.unionByName, [looked_up(chosen.where(place == b) if blocks > 1 else chosen) for b in range(blocks)])


def remove_leaks(docs: DataFrame, leaks: DataFrame, key: str = "doc_id", text: str = "text", into: str = "cleaned") -> DataFrame:
    """docs with the leaked stretches cut from the text, all other characters as they were.

    The leaks of a document are few and collected as a set, so they travel as one small array by a left join.
    """
    spans = leaks.groupBy(key).agg(F.sort_array(F.collect_set(F.struct("start_pos", "end_pos"))).alias("_spans"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(texts, spans):
            if t is not None and s is not None and len(s):
                at, kept = 0, []
                for x in s:
                    kept.append(t[at : max(at, x["start_pos"])])
                    at = max(at, x["end_pos"])
                t = "".join([*kept, t[at:]])
            out.append(t)
        return pd.Series(out, dtype=object)

    return docs.join(spans, key, "left").withColumn(into, cut(F.col(text), F.col("_spans"))).drop("_spans")
