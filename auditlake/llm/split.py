"""Problem 3: cutting items above a size limit into overlapping pieces at natural boundaries.

A hierarchy of separators (sections, paragraphs and fences, lines, sentences, words, characters) is descended only
where a part is still too large; the parts are then packed greedily up to the limit.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


OVERLAP = 200
_HEADING = re.compile(r"^#{1,6}[ \t]", re.M)
_FENCE = re.compile(r"^ {0,3}(`{3,}|~{3,})[^\n]*$", re.M)
_PARAGRAPH = re.compile(r"\n[ \t]*\n\s*")
_LINE = re.compile(r"\r?\n")
_SENTENCE = re.compile(r"[.!?…][\"')\]]*\s+|[。！？]+\s*")
_WORD = re.compile(r"\s+")
_JOINED = re.compile(r"[̀-ͯ‍︀-️\U0001f3fb-\U0001f3ff]")
#: At most so many characters are kept together because they form one sign (letter with marks, joined emoji).
CLUSTER = 32

PIECE = "piece_no int, start_pos int, end_pos int, overlap int, boundary string, piece string"


def _fences(text: str) -> list[tuple[int, int]]:
    """Spans of fenced code, from the opening line to the end of the closing one (or of the text)."""
    spans, opened = [], None
    for m in _FENCE.finditer(text):
        mark = m.group(1)
        if opened is None:
            opened = (m.start(), mark)
        elif mark[0] == opened[1][0] and len(mark) >= len(opened[1]) and m.group().strip() == mark:
            spans.append((opened[0], min(len(text), m.end() + 1)))
            opened = None
    if opened is not None:
        spans.append((opened[0], len(text)))
    return spans


class _Cutter:
    """Cut positions of one text by level; levels are named for the boundary at which a piece ends."""

    LEVELS = ("section", "paragraph", "line", "sentence", "word")

    def __init__(self, text: str):
        self.text = text
        fences = _fences(text)
        starts = [a for a, _ in fences]

        def outside(at: int) -> bool:
            k = bisect.bisect_right(starts, at) - 1
            return k < 0 or not fences[k][0] < at < fences[k][1]

        edges = [x for span in fences for x in span]
        self.cuts = {
            "section": [m.start() for m in _HEADING.finditer(text) if outside(m.start())],
            "paragraph": sorted({m.end() for m in _PARAGRAPH.finditer(text) if outside(m.end())} | set(edges)),
        }

    def within(self, level: str, start: int, end: int) -> list[int]:
        if level in self.cuts:
            return [x for x in self.cuts[level] if start < x < end]
        pattern = {"line": _LINE, "sentence": _SENTENCE, "word": _WORD}[level]
        return [x for m in pattern.finditer(self.text, start, end) if start < (x := m.end()) < end]

    def parts(self, start: int, end: int, room: int, level: int = 0) -> Iterator[tuple[int, str]]:
        """(end, boundary) of consecutive parts of at most ``room`` characters."""
        stack = [(start, end, level, "end")]
        while stack:
            start, end, level, name = stack.pop()
            if end - start <= room:
                yield end, name
            elif level < len(self.LEVELS):
                cuts = self.within(self.LEVELS[level], start, end)
                bounds = [start, *cuts, end]
                names = [self.LEVELS[level]] * len(cuts) + [name]
                stack += [(a, b, level + 1, n) for a, b, n in reversed(list(zip(bounds, bounds[1:], names)))]
            else:
                while end - start > room:
                    start = self.character(start, start + room)
                    yield start, "character"
                yield end, name

    def character(self, start: int, at: int) -> int:
        """The last position up to ``at`` that doesn't part a sign from its marks."""
        for back in range(min(CLUSTER, at - start - 1)):
            x = at - back
            if not _JOINED.match(self.text[x]) and self.text[x - 1] != "‍" and self.text[x - 1 : x + 1] != "\r\n":
                return x
        return at


def split_text(text: str, limit: int, overlap: int = OVERLAP) -> list[tuple[int, int, int, int, str, str]]:
    """Pieces (no, start, end, overlap, boundary, text) of at most ``limit`` code points.

    Every piece but the first starts with the last ``overlap`` characters of the one before, so the text is the
    first piece and the rest of each later one. A text within the limit is one piece, an empty one too.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be shorter than the limit")
    if len(text) <= limit:
        return [(1, 0, len(text), 0, "end", text)]
    pieces, begun, until, name = [], 0, 0, "end"

    def close() -> None:
        back = min(overlap, begun) if pieces else 0
        pieces.append((len(pieces) + 1, begun - back, until, back, name, text[begun - back : until]))

    for end, boundary in _Cutter(text).parts(0, len(text), limit - overlap):
        if until > begun and end - begun > limit - (min(overlap, begun) if pieces else 0):
            close()
            begun = until
        until, name = end, boundary
    close()
    return pieces


def split_items(df: DataFrame, text: str, limit: int, overlap: int = OVERLAP, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per piece: the key columns, then piece_no, start_pos, end_pos, overlap, boundary and piece.

    Null texts give no piece; empty ones and those within the limit give one. Keys that repeat give repeated pieces
    (drop redelivered rows first). Only texts above the limit leave the JVM; nothing is shuffled.
    """
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    base = df.select(*named, F.col(text).alias("_text")).where("_text is not null")
    short = base.where(F.char_length("_text") <= limit).select(
        *[f"_key{i}" for i in range(len(keys))],
        F.lit(1).alias("piece_no"), F.lit(0).alias("start_pos"), F.char_length("_text").alias("end_pos"),
        F.lit(0).alias("overlap"), F.lit("end").alias("boundary"), F.col("_text").alias("piece"),
    )

    @F.pandas_udf(f"array<struct<{PIECE.replace(' int', ':int').replace(' string', ':string')}>>")
    def pieces(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(_NAMES, p)) for p in split_text(t, limit, overlap)] for t in texts], dtype=object)

    long = base.where(F.char_length("_text") > limit).select(*[f"_key{i}" for i in range(len(keys))], F.inline(pieces("_text")))
    return short.unionByName(long).withColumnsRenamed({f"_key{i}": k for i, k in enumerate(keys)})


_NAMES = ("piece_no", "start_pos", "end_pos", "overlap", "boundary", "piece")


def restore(pieces: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The texts back from their pieces, as (keys, text)."""
    body = F.expr("substring(piece, overlap + 1, end_pos - start_pos)")
    ordered = F.array_sort(F.collect_list(F.struct("piece_no", body.alias("body"))))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x.body), "").alias("text"))
