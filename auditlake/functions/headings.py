"""Headings of Markdown texts: a scanner for the part of CommonMark that decides what is a heading.

Known: ATX headings with closing signs, setext headings, fences of both kinds with their lengths, indented code and
HTML blocks. Inline marks are taken off the titles. Not known: headings inside quotes and list items.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

HEADINGS = "array<struct<level:int,title:string,start_line:int>>"
_ATX = re.compile(r"^ {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$")
_FENCE = re.compile(r"^ {0,3}(`{3,}(?=[^`]*$)|~{3,})")
_SETEXT = re.compile(r"^ {0,3}(=+|-+)[ \t]*$")
_HTML_BLOCK = re.compile(r"^ {0,3}<(?:pre|script|style|textarea|!--|/?(?:table|div|p|ul|ol|li|tr|td|th|details|summary|blockquote|h[1-6]|hr|center)\b)", re.I)
_BREAKS_PARAGRAPH = re.compile(r"^ {0,3}(?:>|[-*+][ \t]|\d{1,9}[.)][ \t]|\||(?:\*[ \t]*){3,}$|(?:_[ \t]*){3,}$)")


def inline_text(title: str) -> str:
    """A title without emphasis, links and tags; what code spans hold stays."""
    title = re.sub(r"`+([^`]+)`+", r"\1", title)
    title = re.sub(r"!?\[([^\]]*)\]\([^)]*\)", r"\1", title)
    title = re.sub(r"(\*\*|__)(?=\S)(.*?\S)\1", r"\2", title)
    title = re.sub(r"(?<!\w)([*_])(?=\S)(.*?\S)\1(?!\w)", r"\2", title)
    return re.sub(r"\\([!-/:-@\[-`{-~])", r"\1", title).strip()


def scan_headings(text: str) -> list[tuple[int, str, int]]:
    """(level, title, 0-based line) of all headings."""
    found, fence, paragraph, html = [], None, None, False
    for i, line in enumerate(text.splitlines()):
        if fence:
            if (m := _FENCE.match(line)) and m.group(1)[0] == fence[0] and len(m.group(1)) >= len(fence) and line.strip() == m.group(1):
                fence = None
            continue
        if m := _FENCE.match(line):
            fence, paragraph = m.group(1), None
        elif not line.strip():
            paragraph, html = None, False
        elif html:
            continue
        elif m := _ATX.match(line):
            found.append((len(m.group(1)), inline_text(m.group(2) or ""), i))
            paragraph = None
        elif paragraph is not None and (m := _SETEXT.match(line)):
            found.append((1 if m.group(1)[0] == "=" else 2, inline_text(" ".join(paragraph[1])), paragraph[0]))
            paragraph = None
        elif _HTML_BLOCK.match(line):
            html, paragraph = True, None
        elif paragraph is None and (line.startswith("    ") or line.startswith("\t")):
            continue
        elif _BREAKS_PARAGRAPH.match(line):
            paragraph = None
        elif paragraph is None:
            paragraph = (i, [line.strip()])
        else:
            paragraph[1].append(line.strip())
    return found


@lru_cache(maxsize=1)
def _headings():
    @F.pandas_udf(HEADINGS)
    def headings(texts: pd.Series) -> pd.Series:
        names = ("level", "title", "start_line")
        return pd.Series([[] if t is None else [dict(zip(names, h)) for h in scan_headings(t)] for t in texts], dtype=object)

    return headings


def md_headings(text: Column) -> Column:
    """Headings of a Markdown text as an array of (level, title, start_line); empty for null."""
    return _headings()(text)
