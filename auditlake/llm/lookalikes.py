"""Problem 9: one consistent form for texts that read the same but are stored as different characters.

A longest-match transducer works on grapheme clusters: letters with their marks, kana with their voice marks, single
characters. Its table is derived by rule from the Unicode character data and a short list of look-alike letters,
checked for conflicts, and applied in a single pass over the text. Covered are full-width and half-width forms,
joined letters, composed and combining accents, invisible signs, all blanks, and the Cyrillic, Greek and Armenian
letters and hyphens listed below; other scripts' look-alikes are not.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.runtime import cut_lineage

# Letters of other scripts that are drawn like Latin ones, and hyphens drawn alike.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХԚԜаеѕіјорсухһԁԛԝ", "ABESIJKMHOPCTYXQWaesijopcyxhdqw"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳον", "ABEZHIKMNOPTYXCjov"))
OTHERS = {"‐": "-", "‑": "-", "ѵ": "v", "Ѵ": "V", "ӏ": "l", "Ӏ": "I", "ո": "n", "օ": "o"}
#: Ranges of compatibility forms that count as the ordinary letters: joined letters, full-width and half-width forms.
FOLDED = ((0x0132, 0x0133), (0x01C4, 0x01CC), (0x01F1, 0x01F3), (0xFB00, 0xFB06), (0xFB13, 0xFB17), (0xFF01, 0xFFEE))
#: Half-width kana, and the half-width voice marks that make one sign with them.
KANA, VOICE = (0xFF66, 0xFF9D), "ﾞﾟ"
# Invisible characters: they part or join nothing that can be seen.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩⁪⁫⁬⁭⁮⁯ㅤ﻿￹￺￻"
JOINER = "‍"


# Scripts in which joiners and non-joiners change how letters are drawn.
SHAPED = r"[\p{Arab}\p{Syrc}\p{Mong}\p{Deva}\p{Beng}\p{Guru}\p{Gujr}\p{Orya}\p{Taml}\p{Telu}\p{Knda}\p{Mlym}\p{Sinh}]"
MEMO_TOKENS = 100_000


class Transducer:
    """Mapping of grapheme clusters to their consistent form.

    Rows (source, target) of one or more characters enter one table; a source with two targets, or a target that would
    itself be rewritten, is a conflict and refused. So the mapping is one function, and applying it twice changes nothing.
    """

    def __init__(self) -> None:
        self.table: dict[str, str] = {}
        for source, target in {**CYRILLIC, **GREEK, **OTHERS, **dict.fromkeys(INVISIBLE + JOINER, "")}.items():
            self.add(source, target)
        for low, high in FOLDED:
            for code in range(low, high + 1):
                plain = unicodedata.normalize("NFKC", chr(code))
                if plain != chr(code) and " " not in plain:  # a sign that stands on its own stays one
                    self.add(chr(code), "".join(self.table.get(c, c) for c in plain))
        for code in range(0x80, 0x10000):  # letters with marks whose letter is mapped, in one character and in several
            parts = unicodedata.normalize("NFD", chr(code))
            if len(parts) > 1 and any(c in self.table for c in parts):
                target = unicodedata.normalize("NFC", "".join(self.table.get(c, c) for c in parts))
                self.add(chr(code), target)
                self.add(parts, target)
        for code in range(KANA[0], KANA[1] + 1):
            for mark in VOICE:
                if len(joined := unicodedata.normalize("NFKC", chr(code) + mark)) == 1:
                    self.add(chr(code) + mark, joined)
        self.check()
        self.chars = {ord(k): v for k, v in self.table.items() if len(k) == 1}
        self.tokens: dict[str, str] = {}
        self.marked = regex.compile(rf"[\p{{M}}{VOICE}]")
        self.kept = regex.compile(
            rf"(?<=\p{{Extended_Pictographic}}[️\U0001f3fb-\U0001f3ff]*){JOINER}(?=\p{{Extended_Pictographic}})|(?<={SHAPED}\p{{M}}*)[‌{JOINER}](?={SHAPED})"
        )

    def add(self, source: str, target: str) -> None:
        if self.table.setdefault(source, target) != target:
            raise ValueError(f"{source!r} would become both {self.table[source]!r} and {target!r}")

    def check(self) -> None:
        for source, target in self.table.items():
            if any(c in self.table for c in target):
                raise ValueError(f"{source!r} becomes {target!r}, which would be rewritten again")

    def run(self, text: str) -> str:
        """The form of a text without blanks: clusters mapped, unseen signs dropped, marks composed."""
        keep = {m.start() for m in self.kept.finditer(text)} if JOINER in text or "‌" in text else ()
        if keep:
            text = "".join(ch if i in keep else self.table.get(ch, ch) for i, ch in enumerate(text))
        elif self.marked.search(text):
            text = "".join(self.table.get(x) or x.translate(self.chars) for x in regex.findall(r"\X", text))
        else:
            text = text.translate(self.chars)
        return unicodedata.normalize("NFC", text)

    def token(self, token: str) -> str:
        if token.isascii():
            return token
        got = self.tokens.get(token)
        if got is None:
            if len(self.tokens) >= MEMO_TOKENS:
                self.tokens.clear()
            got = self.tokens[token] = self.run(token)
        return got

    def __call__(self, text: str) -> str:
        """The form of a text; a run of blanks (with unseen signs in it) is one blank, none at the ends."""
        if _OTHER_BLANKS.search(text):
            text = _OTHER_BLANKS.sub(" ", text)
        if text.isascii():
            return " ".join(text.split())
        return " ".join(filter(None, map(self.token, text.split())))


# Blank signs that don't count as white space elsewhere: controls, and the empty braille pattern.
_OTHER_BLANKS = re.compile("[\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f⠀]")


@lru_cache(maxsize=1)
def transducer() -> Transducer:
    return Transducer()


def consistent_texts(df: DataFrame, text: str = "text", into: str = "form") -> DataFrame:
    """df with the consistent form of ``text`` in ``into`` (replacing a column of that name).

    Equal-looking texts get equal forms: widths, joined letters, look-alike letters, composed or combining accents,
    invisible signs and all blanks (a run is one blank, none at the ends). Case, accents, digits, raised and circled
    signs stay. Null stays null, blank texts become empty. One pass, no shuffle.
    """
    @F.pandas_udf("string")
    def form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        apply = transducer()
        for texts in batches:
            yield pd.Series([None if t is None else apply(t) for t in texts], dtype=object)

    return df.withColumn(into, form(F.col(text)))


def equal_looking_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, form_id, text_id): form_id is shared by texts that look the same, text_id by texts stored the same.

    Only texts that look like another, differently stored one are listed; null and blank texts never are. Ids are
    SHA-256 digests. Texts are reduced to digests before the only shuffles.
    """
    forms = consistent_texts(df.select(F.col(key).alias(key), F.col(text).alias("_text")).where("_text is not null"), "_text", "_form")
    ids = forms.where("_form <> ''").select(key, F.unhex(F.sha2("_form", 256)).alias("form_id"), F.unhex(F.sha2("_text", 256)).alias("text_id"))
    ids = cut_lineage(ids)  # read by three branches; the texts are reduced only once
    mixed = ids.groupBy("form_id").agg(F.min("text_id").alias("low"), F.max("text_id").alias("high")).where("low <> high")
    return ids.join(mixed.select("form_id"), "form_id", "left_semi")


def equal_looking_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key_a, key_b), a < b: rows whose texts differ as stored but look the same.

    Variants of a form meet first, each once however many copies it has; then either side takes its keys. So nothing
    is joined that isn't in the result, whose size this is.
    """
    one = equal_looking_classes(df, key, text).distinct()
    variants = one.select("form_id", "text_id").distinct()
    met = variants.select("form_id", F.col("text_id").alias("ta")).join(variants.select("form_id", F.col("text_id").alias("tb")), "form_id").where("ta < tb").select("ta", "tb")
    x = one.select(F.col("text_id").alias("ta"), F.col(key).alias("x"))
    y = one.select(F.col("text_id").alias("tb"), F.col(key).alias("y"))
    return met.join(x, "ta").join(y, "tb").where("x <> y").select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()
