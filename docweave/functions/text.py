"""Text normalisation as column expressions."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# White space and line ends as the results to be matched define them.
# Java's \s is ASCII only, and its Unicode form leaves out U+001C to U+001F.
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
LINE_BREAK = rf"\r\n|[{LINE_END}]"

# Page-number lines.
ROMAN = r"(?=[mdclxvi])m{0,4}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
NUMBER = rf"(?:\p{{Nd}}{{1,4}}|{ROMAN})"
PAGE_NUMBER_LINE = (
    rf"(?i)\A[{WS}]*(?:-[{WS}]*{NUMBER}[{WS}]*-?|{NUMBER}[{WS}]*-|\p{{Nd}}{{1,3}}|{ROMAN})[{WS}]*\z"
)
PAGE_OF_LINE = (
    rf"\A[{WS}]*(?:Page[{WS}]+\p{{Nd}}+(?:[{WS}]+of[{WS}]+\p{{Nd}}+)?"
    rf"|페이지[{WS}]*\p{{Nd}}+[{WS}]*/[{WS}]*\p{{Nd}}+)[{WS}]*\z"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside a lambda.

    An outer expression named in a lambda is evaluated again for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(col: Column) -> Column:
    """NULL for the empty string (a missing value, not a white-space one)."""
    return F.nullif(col, F.lit(""))


# The same white space as a set of characters, for trimming without a pattern.
WS_CHARS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip(col: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(col, F.lit(WS_CHARS))


def lstrip(col: Column) -> Column:
    return F.ltrim(col, F.lit(WS_CHARS))


def is_blank(col: Column) -> Column:
    return strip(F.coalesce(col, F.lit(""))) == ""


def lines(col: Column) -> Column:
    """Lines of a text, without a last empty one after a closing line end."""
    return let(F.split(col, LINE_BREAK, -1), lambda parts: F.when(
        F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)
    ).otherwise(parts))


def fingerprint(col: Column, n: int | None = None) -> Column:
    """Lower case, one blank per white-space run, trimmed; of that the first ``n`` characters, if given."""
    folded = F.trim(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), rf"[{WS}]+", " "))
    return F.substring(folded, 1, n) if n else folded


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: unicodedata.normalize("NFC", text), na_action="ignore")


def html_unescape(col: Column) -> Column:
    """Decode entities. Only texts holding an ampersand travel to Python."""
    return F.coalesce(_unescape(F.when(F.contains(col, F.lit("&")), col)), col)


def nfc(col: Column) -> Column:
    """Compose to NFC. Texts below U+0300 are composed already and stay in the JVM."""
    return F.coalesce(_nfc(F.when(col.rlike(r"[^\u0000-\u02ff]"), col)), col)


def unescape_chunk_text(col: Column) -> Column:
    """Entities decoded, line ends unified, at most one blank line, trimmed."""
    text = html_unescape(F.coalesce(col, F.lit("")))
    text = F.regexp_replace(text, r"\r\n?", "\n")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def strip_noise(col: Column) -> Column:
    """Drop page-number lines, keep at most one blank line, trim."""
    kept = F.filter(lines(col), lambda line: ~(line.rlike(PAGE_NUMBER_LINE) | line.rlike(PAGE_OF_LINE)))
    return strip(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"))


def cleanup_markdown(col: Column) -> Column:
    return strip_noise(nfc(col))


def canonical(col: Column) -> Column:
    """Composed text without private-use characters, emphasis marks and white space."""
    text = nfc(F.coalesce(col, F.lit("")))
    return F.regexp_replace(text, rf"[\ue000-\uf8ff*~`#\\{WS}]+", "")


def utf8_length(col: Column) -> Column:
    return F.octet_length(col)


# --- Markdown tables inside one text -------------------------------------------------


def is_separator_row(line: Column) -> Column:
    """A table rule: only bars, colons, dashes, blanks and tabs, with a bar and three dashes."""
    text = strip(line)
    return F.contains(text, F.lit("|")) & F.contains(text, F.lit("---")) & text.rlike(r"\A[|:\- \t]+\z")


def count_markdown_tables(col: Column) -> Column:
    """Rules that follow a line starting with a bar, plus HTML table tags."""
    text = F.coalesce(col, F.lit(""))

    def ruled(rows: Column) -> Column:
        rules = F.filter(
            F.sequence(F.lit(2), F.size(rows)),
            lambda i: is_separator_row(F.element_at(rows, i))
            & lstrip(F.element_at(rows, i - 1)).startswith("|"),
        )
        return F.when(F.size(rows) > 1, F.size(rules)).otherwise(0)

    gfm = F.when(F.contains(text, F.lit("---")), let(lines(text), ruled)).otherwise(0)
    return F.regexp_count(F.lower(text), F.lit("<table")) + gfm


# A run of lines that start and end with a bar. The possessive forms keep Java's matcher
# iterative, so that a table of many thousand rows does not deepen its stack.
_INLINE_WS = r"\t\x1f\x20\xa0\u1680\u2000-\u200a\u202f\u205f\u3000"
_ROW = rf"[{_INLINE_WS}]*+\|(?:[^{LINE_END}]*\|)?+[{_INLINE_WS}]*+(?:{LINE_BREAK}|\z)"
TABLE_BLOCK = rf"(?<![^{LINE_END}])(?:{_ROW})++"


def table_spans(col: Column) -> Column:
    """Start and end offsets (from 0, end exclusive) of the Markdown tables of a text.

    The pieces between the blocks and the blocks themselves are cut by one pattern, so the
    offsets are sums of piece lengths; no line leaves its row.
    """
    text = F.coalesce(col, F.lit(""))

    def sizes(pieces: Column) -> Column:
        return F.transform(pieces, lambda piece: F.length(piece))

    def total(counts: Column, n: Column) -> Column:
        return F.aggregate(F.slice(counts, 1, n), F.lit(0), lambda acc, count: acc + count)

    def spans(cut: Column) -> Column:
        return F.transform(
            cut["newlines"],
            lambda newlines, k: F.struct(
                (total(cut["gaps"], k + 1) + total(cut["blocks"], k)).alias("start"),
                (total(cut["gaps"], k + 1) + total(cut["blocks"], k + 1)).alias("end"),
                newlines.alias("newlines"),
            ),
        )

    blocks = F.regexp_extract_all(text, F.lit(TABLE_BLOCK), F.lit(0))
    cut = let(blocks, lambda found: F.struct(
        sizes(found).alias("blocks"),
        sizes(F.split(text, TABLE_BLOCK, -1)).alias("gaps"),
        F.transform(found, lambda block: F.regexp_count(block, F.lit("\n"))).alias("newlines"),
    ))
    return F.filter(let(cut, spans), lambda span: span["newlines"] >= 2)
