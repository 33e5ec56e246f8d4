"""Tokens, query terms, coverage and BM25 terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.text import let

# Fixed values of the lexical ranking.
TOKEN = r"[가-힣]+|[a-zA-Z]+|\p{Nd}+"
HANGUL = r"\A[가-힣]"
MIN_TERM_CHARS = 2
BM25_K1 = 1.5
BM25_B = 0.75
RRF_K = 60.0


def words(col: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(TOKEN), F.lit(0))


def tokens(col: Column) -> Column:
    """Lower-case tokens; a Hangul token also gives its pairs of neighbouring letters."""
    plain = words(F.lower(col))

    def with_pairs(token: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.length(token) - 1), lambda i: F.substring(token, i, F.lit(2))
        )
        wide = token.rlike(HANGUL) & (F.length(token) > 1)
        return F.when(wide, F.concat(F.array(token), pairs)).otherwise(F.array(token))

    return F.when(col.rlike("[가-힣]"), F.flatten(F.transform(plain, with_pairs))).otherwise(plain)


def query_terms(col: Column) -> Column:
    """Words of two or more characters in their own spelling, first spelling of each kept."""
    long_words = F.filter(words(col), lambda w: F.length(w) >= MIN_TERM_CHARS)
    keyed = F.struct(long_words.alias("words"), F.transform(long_words, lambda w: F.lower(w)).alias("keys"))
    return let(keyed, lambda both: F.filter(
        both["words"], lambda w, i: F.array_position(both["keys"], F.lower(w)) == i + 1
    ))


def matched_terms(terms: Column, text: Column) -> Column:
    """Terms found in a text: Hangul anywhere, other words only as whole tokens."""
    low = F.lower(F.coalesce(text, F.lit("")))
    read = let(low, lambda t: F.struct(t.alias("text"), F.array_distinct(words(t)).alias("words")))
    return let(read, lambda known: F.filter(
        terms,
        lambda t: F.when(t.rlike(HANGUL), F.contains(known["text"], F.lower(t))).otherwise(
            F.array_contains(known["words"], F.lower(t))
        ),
    ))


def bm25_term(n: Column, df: Column, tf: Column, length: Column, mean_length: Column) -> Column:
    idf = F.ln(1 + (n - df + 0.5) / (df + 0.5))
    norm = 1 - BM25_B + BM25_B * length / mean_length
    return idf * (tf * (BM25_K1 + 1)) / (tf + BM25_K1 * norm)


def rrf(vector_rank: Column, lexical_rank: Column) -> Column:
    return 1.0 / (F.lit(RRF_K) + vector_rank) + 1.0 / (F.lit(RRF_K) + lexical_rank)
