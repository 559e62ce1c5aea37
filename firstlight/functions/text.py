"""Text match and highlight.

A text is cut into tokens: lower-cased runs of letters and digits, with every
Han character a token of its own.  A text matches a query when it holds any
(``or``) or all (``and``) of the query's tokens.
"""

from __future__ import annotations

import unicodedata
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code-point ranges of the Han ideographs.
HAN_RANGES = (
    (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF),
    (0x20000, 0x323AF),
)

_HAN = "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in HAN_RANGES)
_WORD = f"[\\p{{L}}\\p{{N}}&&[^{_HAN}]]"


def _is_han(ch: str) -> bool:
    return any(lo <= ord(ch) <= hi for lo, hi in HAN_RANGES)


def tokens(text: Column) -> Column:
    """Array of the tokens of a text column."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"([{_HAN}]|{_WORD}+)"), F.lit(1))


def query_terms(query: str) -> list[str]:
    """Distinct tokens of a query text, in order."""
    terms, word = [], ""
    for ch in query.lower() + " ":
        if _is_han(ch) or unicodedata.category(ch)[0] not in "LN":
            if word:
                terms.append(word)
            word = ""
            if _is_han(ch):
                terms.append(ch)
        else:
            word += ch
    return list(dict.fromkeys(terms))


def _pattern(terms: list[str]) -> str:
    """Whole-token pattern.  Terms hold letters and digits only, so they need no escape."""
    words = [t for t in terms if not _is_han(t[0])]
    parts = [t for t in terms if _is_han(t[0])]
    if words:
        parts.append(f"(?<!{_WORD})(?:{'|'.join(words)})(?!{_WORD})")
    return "|".join(parts)


def match_text(text: Column, query: str, operator: str = "or") -> Column:
    """Does the whole text hold the query's tokens?

    One regular expression over the lower-cased text: same answer as
    comparing :func:`tokens` with the query's, without building an array per
    row.  A plain substring test comes first and spares the expression most
    texts without the token.  A query without tokens matches nothing.
    """
    if operator not in ("or", "and"):
        raise ValueError("operator is 'or' or 'and'")
    terms = query_terms(query)
    if not terms:
        return F.lit(False)
    low = F.lower(text)
    holds = lambda some: reduce(or_, [low.contains(t) for t in some]) & low.rlike(_pattern(some))
    if operator == "or":
        return holds(terms)
    return reduce(and_, [holds([t]) for t in terms])


def highlight(text: Column, query: str, pre: str = "<em>", post: str = "</em>") -> Column:
    """Mark every token of the query in the text, keeping the text's own case."""
    terms = query_terms(query)
    if not terms:
        return text
    escape = lambda s: s.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, f"(?iu)({_pattern(terms)})", f"{escape(pre)}$1{escape(post)}")
