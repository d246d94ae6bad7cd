"""Keyword tokens and share arithmetic used by the sale-detail search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token rule (fixed): a token is one Han character, or a run of other letters, digits
# and the combining marks that follow them; everything is lower-cased.  A match
# requires every keyword token.
TOKEN_PATTERN = r"\p{IsHan}|[\p{L}\p{N}\p{M}&&[^\p{IsHan}]]+"


def tokens(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


def match_all(text: Column | str, keyword: str | None) -> Column:
    """True when every token of ``keyword`` is a token of ``text``.

    Both sides go through ``tokens``; the keyword is a literal, so its token list
    folds to a constant.  An empty keyword matches every row; a keyword that has
    characters but no token (``"--"``) matches none.
    """
    if not (keyword or "").strip():
        return F.lit(True)
    want = tokens(F.lit(keyword))
    return (F.size(want) > 0) & (F.size(F.array_except(want, tokens(text))) == 0)


def round_half_up_1(count: Column, total: Column) -> Column:
    """``round(count * 1000 / total) / 10`` with a guard for total 0 (gives 0)."""
    ratio = F.try_divide(count.cast("double") * F.lit(1000.0), total.cast("double"))
    return F.coalesce(F.floor(ratio + F.lit(0.5)) / F.lit(10.0), F.lit(0.0))


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole years as days // 365 (no leap days), truncated toward zero."""
    days = F.datediff(as_of, birthday)
    return F.when(days >= 0, F.floor(days / F.lit(365))).otherwise(-F.floor(-days / F.lit(365))).cast("int")
