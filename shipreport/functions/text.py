"""Text expressions with SQL Server comparison and concatenation rules.

Comparing there ignores trailing blanks and, under the usual collations, letter
case; ``+`` on strings is NULL when either side is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Python's str.strip() removes.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _fold_text(value: str, ignore_case: bool) -> str:
    value = value.rstrip(" ")
    return value.upper() if ignore_case else value


def fold(col: Column, ignore_case: bool = True) -> Column:
    """The form of a code in which two equal codes are equal strings."""
    trimmed = F.rtrim(col)
    return F.upper(trimmed) if ignore_case else trimmed


def code_eq(col: Column, value: str, ignore_case: bool = True) -> Column:
    return fold(col, ignore_case) == F.lit(_fold_text(value, ignore_case))


def code_ne(col: Column, value: str, ignore_case: bool = True) -> Column:
    return fold(col, ignore_case) != F.lit(_fold_text(value, ignore_case))


def code_in(col: Column, values: list[str] | tuple[str, ...], ignore_case: bool = True) -> Column:
    return fold(col, ignore_case).isin(*[_fold_text(v, ignore_case) for v in values])


def is_blank(col: Column) -> Column:
    """NULL, empty and blanks-only are the same."""
    return F.rtrim(F.coalesce(col, F.lit(""))) == ""


def not_blank(col: Column) -> Column:
    """``is_blank`` negated, with a null check that Parquet can prune on."""
    return col.isNotNull() & (F.rtrim(col) != "")


def join_text(*cols: Column) -> Column:
    """Concatenate; NULL if any part is NULL."""
    return F.concat(*cols)


def to_text(col: Column) -> Column:
    return col.cast("string")


def left_chars(col: Column, n: int) -> Column:
    return F.left(col, F.lit(n))


def right_chars(col: Column, n: int) -> Column:
    return F.right(col, F.lit(n))


def pieces_by_unit(pieces: Column, unit: Column, wanted: str, ignore_case: bool = True) -> Column:
    """The piece count if it is counted in ``wanted``, else NULL."""
    return F.when(code_eq(unit, wanted, ignore_case), pieces)


def pieces_label(pieces: Column, unit: Column, inner: Column | None = None,
                 inner_unit: Column | None = None) -> Column:
    """``"12 PLT"``, or ``"12 PLT 3 CTN"`` unless the inner count is 0."""
    outer = join_text(to_text(pieces), F.lit(" "), unit)
    if inner is None:
        return outer
    both = join_text(outer, F.lit(" "), to_text(inner), F.lit(" "), inner_unit)
    return F.when(inner == 0, outer).otherwise(both)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def norm_name(col: Column) -> Column:
    """A file name in upper case without the PDF extension."""
    return strip(F.replace(F.upper(strip(col)), F.lit(".PDF"), F.lit("")))


def clean_type(col: Column) -> Column:
    """A stored document type in upper case without its ``*`` marks."""
    bare = F.replace(F.coalesce(col, F.lit("")), F.lit("*"), F.lit(""))
    return F.upper(strip(bare))


def slice_match(name: Column, key: Column) -> Column:
    """The name starts with characters 4 to 6 of the key."""
    head = F.substring(F.upper(strip(name)), 1, 3)
    return (F.length(key) >= 6) & (head == F.substring(key, 4, 3))
