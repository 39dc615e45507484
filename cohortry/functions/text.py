"""Text clean-up and casts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_chars(col: Column | str, chars: str = "'\"") -> Column:
    """Remove the characters anywhere, then trim blanks."""
    return F.trim(F.regexp_replace(_col(col), f"[{re.escape(chars)}]", ""))


def replace_text(col: Column | str, pattern: str, to: str, first_only: bool = False) -> Column:
    c = _col(col)
    if first_only:
        # Everything before the first match is captured lazily, so one replacement is made per value.
        return F.regexp_replace(c, f"(?s)^(.*?)(?:{pattern})", f"$1{to}")
    return F.regexp_replace(c, pattern, to)


def replace_in_order(col: Column | str, rules: Sequence[tuple[str, str | None]]) -> Column:
    """Apply (pattern, replacement) rules one after the other; a rule to None turns a matching value into NULL."""
    out = _col(col)
    for pattern, to in rules:
        out = F.when(~out.rlike(pattern), out) if to is None else F.regexp_replace(out, pattern, to)
    return out


def substring_from(col: Column | str, start: int) -> Column:
    """From the 1-based position to the end."""
    c = _col(col).cast("string")
    return F.substring(c, F.lit(start), F.greatest(F.length(c), F.lit(0)))


def pad_left(col: Column | str, width: int, pad: str = "0") -> Column:
    """Pad on the left; longer values stay whole."""
    c = _col(col).cast("string")
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, pad))


def concat_text(*cols: Column | str, null_as: str | None = None) -> Column:
    """Join texts. NULL makes the result NULL, unless ``null_as`` gives the text to print for it."""
    parts = [_col(c).cast("string") for c in cols]
    if null_as is not None:
        parts = [F.coalesce(p, F.lit(null_as)) for p in parts]
    return F.concat(*parts)


def safe_cast(col: Column | str, to: str) -> Column:
    """Cast; a value that does not parse becomes NULL."""
    c = _col(col)
    return F.trim(c.cast("string")).try_cast(to)


def lowercase(col: Column | str) -> Column:
    return F.lower(_col(col))


def hospital_key(col: Column | str, prefix_chars: int = 0, width: int = 6) -> Column:
    """The one form of a hospital id used everywhere: text, state prefix dropped, padded to six."""
    c = _col(col).cast("string")
    if prefix_chars:
        c = substring_from(c, prefix_chars + 1)
    return pad_left(c, width)
