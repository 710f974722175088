"""Parsing helpers that keep the strict rules of a Java line parser."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


# The characters Java's Character.isWhitespace accepts, which
# decide whether a log line is blank - tab, line feed, vertical tab, form
# feed, carriage return, the four information separators, space, and the
# Unicode space, line and paragraph separators except the no-break spaces
# (U+00A0, U+2007, U+202F).
WHITE_SPACE = ("\t\n\u000b\f\r\u001c\u001d\u001e\u001f"
               " \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2008\u2009\u200a\u2028\u2029\u205f\u3000")
_REGEX_META = set(".$|()[]{}^?*+\\")


def not_blank(c: Column) -> Column:
    """True when the text holds a character other than white space."""
    return c.isNotNull() & (F.length(F.btrim(c, F.lit(WHITE_SPACE))) > 0)


def split_fields(c: Column, sep: str = "\t") -> Column:
    """Split like Java ``String.split(sep)``: empty fields inside and at the
    start are kept, empty fields at the end are dropped.  ``sep`` is a
    regular expression, as in Java."""
    if len(sep) == 1 and sep not in _REGEX_META:
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, f"(?:{sep})+$", "")
    return F.split(stripped, sep, -1)


def strict_int(c: Column, what: str = "field") -> Column:
    """Parse a 32-bit int the way ``Integer.parseInt`` does, or fail the job.

    Accepted: an optional sign and ASCII digits, inside the int range.
    Blanks around the number, decimals, empty text and overflow raise an
    error (Spark's cast would trim blanks and, without ANSI, give NULL).
    """
    wide = c.try_cast("bigint")
    ok = c.rlike(r"^[+-]?[0-9]+$") & wide.isNotNull() & wide.between(INT_MIN, INT_MAX)
    message = F.concat(F.lit(f"not an int in {what}: '"), F.coalesce(c, F.lit("NULL")), F.lit("'"))
    return F.when(ok, wide.cast("int")).otherwise(F.raise_error(message).cast("int"))


def utf8_bytes(c: Column) -> Column:
    """Text -> UTF-8 bytes (cell values stored as binary)."""
    return F.encode(c, "UTF-8")


def utf8_text(c: Column) -> Column:
    """UTF-8 bytes -> text."""
    return F.decode(c, "UTF-8")
