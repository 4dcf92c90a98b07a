"""Text expressions, all native so that they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Python's ``str.strip`` removes.
_BLANKS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Characters with a meaning in regular expressions.
_SPECIAL = "\\.[]{}()<>*+-=!?^$|"


def quoted(name: str) -> str:
    """Back-quote one identifier, so that dots and dashes in names are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def sql_string(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_pattern(text: str) -> str:
    """A regular expression that matches ``text`` and nothing else."""
    if not text:
        raise ValueError("empty delimiter")
    if len(text) == 1 and text not in _SPECIAL:
        return text  # a plain character is split on without a regular expression
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` alone only removes spaces)."""
    return F.trim(text, F.lit(_BLANKS))


def truncate_utf8(text: Column, width: int) -> Column:
    """Cut ``text`` to at most ``width`` UTF-8 bytes, never inside a character.

    Characters are counted by their first bytes. Among the first ``width + 1`` bytes exactly one counted
    character is not whole within ``width``: either one that begins at the last byte, or one that goes on
    there. Short on purpose: a wide table has this once per text column in one generated method, and the
    JVM does not compile very long methods.
    """
    if width < 0:
        raise ValueError("width must not be negative")
    head = F.substring(text.cast("binary"), 1, width + 1).cast("string")
    cut = F.left(text, F.char_length(head) - 1)
    return F.when(F.octet_length(text) <= width, text).otherwise(cut)
