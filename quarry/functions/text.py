"""Column-level text helpers, all JVM-side built-in functions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.schemas import PY_WHITESPACE, PY_WHITESPACE_CLASS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def py_words(c) -> Column:
    """Python ``str.split()`` on already stripped text; [] for empty text.

    ``split('')`` yields [''] in Spark, so empty text is guarded.
    """
    c = _col(c)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")) \
        .otherwise(F.split(c, PY_WHITESPACE_CLASS + "+"))


def py_word_count(c) -> Column:
    """Number of whitespace-separated words of stripped text, 0 if empty."""
    c = _col(c)
    return F.when(c.isNull() | (F.length(c) == 0), F.lit(0)) \
        .otherwise(F.size(F.split(c, PY_WHITESPACE_CLASS + "+")))


def ascii_lower(c) -> Column:
    """Lower-case ASCII letters only (SQLite ``LIKE`` and FTS5 ``ascii`` fold)."""
    return F.translate(_col(c), _UPPER, _LOWER)


def like_pattern_contains(q: str) -> str:
    """``%q%`` for Spark ``LIKE`` with SQLite's semantics: ``%`` and ``_`` in
    ``q`` stay wildcards and there is no escape character, so every
    backslash is doubled (Spark's default escape is ``\\``)."""
    return "%" + q.replace("\\", "\\\\") + "%"


def name_contains(c, q: str) -> Column:
    """SQLite ``c LIKE '%q%'``: ASCII-case-insensitive, wildcards in ``q`` live."""
    return ascii_lower(c).like(like_pattern_contains(q.translate(str.maketrans(_UPPER, _LOWER))))


def basename(c) -> Column:
    """Last ``/``-separated segment of a path or URL."""
    return F.element_at(F.split(_col(c), "/"), -1)


def url_filename(c, decode: bool = False) -> Column:
    """Last path segment cut at ``?``; optionally percent-decoded.

    ``url_decode`` would also turn ``+`` into a space, which ``unquote`` does
    not; ``+`` is protected as ``%2B`` first. ``try_url_decode`` keeps bad
    escapes from failing the job (the value becomes null).
    """
    name = F.split(basename(c), "\\?").getItem(0)
    if decode:
        name = F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return name
