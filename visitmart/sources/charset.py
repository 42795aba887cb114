"""Charsets of the extracts' files.

Spark reads and writes text in a few charsets only; windows-1252, which the
loaders call ``latin1``, is not among them. It differs from ISO-8859-1 in the 27
characters it puts at 0x80-0x9F, so files go through ISO-8859-1 and those
characters are translated by a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT = "windows-1252"


def _table() -> tuple[str, str]:
    """(characters of windows-1252 at 0x80-0x9F, what ISO-8859-1 has there)."""
    pairs = [(bytes([b]).decode("cp1252", "ignore"), chr(b)) for b in range(0x80, 0xA0)]
    return "".join(c for c, _ in pairs if c), "".join(i for c, i in pairs if c)


WINDOWS, CONTROLS = _table()


def spark_name(charset: str) -> str:
    return "ISO-8859-1" if charset.lower() in ("windows-1252", "cp1252") else charset


def after_read(c: Column, charset: str) -> Column:
    return F.translate(c, CONTROLS, WINDOWS) if spark_name(charset) != charset else c


def before_write(c: Column, charset: str) -> Column:
    return F.translate(c, WINDOWS, CONTROLS) if spark_name(charset) != charset else c
