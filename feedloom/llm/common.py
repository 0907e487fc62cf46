"""What the text operators share: words, keys of rows, tables read more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of anything but ASCII white space; bytes.split() cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, with A-Z (and nothing else) in lower case."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def text_key(text: Column) -> Column:
    """A key that tells rows of equal id but different text apart."""
    return F.xxhash64(text)


def free_name(columns: Sequence[str], wanted: str) -> str:
    """The wanted column name, with underscores in front until no input column has it."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
