"""Words, lines and hashes as the corpus operators define them."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, functions as F

# Fixed by the query contracts: what separates words, and what a word is.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def whole(text: str = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, other letters as they are."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hash_pair(name: str, *values: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes, which together identify a value."""
    return (F.xxhash64(F.lit(name), *values),
            F.xxhash64(F.lit(f"second {name}"), *values))


def row_id(*columns: str) -> tuple[Column, Column]:
    """Two hashes that rows with equal values share; nulls count as values."""
    return hash_pair("row", *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words after A-Z are lower-cased.

    Blanks are ASCII and so is the case change, so both work on the UTF-8 bytes.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finalizer of a 64-bit hash)."""
    h = values.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def joined(first: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Hashes of sequences from the hashes of their members, order kept."""
    h = mixed(first)
    for other in others:
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + other)
    return h
