"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.operators.staging import materialize, ordered_prefix, scratch, shared_folder

__all__ = ["WORD", "crc_bucket", "materialize", "ordered_prefix", "scratch", "shared_folder", "word_count"]

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; null ids fall in bucket 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0)).cast("int")
