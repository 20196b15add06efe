"""Levenshtein distance of texts of any length, a column of the distance table at a time.

A column of the table is kept as two bit sets, the places where it rises and where it falls by one against the place
above (Myers 1999, Hyyro 2003).  Both are whole numbers of as many bits as the longer text has characters, so one step
works on all rows of the table, 64 and more cells an operation, for short and long texts alike.
"""

from __future__ import annotations

from os.path import commonprefix

import numpy as np
import pandas as pd

from pyspark.sql import Column
from pyspark.sql import functions as F


def levenshtein(a: str, b: str) -> int:
    """Characters to insert, delete or replace; what both texts start and end with is not looked at."""
    if len(a) < len(b):
        a, b = b, a
    if a == b:
        return 0
    start = len(commonprefix((a, b)))
    a, b = a[start:], b[start:]
    end = len(commonprefix((a[::-1], b[::-1])))
    if end:
        a, b = a[:-end], b[:-end]
    size = len(a)
    if not b:
        return size
    places: dict[str, int] = {}
    if size <= 64:
        bit = 1
        for c in a:
            places[c] = places.get(c, 0) | bit
            bit <<= 1
    else:
        codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
        for code in np.unique(codes):
            places[chr(code)] = int.from_bytes(np.packbits(codes == code, bitorder="little").tobytes(), "little")
    full = (1 << size) - 1
    last = 1 << (size - 1)
    rises, falls, distance = full, 0, size
    for c in b:
        match = places.get(c, 0) | falls
        diagonal = ((((match & rises) + rises) ^ rises) | match) & full  # where the table does not grow downwards right
        up = falls | (full ^ (rises | diagonal))
        down = rises & diagonal
        if up & last:
            distance += 1
        elif down & last:
            distance -= 1
        up = (up << 1) | 1
        falls = up & diagonal
        rises = ((down << 1) | (full ^ ((up | diagonal) & full))) & full
    return distance


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance on code points; null where a text is null."""

    @F.pandas_udf("long")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        values = [None if x is None or y is None else levenshtein(x, y) for x, y in zip(left, right, strict=True)]
        return pd.Series(values, dtype="Int64")

    return run(a, b)
