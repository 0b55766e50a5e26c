"""Arrow UDFs over scan lines: ``px`` is one row of RGB bytes, three per pixel."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType()) for name in names])


def _pixels(row: bytes) -> np.ndarray:
    return np.frombuffer(row, np.uint8).reshape(-1, 3)


def _uniform(rows: pd.Series) -> np.ndarray | None:
    """All rows as one ``n x width x 3`` block when their lengths agree."""
    if len(rows) == 0 or rows.isna().any():
        return None
    size = len(rows.iloc[0])
    if size == 0 or any(len(row) != size for row in rows):
        return None
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1, 3)


def _cut(block: np.ndarray) -> pd.Series:
    """Rows of a block as bytes."""
    data, size = np.ascontiguousarray(block).tobytes(), block[0].nbytes
    return pd.Series([data[i:i + size] for i in range(0, len(data), size)], dtype=object)


@F.pandas_udf(T.BinaryType())
def mirror_row(rows: pd.Series) -> pd.Series:
    """Reverse the pixels of a scan line."""
    block = _uniform(rows)
    if block is not None:
        return _cut(block[:, ::-1])
    return rows.map(lambda row: None if row is None else _pixels(row)[::-1].tobytes())


@F.pandas_udf(T.BinaryType())
def swap_red_blue(rows: pd.Series) -> pd.Series:
    """BGR bytes to RGB bytes (and back)."""
    block = _uniform(rows)
    if block is not None:
        return _cut(block[:, :, ::-1])
    return rows.map(lambda row: None if row is None else _pixels(row)[:, ::-1].tobytes())


@F.pandas_udf(_longs("total", "squares"))
def slice_moments(rows: pd.Series) -> pd.DataFrame:
    """Sum and sum of squares of the channel sums of a slice, exact integers."""
    block = _uniform(rows)
    if block is not None:
        grey = block.sum(axis=2, dtype=np.int64)
        return pd.DataFrame({"total": grey.sum(axis=1), "squares": (grey * grey).sum(axis=1)})
    out = []
    for row in rows:
        grey = _pixels(row or b"").sum(axis=1, dtype=np.int64)
        out.append((int(grey.sum()), int((grey * grey).sum())))
    return pd.DataFrame(out, columns=["total", "squares"])


def strided_grey(px: Column, stride: int) -> Column:
    """Channel sums of every ``stride``-th pixel of a row, as packed 16-bit numbers."""
    @F.pandas_udf(T.BinaryType())
    def take(rows: pd.Series) -> pd.Series:
        block = _uniform(rows)
        if block is not None:
            return _cut(block[:, ::stride].sum(axis=2, dtype=np.uint16))
        return rows.map(lambda row: _pixels(row)[::stride].sum(axis=1, dtype=np.uint16).tobytes())
    return take(px)


@F.pandas_udf(_longs("n", "a", "b", "aa", "bb", "ab", "ab_mirrored"))
def row_products(first: pd.Series, second: pd.Series) -> pd.DataFrame:
    """Sums needed for the correlation of two grey rows, plain and with the second mirrored."""
    names = ["n", "a", "b", "aa", "bb", "ab", "ab_mirrored"]
    out = np.zeros((len(first), 7), np.int64)
    lengths = first.map(len).to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        a, b = (np.frombuffer(b"".join(side.iloc[at]), np.uint16).reshape(len(at), -1).astype(np.int64)
                for side in (first, second))
        sums = [a.sum(1), b.sum(1), (a * a).sum(1), (b * b).sum(1), (a * b).sum(1), (a * b[:, ::-1]).sum(1)]
        out[at] = np.stack([np.full(len(at), length // 2), *sums], axis=1)
    return pd.DataFrame(out, columns=names)


def _mismatch(first: pd.Series, second: pd.Series):
    """Pairs of rows grouped by length: row numbers, first pixels, mask of differing pixels."""
    lengths = first.map(len).to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        a, b = (np.frombuffer(b"".join(side.iloc[at]), np.uint8).reshape(len(at), -1, 3) for side in (first, second))
        yield at, a, (a != b).any(axis=2)


@F.pandas_udf(_longs("differing", "white"))
def count_differences(first: pd.Series, second: pd.Series) -> pd.DataFrame:
    """Differing pixels of two rows and how many of them are pure white in the first."""
    out = np.zeros((len(first), 2), np.int64)
    for at, a, differs in _mismatch(first, second):
        out[at, 0] = differs.sum(axis=1)
        out[at, 1] = (differs & (a == 255).all(axis=2)).sum(axis=1)
    return pd.DataFrame(out, columns=["differing", "white"])


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def differing_columns(first: pa.Array, second: pa.Array) -> pa.Array:
    """Columns of the differing pixels of two rows, ascending; made as one list array a batch."""
    counts, rows, columns = np.zeros(len(first), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at, _, differs in _mismatch(first.to_pandas(), second.to_pandas()):
        row, column = np.nonzero(differs)
        counts[at] = differs.sum(axis=1)
        rows.append(at[row])
        columns.append(column)
    order = np.argsort(np.concatenate(rows), kind="stable")
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(columns)[order].astype(np.int32)))


def row_slice(px: Column, left: Column, width: Column) -> Column:
    """Bytes of ``width`` pixels from pixel ``left`` of a row."""
    return F.substring(px, (left * 3 + 1).cast("int"), (width * 3).cast("int"))
