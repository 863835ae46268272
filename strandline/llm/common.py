"""Shared plumbing: table reading and text definitions."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scratch import discard, materialize, release, scratch_dir, scratch_path, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Separators of the alphanumeric word definition, after A-Z became a-z.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column | str) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(F.col(col) if isinstance(col, str) else col, UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    """Words of the alphanumeric definition, in order; null text has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NON_WORD)
    return F.filter(parts, lambda w: w != "")


# --- memory of a worker process ----------------------------------------------------------------------------------

_HELD: dict[Any, Any] = {}


def held(name: Any, make: Callable[[], Any]) -> Any:
    """make()'s object, kept between the tasks of a worker process; one object at a time, so that none outlives its operator's turn."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def give_back() -> None:
    """Return freed memory to the machine: a reused worker process would keep its largest task's."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only this C library has the call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def sliced(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts in the column have about max_bytes at most; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            yield batch
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        a = size = 0
        for b, x in enumerate(sizes.tolist()):
            if b > a and size + x > max_bytes:
                yield batch.slice(a, b - a)
                a, size = b, 0
            size += x
        yield batch.slice(a)
    give_back()


__all__ = ["LOWER", "NON_WORD", "UPPER", "alnum_words", "ascii_lower", "discard", "give_back", "held", "materialize", "read_table", "release", "scratch_dir", "scratch_path", "sliced", "written"]
