"""What several operators share: reading tables, storing intermediates, word patterns, column helpers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.sources.tables import write_once

# Fixed value: a word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

#: Code that runs in Spark's Python workers never holds more than about so many entries in a cache.
CACHE_ENTRIES = 100_000


def reach_workers(spark: SparkSession) -> None:
    """Let Spark's Python workers import this package from where the driver found it.

    Enough where executors see the same folder, as in local mode; elsewhere ship the package with --py-files.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Write an intermediate result to the shared folder and go on from the written rows. That cuts the lineage: a lost
#: executor costs a task, never the work before this table.
store = write_once

def release_memory() -> None:
    """Give what was freed back to the machine: a worker lives on between tasks, beside others and the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


_STATE: dict[Any, Any] = {}


def worker_state(key: Any, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps between tasks under ``key``; only the last key's, since workers serve all operators."""
    if key not in _STATE:
        _STATE.clear()
        release_memory()
        _STATE[key] = make()
    return _STATE[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that a worker's memory follows them and not Arrow's batch; the memory goes back at the end."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)
    release_memory()


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, with underscores added until no column has that name (Spark ignores case)."""
    taken = {name.lower() for name in taken}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)
