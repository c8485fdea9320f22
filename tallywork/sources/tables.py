"""Stored tables: full-refresh parquet, and intermediate results written once."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallywork.sources.files import Files
from tallywork.sources.snapshots import MANIFESTS, TableSet

_TABLE = "table"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table as last written by ``write_table``, or plain parquet; with a schema given, no file footer is read to plan it."""
    if Files(spark).exists(f"{path.rstrip('/')}/{MANIFESTS}"):
        return TableSet(spark, path).current().read(_TABLE)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and return it as stored; a job that fails leaves the old one, readers keep theirs."""
    with TableSet(df.sparkSession, path).draft() as draft:
        draft.write(_TABLE, df)
    return draft.read(_TABLE)


def scratch_dir(spark: SparkSession) -> str:
    """The folder for intermediate results: the one that spark.checkpoint.dir names, which all executors must share.

    In local mode, where there is one machine, it may be unset; the folder is then in the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for intermediate results, removed when the application ends."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    Files(spark).make_folder(path)
    Files(spark).remove_on_exit(path)
    return path


_written: ContextVar[list[str] | None] = ContextVar("scratch tables of the run", default=None)


@contextmanager
def scratch_of_run(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what ``write_once`` wrote inside it; for runs whose results are stored by then."""
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        for path in paths or ():
            Files(spark).remove(path)


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several consumers read to the shared folder, and read it from there.

    Unlike a cache, it is not recomputed by each consumer when executors are lost. It is removed at the
    end of the run (``scratch_of_run``) or of the application, since lazy results may read it until then.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("append").parquet(path)
    if (paths := _written.get()) is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)
