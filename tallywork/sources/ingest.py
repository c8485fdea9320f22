"""CSV input: read, select and rename, clean, stamp."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywork.functions import text
from tallywork.sources.schemas import CSV_NULLS, SENTINELS, SURVEY_COLUMNS
from tallywork.sources.tables import write_once

logger = logging.getLogger(__name__)

# Quotes are doubled inside quoted fields.
CSV_OPTIONS = {"quote": '"', "escape": '"'}

# A record may begin at most so many bytes before a block that it reaches into; blocks bound it beyond that.
MAX_RECORD_BYTES = 256 * 1024 * 1024
# Lines of a block: what a task of one file split has read is cut into blocks of so many, also where a file cannot be split.
BLOCK_LINES = 65_536

# One field from its beginning: quoted, with what may follow the closing quote, or unquoted, in which quotes are text.
# All repetition is possessive, so that no line is tried twice or needs a deep stack.
_QUOTED_REST = r'[^"]*+(?:""[^"]*+)*+"(?:[^",][^,]*+)?+'
_FIELD = rf'(?:"{_QUOTED_REST}|[^",][^,]*+)?+'
_CLOSED = rf"(?s)^{_FIELD}(?:,{_FIELD})*+\z"
_CLOSING = rf"(?s)^{_QUOTED_REST}(?:,{_FIELD})*+\z"


def read_csv(spark: SparkSession, path: str, records: str = "auto") -> DataFrame:
    """Headed CSV, every column as text; the files of one path share one header.

    The rows are a matter of the content alone. A field is quoted if it begins with a
    quote; there, quotes are doubled and newlines are text. In any other field a quote is
    text. Lines end with a newline, with or without a carriage return before it. Blank
    lines between records are skipped, short rows are filled up with NULL, and a row with
    more fields than the header stops the load, as does a quoted field that is never closed.

    ``records`` only chooses the work: ``"line"`` expects each line to be a record and
    stops where one is not; ``"block"`` puts records together from lines; ``"auto"`` does
    what the lines need. All split files over tasks.

    The source is read once: its lines are stored, each with what it does to the question whether a quoted field
    is open, from either state. What the lines need is known from those marks alone, and rows are made of the
    stored lines, so a slow or compressed source costs one reading whatever it holds.
    """
    if records not in ("auto", "line", "block"):
        raise ValueError(f"records must be 'auto', 'line' or 'block', not {records!r}")
    reader = spark.read.options(**CSV_OPTIONS).option("header", True).option("multiLine", True)
    names = [name.removesuffix("\r") for name in reader.csv(path).columns]  # reads the beginning of one file
    stored = write_once(_lines(spark, path, names), "csv-lines")
    blocks = write_once(_blocks(stored.drop("value")), "csv-blocks")
    if records != "block":
        simple, why = _each_line_a_record(blocks)
        if simple:
            return _parsed(stored.select("value", F.col("like_header").alias("first")), names)
        if records == "line":
            raise ValueError(why)
    blocks = write_once(_placed(blocks), "csv-blocks")
    _stop_at_open_quotes(blocks)
    return _parsed(_records(stored, blocks), names)


def _lines(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Lines with their place, and whether a field is open after them: if none was before (``out``), and if one was (``into``).

    A block is a number of lines that one task has read in a row, (start, part): its split of the file, and its place there.
    """
    raw = F.col("value")
    value = F.when(raw.endswith("\r"), F.left(raw, F.length(raw) - 1)).otherwise(raw)
    quoted = F.contains("value", F.lit('"'))
    header = F.lit(",".join(names).replace('"', "").replace("\r", ""))
    marked = quoted | F.contains("value", F.lit("\r"))  # else the line is what is left without those characters
    like_header = F.when(marked, F.translate("value", '"\r', "") == header).otherwise(F.col("value") == header)
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
            value.alias("value"),
        )
        .withColumn("block", F.struct("start", F.floor(F.col("line") / BLOCK_LINES).alias("part")))
        .drop("start")
        .withColumn("bytes", F.octet_length("value"))
        .withColumn("out", quoted & ~F.col("value").rlike(_CLOSED))
        .withColumn("into", ~quoted | ~F.col("value").rlike(_CLOSING))
        .withColumn("like_header", like_header)
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """Per block of a file: the lines that can change whether a field is open, in order, and what they do together."""
    changes = F.when(F.col("out") | ~F.col("into"), F.struct("line", "out", "into"))
    start = F.struct(F.lit(False).alias("out"), F.lit(True).alias("into"))

    def after(state: Column, line: Column) -> Column:
        """One more line: what it makes of either state."""
        through = lambda was: F.when(was, line["into"]).otherwise(line["out"])
        return F.struct(through(state["out"]).alias("out"), through(state["into"]).alias("into"))

    return (
        lines.groupBy("file", "block")
        .agg(
            F.sort_array(F.collect_list(changes)).alias("changes"),
            F.count_if("out").alias("openers"),
            F.count_if("like_header").alias("headers"),
            F.min_by("like_header", "line").alias("begins_with_header"),
            F.min("line").alias("first_line"),
            F.sum(F.col("bytes") + 1).alias("bytes"),
        )
        .withColumn("whole", F.aggregate("changes", start, after))
    )


def _each_line_a_record(blocks: DataFrame) -> tuple[bool, str]:
    """Whether no field spans lines and the only line like a header is each file's first; if not, why."""
    files = blocks.groupBy("file").agg(
        F.sum("openers").alias("openers"),
        F.sum("headers").alias("headers"),
        F.min_by("begins_with_header", "block").alias("headed"),
    )
    spanning, unheaded = files.agg(
        F.max(F.when(F.col("openers") > 0, F.col("file"))),
        F.max(F.when((F.col("headers") != 1) | ~F.col("headed"), F.col("file"))),
    ).first()
    if spanning is not None:
        return False, f"a record spans lines in {spanning}"
    return unheaded is None, f"the header is not the first line, and that alone, of {unheaded}"


def _placed(blocks: DataFrame) -> DataFrame:
    """Adds ``base``, whether a field is open where the block begins, and ``opened``, the (block, line) where it was opened.

    ``far`` says how many bytes before this block the block begins in which that was.
    """
    keeps, turns = F.col("whole.out") < F.col("whole.into"), F.col("whole.out") > F.col("whole.into")
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    here = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, W.currentRow)
    # A block keeps the state, turns it, or sets it; what counts is the last that sets it and the turns since.
    counted = blocks.withColumn("turned", F.sum(turns.cast("int")).over(here))
    sets = F.when(~keeps & ~turns, F.struct(F.col("whole.out").alias("state"), "turned"))
    last = F.last(sets, ignorenulls=True).over(earlier)
    turned = F.coalesce(F.last("turned").over(earlier), F.lit(0)) - F.coalesce(last["turned"], F.lit(0))
    base = F.coalesce(last["state"], F.lit(False)) != (turned % 2 == 1)
    no_line = F.lit(None).cast("bigint")

    def follow(state: Column, line: Column) -> Column:
        open_after = F.when(state["open"], line["into"]).otherwise(line["out"])
        opens = ~state["open"] & open_after
        return F.struct(open_after.alias("open"), F.when(opens, line["line"]).otherwise(state["line"]).alias("line"))

    followed = F.aggregate("changes", F.struct(F.col("base").alias("open"), no_line.alias("line")), follow)
    opened = F.when(F.col("end.line").isNotNull(), F.struct("block", F.col("end.line").alias("line")))
    begin = F.coalesce(F.sum("bytes").over(earlier), F.lit(0))
    return (
        counted.withColumn("base", base)
        .withColumn("end", followed)
        .withColumn("begin", begin)
        .withColumn("opened", F.last(opened, ignorenulls=True).over(earlier))
        .withColumn("opened_at", F.last(F.when(opened.isNotNull(), F.col("begin")), ignorenulls=True).over(earlier))
        .withColumn("is_first", F.col("block") == F.min("block").over(W.partitionBy("file")))
        .withColumn("is_last", F.col("block") == F.max("block").over(W.partitionBy("file")))
        .select("file", "block", "base", "opened", "first_line", "is_first", "is_last", "opened_at",
                (F.col("begin") - F.col("opened_at")).alias("far"), F.col("end.open").alias("open_end"),
                (F.col("base") | (F.col("openers") > 0)).alias("spans"))
    )


def _stop_at_open_quotes(blocks: DataFrame) -> None:
    """Before any record is gathered: stop if one is never closed or longer than a record may be."""
    far = F.col("base") & (F.col("far") > MAX_RECORD_BYTES)
    place = F.concat(F.col("file"), F.lit(", in the block from byte "), F.col("opened_at"))
    unclosed, long = blocks.agg(
        F.max(F.when(F.col("is_last") & F.col("open_end"), F.col("file"))), F.max(F.when(far, place))
    ).first()
    if unclosed is not None:
        raise ValueError(f"a quoted field is never closed in {unclosed}")
    if long is not None:
        raise ValueError(f"a record of more than {MAX_RECORD_BYTES} bytes is opened in {long}")


def _records(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """(value, first): the text of each record, and whether it is the first of its file.

    In blocks where no field is open across a line, a line is a record and is not shuffled.
    """
    placed = lines.join(blocks, ["file", "block"]).withColumn(
        "first", F.col("is_first") & (F.col("line") == F.col("first_line"))
    )
    inside = W.partitionBy("file", "block").orderBy("line")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    turns = F.col("out") & ~F.col("into")
    sets = F.when(F.col("out") == F.col("into"), F.struct(F.col("out").alias("state"), "turned"))
    last = F.last(sets, ignorenulls=True).over(upto)
    after = F.coalesce(last["state"], F.col("base")) != (
        (F.col("turned") - F.coalesce(last["turned"], F.lit(0))) % 2 == 1
    )
    followed = (
        placed.where("spans")
        .withColumn("turned", F.sum(turns.cast("int")).over(upto))
        .withColumn("after", after)
        .withColumn("before", F.coalesce(F.lag("after").over(inside), F.col("base")))
    )
    opens = F.when(~F.col("before") & F.col("after"), F.struct("block", "line"))
    own = F.when(~F.col("before") & ~F.col("after"), F.struct("block", "line"))
    record = F.coalesce(own, F.last(opens, ignorenulls=True).over(upto), F.col("opened"))
    gathered = (
        followed.withColumn("record", record)
        .groupBy("file", "record")
        .agg(
            F.array_join(F.sort_array(F.collect_list(F.struct("block", "line", "value")))["value"], "\n").alias("value"),
            F.bool_or("first").alias("first"),
        )
    )
    alone = placed.where("NOT spans").select("value", "first")
    return alone.unionByName(gathered.select("value", "first"))


def _parsed(texts: DataFrame, names: Sequence[str]) -> DataFrame:
    """The fields of record texts; the first record of each file must be the header.

    A record goes through a generator together with the question whether it is a row: a filter on that alone would be
    moved before the fields are taken apart, and take each record apart again.
    """
    width = len(names)
    schema = ", ".join(f"c{i} string" for i in range(width + 1))  # one more than there may be
    filled = texts.filter(F.ltrim("value", F.lit(" \t\r")) != "")
    parsed = filled.select("first", "value", F.from_csv("value", schema, {**CSV_OPTIONS, "multiLine": "true"}).alias("r"))
    fields = [F.col(f"r.c{i}") for i in range(width)]
    # Spark names a column whose header is empty by itself.
    same = F.array(*[F.coalesce(f, F.lit(n)) for f, n in zip(fields, names)]) == F.array(*map(F.lit, names))
    other = F.raise_error(F.lit("files of one input differ in their header")).cast("boolean")
    shown = F.concat(F.lit(f"malformed: more than {width} fields in the record "), F.left("value", F.lit(200)))
    long = F.raise_error(shown).cast("boolean")
    is_row = F.when(F.col("first"), F.when(same, False).otherwise(other)).otherwise(
        F.when(F.col(f"r.c{width}").isNotNull(), long).otherwise(True)
    )
    judged = parsed.select(F.inline_outer(F.array(F.struct(is_row.alias("is_row"), F.col("r")))))
    return judged.filter("is_row").select(*[field.alias(name) for field, name in zip(fields, names)])


def select_rename(df: DataFrame, mapping: Mapping[str, str] = SURVEY_COLUMNS) -> DataFrame:
    """Keep and rename the mapped columns; one that is missing becomes a NULL text column."""
    missing = [source for source in mapping if source not in df.columns]
    if missing:
        logger.warning("columns missing from the source: %s", missing)
    return df.select(
        *[
            (F.lit(None).cast("string") if source in missing else F.col(f"`{source}`")).alias(target)
            for source, target in mapping.items()
        ]
    )


def _map_text(df: DataFrame, change) -> DataFrame:
    return df.select(
        *[
            change(F.col(f"`{name}`")).alias(name) if dtype == "string" else F.col(f"`{name}`")
            for name, dtype in df.dtypes
        ]
    )


def null_tokens(df: DataFrame, tokens: Sequence[str] = CSV_NULLS) -> DataFrame:
    """NULL for every text field that is, untrimmed, one of the reader's null tokens."""
    return _map_text(df, lambda c: text.null_if_in(c, tokens))


def clean_strings(df: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Trim every text column, then turn the sentinels into NULL.

    In two selections, since the second needs the trimmed text twice: Spark does not merge them, so it is made once.
    """
    return _map_text(_map_text(df, text.strip), lambda c: text.null_if_in(c, sentinels))


def timestamp(moment: datetime) -> Column:
    """A moment as a timestamp without zone, in UTC when the moment has a zone."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")


def load_raw(
    spark: SparkSession, paths: str | Sequence[str], loaded_at: datetime, records: str = "auto"
) -> DataFrame:
    """The raw layer from CSV: 23 cleaned text columns and one load time for the whole run.

    Each path is read under its own header, so inputs of several survey versions
    can be loaded together.
    """
    parts = []
    for path in [paths] if isinstance(paths, str) else paths:
        chosen = select_rename(read_csv(spark, path, records))
        parts.append(clean_strings(null_tokens(chosen)))
    raw = reduce(DataFrame.unionByName, parts)
    # A number the CSV holds in exponent form is that number; one that does not fit stays text, for staging to count.
    raw = raw.withColumn("comp_total", text.expand_exponent(F.col("comp_total")))
    return raw.withColumn("loaded_at", timestamp(loaded_at))
