"""Quoted CSV read in parallel inside one file (A3).

A quoted field may hold newlines, so where a record starts depends on every quote
before it, and the built-in `multiLine` reader gives each file to one task. Here
the file is scanned as lines, in Spark's own splits, and two scans settle the
rest:

1. Each split tells how it maps the state at its start (0 between records, 1
   inside quotes) to the state at its end. These maps, a few bytes per split, are
   composed along each file by a window, so every split's start state is known.
2. Each split joins its lines to records from the known state. Records that cross
   splits come out as pieces from the crossing splits only, and are put together
   per record.

Rules are those of the `multiLine` reader: a quote opens a field only as its first
character, "" inside quotes is a quote, text after a closing quote belongs to the
field up to the next comma; a quote left open swallows the rest of its file (as
one record, in one task; the text of that open field is the only value that may differ). Empty lines between records are skipped, a UTF-8 BOM is
dropped, a line ends with \\n. Bytes that are no UTF-8 become U+FFFD. A missing
path is an error, an empty file has no rows.

Both scans have to cut the files alike. The cut follows `spark.sql.files.*` and, for
input smaller than those settings times the cores, the number of cores: if that changed
between the scans, the second ends with an error that says so, never with wrong
rows; set spark.sql.files.minPartitionNum to keep the cut fixed."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS

# a line that starts between records and ends inside quotes: whole fields, then an open one
_LEFT_OPEN = re.compile(rb'(?:"(?:[^"]++|"")*+"[^,]*+,|[^",][^,]*+,|,)*+"(?:[^"]++|"")*+\Z')
_SPLIT = ["file", "begin", "size"]
BATCH_BYTES = 4 << 20


def end_state(line: bytes, inside: bool) -> bool:
    """Whether a line ends inside quotes, given whether it starts inside."""
    if b'"' not in line:
        return inside
    return _LEFT_OPEN.match(b'"' + line if inside else line) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("begin"), F.col("_metadata.file_block_length").alias("size"))


def _split_maps(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, begin, size, from0, from1) of each split; the lines of a split come together and in order."""
    split, states = None, [False, True]

    def row():
        return pa.RecordBatch.from_pylist([dict(zip([*_SPLIT, "from0", "from1"], [*split, *map(int, states)]))], schema=_MAP_ARROW)

    for part in parts:
        for line, *at in zip(*(c.to_pylist() for c in part.columns)):
            if at != split:
                if split is not None:
                    yield row()
                split, states = at, [False, True]
            if line is not None:
                states = [end_state(line, s) for s in states]
    if split is not None:
        yield row()


_MAP_ARROW = pa.schema([("file", pa.string()), ("begin", pa.int64()), ("size", pa.int64()), ("from0", pa.int32()), ("from1", pa.int32())])


def split_states(lines: DataFrame) -> DataFrame:
    """(file, begin, size, state, left): the state at the start and the end of each split."""
    quoted = lines.select(F.when(F.expr("position(X'22', line) > 0"), F.col("line")).alias("line"), *_SPLIT)
    maps = quoted.mapInArrow(_split_maps, "file string, begin long, size long, from0 int, from1 int")
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("from0") > F.col("from1")).cast("int")
    fixed = F.when(F.col("from0") == F.col("from1"), F.struct(F.col("from0").alias("state"), F.col("swaps")))
    known = maps.withColumn("swaps", F.coalesce(F.sum(swap).over(before), F.lit(0))) \
        .withColumn("last", F.last(fixed, ignorenulls=True).over(before))
    state = (F.coalesce(F.col("last.state"), F.lit(0)) + F.col("swaps") - F.coalesce(F.col("last.swaps"), F.lit(0))) % 2
    return known.withColumn("state", state.cast("int")) \
        .select(*_SPLIT, "state", F.when(F.col("state") == 0, F.col("from0")).otherwise(F.col("from1")).alias("left"))


def _with_state(lines: DataFrame, splits: DataFrame, small: bool, how: str) -> DataFrame:
    """Each line with its split's start state, lines of a split still together and in order."""
    wanted = splits.select(*_SPLIT, "state")
    if small:
        return lines.join(F.broadcast(wanted), _SPLIT, how).select("line", *_SPLIT, "state")
    ordered = lines.withColumn("place", F.monotonically_increasing_id()).join(wanted, _SPLIT, how)
    return ordered.repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "place").select("line", *_SPLIT, "state")


def _pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, bytes, bool, bool]]:
    """(split, text, starts, ends): whole records, and pieces of those that cross the split's edges."""
    split, inside, starts, held = None, False, True, []
    for part in parts:
        for line, file, begin, size, state in zip(*(c.to_pylist() for c in part.columns)):
            at = [file, begin, size]
            if at != split:
                if held:
                    yield split, b"\n".join(held), starts, False
                if state is None:
                    raise RuntimeError(f"the files were cut differently in the two scans ({file} at {begin}); "
                                       "set spark.sql.files.minPartitionNum to keep the cut fixed")
                split, inside, held, starts = at, state == 1, [], state == 0
            held.append(line)
            inside = end_state(line, inside)
            if not inside:
                yield split, b"\n".join(held), starts, True
                held, starts = [], True
    if held:
        yield split, b"\n".join(held), starts, False


def _whole(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for _, text, starts, ends in _pieces(parts):
        if starts and ends and text:
            out.append(text)
            size += len(text)
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
            out, size = [], 0
    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def _crossing(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, begin, _), text, starts, ends in _pieces(parts):
        if not (starts and ends):
            yield pa.RecordBatch.from_pylist([{"file": file, "begin": begin, "starts": starts, "piece": text}], schema=_PIECE_ARROW)


_PIECE_ARROW = pa.schema([("file", pa.string()), ("begin", pa.int64()), ("starts", pa.bool_()), ("piece", pa.binary())])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of each record of the CSV files at `path`."""
    lines = _lines(spark, path)
    splits = split_states(lines).checkpoint(eager=True)
    rows, names, crossing = splits.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("file") + 24), F.lit(0)),
                                       F.count_if(F.expr("state + left > 0"))).first()
    small = rows <= BROADCAST_MAX_ROWS and names <= BROADCAST_MAX_BYTES
    records = _with_state(lines, splits, small, "left").mapInArrow(_whole, "record binary")
    if crossing:
        pieces = _with_state(lines, splits.where("state + left > 0"), small, "inner") \
            .mapInArrow(_crossing, "file string, begin long, starts boolean, piece binary")
        number = F.count_if(F.col("starts")).over(Window.partitionBy("file").orderBy("begin", "starts"))
        parts = pieces.withColumn("number", number).groupBy("file", "number") \
            .agg(F.sort_array(F.collect_list(F.struct("begin", "starts", "piece"))).alias("parts"))
        joined = F.expr("array_join(transform(parts, p -> cast(p.piece as string)), '\n')")
        records = records.unionByName(parts.select(joined.cast("binary").alias("record")))
    return records.select(F.make_valid_utf8(F.col("record").cast("string")).alias("record"))


def read_csv_ranges(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """Headerless quoted CSV with an all-string `schema`; `options` are the CSV parser's."""
    ddl = ", ".join(f"`{name}` string" for name in schema.names)
    return csv_records(spark, path).select(F.from_csv("record", ddl, options).alias("row")).select("row.*")
