"""CSV files with line breaks inside quotes, read by many tasks each.

Such a file cannot be cut at any line break, as the break may lie inside a field.  But all that the text
before a line says about it is whether the line starts a record or goes on inside a quoted field:
two states.  So every block of lines is a map from two states to two states, found by the task that
reads it, whatever came before; maps of consecutive blocks are composed over one small row per block;
and with the state at its start known, each block is cut into records in a second scan.  A record
that goes on in later blocks is put together from one piece per block.

A field is quoted if its first character is a quote, and ends at the next quote that is not doubled;
quotes elsewhere are ordinary characters.  A field left open runs to the end of its file.  Where the
first line of a file ends in carriage return and line feed, both are a line feed inside of its fields too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritill.session import scratch_dir

#: Up to so many blocks, their states are sent to all tasks; beyond, lines are dealt to their blocks again.
MOST_BLOCKS = 50_000

_OPTIONS = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}

#: A whole record, and the rest of one that starts inside a quoted field.
_FIELDS = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_WHOLE = re.compile(rf"{_FIELDS}(?:,{_FIELDS})*+")
_REST = re.compile(rf'[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_FIELDS})*+')

_SUMMARY = "file string, folder bigint, block bigint, n bigint, open_0 boolean, open_1 boolean, starts_1 boolean, crlf boolean"
_PIECES = "file string, folder bigint, block bigint, line bigint, kind int, text string"
#: Kinds of pieces: a whole record; the start of one that goes on in the next block; what continues one.
_RECORD, _OPENED, _CONTINUED = 0, 1, 2


def _after(line: str, inside: bool) -> bool:
    """Whether the line after this one starts inside a quoted field."""
    return (_REST if inside else _WHOLE).fullmatch(line) is None


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], list[str], list[bool]]]:
    """Lines of one block at a time, with whether each has a quote; most have none and change no state."""
    for batch in batches:
        lines = batch.column("value").to_pylist()
        quoted = pc.greater(pc.count_substring(batch.column("value"), '"'), 0).to_pylist()
        places = list(zip(*(batch.column(c).to_pylist() for c in ("file", "folder", "block"))))
        start = 0
        for at in range(1, len(lines) + 1):
            if at == len(lines) or places[at] != places[start]:
                yield places[start], lines[start:at], quoted[start:at]
                start = at


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and block; within a block in order.  Only line feeds end a line here."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(
        "value", F.col("_metadata.file_name").alias("file"), F.xxhash64("_metadata.file_path").alias("folder"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _summaries(lines: DataFrame) -> DataFrame:
    """One row per block: the state after it for both states before it, and whether a record starts in it if it starts inside one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list] = {}
        for place, lines_, quoted in _runs(batches):
            n, from_0, from_1, starts_1, crlf = seen.get(place, (0, False, True, False, lines_[0].endswith("\r")))
            for line, has in zip(lines_, quoted):
                # a record starts at this line if the line before ended outside
                starts_1 = starts_1 or not from_1
                if has:
                    same = from_0 == from_1
                    from_0 = _after(line, from_0)
                    from_1 = from_0 if same else _after(line, from_1)
            seen[place] = [n + len(lines_), from_0, from_1, starts_1, crlf]
        names = [f.split()[0] for f in _SUMMARY.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_()]
        rows = [(*place, *found) for place, found in seen.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names=names
        )

    return lines.mapInArrow(run, _SUMMARY)


def _composed(summaries: DataFrame) -> DataFrame:
    """State before each block, and the block in which the record that reaches into it was opened.

    A map that sends both states to one forgets what came before, any other keeps or swaps the states:
    the state is that after the last forgetting block, swapped as often as a swap came since.
    """
    order = Window.partitionBy("file", "folder").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("open_0") == F.col("open_1")
    swaps = F.sum(F.when(fixed | ~F.col("open_0"), 0).otherwise(1)).over(before)
    counted = summaries.withColumn("swaps", F.coalesce(swaps, F.lit(0)))
    own = F.when(fixed, F.struct(F.col("open_0").cast("int").alias("state"), (F.col("swaps")).alias("swaps")))
    last = F.last(own, ignorenulls=True).over(before)
    state = F.pmod(F.coalesce(last["state"], F.lit(0)) + F.col("swaps") - F.coalesce(last["swaps"], F.lit(0)), F.lit(2)) == 1
    known = counted.withColumn("inside", state)
    opens = F.when(F.col("inside"), F.col("open_1") & F.col("starts_1")).otherwise(F.col("open_0"))
    # the first line of a file says how its lines end
    first = F.first("crlf").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return known.withColumn("opened", F.last(F.when(opens, F.col("block")), ignorenulls=True).over(before)).select(
        "file", "folder", "block", "inside", "opened", first.alias("crlf")
    )


def _cut(lines: DataFrame) -> DataFrame:
    """Records of each block, and the pieces of those that reach over its ends; lines come with ``inside`` and ``crlf``."""
    names = [f.split()[0] for f in _PIECES.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, state, number, start, held, kind = None, False, 0, 0, [], _RECORD
        out: list[tuple] = []

        def unfinished() -> None:
            if held:
                out.append((*place, start, _OPENED if kind == _RECORD else kind, "\n".join(held)))

        def batch_of_pieces() -> pa.RecordBatch:
            arrays = [pa.array([row[i] for row in out], own) for i, own in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            states, ends, at = batch.column("inside").to_pylist(), batch.column("crlf").to_pylist(), 0
            for own, lines_, quoted in _runs(iter([batch])):
                if own != place:
                    unfinished()
                    place, state, number, held = own, states[at], 0, []
                    kind = _CONTINUED if state else _RECORD
                crlf = ends[at]
                at += len(lines_)
                for line, has in zip(lines_, quoted):
                    if crlf:
                        line = line.removesuffix("\r")
                    if not held:
                        start = number
                    held.append(line)
                    number += 1
                    if has:
                        state = _after(line, state)
                    if not state:
                        out.append((*place, start, kind, "\n".join(held)))
                        held, kind = [], _RECORD
            yield batch_of_pieces()
        unfinished()
        yield batch_of_pieces()

    return lines.mapInArrow(run, _PIECES)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Text of every record with its file, block and line; the first record of each file has block and line 0."""
    lines = _lines(spark, path)
    states, keys = _composed(_summaries(lines)), ["file", "folder", "block"]
    # one row per block, read several times
    folder = scratch_dir(spark, "blocks")
    states.write.parquet(folder)
    states = spark.read.schema(states.schema).parquet(folder)
    if states.count() <= MOST_BLOCKS:
        placed = lines.join(F.broadcast(states.select(*keys, "inside", "crlf")), keys)
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id()).join(states.select(*keys, "inside", "crlf"), keys)
        placed = numbered.repartition(*keys).sortWithinPartitions(*keys, "line")
    pieces = _cut(placed.select("value", *keys, "inside", "crlf"))
    # at most two pieces of a block belong to records that reach over its ends
    broken = pieces.where(F.col("kind") != _RECORD).join(states.select(*keys, "opened"), keys)
    first = F.when(F.col("kind") == _OPENED, F.col("block")).otherwise(F.col("opened"))
    piece = F.struct("block", "line", "text")
    joined = broken.groupBy("file", "folder", first.alias("first")).agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    mended = joined.select(
        "file", "folder", F.col("first").alias("block"), F.element_at("pieces", 1)["line"].alias("line"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("text"),
    )
    whole = pieces.where(F.col("kind") == _RECORD).select("file", "folder", "block", "line", "text")
    return whole.unionByName(mended)


def read_quoted(spark: SparkSession, path: str, names: list[str], position: str) -> DataFrame:
    """Columns ``names`` as text and ``position``; every file has to start with a header of these names."""
    found = records(spark, path)
    header = (F.col("block") == 0) & (F.col("line") == 0)
    fields = F.from_csv("text", _ddl(names), _OPTIONS)
    parsed = found.withColumn("fields", fields)
    place = F.struct("file", "folder", "block", "line").alias(position)
    wrong = F.raise_error(F.concat(F.lit("the header is not that of the other files: "), F.col("text"))).cast("boolean")
    kept = F.when(header, F.when(_is_header(names), F.lit(False)).otherwise(wrong)).otherwise(F.col("text") != "")
    return parsed.where(kept).select(*[F.col("fields")[name].alias(name) for name in names], place)


def _ddl(names: list[str]) -> str:
    return ", ".join("`" + name.replace("`", "``") + "` string" for name in names)


def _is_header(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col("fields")[name].eqNullSafe(F.lit(name)) for name in names], F.lit(True))
