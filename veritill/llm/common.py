"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veritill.session import scratch_dir

#: Rows that one step inside a task works on; longer Arrow batches are cut.
STEP_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Empty the folders of stored frames that nothing reads any more."""
    for frame in frames:
        files = frame.inputFiles()
        if files:
            empty = frame.sparkSession.createDataFrame([], frame.schema)
            empty.coalesce(1).write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])


def per_row(
    df: DataFrame,
    inputs: list[str],
    schema: str,
    work: Callable[..., list[list]],
    ready: Callable[[], object] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Apply ``work`` to short runs of rows inside the tasks, in Arrow columns.

    ``work`` gets what ``ready`` made once per task, then one list per input column; it returns
    one list per output column.  Where each row gives one, ``keep`` names columns to pass on
    behind them.  Other columns are not read.
    """
    selected = df.select(*inputs, *[F.col(c).alias(f"kept {i}") for i, c in enumerate(keep)])
    schema = ", ".join([schema, *(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)])
    target = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in StructType.fromDDL(schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = ready() if ready else None
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(start, STEP_ROWS)
                columns = work(state, *(part.column(i).to_pylist() for i in range(len(inputs))))
                arrays = [pa.array(values, type=f.type) for values, f in zip(columns, target)]
                passed = [part.column(i).cast(f.type) for i, f in zip(range(len(inputs), part.num_columns), list(target)[len(arrays):])]
                yield pa.RecordBatch.from_arrays(arrays + passed, schema=target)

    return selected.mapInArrow(run, schema)


def packed_text(df: DataFrame, text_column: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and the text, compressed in ``packed``, for a way through a shuffle; null stays null."""

    def ready():
        import zstandard

        return zstandard.ZstdCompressor(level=3)

    def work(compressor, texts):
        return [[None if text is None else compressor.compress(text.encode()) for text in texts]]

    return per_row(df, [text_column], "packed binary", work, ready, keep)


def unpacker():
    import zstandard

    return zstandard.ZstdDecompressor()


def unpacked_text(df: DataFrame, text_column: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and the text of a frame that ``packed_text`` made."""

    def work(decompressor, packed):
        return [[None if data is None else decompressor.decompress(data).decode() for data in packed]]

    return per_row(df, ["packed"], f"`{text_column}` string", work, unpacker, keep)


_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()),
    "array<double>": pa.list_(pa.float64()), "array<binary>": pa.list_(pa.binary()),
    "array<float>": pa.list_(pa.float32()),
}


def shuffle_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class ChunkTable(dict):
    """Distinct chunks seen by this task and what they encode to, in two generations.

    When the young generation is full it replaces the old one, so frequent chunks stay, rare ones
    go, and memory is bounded whatever the number of distinct chunks.
    """

    def __init__(self, encode: Callable[[list[str]], list], young: int = 200_000) -> None:
        super().__init__()
        self.encode, self.young, self.old = encode, young, {}

    def admit(self, chunks: set[str]) -> None:
        """Make sure that all of ``chunks`` can be looked up."""
        new = chunks.difference(self)
        if len(self) + len(new) > self.young:
            self.old = dict(self)
            self.clear()
            new = chunks
        old, missing = self.old, []
        for chunk in new:
            value = old.get(chunk)
            if value is None:
                missing.append(chunk)
            else:
                self[chunk] = value
        if missing:
            self.update(zip(missing, self.encode(missing)))
