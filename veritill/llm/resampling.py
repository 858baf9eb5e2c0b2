"""Importance resampling towards a target collection, on hashed word n-grams.

Every text is a bag of its runs of one to three words; each run falls into one of ``BUCKETS`` buckets.
A bucket's gain is the log ratio of its smoothed share in the target to that in the source, in
thousandths and rounded down.  A document weighs the sum of the gains of its runs; adding Gumbel
noise made from its id turns "the highest scores" into a draw without replacement in proportion to
the likelihood ratio.

Inside the tasks the words stay in Arrow: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten``
and ``dictionary_encode`` give one number per word.  Neighbouring numbers make pairs, a pair and the
next number make a run of three; every distinct pair is hashed once, on from the hash of its left
part, and gains are looked up by number and summed per document.  Words are worked on in blocks, so
memory is bounded for texts of any length.

Spark adds up the bucket counts of the tasks (a fixed number of rows each) and ranks by a sort over
ranges of scores: a place is the place within its range plus the rows in the ranges before, so no
task sees more than its range.

Cases: null and empty texts have no features, weight 0 and are never drawn with ``least_words`` > 0;
very long texts count whole; repeated rows count and are ranked each for itself; ties go to the
smaller id, null ids last; the noise of a null id is that of ``<seed>:``; an empty table gives no
rows, and an empty target counts as all zeros; other columns are ignored but for ``keep``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritill.llm.common import shuffle_partitions, stored

BUCKETS = 10_000
SEED = 42
#: Share of the eligible documents that is drawn, and the words a document needs to be eligible.
PERCENT, LEAST_WORDS = 5, 20

#: Rows and words that one step inside a task works on.
STEP_ROWS, STEP_WORDS = 500, 1 << 19
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOCAL = (1 << 33) - 1


def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words as a dictionary array, and the row each belongs to."""
    lists = pc.split_pattern_regex(pc.fill_null(pc.ascii_lower(texts), ""), _BETWEEN)
    flat, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    there = pc.greater(pc.binary_length(flat), 0)
    return pc.dictionary_encode(flat.filter(there)), rows.filter(there).to_numpy()


def _hashed(left: list[int], hashes: list[int], right: list[int], tails: list[bytes]) -> np.ndarray:
    """Hash of each left part followed by its right word."""
    return np.fromiter((crc32(tails[w], hashes[p]) for p, w in zip(left, right)), np.uint32, len(left))


def _features(texts: pa.Array, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of runs of one to three words: their length, and the row and bucket of each."""
    coded, rows = _words(texts)
    words = [word.encode() for word in coded.dictionary.to_pylist()]
    tails = [b" " + word for word in words]
    hashes, kinds = [crc32(word) for word in words], len(words)
    single = np.array(hashes, np.uint32) % buckets if words else np.zeros(0, np.uint32)
    index = coded.indices.to_numpy().astype(np.int64)
    for start in range(0, len(index), STEP_WORDS):
        # two words of the next block, for the runs that reach into it
        number, row = index[start : start + STEP_WORDS + 2], rows[start : start + STEP_WORDS + 2]
        own = slice(0, STEP_WORDS)
        yield 1, row[own], single[number[own]]
        if len(number) < 2:
            continue
        joined = row[1:] == row[:-1]
        pairs, pair = np.unique(number[:-1] * kinds + number[1:], return_inverse=True)
        pair_hashes = _hashed((pairs // kinds).tolist(), hashes, (pairs % kinds).tolist(), tails)
        first = joined[own]
        yield 2, row[:-1][own][first], (pair_hashes % buckets)[pair[own][first]]
        if len(number) < 3:
            continue
        whole = (joined[1:] & joined[:-1])[own]
        triples, triple = np.unique(pair[:-1][own][whole] * kinds + number[2:][own][whole], return_inverse=True)
        found = _hashed((triples // kinds).tolist(), pair_hashes.tolist(), (triples % kinds).tolist(), tails) % buckets
        yield 3, row[:-2][own][whole], found[triple]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, STEP_ROWS):
            yield batch.slice(start, STEP_ROWS)


def bucket_counts(df: DataFrame, text_column: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Features in each bucket over all rows; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in _steps(batches):
            for _, _, found in _features(part.column(0), buckets):
                total += np.bincount(found, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(there, pa.int64()), "n": pa.array(total[there], pa.int64())})

    return df.select(F.col(text_column)).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket from the counts of both sides; at most ``buckets`` rows of each are read."""
    s, t = ({row["bucket"]: row["n"] for row in side.collect()} for side in (source, target))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    return [
        math.floor(1000 * math.log((t.get(b, 0) + 1.0) * all_s / ((s.get(b, 0) + 1.0) * all_t))) for b in range(buckets)
    ]


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Noise of a document in thousandths, from its id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(
    df: DataFrame,
    gains: list[int],
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Words, features, weight and score of each row, with the columns named in ``keep``."""
    table, buckets = np.array(gains, np.float64), len(gains)
    selected = df.select(id_column, text_column, *[F.col(f"`{c}`").alias(f"kept {i}") for i, c in enumerate(keep)])
    passed = selected.drop(text_column).schema
    added = ("n_words", "n_features", "weight", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _steps(batches):
            rows = part.num_rows
            n_words, n_features, weight = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows)
            for length, row, found in _features(part.column(1), buckets):
                runs = np.bincount(row, minlength=rows)
                n_features += runs
                if length == 1:
                    n_words += runs
                # whole numbers far below 2^53, so sums in doubles are exact
                weight += np.bincount(row, weights=table[found], minlength=rows)
            weight = weight.astype(np.int64)
            noise = np.array([gumbel(doc, seed) for doc in part.column(0).to_pylist()], np.int64)
            columns = [part.column(0), *[part.column(i) for i in range(2, part.num_columns)]]
            columns += [pa.array(values, pa.int64()) for values in (n_words, n_features, weight, weight + noise)]
            yield pa.RecordBatch.from_arrays(columns, names=[*passed.names, *added])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in passed) + ", " + ", ".join(f"{c} bigint" for c in added)
    found = selected.mapInArrow(run, schema)
    return found.select(id_column, *added, *[F.col(f"`kept {i}`").alias(c) for i, c in enumerate(keep)])


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_column: str = "doc_id") -> DataFrame:
    """``weighed`` with ``rank``: 1, 2, 3... for the drawn rows, null for all others."""
    spark = weighed.sparkSession
    # a stored number of the row parts equal keys, however many rows have one
    rows = stored(weighed.withColumn("row number", F.monotonically_increasing_id()), "weighed")
    rows = rows.withColumn("enough", F.col("n_words") >= least_words)
    order = [F.col("enough").desc(), F.col("score").desc(), F.col(id_column).asc_nulls_last(), F.col("row number")]
    ranges = rows.repartitionByRange(shuffle_partitions(rows), *order).sortWithinPartitions(*order)
    placed = stored(ranges.withColumn("place", F.monotonically_increasing_id()), "ranges")
    # one row per range
    sizes = placed.groupBy(F.shiftright("place", 33).alias("range")).agg(F.count("*").alias("n"), F.count_if("enough").alias("enough"))
    before, eligible, starts = 0, 0, []
    for size in sorted(sizes.collect(), key=lambda r: r["range"]):
        starts.append((size["range"], before))
        before, eligible = before + size["n"], eligible + size["enough"]
    offsets = spark.createDataFrame(starts, "`range` bigint, `rows before` bigint")
    place = F.col("rows before") + F.col("place").bitwiseAND(F.lit(_LOCAL)) + 1
    ranked = placed.join(F.broadcast(offsets), F.shiftright("place", 33) == F.col("range"))
    return ranked.select(
        *[F.col(f"`{c}`") for c in weighed.columns],
        F.when(F.col("enough") & (place <= percent * eligible // 100), place).alias("rank"),
    )


def resample(
    df: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every row's weight, score and rank in the draw; ``rank IS NOT NULL`` is the sample."""
    gains = bucket_gains(bucket_counts(df, text_column, buckets), bucket_counts(target, target_text, buckets), buckets)
    return draw(weigh(df, gains, seed, id_column, text_column, keep), percent, least_words, id_column)
