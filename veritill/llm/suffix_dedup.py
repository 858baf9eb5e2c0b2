"""Removal of every byte that lies in a long string occurring elsewhere, by content-chosen anchors.

This takes the place of bucket-pointer refinement, whose bucket identifiers of later offsets are not used here.

The start positions of all strings of ``length`` bytes are sorted into buckets, as far as needed to
see which strings are equal to another one, by hashes of their bytes:

* *Initial buckets.*  In every string one q-gram is chosen by content alone (the one with the least
  hash, the leftmost of equals), so equal strings choose equal q-grams at the same offset.  A chosen
  place stands for all neighbouring strings that choose it, some hundred at a time, and its bucket
  is the identifier of its q-gram.  Buckets with one place are finished: none of its strings recurs.
* *Refinement.*  The places of a bucket are told apart by the identifiers of what lies at their
  other offsets, before and behind the q-gram, up to the ends of the strings they stand for.  Places that
  still agree are copies of each other: all their strings recur.  One of them stays in the bucket
  for the others to be compared with.
* *Recursion.*  What is left in a bucket is split by where in the string the q-gram stands, and each
  part is bucketed anew by the identifier of the bytes that all its strings have in common.  Buckets
  with one place are finished again.  In the others single strings are compared, by the
  identifiers of their ends beside the common middle.

Identifiers are 64-bit hashes within a bucket that is itself identified by 64 bits (and 64 more in the
recursion), from prefix sums over the whole text, so any string's identifier is two lookups.

Equal texts have equal strings at equal places; each task counts them once with their number.  Buckets
with over ``HOT_ROWS`` places left are compared by a grouped count of all their strings instead of
within a task; the result is the same.

Cases: null text is empty; matches never cross documents; overlaps count; texts shorter than
``length`` bytes keep all; very long texts are read whole; repeated rows are copies of each other; a
null id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritill.llm.common import discard, per_row, shuffle_partitions, stored, unpacker

LENGTH, GRAM, PARTS = 400, 64, 4
HOT_ROWS = 50_000

_FACTOR = 0x9E3779B97F4A7C15

#: White space as ``str.split`` has it: single bytes, and longer characters
_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_WIDE_SPACE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


@functools.cache
def _byte_codes() -> np.ndarray:
    return np.random.default_rng(1).integers(0, 1 << 64, 256, dtype=np.uint64)


class _Powers:
    """Powers of an odd number modulo 2**64, grown as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.known = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            step = np.uint64(pow(self.base, len(self.known), 1 << 64))
            self.known = np.concatenate([self.known, self.known * step])
        return self.known


_UP, _DOWN = _Powers(_FACTOR), _Powers(pow(_FACTOR, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_sums(data: bytes) -> np.ndarray:
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_codes()[np.frombuffer(data, dtype=np.uint8)] * _UP.upto(len(data))[: len(data)], out=sums[1:])
    return sums


def identifiers(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Identifier of each string from start to end, the same wherever it stands."""
    return mixed((sums[end] - sums[start]) * _DOWN.upto(len(sums))[start])


def places(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chosen places: position, least and greatest offset in the strings it stands for, bucket, identifier of all its strings."""
    n = len(data)
    if n < length:
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),) * 2
    sums = prefix_sums(data)
    first = np.arange(n - gram + 1)
    gram_ids = identifiers(sums, first, first + gram)
    width = length - gram + 1
    least, reach = gram_ids, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    count = n - length + 1
    least = np.minimum(least[:count], least[width - reach : width - reach + count])
    change = np.flatnonzero(least[1:] != least[:-1]) + 1
    found = []
    for start, end in zip([0, *change.tolist()], [*change.tolist(), count]):
        while start < end:
            at = start + int(gram_ids[start : start + width].argmin())
            after = min(at + 1, end)
            found.append((at, at - after + 1, at - start))
            start = after
    at, low, high = np.array(found, dtype=np.int64).T
    whole = identifiers(sums, at - high, at - low + length) ^ (low * 4096 + high).astype(np.uint64)
    return at, low, high, gram_ids[at], whole


def _pack(df: DataFrame, id_column: str, text_column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc, key, data): data is the compressed text, key stands for its content."""

    def work(compressor, docs, texts):
        raw = [(text or "").encode() for text in texts]
        return [docs, [hashlib.md5(x).digest() for x in raw], [compressor.compress(x) for x in raw]]

    def ready():
        import zstandard

        return zstandard.ZstdCompressor(level=3)

    renamed = df.select(F.col(id_column).alias("doc"), F.col(text_column).alias("body"), *[F.col(c).alias(f"kept_{c}") for c in keep])
    return per_row(renamed, ["doc", "body"], "doc bigint, key binary, data binary", work, ready, tuple(f"kept_{c}" for c in keep))


def _places(df: DataFrame, text_column: str, length: int, gram: int) -> DataFrame:
    """One row per chosen place of each distinct text of a run of rows; ``n`` is how often that text occurs there."""

    def work(_, texts):
        counts: dict[bytes, int] = {}
        for text in texts:
            raw = (text or "").encode()
            if len(raw) >= length:
                counts[raw] = counts.get(raw, 0) + 1
        out: list[list] = [[] for _ in range(7)]
        for raw, n in counts.items():
            at, low, high, bucket, whole = places(raw, length, gram)
            for column, values in zip(out[1:], (at, low, high, bucket.view(np.int64), whole.view(np.int64))):
                column.append(values)
            out[0] += [hashlib.md5(raw).digest()] * len(at)
            out[6].append(np.full(len(at), n))
        return [out[0], *(np.concatenate(c) if c else [] for c in out[1:])]

    schema = "key binary, at int, low int, high int, bucket bigint, whole bigint, n bigint"
    return per_row(df.select(F.col(text_column).alias("body")), ["body"], schema, work)


def _parts(packed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Split contested places by offset; ``bytes`` holds the strings of one part, one after another."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("at", "low", "high", "bucket", "asks")).alias("list"))
    joined = packed.select("key", "data").join(lists, "key").select(
        "key", "data", "list.at", "list.low", "list.high", "list.bucket", F.col("list.asks").alias("asks")
    )
    width = -(-(length - GRAM + 1) // PARTS)

    def work(decompressor, keys, datas, ats, lows, highs, buckets, asks):
        out: list[list] = [[] for _ in range(9)]
        last = None
        for key, data, *lists in zip(keys, datas, ats, lows, highs, buckets, asks):
            if key == last:  # copies of one text lie next to each other
                continue
            last = key
            raw = decompressor.decompress(data) if data else b""
            sums = prefix_sums(raw)
            at, low, high = (np.array(x, dtype=np.int64) for x in lists[:3])
            for part in range(PARTS):
                x, y = part * width, part * width + width - 1
                rows = np.flatnonzero((low <= y) & (high >= x))
                if not len(rows):
                    continue
                core = identifiers(sums, at[rows] - x, at[rows] - y + length).view(np.int64)
                for i, own in zip(rows.tolist(), core.tolist()):
                    near, far = max(int(low[i]), x), min(int(high[i]), y)
                    start = int(at[i]) - far
                    row = (key, start, near, far, lists[3][i], part, own, lists[4][i], raw[start : int(at[i]) - near + length])
                    for column, value in zip(out, row):
                        column.append(value)
        return out

    schema = "key binary, start int, near int, far int, bucket bigint, part int, core bigint, asks boolean, bytes binary"
    return per_row(joined, ["key", "data", "at", "low", "high", "bucket", "asks"], schema, work, unpacker)


def _windows(strings: list[bytes], near: np.ndarray, far: np.ndarray, salt: np.ndarray, length: int):
    """Row and identifier of every string in ``strings`` (offsets far down to near), under the row's salt."""
    rows, ids = [], []
    most = int((far - near).max()) + 1
    up, down = _UP.upto(length + most), _DOWN.upto(length + most)
    for first in range(0, len(strings), 1024):
        part = strings[first : first + 1024]
        grid = np.zeros((len(part), length + most - 1), dtype=np.uint8)
        for i, s in enumerate(part):
            grid[i, : len(s)] = np.frombuffer(s, dtype=np.uint8)
        sums = np.zeros((len(part), length + most), dtype=np.uint64)
        np.cumsum(_byte_codes()[grid] * up[: length + most - 1], axis=1, out=sums[:, 1:])
        ids_here = mixed((sums[:, length:] - sums[:, :most]) * down[:most])
        offset = far[first : first + 1024, None] - np.arange(most)[None, :]
        there = offset >= near[first : first + 1024, None]
        own = mixed(ids_here ^ mixed(salt[first : first + 1024, None] + offset.astype(np.uint64)))
        rows.append(np.nonzero(there)[0] + first)
        ids.append(own[there])
    return np.concatenate(rows), np.concatenate(ids)


def _salt(bucket, part, core) -> np.ndarray:
    bucket, part, core = (np.asarray(x, dtype=np.int64).view(np.uint64) for x in (bucket, part, core))
    return mixed(bucket ^ mixed(core + part * np.uint64(_FACTOR)))


def _spans_of(table: pa.Table, repeated_rows: np.ndarray, shift: np.ndarray, length: int):
    """Maximal runs of recurring strings per row."""
    order = np.lexsort((shift, repeated_rows))
    rows, shift = repeated_rows[order], shift[order]
    fresh = np.r_[True, (rows[1:] != rows[:-1]) | (shift[1:] != shift[:-1] + 1)]
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(rows)] - 1
    start = table.column("start").to_numpy()[rows[first]]
    keys = table.column("key").take(pa.array(rows[first]))
    return keys, start + shift[first], start + shift[last] + length


def _compare(parts: DataFrame, length: int) -> DataFrame:
    """Recurring spans within buckets; rows of a bucket lie together in a sorted partition."""
    target = pa.schema([("key", pa.binary()), ("start", pa.int32()), ("end", pa.int32())])

    def decide(table: pa.Table):
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        near, far = (table.column(c).to_numpy().astype(np.int64) for c in ("near", "far"))
        salt = _salt(*(table.column(c).to_numpy() for c in ("bucket", "part", "core")))
        rows, ids = _windows(table.column("bytes").to_pylist(), near, far, salt, length)
        _, place, count = np.unique(ids, return_inverse=True, return_counts=True)
        keep = (count[place] > 1) & asks[rows]
        if not keep.any():
            return None
        # position of a string within its row: rows come in order, each from its first string on
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keys, start, end = _spans_of(table, rows[keep], nth[keep], length)
        return pa.RecordBatch.from_arrays(
            [keys.combine_chunks(), pa.array(start, pa.int32()), pa.array(end, pa.int32())], schema=target
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for first in range(0, batch.num_rows, 4000):
                held.append(batch.slice(first, 4000))
                table = pa.Table.from_batches(held).combine_chunks()
                bucket, part, core = (table.column(c).to_numpy() for c in ("bucket", "part", "core"))
                same = (bucket == bucket[-1]) & (part == part[-1]) & (core == core[-1])
                whole = len(same) if not same.any() else int(same.argmax())
                if whole:
                    found = decide(table.slice(0, whole).combine_chunks())
                    if found is not None:
                        yield found
                held = table.slice(whole).combine_chunks().to_batches()
        if held:
            found = decide(pa.Table.from_batches(held).combine_chunks())
            if found is not None:
                yield found

    columns = ["key", "start", "near", "far", "bucket", "part", "core", "asks", "bytes"]
    dealt = parts.select(*columns).repartition(shuffle_partitions(parts), "bucket", "part", "core")
    return dealt.sortWithinPartitions("bucket", "part", "core").mapInArrow(run, "key binary, start int, end int")


def _compare_hot(parts: DataFrame, length: int) -> DataFrame:
    """The same for buckets of any size: all their strings as rows, counted before and after the shuffle."""

    def work(_, keys, starts, nears, fars, buckets, part, cores, asks, strings):
        if not keys:
            return [[], [], [], []]
        rows, ids = _windows(strings, np.array(nears), np.array(fars), _salt(buckets, part, cores), length)
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        return [[keys[i] for i in rows], np.array(starts)[rows] + nth, ids.view(np.int64), np.array(asks)[rows]]

    columns = ["key", "start", "near", "far", "bucket", "part", "core", "asks", "bytes"]
    single = per_row(parts, columns, "key binary, start int, string bigint, asks boolean", work)
    again = single.groupBy("string").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("string")
    return single.where("asks").join(again, "string", "left_semi").select(
        "key", "start", (F.col("start") + length).cast("int").alias("end")
    )


def short_runs(data: bytes, words: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``words`` words in fewer than ``length`` bytes: start, end, identifiers of the run and of its first half."""
    letters = np.frombuffer(_WIDE_SPACE.sub(lambda m: b" " * len(m[0]), data), dtype=np.uint8)
    edge = np.diff(np.r_[True, _SPACE[letters], True].astype(np.int8))
    starts, ends = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    count = max(0, len(starts) - words + 1)
    some = np.flatnonzero(ends[len(ends) - count :] - starts[:count] < length)
    if not len(some):
        return (np.zeros(0, dtype=np.int64),) * 2 + (np.zeros(0, dtype=np.uint64),) * 2
    sums, start, end = prefix_sums(data), starts[some], ends[some + words - 1]
    return start, end, identifiers(sums, start, end), identifiers(sums, start, ends[some + words // 2 - 1])


def _short_repeats(df: DataFrame, text_column: str, words: int, length: int) -> tuple[DataFrame, DataFrame]:
    """(key, start, end) of runs of ``words`` words in fewer than ``length`` bytes that occur elsewhere too, and all such runs."""

    def work(_, texts):
        counts: dict[bytes, int] = {}
        for text in texts:
            raw = (text or "").encode()
            counts[raw] = counts.get(raw, 0) + 1
        out: list[list] = [[] for _ in range(6)]
        for raw, n in counts.items():
            start, end, whole, half = short_runs(raw, words, length)
            for column, values in zip(out[1:], (start, end, whole.view(np.int64), half.view(np.int64))):
                column.append(values)
            out[0] += [hashlib.md5(raw).digest()] * len(start)
            out[5].append(np.full(len(start), n))
        return [out[0], *(np.concatenate(c) if c else [] for c in out[1:])]

    schema = "key binary, start int, end int, whole bigint, half bigint, n bigint"
    runs = stored(per_row(df.select(F.col(text_column).alias("body")), ["body"], schema, work), "short-runs")
    again = stored(
        runs.groupBy("whole", "half").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("whole", "half"), "short-repeats"
    )
    return runs.join(again, ["whole", "half"], "left_semi").select("key", "start", "end"), runs


def repeated_spans(
    df: DataFrame, packed: DataFrame, length: int = LENGTH, gram: int = GRAM, text_column: str = "text", words: int | None = None
) -> DataFrame:
    """(key, spans) of each text with spans (start, end) whose every string of ``length`` bytes occurs elsewhere too.

    With ``words``, strings of so many words count too, however short the words are.
    """
    chosen = _places(df, text_column, length, gram)
    # stored, so that the join below is one that Spark can split where a bucket is hot
    shared = stored(
        chosen.groupBy("bucket").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("bucket"), "shared-buckets"
    )
    bucketed = stored(chosen.join(shared, "bucket", "left_semi"), "buckets")
    told = stored(
        bucketed.groupBy("bucket", "whole").agg(
            F.sum("n").alias("n"), F.min(F.struct("key", "at", "low", "high")).alias("one")
        ),
        "refined",
    )
    copies = bucketed.join(told.where(F.col("n") > 1).select("bucket", "whole"), ["bucket", "whole"], "left_semi").select(
        "key", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).cast("int").alias("end")
    )
    contested = told.groupBy("bucket").agg(F.count("*").alias("kinds"), F.min("n").alias("fewest")).where(
        (F.col("kinds") > 1) & (F.col("fewest") == 1)
    )
    wanted = told.join(contested.select("bucket"), "bucket", "left_semi").select(
        "one.key", "one.at", "one.low", "one.high", "bucket", (F.col("n") == 1).alias("asks")
    )
    parts = stored(_parts(packed, wanted, length), "parts")
    sizes = parts.groupBy("bucket", "part", "core").agg(F.count("*").alias("size"), F.max("asks").alias("any"))
    left = sizes.where((F.col("size") > 1) & F.col("any"))
    hot = left.where(F.col("size") > HOT_ROWS).select("bucket", "part", "core")
    usual = left.where(F.col("size") <= HOT_ROWS).select("bucket", "part", "core")
    name = ["bucket", "part", "core"]
    found = copies.unionAll(_compare(parts.join(usual, name, "left_semi"), length)).unionAll(
        _compare_hot(parts.join(hot, name, "left_semi"), length)
    )
    spent = [shared, bucketed, told, parts]
    if words:
        short, runs = _short_repeats(df, text_column, words, length)
        found, spent = found.unionAll(short), [*spent, runs]
    spans = stored(found.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    discard(*spent)
    return spans


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], end))
        else:
            found.append((start, end))
    return found


def _with_spans(df: DataFrame, length: int, id_column: str, text_column: str, keep: tuple[str, ...] = (), words: int | None = None) -> DataFrame:
    spans = repeated_spans(df, _pack(df, id_column, text_column), length, GRAM, text_column, words)
    return _pack(df, id_column, text_column, keep).join(spans, "key", "left").select(
        "doc", "data", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"),
        *[F.col(f"kept_{c}").alias(c) for c in keep],
    )


def _cut(decompressor, data: bytes, starts, ends) -> tuple[bytes, bytes, list[tuple[int, int]]]:
    raw = decompressor.decompress(data)
    spans = _merged(list(zip(starts or (), ends or ())))
    edges = [0, *(x for span in spans for x in span), len(raw)]
    return raw, b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])), spans


def _left(raw: bytes, spans: list[tuple[int, int]]) -> str:
    """The text outside of the spans; a character that is cut in two goes as a whole."""
    edges = [0, *(x for span in spans for x in span), len(raw)]
    return "".join(raw[a:b].decode(errors="ignore") for a, b in zip(edges[::2], edges[1::2]))


def removed_digests(
    df: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", left_column: str | None = None
) -> DataFrame:
    """Per document: its bytes, the bytes and runs removed, and the SHA-256 of what is kept.

    ``left_column`` names a further column with the text that is left; a character that is cut in two goes as a whole there.
    """

    def work(decompressor, docs, datas, starts, ends):
        out: list[list] = [docs, [], [], [], [], *([[]] if left_column else [])]
        for data, a, b in zip(datas, starts, ends):
            raw, kept, spans = _cut(decompressor, data, a, b)
            row = [len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()]
            for column, value in zip(out[1:], [*row, _left(raw, spans)] if left_column else row):
                column.append(value)
        return out

    schema = f"{id_column} bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    schema += f", `{left_column}` string" if left_column else ""
    inputs = ["doc", "data", "starts", "ends"]
    return per_row(_with_spans(df, length, id_column, text_column), inputs, schema, work, unpacker)


def without_repeats(
    df: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = (),
    words: int | None = None,
) -> DataFrame:
    """Per document: its removed spans in bytes and the text that is left; ``keep`` names further columns.

    A character that is cut in two goes as a whole.
    """

    def work(decompressor, docs, datas, starts, ends):
        out: list[list] = [docs, [], [], []]
        for data, a, b in zip(datas, starts, ends):
            raw, _, spans = _cut(decompressor, data, a, b)
            for column, value in zip(out[1:], ([s for s, _ in spans], [e for _, e in spans], _left(raw, spans))):
                column.append(value)
        return out

    schema = f"{id_column} bigint, span_starts array<int>, span_ends array<int>, kept string"
    inputs = ["doc", "data", "starts", "ends"]
    return per_row(_with_spans(df, length, id_column, text_column, keep, words), inputs, schema, work, unpacker, keep)
