"""Best-fit packing of documents into sequences, after Martello-Toth dominance reduction.

The instance is the histogram of piece lengths: at most ``capacity`` rows however large the corpus.
On it the reduction fixes sets that provably dominate every alternative (a set dominates when any
other set around the same item could be exchanged piece by piece for it without a larger total):

* the largest item fits with nothing: it is alone;
* it and one other item fill the sequence exactly;
* no two other items fit beside it: it takes the largest that fits;
* two fit, but not three, and no fitting pair is longer than the largest single partner: that one;
* two fit, but not three, and one fitting pair takes the largest item there is for its first place
  and the largest for its second: that pair.

What is left is packed best-fit decreasing.  Equal sequences are laid out together as a pattern
with a count.  Every fixed pattern leaves fewer of one length than it needs, and every length splits
at most one group of equal sequences in three, so there are at most 5 x capacity patterns.  Pieces
find their place by their rank among pieces of the same length; ranks are counted per salted part
of a length and then shifted, so that a hot length is no hot task.

Cases: null and empty text is the closing id alone, a piece of one token; an empty table gives no
rows; repeated rows are packed each for itself; a null id stays null; other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritill.llm.common import ChunkTable, per_row, shuffle_partitions, stored

CAPACITY = 2048
_RUN = re.compile(r"\s\s")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


class ByteCodec:
    """Byte-level subword encoding; each distinct space-led chunk once per task.

    A single space between two other characters always starts a pre-token, so a text can be cut
    there.  Chunks with letters beyond Latin, or with the text of a special token, are encoded by
    the tokenizer of the file itself; the others by the same merges in a faster library, whose
    ids are the same (the two libraries may only differ in the Unicode version of their patterns).
    """

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str, special: str = "<|endoftext|>") -> None:
        import base64
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.first = ChunkTable(self._encode, 20_000)
        self.rest = ChunkTable(lambda chunks: self._encode([" " + chunk for chunk in chunks]), 300_000)

    def _encode(self, chunks: list[str]) -> list[bytes]:
        found = []
        for chunk in chunks:
            if not chunk:
                ids = []
            elif not chunk.isascii() and max(chunk) > "ɏ" or self.special in chunk:
                ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            else:
                ids = self.fast.encode_ordinary(chunk)
            found.append(struct.pack(f"<{len(ids)}I", *ids))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [_BETWEEN.split(text) if _RUN.search(text) else text.split(" ") for text in texts]
        self.first.admit({words[0] for words in cut})
        self.rest.admit(set().union(*(words[1:] for words in cut)) if cut else set())
        first, rest = self.first, self.rest
        return [first[words[0]] + b"".join([rest[word] for word in words[1:]]) for words in cut]


def pieces(
    df: DataFrame,
    tokenizer_path: str,
    ranks_path: str,
    pattern: str,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the document's ids and a closing 0, cut only when longer than ``capacity``.

    All pieces of a cut document have ``capacity`` ids but the first, which may have fewer.
    ``with_ids`` adds the ids of each piece.
    """

    def work(codec, ids, texts):
        out = [[], [], [], [], []] + ([[]] if with_ids else [])
        for doc, encoded in zip(ids, codec.encode([text or "" for text in texts])):
            encoded += b"\0\0\0\0"
            n = len(encoded) // 4
            end, start, piece = n % capacity or capacity, 0, 0
            while start < n:
                part = encoded[4 * start : 4 * end]
                for column, value in zip(out, (doc, piece, start, end - start, zlib.crc32(part))):
                    column.append(value)
                if with_ids:
                    out[5].append(memoryview(part).cast("I").tolist())
                start, end, piece = end, end + capacity, piece + 1
        return out

    schema = f"{id_column} bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<bigint>" if with_ids else ""
    make = lambda: ByteCodec(tokenizer_path, ranks_path, pattern)
    return per_row(df, [id_column, text_column], schema, work, make)


class _Sizes:
    """Multiset of lengths with the lookups of the reduction."""

    def __init__(self, histogram: dict[int, int]) -> None:
        self.count = {size: n for size, n in histogram.items() if n > 0}
        self.sorted = sorted(self.count)

    def __bool__(self) -> bool:
        return bool(self.sorted)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.sorted.pop(bisect.bisect_left(self.sorted, size))

    def largest(self, room: int, without: Counter) -> int | None:
        """The largest size up to ``room`` of which one is left besides those in ``without``."""
        at = bisect.bisect_right(self.sorted, room) - 1
        while at >= 0:
            size = self.sorted[at]
            if self.count[size] > without[size]:
                return size
            at -= 1
        return None

    def smallest(self, n: int, without: Counter) -> list[int]:
        found: list[int] = []
        for size in self.sorted:
            found += [size] * min(n - len(found), self.count[size] - without[size])
            if len(found) == n:
                break
        return found


def _best_pair(sizes: _Sizes, room: int, used: Counter) -> tuple[int, int] | None:
    """The two items with the largest sum up to ``room``: two pointers over the distinct sizes."""
    there = [size for size in sizes.sorted if size <= room and sizes.count[size] > used[size]]
    best, low, high = None, 0, len(there) - 1
    while low <= high:
        a, b = there[low], there[high]
        if a + b > room:
            high -= 1
            continue
        if (low < high or sizes.count[a] - used[a] > 1) and (best is None or a + b > sum(best)):
            best = (b, a)
        low += 1
    return best


def _dominating(sizes: _Sizes, top: int, room: int) -> list[int] | None:
    """Partners of ``top`` in a set that dominates all others around it, or None."""
    used = Counter([top])
    partner = sizes.largest(room, used)
    if partner is None:
        return []
    if partner == room:
        return [partner]
    few = sizes.smallest(3, used)
    if len(few) < 2 or few[0] + few[1] > room:
        return [partner]
    if len(few) == 3 and sum(few) <= room:
        return None
    pair = _best_pair(sizes, room, used)
    if pair is None or sum(pair) <= partner:
        return [partner]
    largest = sizes.largest(room - few[0], used)
    # of every fitting set, its larger item is at most pair[0] and its smaller one at most pair[1]
    if pair[0] == largest and partner <= pair[0]:
        smaller = sizes.largest(min(room - few[0], room // 2), used)
        if smaller is not None and pair[1] >= smaller:
            return list(pair)
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int, bool]]:
    """Patterns of lengths, how often each is used, and whether the reduction fixed it."""
    sizes, found = _Sizes(histogram), []
    while sizes:
        top = sizes.sorted[-1]
        partners = _dominating(sizes, top, capacity - top)
        if partners is None:
            break
        need = Counter([top, *partners])
        times = min(sizes.count[size] // n for size, n in need.items())
        for size, n in need.items():
            sizes.take(size, n * times)
        found.append(([top, *partners], times, True))
    return found + [(pattern, times, False) for pattern, times in _best_fit(sizes.count, capacity)]


def _best_fit(count: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Longest first, each into the fullest sequence that has room; equal sequences are one group."""
    open_: dict[int, list[tuple[list[int], int]]] = {}
    rooms: list[int] = []

    def put(pattern: list[int], room: int, times: int) -> None:
        if times:
            if room not in open_:
                open_[room] = []
                bisect.insort(rooms, room)
            open_[room].append((pattern, times))

    for size in sorted(count, reverse=True):
        left = count[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                pattern, room, times = [], capacity, left
            # the sequence just added to is the fullest with room, as long as it has room
            each = room // size
            whole = min(times, left // each)
            put(pattern + [size] * each, room - size * each, whole)
            left -= whole * each
            times -= whole
            if times and 0 < left < each:
                put(pattern + [size] * left, room - size * left, 1)
                left, times = 0, times - 1
            if pattern:
                put(pattern, room, times)
    return [group for groups in open_.values() for group in groups]


def lower_bound(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """No packing has fewer sequences: total length, or items over half plus what their room cannot take."""
    total = sum(size * n for size, n in histogram.items())
    best = -(-total // capacity)
    for alpha in sorted({size for size in histogram if 2 * size <= capacity} | {0}):
        large = sum(n for size, n in histogram.items() if size > capacity - alpha)
        middle = {size: n for size, n in histogram.items() if capacity // 2 < size <= capacity - alpha}
        small = sum(size * n for size, n in histogram.items() if alpha <= size <= capacity // 2)
        room = sum(middle.values()) * capacity - sum(size * n for size, n in middle.items())
        best = max(best, large + sum(middle.values()) + max(0, -(-(small - room) // capacity)))
    return best


def _segments(found: list[tuple[list[int], int, bool]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies in a sequence, first sequence, first offset)."""
    used, rows, sequence = Counter(), [], 0
    for pattern, times, _ in found:
        offset = 0
        for size, copies in sorted(Counter(pattern).items(), reverse=True):
            rows.append((size, used[size], used[size] + copies * times, copies, sequence, offset))
            used[size] += copies * times
            offset += size * copies
        sequence += times
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY, id_column: str = "doc_id") -> DataFrame:
    """Give each piece its ``sequence_id`` and ``offset``; ``cut`` has a ``length`` of 1 to ``capacity``.

    ``cut`` is read three times, so pass a stored table.
    """
    spark = cut.sparkSession
    histogram = {row["length"]: row["n"] for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    segments = _segments(plan(histogram, capacity))
    fields = "length bigint, from_rank bigint, to_rank bigint, copies bigint, first_sequence bigint, first_offset bigint"
    places = spark.createDataFrame(segments, fields)

    parts = 4 * shuffle_partitions(cut)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64(id_column, "piece", "ids_crc32"), F.lit(parts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "salt").orderBy(id_column, "piece", "ids_crc32")
    ranked = (
        salted.withColumn("nth", F.row_number().over(within) - 1)
        .join(shifts, ["length", "salt"])
        .withColumn("rank", F.col("nth") + F.col("shift"))
    )
    # the plan has at most 5 x capacity patterns, whatever the corpus
    placed = ranked.join(
        F.broadcast(places),
        (ranked["length"] == places["length"]) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")),
    )
    along = F.col("rank") - F.col("from_rank")
    return placed.select(
        *[cut[c] for c in cut.columns],
        (F.col("first_sequence") + F.floor(along / F.col("copies"))).cast("bigint").alias("sequence_id"),
        (F.col("first_offset") + (along % F.col("copies")) * cut["length"]).cast("bigint").alias("offset"),
    )


def pack_documents(df: DataFrame, tokenizer_path: str, ranks_path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(pieces(df, tokenizer_path, ranks_path, pattern, capacity), "pieces"), capacity)
