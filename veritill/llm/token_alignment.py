"""Alignment of two tokenizations of the same texts, and how often their tokens meet in a corpus.

Both tokenizers see a space and the text.  A token is known by the byte offset it ends at; where a
token of each side ends at the same offset, a group ends.  The two lists of ends are compared at the
current index shift (the difference between the positions on both sides): exponential probing,
1, 2, 4, 8... ends at a time and halved at the first difference, jumps over stretches in which
tokens match one to one.  An irregular group is resolved where it lies, by advancing whichever side
ends first until both end together; the shift is then the new difference.  On the way each step
meets one pair of tokens with common bytes, so these links come out of the same walk.

How many documents hold a pair of ids linked is counted over the whole corpus.  Pairs with more than
one in ``SHARES`` of all counts are at most ``SHARES``, whatever the corpus: tasks look them up in a
table.  All other pairs are rare each, so a join on the pair has no hot key.

Cases: texts that are null, empty, or that one of the two tokenizers does not give back byte for byte
have no tokens: zeros and an empty string; very long texts are aligned whole; repeated rows each count
as a document; a null id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritill.llm.common import STEP_ROWS, ChunkTable, per_row, stored
from veritill.llm.packing import _RUN, ByteCodec
from veritill.llm.piece_codec import MARK, PieceCodec, chunks_of

#: Pairs that hold more than one in so many counts are looked up inside the tasks.
SHARES = 100_000


class Pieces(PieceCodec):
    """Ids of the piece model by chunk, with the chunks that it does not give back."""

    def __init__(self, model_path: str) -> None:
        super().__init__(model_path)
        self.bytes_of = []
        for piece in range(self.model.get_piece_size()):
            text = self.model.id_to_piece(piece)
            self.bytes_of.append(bytes([int(text[3:5], 16)]) if self.model.is_byte(piece) else text.replace(MARK, " ").encode())
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk; nothing for one that they do not give back."""
        found, bytes_of = [], self.bytes_of
        for chunk, ids in zip(chunks, self.model.encode(chunks, num_threads=1)):
            ids = ids if chunk else [self.mark_id]
            whole = b"".join([bytes_of[i] for i in ids]) == b" " + chunk.encode()
            found.append(struct.pack(f"<{len(ids)}I", *ids) if whole else b"")
        return found

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where their bytes are not those of a space and the text."""
        cut = [[] if MARK in text else chunks_of(text) for text in texts]
        self.table.admit(set().union(*cut) if cut else set())
        table, found = self.table, []
        for words in cut:
            parts = [table[word] for word in words]
            found.append(np.frombuffer(b"".join(parts), "<u4") if parts and b"" not in parts else None)
        return found


class Bytes(ByteCodec):
    """Ids of the byte-level model; strings of special tokens are ordinary text."""

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str) -> None:
        super().__init__(tokenizer_path, ranks_path, pattern)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.normalizer is not None:
            raise ValueError("this tokenizer changes the text")
        # an entry has one character for each of its bytes
        self.lengths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for entry, i in self.tokenizer.get_vocab().items():
            self.lengths[i] = len(entry)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, "<u4") for ids in self.encode([" " + text for text in texts])]


def align(ends_a: list[int], ends_b: list[int]) -> tuple[list[tuple[int, int, int, int]], list[int], list[int]]:
    """Irregular groups of two increasing lists of ends with the same last end, and the links inside them.

    A group is (from a, to a, from b, to b), a link a position on either side.  All tokens outside of
    these groups match one to one, in their order.
    """
    irregular: list[tuple[int, int, int, int]] = []
    left: list[int] = []
    right: list[int] = []
    i, shift, n = 0, 0, len(ends_a)
    while True:
        # double the probe as long as the ends agree at this shift, then halve it
        step = 1
        while i < n and ends_a[i] == ends_b[i + shift] and ends_a[i : i + step] == ends_b[i + shift : i + shift + step]:
            i += step
            step *= 2
        if i >= n:
            return irregular, left, right
        while step > 1:
            step //= 2
            if ends_a[i : i + step] == ends_b[i + shift : i + shift + step]:
                i += step
        # resolve the group that starts here
        j = i + shift
        at_i, at_j, a, b = i, j, ends_a[i], ends_b[j]
        while a != b:
            left.append(i)
            right.append(j)
            if a < b:
                i += 1
                a = ends_a[i]
            else:
                j += 1
                b = ends_b[j]
        left.append(i)
        right.append(j)
        i, j = i + 1, j + 1
        irregular.append((at_i, i, at_j, j))
        shift = j - i


def _outside(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in none of the ranges."""
    return np.cumsum(np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1))[:n] == 0


class _Shown(dict):
    """Texts of groups, each made once; emptied when it is full."""

    def __init__(self, make: Callable[..., str], most: int = 500_000) -> None:
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, group) -> str:
        if len(self) >= self.most:
            self.clear()
        self[group] = text = self.make(group)
        return text


def _ids(packed: bytes) -> str:
    return ",".join(map(str, memoryview(packed).cast("I")))


class Aligner:
    """Both codecs of one task."""

    def __init__(self, byte_model: tuple[str, str, str], piece_model: str) -> None:
        self.a, self.b = Bytes(*byte_model), Pieces(piece_model)
        self.kinds = len(self.b.lengths)
        self.words = ChunkTable(self._both)
        self.matches = _Shown(lambda pair: f"{pair // self.kinds}|{pair % self.kinds}")
        self.others = _Shown(lambda group: "|".join(map(_ids, group)))

    def _both(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        return list(zip(self.a._encode([" " + word for word in words]), self.b._encode(words)))

    def _ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids on both sides; None where the piece model does not give the text back.

        Both models cut before a single space between two words, so most texts are cut once for both.
        """
        found: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(texts)
        plain = [i for i, text in enumerate(texts) if text and " " not in (text[0], text[-1]) and MARK not in text and not _RUN.search(text)]
        cut = [texts[i].split(" ") for i in plain]
        self.words.admit(set().union(*cut) if cut else set())
        table = self.words
        for i, words in zip(plain, cut):
            parts_a, parts_b = zip(*[table[word] for word in words])
            if b"" not in parts_b:
                found[i] = np.frombuffer(b"".join(parts_a), "<u4"), np.frombuffer(b"".join(parts_b), "<u4")
        rest = sorted({i for i, text in enumerate(texts) if text}.difference(plain))
        own = [texts[i] for i in rest]
        for i, a, b in zip(rest, self.a.ids(own), self.b.ids(own)):
            found[i] = None if b is None else (a, b)
        return found

    def pairs(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list[int], list[int]] | None]:
        """Ids and ends on both sides; None for a text without tokens."""
        for text, found in zip(texts, self._ids(texts)):
            if found is None:
                yield None
                continue
            a, b = found
            ends_a, ends_b = self.a.lengths[a].cumsum().tolist(), self.b.lengths[b].cumsum().tolist()
            yield (a, b, ends_a, ends_b) if ends_a[-1] == ends_b[-1] == len(text.encode()) + 1 else None

    def groups(self, a: np.ndarray, b: np.ndarray, ends_a: list[int], ends_b: list[int]):
        """Groups as text, their number, and the linked ids as (number of the pair, how often)."""
        irregular, left, right = align(ends_a, ends_b)
        packed_a, packed_b = a.tobytes(), b.tobytes()
        a, b = a.astype(np.int64), b.astype(np.int64)
        bounds = np.fromiter(chain.from_iterable(irregular), np.int64, 4 * len(irregular)).reshape(-1, 4)
        alone_a, alone_b = (_outside(bounds[:, k], bounds[:, k + 1], len(ids)) for k, ids in ((0, a), (2, b)))
        matched = a[alone_a] * self.kinds + b[alone_b]
        linked, times = np.unique(np.concatenate([matched, a[left] * self.kinds + b[right]]), return_counts=True)
        single = list(map(self.matches.__getitem__, matched.tolist()))
        parts: list[str] = []
        at, before, others = 0, 0, self.others
        for from_a, to_a, from_b, to_b in irregular:
            between = from_a - before
            parts += single[at : at + between]
            parts.append(others[packed_a[4 * from_a : 4 * to_a], packed_b[4 * from_b : 4 * to_b]])
            at, before = at + between, to_a
        parts += single[at:]
        return ";".join(parts), len(parts), linked, times


def aligned(
    df: DataFrame,
    byte_model: tuple[str, str, str],
    piece_model: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_groups: bool = False,
) -> DataFrame:
    """Counts and digest of each text's groups, its linked pairs (``a`` x pieces + ``b``) and how often each occurs.

    ``with_groups`` adds the groups themselves as ``a1,a2|b1;a3|b2,b3``.
    """

    def work(aligner, ids, texts):
        rows = []
        for doc, found in zip(ids, aligner.pairs([text or "" for text in texts])):
            if found is None:
                rows.append((doc, 0, 0, 0, 0, "", [], []) + (("",) if with_groups else ()))
                continue
            text, n, linked, times = aligner.groups(*found)
            digest = hashlib.sha256(text.encode()).hexdigest()
            row = (doc, len(found[0]), len(found[1]), n, int(times.sum()), digest, linked, times)
            rows.append(row + ((text,) if with_groups else ()))
        return [list(column) for column in zip(*rows)]

    schema = f"{id_column} bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    schema += ", pairs array<bigint>, times array<bigint>" + (", `groups` string" if with_groups else "")
    return per_row(df, [id_column, text_column], schema, work, lambda: Aligner(byte_model, piece_model))


def pair_counts(found: DataFrame, kinds: int) -> DataFrame:
    """Documents that hold each pair linked, and whether no other pair of the same A id has more."""
    counts = stored(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    of = F.floor(F.col("pair") / kinds).cast("bigint")
    # one row per A id: bounded by its vocabulary
    most = counts.groupBy(of.alias("a id")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), of == F.col("a id")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _heavy(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs with over one in ``SHARES`` of all counts, sorted: at most ``SHARES`` rows."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = sorted(counts.where(F.col("n") * SHARES > total).collect(), key=lambda r: r["pair"])
    return tuple(np.array([r[c] for r in rows], np.int64) for c in ("pair", "n", "best"))


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)


def _looked_up(found: DataFrame, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """Sums over the pairs of the table for each row, and the pairs that are not in it."""
    keys, counts, best = table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(start, STEP_ROWS)
                row = part.column("pairs").value_parent_indices().to_numpy()
                pairs, times = part.column("pairs").flatten().to_numpy(), part.column("times").flatten().to_numpy()
                at = np.searchsorted(keys, pairs)
                held = at < len(keys)
                held[held] = keys[at[held]] == pairs[held]
                at, there = at[held], row[held]
                sums = [np.zeros(part.num_rows, np.int64) for _ in range(2)]
                np.add.at(sums[0], there, times[held] * counts[at])
                np.add.at(sums[1], there, times[held] * best[at])
                rest = _offsets(np.bincount(row[~held], minlength=part.num_rows))
                lists = [pa.ListArray.from_arrays(rest, pa.array(values[~held], pa.int64())) for values in (pairs, times)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row number"), *[pa.array(s) for s in sums], *lists], names=["row", "sum", "best", "pairs", "times"]
                )

    schema = "`row` bigint, `sum` bigint, best bigint, pairs array<bigint>, times array<bigint>"
    return found.select("row number", "pairs", "times").mapInArrow(run, schema)


def alignment(
    df: DataFrame,
    byte_model: tuple[str, str, str],
    piece_model: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Groups and links of each row, with the corpus counts of its links."""
    import sentencepiece

    kinds = sentencepiece.SentencePieceProcessor(model_file=piece_model).get_piece_size()
    # the stored number of a row tells repeated rows apart
    rows = aligned(df, byte_model, piece_model, id_column, text_column).withColumn("row number", F.monotonically_increasing_id())
    found = stored(rows, "aligned")
    counts = stored(pair_counts(found, kinds), "pair-counts")
    part = stored(_looked_up(found, _heavy(counts)), "looked-up")
    rare = part.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("one"))
    rare = rare.select("row", F.col("one.pairs").alias("pair"), F.col("one.times").alias("times"))
    own = F.when(F.col("best"), F.col("times")).otherwise(0)
    rest = rare.join(counts, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("rare sum"), F.sum(own).alias("rare best"))
    sums = part.select("row", "sum", F.col("best").alias("held")).join(rest, "row", "left")
    zero = F.lit(0).cast("bigint")
    return found.join(sums, F.col("row number") == F.col("row")).select(
        id_column, "n_a", "n_b", "n_groups", "n_links",
        (F.col("held") + F.coalesce("rare best", zero)).alias("n_best"),
        (F.col("sum") + F.coalesce("rare sum", zero)).alias("count_sum"),
        "groups_sha256",
    )
