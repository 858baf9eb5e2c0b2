"""Near-duplicates by MinHash bands and sequential Bayesian verification.

A document's set is that of its distinct word shingles; equal sets are one class, represented by its
smallest id.  Classes that agree in a whole band of their signatures share a bucket.  A pair of
a bucket is verified in two steps.  First its signatures are compared batch by batch: with
m of n hashes equal and a uniform prior, the similarity is at least t with the probability that
Binomial(n + 1, t) is at most m; below ``miss`` the pair is dropped.  Survivors are confirmed on
their full sets.

To lose no link without comparing all pairs of a bucket, verification has two rounds.  In the first,
every member of a bucket is compared with the bucket's smallest id.  Buckets whose members then lie
in one component are done.  The others go, in blocks of bounded size, to grouped tasks that compare
members of different components, most similar first, and stop as soon as they are connected.

Cases: null and empty text has an empty set, is linked with nothing and kept; a text with fewer
words than a shingle is one shingle; very long texts are read whole; repeated rows are one class;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritill.llm.common import discard, packed_text, per_row, stored, unpacker
from veritill.llm.components import components

#: Two sets of similarity 0.8 share no band with probability (1 - 0.8 ** 5) ** 32 = 3e-6.
BANDS, BAND_HASHES, BATCH = 32, 5, 32
MISS = 1e-6
#: Members of a bucket that are compared within one task group.
BLOCK = 512

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PRIME = np.uint64(0x100000001B3)


def shingles(text: str | None, words_each: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    import xxhash

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    code = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(words_each, len(words))
    found = code[: len(code) - size + 1].copy()
    for i in range(1, size):
        found = found * _PRIME + code[i : len(code) - size + 1 + i]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0x9E3779B97F4A7C15)
    return np.unique(found ^ np.uint64(size))


@functools.cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20).integers(0, 1 << 32, (2, BANDS * BAND_HASHES), dtype=np.uint64).astype(np.uint32)
    return draw[0] | np.uint32(1), draw[1]


def signature(found: np.ndarray) -> np.ndarray:
    factor, mask = _permutations()
    folded = (found >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factor), np.uint32(0xFFFFFFFF))
    for start in range(0, len(folded), 512):
        best = np.minimum(best, ((folded[start : start + 512, None] ^ mask) * factor).min(axis=0))
    return best


def _band_keys(signed: np.ndarray) -> np.ndarray:
    parts = signed.reshape(BANDS, BAND_HASHES).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND_HASHES):
        key = (key ^ parts[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


@functools.cache
def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, fewest equal ones that keep a pair) after each batch."""
    found = []
    for n in range(BATCH, BANDS * BAND_HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found.append((n, m))
    return found


def plausible(left: np.ndarray, right: np.ndarray, threshold: float, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of signatures (rows) stay, and their equal hashes: batches of growing prefixes."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), dtype=np.int32)
    done = 0
    for n, least in least_matches(threshold, miss):
        equal[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        alive, done = alive[equal[alive] >= least], n
    return alive, equal


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct hashes."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signed(df: DataFrame, words_each: int, id_column: str, text_column: str) -> DataFrame:
    def work(_, ids, texts):
        import xxhash

        sizes, keys, signed, bands = [], [], [], []
        for text in texts:
            found = shingles(text, words_each)
            sizes.append(len(found))
            if not len(found):
                keys.append(None), signed.append(None), bands.append([])
                continue
            own = signature(found)
            keys.append(xxhash.xxh3_128_digest(found.tobytes()))
            signed.append(own.tobytes())
            bands.append(_band_keys(own))
        return [ids, sizes, keys, signed, bands]

    schema = "doc bigint, n_shingles bigint, set_key binary, signature binary, bands array<bigint>"
    return per_row(df.select(F.col(id_column).alias("doc"), F.col(text_column).alias("body")), ["doc", "body"], schema, work)


def _sets(df: DataFrame, ids: DataFrame, words_each: int, id_column: str, text_column: str) -> DataFrame:
    """(doc, hashes) of the documents in ``ids``, from their texts once more."""
    texts = df.select(F.col(id_column).alias("doc"), F.col(text_column).alias("body"))
    some = packed_text(texts, "body", ("doc",)).join(ids, "doc", "left_semi")

    def work(decompressor, docs, packed):
        return [docs, [shingles(decompressor.decompress(data).decode() if data else None, words_each).tobytes() for data in packed]]

    return per_row(some, ["doc", "packed"], "doc bigint, hashes binary", work, unpacker)


def _each_pair(pairs: DataFrame, items: DataFrame, column: str) -> DataFrame:
    left = items.select(F.col("doc").alias("a"), F.col(column).alias("of_a"))
    right = items.select(F.col("doc").alias("b"), F.col(column).alias("of_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")


def _round_of_leaders(members: DataFrame, signatures: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links between members of buckets and the smallest id there."""
    pairs = members.where(F.col("doc") != F.col("leader")).select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct()

    def compare(_, a, b, left, right):
        alive, _ = plausible(
            np.frombuffer(b"".join(left), dtype=np.uint32).reshape(len(a), -1),
            np.frombuffer(b"".join(right), dtype=np.uint32).reshape(len(a), -1), percent / 100, miss,
        )
        return [[a[i] for i in alive], [b[i] for i in alive]]

    def confirm(_, a, b, left, right):
        sure = [i for i in range(len(a)) if linked(np.frombuffer(left[i], np.uint64), np.frombuffer(right[i], np.uint64), percent)]
        return [[a[i] for i in sure], [b[i] for i in sure]]

    columns = ["a", "b", "of_a", "of_b"]
    kept = stored(per_row(_each_pair(pairs, signatures, "signature"), columns, "a bigint, b bigint", compare), "plausible")
    return per_row(_each_pair(kept, sets, "hashes"), columns, "a bigint, b bigint", confirm)


def _round_of_blocks(members: DataFrame, found: DataFrame, signatures: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links between components within the buckets that hold several."""
    named = members.join(found, members["doc"] == found["id"], "left").select(
        "bucket", "doc", F.coalesce("component", "doc").alias("component")
    )
    mixed = named.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("who"),
    ).where(F.col("low") != F.col("high"))
    # buckets of the same members are one
    once = mixed.groupBy("n", "who").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    open_ = stored(named.join(once, "bucket"), "open-buckets")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (
        open_.withColumn("own", F.pmod(F.xxhash64("doc"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "doc", "component", "own")
    )
    ids = open_.select("doc").distinct()
    heavy = sets.join(ids, "doc", "left_semi").join(signatures, "doc")
    target = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def connect(key, table):
        low, high = key[1].as_py(), key[2].as_py()
        doc = table.column("doc").to_numpy()
        own = table.column("own").to_numpy()
        signed = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint32).reshape(len(doc), -1)
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("hashes").to_pylist()]
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        component = table.column("component").to_pylist()
        label = np.array(component)
        out = []
        for i in range(len(doc)):
            others = np.flatnonzero((label[i + 1 :] != label[i]) & ((own[i + 1 :] != own[i]) | (low == high))) + i + 1
            if not len(others):
                continue
            alive, equal = plausible(np.broadcast_to(signed[i], (len(others), signed.shape[1])), signed[others], percent / 100, miss)
            for j in others[alive[np.argsort(-equal[alive], kind="stable")]]:
                mine, its = top(component[i]), top(component[j])
                if mine != its and linked(sets[i], sets[j], percent):
                    root[max(mine, its)] = min(mine, its)
                    out.append((int(doc[i]), int(doc[j])))
        columns = list(zip(*out)) if out else [[], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=target)

    return dealt.join(heavy, "doc").groupBy("bucket", "low", "high").applyInArrow(connect, "a bigint, b bigint")


def near_duplicates(
    df: DataFrame, words_each: int = 5, percent: int = 80, miss: float = MISS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document: size of its set, its component (smallest id reachable by links) and whether it is that one."""
    signed = stored(_signed(df, words_each, id_column, text_column), "minhash")
    classes = stored(
        signed.where(F.col("n_shingles") > 0).groupBy("set_key").agg(F.min("doc").alias("representative")), "classes"
    )
    heads = classes.where(F.col("representative").isNotNull()).select(F.col("representative").alias("doc"), "set_key")
    members = (
        signed.join(heads, ["doc", "set_key"], "left_semi").select("doc", F.explode(F.array_distinct("bands")).alias("bucket")).distinct()
    )
    shared = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("doc").alias("leader")).where(F.col("n") > 1)
    members = stored(members.join(shared.select("bucket", "leader"), "bucket"), "buckets")
    involved = members.select("doc").distinct()
    signatures = stored(
        signed.join(heads, ["doc", "set_key"], "left_semi").join(involved, "doc", "left_semi").select("doc", "signature").dropDuplicates(["doc"]),
        "signatures",
    )

    # texts are read and dealt out once more for the full sets of documents that share a bucket
    sets = stored(_sets(df, involved, words_each, id_column, text_column), "shingles")
    first = stored(_round_of_leaders(members, signatures, sets, percent, miss), "links-leaders")
    found = components(first)
    second = stored(_round_of_blocks(members, found, signatures, sets, percent, miss), "links-blocks")
    found = components(first.unionAll(second))
    discard(members, signatures, sets)
    named = classes.join(found, classes["representative"] == found["id"], "left").select(
        "set_key", F.coalesce("component", "representative").alias("component")
    )
    return signed.select("doc", "n_shingles", "set_key").join(named, "set_key", "left").select(
        F.col("doc").alias(id_column), "n_shingles", F.coalesce("component", "doc").alias("component_id"),
        F.coalesce("component", "doc").eqNullSafe(F.col("doc")).alias("kept"),
    )
