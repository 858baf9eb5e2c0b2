"""A gated recurrent language model that scores whole documents.

Words are runs of anything but white space, A-Z in lower case; each document closes with an end token.

**Counts.**  Spark counts every word of the corpus, apart for the documents that are learned from.
Words with more than one in ``SHARES`` of all tokens are at most ``SHARES``, whatever the corpus:
tasks look them up in a table.  All others are rare each, so their join with the counts has no hot
key.  The ``VOCABULARY`` most frequent words are words of the model; the others fall into
``TAILS`` tail classes by their form, and have their share of the class's count there.

**Model.**  Embedding, one gated recurrent layer, and a softmax factored by classes: frequency
classes of equal mass with a softmax of their own inside, and the tail classes.  It starts as the
unigram model of the counts.

**Training** is truncated backpropagation in numpy: windows of ``WINDOW`` steps over ``LANES``
documents side by side, whose states are carried from window to window and reset where a document, or
a stretch of ``STRETCH`` tokens of a longer one, starts.  In each of ``ROUNDS`` rounds every task learns
from its share of the documents, starting at the current weights; the weights are then averaged by
tokens, in two levels, so that no task reads the weights of all tasks.  Every training document is
learned from once.

**Scoring** carries the state across windows too, so a document's score is the log-likelihood of all
its tokens, whatever its length.

Cases: null and empty texts are one end token; a null id is neither held out nor learned from, and
stays null; very long texts and words count whole; repeated rows each count; an empty table gives
no rows; without anything to learn from every score is that of unknown words; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritill.llm.common import STEP_ROWS, shuffle_partitions, stored

#: Bounds of the model, fixed whatever the corpus.
VOCABULARY, CLASSES, TAILS = 2048, 40, 4
EMBEDDING, HIDDEN = 16, 16
WINDOW, LANES, ROUNDS = 32, 256, 4
RATE = 0.1
#: Longer documents are learned in stretches of so many tokens, so that lanes end together.
STRETCH = 2048
#: Tokens that a task learns from in one round, about; its weights then count as much as they cost to send.
TASK_TOKENS = 4_000_000
#: Words that hold more than one in so many tokens are looked up inside the tasks.
SHARES = 500_000
#: Rows whose words a task counts at once, and tokens that it learns from or scores at once.
COUNTED, BUFFER = 5_000, 4_000_000

END = b""
ALL = slice(None)
#: A last character that is a mark.
_MARK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]$"


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of some texts; and for each word in turn its place among them and its row."""
    lists = pc.ascii_split_whitespace(pc.fill_null(pc.ascii_lower(texts), ""))
    flat, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    there = pc.greater(pc.binary_length(flat), 0)
    coded = pc.dictionary_encode(flat.filter(there))
    return coded.dictionary, coded.indices.to_numpy(), rows.filter(there).to_numpy()


def tails_of(words: pa.Array) -> np.ndarray:
    """``tail_of`` for all of them."""
    is_ascii = pc.equal(pc.utf8_length(words), pc.binary_length(words)).to_numpy(zero_copy_only=False)
    marked = pc.match_substring_regex(words, _MARK).to_numpy(zero_copy_only=False)
    return 2 * is_ascii.astype(np.int32) + marked.astype(np.int32)


def tail_of(word: bytes) -> int:
    """Tail class of a word: whether it is all ASCII, and whether it ends in a mark."""
    return 2 * word.isascii() + (word[-1:].isascii() and not word[-1:].isalnum())


# --- counts ----------------------------------------------------------------------------------


def word_counts(df: DataFrame, learn: Column, text_column: str = "text") -> DataFrame:
    """Each word with its tail class, its count ``n`` in rows to learn from, and ``all_n`` in all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, COUNTED):
                part = batch.slice(start, COUNTED)
                words, at, row = words_in(part.column(0))
                learned = pc.fill_null(part.column(1), False).to_numpy(zero_copy_only=False)
                own = np.bincount(at, minlength=len(words))
                n = np.bincount(at[learned[row]], minlength=len(words))
                ends = [pa.array([value], kind) for value, kind in (
                    (END, pa.binary()), (tail_of(END), pa.int32()), (int(learned.sum()), pa.int64()), (part.num_rows, pa.int64()))]
                columns = [words.cast(pa.binary()), pa.array(tails_of(words)), pa.array(n, pa.int64()), pa.array(own, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(pair) for pair in zip(columns, ends)], names=["word", "tail", "n", "all_n"])

    found = df.select(F.col(text_column), learn).mapInArrow(run, "word binary, tail int, n bigint, all_n bigint")
    return found.groupBy("word", "tail").agg(F.sum("n").alias("n"), F.sum("all_n").alias("all_n"))


class Vocabulary(NamedTuple):
    """What the tasks know of the counts; at most ``SHARES`` words."""

    #: Frequent words, and the log10 of each one's count + 0.5, whether it is known, and its token of the model.
    words: list[bytes]
    logs: np.ndarray
    known: np.ndarray
    tokens: np.ndarray
    #: Counts of the model's words, with the end token first.
    counts: np.ndarray
    #: Training tokens and the log10 of base's divisor.
    total: int
    base: float
    #: Count and log10 of the divisor of each tail class.
    tail_counts: np.ndarray
    tail_logs: np.ndarray


def vocabulary(counts: DataFrame) -> Vocabulary:
    sums = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.sum("all_n").alias("all_n"), F.count_if(F.col("n") > 0).alias("kinds")).collect()
    total, all_total, kinds = (sum(row[c] for row in sums) for c in ("n", "all_n", "kinds"))
    rows = counts.where((F.col("all_n") * SHARES > all_total) & (F.col("word") != F.lit(END))).select("n", "word").toArrow()
    end = counts.where(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = sorted(zip(*(column.to_pylist() for column in rows.columns)), key=lambda r: (-r[0], r[1]))
    model = [pair for pair in frequent if pair[0]][: VOCABULARY - 1]
    tail_n, tail_kinds = np.zeros(TAILS), np.zeros(TAILS)
    for row in sums:
        tail_n[row["tail"]] += row["n"]
        tail_kinds[row["tail"]] += row["kinds"]
    for n, word in [*model, (end, END)]:
        tail_n[tail_of(word)] -= n
        tail_kinds[tail_of(word)] -= n > 0
    tokens = [at + 1 if at < len(model) else len(model) + 1 + tail_of(word) for at, (_, word) in enumerate(frequent)]
    n = np.array([0, *[n for n, _ in frequent]], np.int64)
    n[0] = end
    return Vocabulary(
        [END, *[word for _, word in frequent]], np.log10(n + 0.5), n > 0, np.array([0, *tokens], np.uint16),
        n[: len(model) + 1], total, math.log10(total + 0.5 * (kinds + 1)), tail_n, np.log10(tail_n + 0.5 * (tail_kinds + 1)),
    )


def encoded(df: DataFrame, known: Vocabulary, held_out: Column, learn: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokens of each row, the sums over its frequent words, and its rare words.

    ``logs`` sums log10(count + 0.5) over the frequent words, ``tail_score`` over those of them in
    tail classes less the divisor, which it has for the rare words too.
    """
    names = ("doc", "held_out", "learn", "tokens", "n_tokens", "n_known", "logs", "tail_score", "rare", "times")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {word: at for at, word in enumerate(known.words)}.get
        first_tail = len(known.counts)
        in_tail = np.where(known.tokens >= first_tail, known.logs, 0.0)
        for part in (whole.slice(start, STEP_ROWS) for whole in batches for start in range(0, whole.num_rows, STEP_ROWS)):
            n_rows, (words, at, row) = part.num_rows, words_in(part.column(3))
            kinds, tails = len(words), tails_of(words).astype(np.int64)
            found = np.fromiter(map(place, words.cast(pa.binary()).to_pylist(), repeat(-1)), np.int64, kinds)
            held = found >= 0
            # what a word adds, by its place among the distinct ones
            tokens = np.where(held, known.tokens[found], first_tail + tails)
            logs = np.where(held, known.logs[found], 0.0)
            scores = np.where(held, in_tail[found], 0.0) - np.where(tokens >= first_tail, known.tail_logs[tails], 0.0)
            summed = [np.bincount(row, weights=value[at], minlength=n_rows) for value in (logs, scores, held & known.known[found])]

            n_tokens = np.bincount(row, minlength=n_rows) + 1
            ends = np.cumsum(n_tokens)
            stream = np.zeros(len(at) + n_rows, np.uint16)  # 0 is the end token
            stream[np.arange(len(at)) + row] = tokens[at]
            packed = pa.Array.from_buffers(
                pa.large_binary(), n_rows, [None, pa.py_buffer((2 * np.r_[0, ends]).astype(np.int64)), pa.py_buffer(stream)]
            ).cast(pa.binary())

            missing = ~held[at]
            pairs, times = np.unique(row[missing].astype(np.int64) * kinds + at[missing], return_counts=True)
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(pairs // max(kinds, 1), minlength=n_rows))].astype(np.int32))
            rare = pc.take(words.cast(pa.binary()), pa.array(pairs % max(kinds, 1)))
            arrays = [
                packed, pa.array(n_tokens, pa.int64()), pa.array(summed[2].astype(np.int64) + int(known.known[0])),
                pa.array(summed[0] + known.logs[0]), pa.array(summed[1]),
                pa.ListArray.from_arrays(offsets, rare), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(3)], *arrays], names=list(names))

    schema = "doc bigint, held_out boolean, learn boolean, tokens binary, n_tokens bigint, n_known bigint, logs double, "
    schema += "tail_score double, rare array<binary>, times array<bigint>"
    selected = df.select(F.col(id_column).cast("bigint").alias("doc"), held_out.alias("held_out"), learn.alias("learn"), F.col(text_column).alias("text"))
    return selected.mapInArrow(run, schema)


def rare_sums(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Per row: sums over its rare words, which the tasks' table does not have."""
    rare = found.select("row", F.explode(F.arrays_zip("rare", "times")).alias("one"))
    rare = rare.select("row", F.col("one.rare").alias("word"), F.col("one.times").alias("times"))
    n = F.coalesce("n", F.lit(0))
    joined = rare.join(counts.select("word", "n").hint("shuffle_hash"), "word", "left")
    return joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("rare_logs"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )


# --- model -----------------------------------------------------------------------------------


class Lanes:
    """Documents side by side: each lane is one document after the other, longer lanes first."""

    def __init__(self, documents: list[np.ndarray], lanes: int) -> None:
        self.documents = documents
        order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
        own: list[list[int]] = [[] for _ in range(min(lanes, len(documents)))]
        # the longest that is left goes to the shortest lane
        heap = [(0, lane) for lane in range(len(own))]
        for i in order:
            length, lane = heapq.heappop(heap)
            own[lane].append(i)
            heapq.heappush(heap, (length + len(documents[i]), lane))
        own.sort(key=lambda docs: -sum(len(documents[i]) for i in docs))
        self.order = [i for docs in own for i in docs]
        sizes = np.array([len(documents[i]) for i in self.order], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.lengths = np.array([sum(len(documents[i]) for i in docs) for docs in own], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.targets = np.concatenate([documents[i] for i in self.order]).astype(np.int64)
        self.fresh = np.zeros(len(self.targets), bool)
        self.fresh[self.starts] = True
        # a document starts from the end token
        self.inputs = np.concatenate([[0], self.targets[:-1]])
        self.inputs[self.starts] = 0

    def windows(self, steps: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Lanes that go on, places (steps, lanes) in the streams, and which of them are real."""
        for start in range(0, int(self.lengths[0]) if len(self.lengths) else 0, steps):
            lanes = int(np.searchsorted(-self.lengths, -start, "left"))
            along = start + np.arange(min(steps, int(self.lengths[0]) - start))[:, None]
            real = along < self.lengths[:lanes]
            yield lanes, np.where(real, along, self.lengths[:lanes] - 1) + self.offsets[:lanes], real

    def per_document(self, values: np.ndarray) -> np.ndarray:
        found = np.empty(len(self.documents))
        found[self.order] = np.add.reduceat(values, self.starts)
        return found


def _rows(after: np.ndarray, real: np.ndarray) -> np.ndarray:
    """States one after the other, those of real places only."""
    turned = after.transpose(0, 2, 1)
    return turned.reshape(-1, after.shape[1]) if real.all() else turned[real]


def _sigmoid(x: np.ndarray) -> None:
    """In place."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x *= np.float32(0.5)
    x += np.float32(0.5)


class Network:
    """Weights, forward and backward passes.  ``parts`` are the weights in a fixed order, ``seen`` the
    squared gradients so far: one number for each row of a matrix, one for each number of a vector."""

    NAMES = ("embedding", "inner", "recurrent", "gate_bias", "class_weights", "class_bias", "word_weights", "word_bias")

    def __init__(self, bounds: np.ndarray, parts: dict[str, np.ndarray], seen: dict[str, np.ndarray]) -> None:
        self.bounds, self.parts, self.seen = bounds, parts, seen
        self.class_of = np.concatenate([np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), len(bounds) - 1 + np.arange(TAILS)]).astype(np.int16)

    @classmethod
    def started(cls, counts: np.ndarray, tail_counts: np.ndarray, seed: int = 1) -> Network:
        """The unigram model of the counts: no weight on the state yet."""
        mass = np.cumsum(np.maximum(counts, 0.5))
        split = np.searchsorted(mass, mass[-1] * np.arange(1, CLASSES) / CLASSES) + 1
        bounds = np.unique(np.concatenate([[0], split, [len(counts)]]))
        draw, kinds, classes = np.random.default_rng(seed), len(counts) + TAILS, len(bounds) - 1 + TAILS
        weight = np.maximum(counts, 0.5)
        in_class = np.add.reduceat(weight, bounds[:-1])
        shares = np.concatenate([in_class, np.maximum(tail_counts, 0.5)])
        parts = {
            "embedding": draw.normal(0, 0.5, (kinds, EMBEDDING)),
            "inner": draw.normal(0, 1 / math.sqrt(EMBEDDING), (3 * HIDDEN, EMBEDDING)),
            "recurrent": draw.normal(0, 0.5 / math.sqrt(HIDDEN), (3 * HIDDEN, HIDDEN)),
            # states start out slow, so that they hold what a document is about
            "gate_bias": np.concatenate([np.zeros(HIDDEN), np.linspace(0, 3, HIDDEN), np.zeros(HIDDEN)]),
            "class_weights": np.zeros((classes, HIDDEN)),
            "class_bias": np.log(shares / shares.sum()),
            "word_weights": np.zeros((len(counts), HIDDEN)),
            "word_bias": np.log(weight / np.repeat(in_class, np.diff(bounds))),
        }
        parts = {name: part.astype(np.float32) for name, part in parts.items()}
        return cls(bounds, parts, {name: np.zeros(len(part), np.float32) for name, part in parts.items()})

    def packed(self) -> np.ndarray:
        return np.concatenate([array[name].ravel() for array in (self.parts, self.seen) for name in self.NAMES])

    def unpacked(self, packed: np.ndarray) -> Network:
        at, arrays = 0, []
        for like in (self.parts, self.seen):
            own = {}
            for name in self.NAMES:
                size = like[name].size
                own[name] = packed[at : at + size].reshape(like[name].shape).astype(np.float32)
                at += size
            arrays.append(own)
        return Network(self.bounds, *arrays)

    def states(self, inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray, back: bool = True):
        """States (steps, hidden, lanes) after each step, and what the backward pass needs.

        Lanes come last, so that a gate of all lanes is one run of memory.
        """
        p, h, (steps, lanes) = self.parts, HIDDEN, inputs.shape
        given = p["embedding"][inputs]
        bias, fresh_at = p["gate_bias"][:, None], fresh.any(axis=1)
        kept = steps if back else 1
        gates, after = np.empty((kept, 3 * h, lanes), np.float32), np.empty((steps, h, lanes), np.float32)
        carried, turned = (np.empty((kept, h, lanes), np.float32) for _ in range(2))
        for t in range(steps):
            if fresh_at[t]:
                state = np.where(fresh[t], np.float32(0), state)
            mixed, own = p["recurrent"] @ state, gates[t % kept]
            np.matmul(p["inner"], given[t].T, out=own)
            own += bias
            both, new = own[: 2 * h], own[2 * h :]
            both += mixed[: 2 * h]
            _sigmoid(both)
            new += own[:h] * mixed[2 * h :]
            np.tanh(new, out=new)
            if back:
                carried[t], turned[t] = state, mixed[2 * h :]
            np.subtract(state, new, out=after[t])
            after[t] *= own[h : 2 * h]
            after[t] += new
            state = after[t]
        return after, (given, gates, carried, turned)

    def log_likelihood(self, states: np.ndarray, targets: np.ndarray, grads: list | None = None):
        """Natural log-likelihood of each target, and with ``grads`` the gradient for the states."""
        p, classes = self.parts, self.class_of[targets]
        logits = p["class_weights"] @ states.T
        logits += p["class_bias"][:, None]
        found, back = _chosen(logits, classes, grads is not None)
        d_states = None
        if grads is not None:
            grads += [("class_weights", ALL, back @ states), ("class_bias", ALL, back.sum(axis=1))]
            d_states = back.T @ p["class_weights"]
        order = np.argsort(classes, kind="stable")
        ends = np.cumsum(np.bincount(classes, minlength=len(self.bounds) - 1 + TAILS))
        for k in range(len(self.bounds) - 1):
            low, high = self.bounds[k], self.bounds[k + 1]
            rows = order[ends[k - 1] if k else 0 : ends[k]]
            if high - low < 2 or not len(rows):
                continue
            own = states[rows]
            logits = p["word_weights"][low:high] @ own.T
            logits += p["word_bias"][low:high, None]
            inside, back = _chosen(logits, targets[rows] - low, grads is not None)
            found[rows] += inside
            if grads is not None:
                grads += [("word_weights", slice(low, high), back @ own), ("word_bias", slice(low, high), back.sum(axis=1))]
                d_states[rows] += back.T @ p["word_weights"][low:high]
        return found, d_states

    def gradients(self, inputs, targets, fresh, real, state) -> tuple[list[tuple], float, np.ndarray]:
        """Gradients of the log-likelihood of one window as (name, rows, gradient), that likelihood, and the state after it."""
        p, h, grads = self.parts, HIDDEN, []
        after, (given, gates, carried, turned) = self.states(inputs, fresh, state)
        d_after = np.zeros((*inputs.shape, h), np.float32)
        found, d_after[real] = self.log_likelihood(_rows(after, real), targets[real], grads)
        d_gate, flowing, d_bias = np.empty_like(gates[0]), np.zeros_like(after[0]), np.zeros(3 * h, np.float32)
        d_recurrent, d_inner, d_given = np.zeros_like(p["recurrent"]), np.zeros_like(p["inner"]), np.empty_like(given)
        for t in range(len(after) - 1, -1, -1):
            reset, update, new = (gates[t, k * h : (k + 1) * h] for k in range(3))
            d_reset, d_update, d_new = (d_gate[k * h : (k + 1) * h] for k in range(3))
            d = d_after[t].T + flowing
            through = d * update
            np.multiply(d - through, 1 - new * new, out=d_new)
            np.multiply(d_new * turned[t], reset - reset * reset, out=d_reset)
            np.multiply(through * (carried[t] - new), 1 - update, out=d_update)
            d_bias += d_gate.sum(axis=1)
            d_inner += d_gate @ given[t]
            np.matmul(d_gate.T, p["inner"], out=d_given[t])
            d_new *= reset
            d_recurrent += d_gate @ carried[t].T
            flowing = p["recurrent"].T @ d_gate
            flowing += through
            if fresh[t].any():
                flowing[:, fresh[t]] = 0
        grads += [("recurrent", ALL, d_recurrent), ("gate_bias", ALL, d_bias), ("inner", ALL, d_inner)]
        rows = d_given.reshape(-1, EMBEDDING)
        order = np.argsort(inputs, axis=None, kind="stable")
        tokens = inputs.ravel()[order]
        firsts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        grads.append(("embedding", tokens[firsts], np.add.reduceat(rows[order], firsts, axis=0)))
        return grads, float(found.sum()), after[-1]

    def step(self, grads: list[tuple], tokens: int) -> None:
        """One step uphill, its length by the squared gradients so far; rows without a gradient stay."""
        for name, rows, grad in grads:
            grad = grad / np.float32(math.sqrt(tokens))
            seen = self.seen[name][rows] + (np.mean(grad * grad, axis=1) if grad.ndim == 2 else grad * grad)
            scale = RATE / np.sqrt(seen + np.float32(1e-2))
            self.seen[name][rows] = seen
            self.parts[name][rows] += grad * (scale[:, None] if grad.ndim == 2 else scale)

    def learn(self, documents: list[np.ndarray]) -> None:
        lanes = Lanes([d[at : at + STRETCH] for d in documents for at in range(0, len(d), STRETCH)], LANES)
        state = np.zeros((HIDDEN, len(lanes.lengths)), np.float32)
        for n, at, real in lanes.windows(WINDOW):
            grads, _, state = self.gradients(lanes.inputs[at], lanes.targets[at], lanes.fresh[at], real, state[:, :n])
            self.step(grads, int(real.sum()))

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        """Log10-likelihood of each document; tokens of tail classes count as their class."""
        lanes = Lanes(documents, LANES)
        state, values = np.zeros((HIDDEN, len(lanes.lengths)), np.float32), np.zeros(len(lanes.targets))
        for n, at, real in lanes.windows(WINDOW):
            after, _ = self.states(lanes.inputs[at], lanes.fresh[at], state[:, :n], back=False)
            places = at.ravel() if real.all() else at[real]
            values[places] = self.log_likelihood(_rows(after, real), lanes.targets[places])[0]
            state = after[-1]
        return lanes.per_document(values) / math.log(10)


def _chosen(logits: np.ndarray, chosen: np.ndarray, with_gradient: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Log-softmax of each column at its chosen row, in place; and its gradient for the logits."""
    columns = np.arange(logits.shape[1])
    logits -= logits.max(axis=0)
    own = logits[chosen, columns].astype(np.float64)
    np.exp(logits, out=logits)
    total = logits.sum(axis=0)
    found = own - np.log(total)
    if not with_gradient:
        return found, None
    logits /= -total
    logits[chosen, columns] += 1
    return found, logits


# --- distribution ----------------------------------------------------------------------------


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows whose tokens come to about ``BUFFER``; a longer document is a buffer of its own."""
    for batch in batches:
        sizes = batch.column("n_tokens").to_pylist()
        start, size = 0, 0
        for at, n in enumerate([*sizes, BUFFER]):
            if at > start and size + n > BUFFER:
                part = batch.slice(start, at - start)
                yield part, [np.frombuffer(tokens, np.uint16) for tokens in part.column("tokens").to_pylist()]
                start, size = at, 0
            size += n


def _summed(frame: DataFrame) -> DataFrame:
    """One row per partition: the sums of its weights, each times its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, total = 0, None
        for batch in batches:
            for n, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                weights = np.frombuffer(packed, np.float32).astype(np.float64) * n
                total, tokens = weights if total is None else total + weights, tokens + n
        if tokens:
            yield pa.RecordBatch.from_pydict({"n": pa.array([tokens]), "weights": pa.array([(total / tokens).astype(np.float32).tobytes()])})

    return frame.mapInArrow(run, "n bigint, weights binary")


def train(found: DataFrame, network: Network) -> Network:
    """``ROUNDS`` rounds over the rows to learn from, each row in one of them."""
    tasks = 1 + (found.where("learn").agg(F.sum("n_tokens")).first()[0] or 0) // (ROUNDS * TASK_TOKENS)
    for turn in range(ROUNDS):
        share = found.where(F.col("learn") & (F.pmod(F.col("row"), F.lit(ROUNDS)) == turn)).select("tokens", "n_tokens")

        def run(batches: Iterator[pa.RecordBatch], start: Network = network) -> Iterator[pa.RecordBatch]:
            own, tokens = start.unpacked(start.packed()), 0
            for part, documents in _buffers(batches):
                own.learn(documents)
                tokens += sum(map(len, documents))
            if tokens:
                yield pa.RecordBatch.from_pydict({"n": pa.array([tokens]), "weights": pa.array([own.packed().tobytes()])})

        groups = math.isqrt(shuffle_partitions(found)) + 1
        learned = share.coalesce(tasks).mapInArrow(run, "n bigint, weights binary").repartition(groups)
        average = _summed(_summed(learned).repartition(1)).first()
        if average is not None:
            network = network.unpacked(np.frombuffer(average["weights"], np.float32))
    return network


def scored(found: DataFrame, network: Network) -> DataFrame:
    """Log10-likelihood of each row's tokens under the network."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, documents in _buffers(batches):
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(network.score(documents))], names=["row", "network"])

    return found.select("row", "tokens", "n_tokens").mapInArrow(run, "`row` bigint, network double")


def score_documents(
    df: DataFrame, held_out: Column, learn: Column, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Base and model score of each row; ``learn`` says which rows the counts and the model come from."""
    counts = stored(word_counts(df, learn, text_column), "word-counts")
    known = vocabulary(counts)
    # the stored number of a row tells repeated rows apart
    found = stored(
        encoded(df, known, held_out, learn, id_column, text_column).withColumn("row", F.monotonically_increasing_id()), "encoded"
    )
    network = train(found, Network.started(known.counts, known.tail_counts))
    joined = found.join(rare_sums(found, counts), "row", "left").join(scored(found, network), "row")
    none = F.lit(0.0)
    logs = F.col("logs") + F.coalesce("rare_logs", none)
    return joined.select(
        F.col("doc").alias(id_column), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(known.base)).alias("base_score"),
        (F.col("network") + F.col("tail_score") + F.coalesce("rare_logs", none)).alias("score"),
    )
