"""Language identification with a linear-chain conditional random field.

Every word of a text is labelled, so that code-switched text is followed word by word.  A word's
features are its affixes, its letter n-grams, the word itself and the lexicons of the labels; labels
of neighbouring words are tied by learned transitions.  Marginals come from forward-backward; a
document's language is the label with the largest expected share of its words.

Fitting uses a bounded sample: ``rows_per_label`` documents of each language, drawn by hash, and of
each one excerpt of ``excerpt_chars`` characters from a place drawn by hash.  Prediction reads every word of every text:
texts are cut into runs of words that are worked on side by side, and the runs of a text are joined exactly
by their transfer matrices.

Cases: null text and text without a letter are ``und`` with score 0; with nothing to learn from,
every text is; very long texts are read whole; ties go to the label that sorts first; repeated rows
each give a row; a null id is never held out nor learned from; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritill.llm.common import ChunkTable, per_row

#: Bounds of the sample that the model is fitted on.
ROWS_PER_LABEL, EXCERPT_CHARS = 400, 500
LEXICON_WORDS = 300
BUCKETS, WORD_LETTERS, RUN = 1 << 15, 24, 128
UNKNOWN = "und"


def word_finder():
    import regex

    return regex.compile(rf"\p{{L}}{{1,{WORD_LETTERS}}}").findall


def features(words: list[str]) -> np.ndarray:
    """Hashed features of lower-cased words, one row each; bucket 0 stands for none."""
    code = np.zeros((len(words), WORD_LETTERS + 2), dtype=np.uint64)
    letters = np.array(words, dtype=f"U{WORD_LETTERS}").view(np.uint32).reshape(len(words), WORD_LETTERS)
    size = np.count_nonzero(letters, axis=1)
    code[:, 0] = 1
    code[:, 1:-1] = letters
    at = np.arange(len(words))
    code[at, size + 1] = 2

    def bucket(value: np.ndarray, kind: int) -> np.ndarray:
        mixed = (value + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return (1 + (mixed >> np.uint64(40)) % np.uint64(BUCKETS - 1)).astype(np.int32)

    grams, found, prime = code.copy(), [], np.uint64(1_000_003)
    whole = np.zeros(len(words), dtype=np.uint64)
    for column in range(code.shape[1]):
        whole = whole * prime + code[:, column]
    found.append(bucket(whole, 77)[:, None])
    for n in (2, 3, 4):
        grams = grams[:, :-1] * prime + code[:, n - 1 :]
        there = np.arange(grams.shape[1])[None, :] <= (size + 2 - n)[:, None]
        found.append(np.where(there, bucket(grams, n), 0))
        # affixes are the grams at the ends once more, under a number of their own
        found.append(np.where(size + 2 >= n, bucket(grams[:, 0], 10 + n), 0)[:, None])
        last = np.maximum(size + 2 - n, 0)
        found.append(np.where(size + 2 >= n, bucket(grams[at, last], 20 + n), 0)[:, None])
    return np.concatenate(found, axis=1)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # bucket, label
    lexicon: dict[str, int]  # word: number of the set of labels that list it
    lexicon_weights: np.ndarray  # set of labels, label
    transitions: np.ndarray  # label, label

    def emissions(self, words: list[str]) -> np.ndarray:
        listed = np.fromiter((self.lexicon.get(word, 0) for word in words), dtype=np.int64, count=len(words))
        return self.weights[features(words)].sum(axis=1) + self.lexicon_weights[listed]


def _runs(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and length of each run of at most RUN words."""
    n = -(-lengths // RUN)
    doc = np.repeat(np.arange(len(lengths)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(np.cumsum(lengths) - lengths, n) + nth * RUN
    return doc, first, np.minimum(RUN, lengths[doc] - nth * RUN)


def marginals(
    emission: np.ndarray, transitions: np.ndarray, lengths: np.ndarray, moves: np.ndarray | None = None
) -> np.ndarray:
    """Label probabilities of every word; ``emission`` has the words of all texts one after the other.

    Runs are worked on side by side.  A first pass multiplies up the transfer matrix of each run;
    these carry forward and backward vectors across the runs of a text; a second pass fills in.
    ``moves`` (label, label) has the expected number of each transition added to it, those from the
    uniform start of every text included.
    """
    labels = emission.shape[1]
    doc, first, size = _runs(lengths)
    steps = int(size.max())
    move = np.exp(transitions - transitions.max())
    at = np.minimum(first[None, :] + np.arange(steps)[:, None], len(emission) - 1)
    there = np.arange(steps)[:, None] < size[None, :]
    likely = np.exp(emission - emission.max(axis=1, keepdims=True))[at]

    before = np.full((len(doc), labels), 1.0 / labels)
    after = np.ones((len(doc), labels))
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    counts = np.diff(np.r_[starts, len(doc)])
    if counts.max() > 1:
        several = np.flatnonzero(np.repeat(counts > 1, counts))
        transfer = np.repeat(np.eye(labels)[None], len(several), axis=0)
        for t in range(steps):
            stepped = (transfer @ move) * likely[t, several][:, None, :]
            stepped /= stepped.max(axis=(1, 2), keepdims=True)
            transfer = np.where(there[t, several][:, None, None], stepped, transfer)
        matrix = np.zeros(len(doc), dtype=np.int64)
        matrix[several] = np.arange(len(several))
        for nth in range(1, counts.max()):
            run = starts[counts > nth] + nth
            carried = np.einsum("nl,nlm->nm", before[run - 1], transfer[matrix[run - 1]])
            before[run] = carried / carried.sum(axis=1, keepdims=True)
        ends = starts + counts - 1
        for nth in range(1, counts.max()):
            run = ends[counts > nth] - nth
            carried = np.einsum("nlm,nm->nl", transfer[matrix[run + 1]], after[run + 1])
            after[run] = carried / carried.sum(axis=1, keepdims=True)

    forward = np.empty_like(likely)
    vector = before
    for t in range(steps):
        stepped = (vector @ move) * likely[t]
        stepped /= stepped.sum(axis=1, keepdims=True)
        vector = np.where(there[t][:, None], stepped, vector)
        forward[t] = vector
    vector = after
    for t in range(steps - 1, -1, -1):
        if moves is not None:
            earlier = forward[t - 1] if t else before
            joint = earlier[:, :, None] * move * (likely[t] * vector)[:, None, :]
            moves += (joint / joint.sum(axis=(1, 2), keepdims=True))[there[t]].sum(axis=0)
        own = forward[t] * vector
        forward[t] = own / own.sum(axis=1, keepdims=True)
        stepped = (vector * likely[t]) @ move.T
        stepped /= stepped.sum(axis=1, keepdims=True)
        vector = np.where(there[t][:, None], stepped, vector)
    found = np.empty_like(emission)
    found[at[there]] = forward[there]
    return found


def transition_slope(transitions: np.ndarray, gold: np.ndarray, lengths: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Gradient of the log-likelihood of the gold labels for the transitions: observed less expected ones.

    A text starts from all labels alike, so its first label counts for each start by that start's share.
    """
    starts = np.cumsum(lengths) - lengths
    later = np.setdiff1d(np.arange(len(gold)), starts)
    observed = np.zeros_like(transitions)
    np.add.at(observed, (gold[later - 1], gold[later]), 1.0)
    share = np.exp(transitions - transitions.max())
    share /= share.sum(axis=0)
    return observed + share * np.bincount(gold[starts], minlength=len(transitions)) - expected


def fit(sample: list[tuple], rounds: int = 40) -> Model | None:
    """Maximise the likelihood of labelled excerpts; pairs of them are spliced to show switches.

    Each is (label, text) or (label, text, whether its start is cut, whether its end is cut).
    """
    find = word_finder()
    by_label: dict[str, list[list[str]]] = {}
    for label, text, *cut in sample:
        words = find(text.lower())
        start, end = cut or (False, False)
        words = words[int(start) : len(words) - int(end)]  # a word at a cut may be a part
        if words:
            by_label.setdefault(label, []).append(words)
    if not by_label:
        return None
    labels = sorted(by_label)
    number = {label: i for i, label in enumerate(labels)}
    counts = {label: {} for label in labels}
    for label, texts in by_label.items():
        for words in texts:
            for word in words:
                counts[label][word] = counts[label].get(word, 0) + 1
    listed: dict[str, int] = {}
    for label, own in counts.items():
        for word in sorted(own, key=lambda w: (-own[w], w))[:LEXICON_WORDS]:
            listed[word] = listed.get(word, 0) | 1 << number[label]
    sets = {mask: i + 1 for i, mask in enumerate(sorted(set(listed.values())))}
    lexicon = {word: sets[mask] for word, mask in listed.items()}

    texts = [(words, number[label]) for label in labels for words in by_label[label]]
    # a fixed shuffle; every third text is followed by another one in the same sequence
    order = np.random.default_rng(7).permutation(len(texts))
    sequences: list[list[tuple[str, int]]] = []
    for i, n in enumerate(order):
        words = [(word, texts[n][1]) for word in texts[n][0]]
        if i % 3 == 2 and sequences:
            sequences[-1] = sequences[-1] + words
        else:
            sequences.append(words)
    lengths = np.array([len(s) for s in sequences])
    vocabulary: dict[str, int] = {}
    token = np.array([vocabulary.setdefault(word, len(vocabulary)) for s in sequences for word, _ in s])
    gold = np.array([label for s in sequences for _, label in s])

    words = list(vocabulary)
    active = features(words)
    model = Model(labels, np.zeros((BUCKETS, len(labels))), lexicon, np.zeros((len(sets) + 1, len(labels))), np.eye(len(labels)))
    member = np.array([lexicon.get(word, 0) for word in words])
    wanted = np.eye(len(labels))[gold]
    grown = [np.full_like(w, 1e-2) for w in (model.weights, model.lexicon_weights, model.transitions)]
    scale = 1.0 / len(token)
    for _ in range(rounds):
        emission = model.emissions(words)[token]
        expected = np.zeros_like(model.transitions)
        found = marginals(emission, model.transitions, lengths, expected)
        gap = (wanted - found) * scale
        by_word = np.stack([np.bincount(token, gap[:, j], len(words)) for j in range(len(labels))], axis=1)
        spread = np.stack([
            np.bincount(active.ravel(), np.repeat(by_word[:, j], active.shape[1]), BUCKETS) for j in range(len(labels))
        ], axis=1)
        spread[0] = 0
        by_set = np.zeros_like(model.lexicon_weights)
        np.add.at(by_set, member, by_word)
        moved = transition_slope(model.transitions, gold, lengths, expected) * scale
        for weight, slope, past, decay in zip(
            (model.weights, model.lexicon_weights, model.transitions), (spread, by_set, moved), grown, (1e-7, 1e-7, 1e-5)
        ):
            slope = slope - decay * weight
            past += slope**2 * 1e4
            weight += 0.3 * slope * 1e2 / np.sqrt(past)
    return model


def learn(df: DataFrame, usable: Column, text_column: str = "text", label_column: str = "lang", id_column: str = "doc_id",
          rows_per_label: int = ROWS_PER_LABEL, excerpt_chars: int = EXCERPT_CHARS) -> Model | None:
    """Fit on a bounded sample of the rows with ``usable``, a label and a text."""
    drawn = F.xxhash64(id_column)
    room = F.greatest(F.length(text_column) - excerpt_chars, F.lit(1))
    start = F.pmod(drawn, room)
    thin = df.where(usable & F.col(text_column).isNotNull() & F.col(label_column).isNotNull()).select(
        F.col(label_column).alias("label"),
        F.substring(F.col(text_column), start.cast("int") + 1, F.lit(excerpt_chars)).alias("excerpt"),
        (start > 0).alias("start"),
        (start + excerpt_chars < F.length(text_column)).alias("end"),
        drawn.alias("drawn"),
    )
    # ranked in parts first, so that a hot label is not ranked in one task
    part = Window.partitionBy("label", F.pmod("drawn", F.lit(61))).orderBy("drawn", "excerpt")
    final = Window.partitionBy("label").orderBy("drawn", "excerpt")
    some = thin.withColumn("r", F.row_number().over(part)).where(F.col("r") <= rows_per_label)
    some = some.withColumn("r", F.row_number().over(final)).where(F.col("r") <= rows_per_label)
    return fit([tuple(r) for r in some.select("label", "excerpt", "start", "end").collect()])


class Labeller:
    """A model with the table of words that a task has met."""

    def __init__(self, model: Model) -> None:
        self.model, self.find = model, word_finder()
        self.table = ChunkTable(lambda words: list(self.model.emissions(words).astype(np.float32)))

    def words(self, texts: list[str | None]) -> list[list[str]]:
        return [self.find(text) if text else [] for text in texts]

    def label(self, cut: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all words one after the other, and the numbers of words."""
        lengths = np.array([len(words) for words in cut])
        own = lengths[lengths > 0]
        if not len(own):
            return np.zeros((0, len(self.model.labels))), lengths
        distinct = set().union(*cut)
        self.table.admit(distinct)
        place, rows = {}, np.empty((len(distinct), len(self.model.labels)), dtype=np.float64)
        for i, word in enumerate(distinct):
            place[word] = i
            rows[i] = self.table[word]
        token = np.fromiter((place[word] for words in cut for word in words), dtype=np.int64, count=int(lengths.sum()))
        return marginals(rows[token], self.model.transitions, own), lengths


def predict(
    df: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = (),
    letters_column: str | None = None,
) -> DataFrame:
    """Language and score of each document; ``keep`` names further columns to pass on.

    ``letters_column`` names a further column: whether the text has a letter, with a model or without.
    """

    def work(labeller, ids, texts):
        languages, scores, lettered = [UNKNOWN] * len(ids), [0.0] * len(ids), [False] * len(ids)
        result = [ids, languages, scores, *([lettered] if letters_column else [])]
        if labeller is None:
            find = word_finder()
            lettered[:] = [bool(letters_column and text and find(text)) for text in texts]
            return result
        start = 0
        while start < len(texts):  # runs of a bounded number of letters
            end, letters = start, 0
            while end < len(texts) and (end == start or letters < 2_000_000):
                letters += len(texts[end] or "")
                end += 1
            found, lengths = labeller.label(labeller.words([t.lower() if t else t for t in texts[start:end]]))
            some = np.flatnonzero(lengths)
            if len(some):
                share = np.add.reduceat(found, np.cumsum(lengths[some]) - lengths[some], axis=0) / lengths[some][:, None]
                for i, best in zip(some, share.argmax(axis=1)):
                    languages[start + i], lettered[start + i] = labeller.model.labels[best], True
                for i, score in zip(some, share.max(axis=1)):
                    scores[start + i] = min(1.0, float(score))
            start = end
        return result

    schema = f"{id_column} bigint, lang_pred string, score double" + (f", `{letters_column}` boolean" if letters_column else "")
    return per_row(df, [id_column, text_column], schema, work, lambda: Labeller(model) if model else None, keep)


def label_words(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Words of each document with their labels and probabilities."""

    def work(labeller, ids, texts):
        cut = labeller.words([t.lower() if t else t for t in texts])
        found, lengths = labeller.label(cut)
        ends = np.cumsum(lengths)
        parts = [found[end - n : end] for end, n in zip(ends, lengths)]
        names = [[labeller.model.labels[i] for i in part.argmax(axis=1)] for part in parts]
        return [ids, cut, names, [part.max(axis=1).tolist() if len(part) else [] for part in parts]]

    schema = f"{id_column} bigint, words array<string>, labels array<string>, probabilities array<double>"
    return per_row(df, [id_column, text_column], schema, work, lambda: Labeller(model))
