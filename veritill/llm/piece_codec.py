"""Encoding and decoding with a subword model, each distinct chunk once.

Text is cut where no piece of the model can reach across: before each run of whitespace markers.
That holds when no piece has a marker behind another character, which is checked on the whole
vocabulary when the model is loaded.  Segmentation then works chunk by chunk.  Each task keeps a
table of the distinct chunks it has met, encodes only chunks that are new to it and joins the ids
back by position.  Rare chunks leave a full table and are encoded again when they return, so memory
is bounded and results do not depend on the table.

Cases: null and empty text give no tokens, the hash of nothing, and decode to the empty text; very
long texts and chunks are encoded whole; repeated rows each give a row; a null id stays null;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from veritill.llm.common import ChunkTable, per_row

MARK = "▁"
_CHUNK = re.compile(r" +[^ ]+| +\Z")
_EMPTY = hashlib.sha256(b"").hexdigest()


def chunks_of(text: str) -> list[str]:
    """Marked words of a text, each without its first marker; markers shown as spaces."""
    text = text.replace(MARK, " ") if MARK in text else text
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [found[1:] for found in _CHUNK.findall(" " + text)]
    return text.split(" ")


class PieceCodec:
    """A loaded model and the chunk table of one task."""

    def __init__(self, model_path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        crossing = re.compile(f"[^{MARK}]{MARK}")
        for piece in range(self.model.get_piece_size()):
            if crossing.search(self.model.id_to_piece(piece)):
                raise ValueError("a piece of this model crosses a whitespace marker")
        if self.model.decode(self.model.encode(" a  b ")) != " a  b ":
            raise ValueError("this model changes whitespace")
        if not self.model.encode("a", out_type=str)[0].startswith(MARK):
            raise ValueError("this model does not mark the first word")
        self.mark_id = self.model.piece_to_id(MARK)
        self.table = ChunkTable(self._encode)

    def _encode(self, chunks: list[str]) -> list[tuple[str, int, str]]:
        ids = self.model.encode(chunks, num_threads=1)
        # a lone marker: the model adds none to an empty text
        ids = [found if chunk else [self.mark_id] for chunk, found in zip(chunks, ids)]
        texts = self.model.decode(ids, num_threads=1)
        return [(",".join(map(str, found)), len(found), text) for found, text in zip(ids, texts)]

    def encode(self, texts: list[str]) -> list[tuple[str, int, str]]:
        """Per text: ids in decimal joined by commas, their number, the decoded text."""
        cut = [chunks_of(text) for text in texts]
        self.table.admit(set().union(*cut) if cut else set())
        table, found = self.table, []
        for words in cut:
            if not words:
                found.append(("", 0, ""))
                continue
            ids, counts, decoded = zip(*[table[word] for word in words])
            found.append((",".join(ids), sum(counts), " ".join(decoded)))
        return found


def encode_documents(df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids as an array and the decoded text of each row."""

    def work(codec, ids, texts):
        found = codec.encode([text or "" for text in texts])
        return [ids, [[int(x) for x in f[0].split(",")] if f[0] else [] for f in found], [f[2] for f in found]]

    schema = f"{id_column} bigint, ids array<int>, decoded string"
    return per_row(df, [id_column, text_column], schema, work, lambda: PieceCodec(model_path))


def encode_digests(df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Number and SHA-256 of the ids, and SHA-256 of the decoded text of each row."""

    def work(codec, ids, texts):
        found = codec.encode([text or "" for text in texts])
        hashes = [hashlib.sha256(f[0].encode()).hexdigest() if f[1] else _EMPTY for f in found]
        decoded = [hashlib.sha256(f[2].encode()).hexdigest() for f in found]
        return [ids, [f[1] for f in found], hashes, decoded]

    schema = f"{id_column} bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return per_row(df, [id_column, text_column], schema, work, lambda: PieceCodec(model_path))
