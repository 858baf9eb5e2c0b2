"""From raw documents to packed training sequences, one corpus operator per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritill.llm import language_crf, line_templates, minhash, packing, suffix_dedup
from veritill.llm.common import packed_text, stored, table, unpacked_text
from veritill.llm.queries import byte_model


#: Strings of so many bytes or so many words that occur elsewhere too are cut out.  The words are the rule;
#: the bytes add long words and scripts without spaces.
REPEAT_BYTES, REPEAT_WORDS = 240, 51


def _shaped(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` in their order and types, with ``n_chars`` of the text as it is now."""
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*[F.col(f"`{c}`").cast(docs.schema[c].dataType) for c in docs.columns])


def _others(docs: DataFrame, *named: str) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c not in {"doc_id", "text", "n_chars", *named})


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter, whatever its language.  A missing ``lang`` is filled in where there is a model."""
    model = language_crf.learn(docs, F.col("doc_id").isNotNull())
    found = language_crf.predict(docs, model, keep=("text", "lang", *_others(docs, "lang")), letters_column="has letters")
    known = F.when(F.col("lang_pred") != language_crf.UNKNOWN, F.col("lang_pred"))
    return _shaped(found.where("`has letters`").withColumn("lang", F.coalesce("lang", known)), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without recurring lines; documents that had nothing else go."""
    found = line_templates.without_templates(docs, keep=_others(docs))
    kept = found.where((F.col("n_dropped") == 0) | (F.trim("kept") != "")).withColumnRenamed("kept", "text")
    return _shaped(kept, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; rows that repeat it go."""
    found = minhash.near_duplicates(docs, words_each=5, percent=80)
    heads = stored(found.where("kept").select(F.col("doc_id").alias("head")).distinct(), "kept")
    others = tuple(c for c in docs.columns if c != "text")
    packed = packed_text(docs.withColumn("text tag", F.xxhash64("text")), "text", (*others, "text tag"))
    some = packed.join(heads, F.col("doc_id").eqNullSafe(F.col("head")), "left_semi")
    once = some.dropDuplicates(["doc_id", "text tag"])
    return unpacked_text(once, "text", others).select(*docs.columns)


def suffixes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without long strings that occur elsewhere too; documents that had nothing else go."""
    found = suffix_dedup.without_repeats(docs, length=REPEAT_BYTES, words=REPEAT_WORDS, keep=_others(docs))
    kept = found.where((F.size("span_starts") == 0) | (F.trim("kept") != "")).withColumnRenamed("kept", "text")
    return _shaped(kept, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the training sequences."""
    return packing.pack_documents(docs, *byte_model())


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("suffixes", suffixes),
    ("packing", packed),
]

#: A trained model and a tokenizer are beyond SQL; ``tests/llm`` compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
