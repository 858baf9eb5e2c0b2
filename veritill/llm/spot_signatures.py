"""Document fingerprints from spot signatures.

A spot is a very common word (an anchor); its signature is the anchor with the chain of content
words that follow it, whatever anchors lie between.  A document's fingerprint is the set of its
signatures.  Fingerprints are compared by Jaccard similarity, which cannot exceed the ratio of the
set sizes: the join only lets sets meet that are near in length, and pairs whose sizes rule a
match out are dropped before their sets are looked at.

Everything is built-in functions: arrays, lambdas and hashes inside Spark.

Cases: null text is empty; a text without any signature (no anchor, or nothing behind it) has one that
stands for all its words, so that equal texts always have equal fingerprints; very long texts are
read whole; in the order of documents rows without id come first and repeated ids go by their
text; the last document is followed by the first, a single one by itself; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritill.llm.common import stored
from veritill.llm.ordering import in_order

#: Anchors: very common words of the languages at hand
ANCHORS = tuple(
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au dans de des du elle en est et la le les pas pour qui sur un une "
    "auf das dem den der die ein eine für ist mit nicht sich und von zu "
    "con del el es lo los no para por que se su y".split()
)
CHAIN = 2
_MARKS = "\n\t\r.,;:!?\"'()[]{}<>|/\\-_*#&%$+=~`"


def signatures(text: Column) -> "list[tuple[str, Column]]":
    """Columns to add one after the other; the last one, ``spots``, is the sorted set of signatures."""
    words = F.filter(
        F.split(F.translate(F.lower(F.coalesce(text, F.lit(""))), _MARKS, " " * len(_MARKS)), " "), lambda w: w != ""
    )
    content = F.filter(
        F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: ~F.get(F.col("words"), i).isin(*ANCHORS),
    )

    def gap_start(k: Column) -> Column:
        return F.when(k == 0, F.lit(0)).otherwise(F.get(F.col("content"), k - 1) + 1)

    heads = F.when(
        F.size("content") >= CHAIN,
        F.filter(
            F.sequence(F.lit(0), F.size("content") - CHAIN), lambda k: F.get(F.col("content"), k) > gap_start(k)
        ),
    ).otherwise(F.array().cast("array<int>"))

    def of_head(k: Column) -> Column:
        chain = [F.get(F.col("words"), F.get(F.col("content"), k + i)) for i in range(CHAIN)]
        anchors = F.slice(F.col("words"), gap_start(k) + 1, F.get(F.col("content"), k) - gap_start(k))
        return F.transform(anchors, lambda anchor: F.xxhash64(anchor, *chain))

    found = F.flatten(F.transform(F.col("heads"), of_head))
    spots = F.when(F.size("found") > 0, F.array_sort(F.array_distinct("found"))).otherwise(
        F.array(F.xxhash64(F.array_join("words", " ")))
    )
    return [("words", words), ("content", content), ("heads", heads), ("found", found), ("spots", spots)]


def with_signatures(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add the set of signatures of a text as column ``name``."""
    kept = df.columns
    for column, value in signatures(text):
        df = df.withColumn(column, value)
    return df.select(*kept, F.col("spots").alias(name))


def digest(spots: Column) -> Column:
    """A short string that is equal for equal sets: their size and a strong hash."""
    members = F.array_join(spots.cast("array<string>"), ",")
    return F.concat(F.size(spots).cast("string"), F.lit(":"), F.sha2(members, 256))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without a look at them where their sizes keep it below ``least``."""
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    if least <= 0:
        return exact.cast("double")
    bound = F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b))
    return F.when(bound < least, F.lit(0.0)).otherwise(exact).cast("double")


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spots, fingerprint) of each document."""
    thin = df.select(F.col(id_column), F.col(text_column).alias("body"))
    found = with_signatures(thin, F.col("body"), "spots")
    return found.select(id_column, "spots", digest(F.col("spots")).alias("fingerprint"))


def similar_sets(prints: DataFrame, least: float = 0.8, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(membership, pairs): the class (smallest id) of each document, and all pairs of classes with
    a likeness of ``least`` or more.

    Two such sets share a signature among the rarest few of each, and their sizes differ by less than
    one step of a geometric scale, so they meet under (signature, step).
    """
    members = prints.groupBy("fingerprint").agg(F.min(id_column).alias("class_id"), F.first("spots").alias("spots"))
    classes = stored(members.select("class_id", "fingerprint", "spots"), "spot-classes")
    each = classes.select("class_id", F.size("spots").alias("n"), F.explode("spots").alias("spot"))
    often = each.groupBy("spot").agg(F.count("*").alias("often"))
    ranked = each.join(often, "spot").groupBy("class_id", "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("often", "spot"))), lambda s: s["spot"]).alias("rare")
    )
    rarest = F.slice(F.col("rare"), F.lit(1), F.col("n") - F.ceil(F.col("n") * least).cast("int") + 1)
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / least)) + 1e-9).cast("int")
    keys = ranked.select("class_id", "n", step.alias("step"), F.explode(rarest).alias("spot"))
    left = keys.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), "spot", F.explode(F.array("step", F.col("step") + 1)).alias("step"))
    right = keys.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), "spot", "step")
    meet = left.join(right, ["spot", "step"]).where((F.col("a") != F.col("b")) & (F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b")))
    pairs = meet.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = classes.select(F.col("class_id"), F.col("spots"))
    compared = (
        pairs.join(of.toDF("a", "of_a"), "a").join(of.toDF("b", "of_b"), "b")
        .select("a", "b", likeness(F.col("of_a"), F.col("of_b"), least).alias("likeness"))
        .where(F.col("likeness") >= least)
    )
    membership = prints.select(id_column, "fingerprint").join(classes.select("fingerprint", "class_id"), "fingerprint")
    return membership.select(id_column, "class_id"), compared


def edited_and_next(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, whose second half comes from the next
    document, and how alike they and the next document's are."""
    body = F.coalesce(F.col(text_column), F.lit(""))
    thin = df.select(F.col(id_column).alias("doc"), body.alias("body")).withColumn("tie", F.xxhash64("body"))
    dealt, window = in_order(thin, "doc", "tie")
    own = with_signatures(dealt, F.col("body"), "own")
    following = own.withColumn("next_body", F.lead("body").over(window)).withColumn("next_spots", F.lead("own").over(window))
    half = F.floor(F.length("body") / 2).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), F.length("body") - half), F.substring("next_body", F.lit(1), half))
    kept = following.where(~F.col("sentinel")).select(
        "doc", F.length("body").cast("bigint").alias("n_chars"), edited.alias("edited"), "own",
        likeness(F.col("own"), F.col("next_spots")).alias("near_next"),
    )
    both = with_signatures(kept, F.col("edited"), "changed")
    return both.select(
        F.col("doc").alias(id_column), "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        digest(F.col("own")).alias("fingerprint"), digest(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), "near_next",
    )
