"""Line deduplication with a log-template tree.

Fields with digits are variable: they are masked.  A masked line that recurs is a template as it is.  Where
too few of its tokens are left unmasked (tables, sums), the line itself has to recur.
All longer lines go down a tree of fixed depth: first by their number of tokens, then by their
leading tokens.  In a leaf, a token stays where enough of the leaf's lines have it at that place;
all others become variable fields.  Lines that come out equal share a template.

A leaf can hold more templates than tokens with that share, and a hot line can outvote the others.  So the
distinct lines of a leaf that do not recur as they are, each counted once, are also judged in groups.
A line belongs to its group's template where enough of its tokens are those that most of the group
has at their places.  What is left of a group is split by the place that leaves lines together
best, and its parts are judged again, until they have too few lines or documents for a template.

A template recurs if at least ``min_docs`` documents have it and enough of its tokens are fixed.  Its lines are dropped from every document but the first one (smallest id) that has it, so
that copies of a text do not wipe each other out.

Everything is built-in functions.  A split fixes one more place of its group, so lines of n tokens take at
most n rounds, and a round reads only the groups that are left.  Counts are pre-aggregated; only lines of leaves that can
hold a template leave the scan with their text, found by a filter of fixed size and then exactly.

Tokens stand between white space of any kind.  Lines with fewer than ``MIN_TOKENS`` tokens recur as they are too;
brief ones among them recur by chance and need ``BRIEF_SHARE`` of all documents.

Cases: null text is empty and has one empty line; blank lines are kept; very long lines and texts are read whole; repeated rows of an id are one document; rows without
id are no further document, but their lines are dropped too; other columns are ignored.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritill.llm.common import discard, stored

MIN_TOKENS, TREE_TOKENS, LEADING = 3, 5, 3
MIN_DOCS = 5
#: Share of a leaf's lines that fix a token, and of a template's tokens that must be fixed
TOKEN_SHARE, FIXED_SHARE = 0.2, 0.7
#: Entries of the first, inexact filter; a bound, whatever the data
FILTER_SIZE = 1 << 18
#: Lines with fewer than MIN_TOKENS tokens and this many bytes recur by chance: they go from this share of all documents on
BRIEF_BYTES, BRIEF_SHARE = 24, 0.05
#: White space within a line, besides the blank.  What lies beyond Latin-1 is looked at only for characters of one range: a
#: union is tried member by member for every character of every text.
OTHER_SPACE = (
    "[\\t\\x0B\\f\\r\\x{85}\\x{A0}[\\x{1680}-\\x{3000}&&"
    "[\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]]]"
)


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, tag, i, whole, firm, spaced, n) of every line that is not blank; ``whole`` is what recurs of it as it is.

    ``spaced`` has the n masked tokens with one blank between them: tokens are counted in it and the leading ones cut off
    it, so only lines of leaves that can hold a template are split into arrays.
    """
    body = F.when(F.col("body").rlike(OTHER_SPACE), F.regexp_replace("body", OTHER_SPACE, " ")).otherwise(F.col("body"))
    digits = F.col("line").rlike("[0-9]")
    masked = F.when(digits, F.regexp_replace("line", "[^ ]*[0-9][^ ]*", "<*>")).otherwise(F.col("line"))
    single = F.when(F.col("masked").contains("  "), F.regexp_replace("masked", " {2,}", " ")).otherwise(F.col("masked"))
    blanks = F.octet_length("spaced") - F.octet_length(F.replace(F.col("spaced"), F.lit(" "), F.lit("")))
    fixed = F.size(F.array_remove(F.split("spaced", " "), "<*>"))
    return (
        docs.select("doc", "tag", F.posexplode(_split(body)).alias("i", "line"))
        # a line without a token has blanks only; asked of the line itself, the filter works nothing out twice
        .where(F.trim("line") != "")
        .select("doc", "tag", "i", "line", digits.alias("digits"), masked.alias("masked"))
        .withColumn("spaced", F.trim(single))
        .withColumn("n", blanks + 1)
        .withColumn("firm", ~F.col("digits") | (fixed >= FIXED_SHARE * F.col("n")))
        .withColumn("whole", F.when(F.col("firm"), F.col("masked")).otherwise(F.col("line")))
    )


def _leaf(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "n", F.substring_index("spaced", " ", LEADING))


def _recurring(lines: DataFrame, keys: list[str], min_docs: int) -> DataFrame:
    """Keys that at least ``min_docs`` documents have, with the first of these."""
    per_doc = lines.select(*keys, "doc").distinct()
    found = per_doc.groupBy(*keys).agg(F.count("doc").alias("docs"), F.min("doc").alias("first")).where(F.col("docs") >= min_docs)
    # stored, so that a join with it is one that Spark can split where a key is hot
    return stored(found.drop("docs"), "recurring")


def _recurring_whole(hashed: DataFrame, everyone: int, min_docs: int) -> DataFrame:
    """Lines that recur as they are; brief ones need a share of all documents."""
    brief = _recurring(hashed.where("brief"), ["h1", "h2"], max(min_docs, math.ceil(BRIEF_SHARE * everyone)))
    return stored(_recurring(hashed.where("not brief"), ["h1", "h2"], min_docs).unionAll(brief), "recurring-whole")


def _dropped(lines: DataFrame, recurring: DataFrame, keys: list[str]) -> DataFrame:
    return lines.join(recurring, keys).where(~F.col("doc").eqNullSafe(F.col("first"))).select("doc", "tag", "i")


def _kinds(lines: DataFrame, group: list[str], min_docs: int) -> DataFrame:
    """Groups with at least two distinct lines and, over these, enough documents."""
    per_kind = lines.groupBy(*group, "h1", "h2").agg(F.count("doc").alias("docs"))
    return per_kind.groupBy(*group).agg(F.count("*").alias("kinds"), F.sum("docs").alias("docs")).where(
        (F.col("kinds") > 1) & (F.col("docs") >= min_docs)
    ).select(*group)


def _judged(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines with whether they are ``near`` their group's template, and the place to ``split`` the group by."""
    group = ["g1", "g2"]
    kinds = lines.select(*group, "h1", "h2", "tokens").dropDuplicates([*group, "h1", "h2"])
    counted = kinds.select(*group, F.posexplode("tokens").alias("p", "token")).groupBy(*group, "p", "token").agg(F.count("*").alias("c"))
    per_place = counted.groupBy(*group, "p").agg(
        F.sum("c").alias("all"), F.max(F.struct("c", "token")).alias("top"), F.sum(F.col("c").cast("double") * F.col("c")).alias("together")
    )
    most = F.when((2 * F.col("top.c") > F.col("all")) & (F.col("top.token") != "<*>"), F.col("top.token"))
    varies = F.when(F.col("top.c") < F.col("all"), F.struct("together", -F.col("p")))
    per_group = stored(
        per_place.groupBy(*group).agg(
            F.array_sort(F.collect_list(F.struct("p", most.alias("token")))).alias("by_place"), F.max_by("p", varies).alias("split")
        ),
        "line-groups",
    )
    same = F.zip_with("tokens", F.col("by_place.token"), lambda t, most: F.coalesce(t == most, F.lit(False)))
    near = F.size(F.filter(same, lambda x: x)) >= FIXED_SHARE * F.size("tokens")
    judged = lines.join(per_group, group).select("doc", "tag", "i", *group, "h1", "h2", "tokens", near.alias("near"), "split")
    return stored(judged, "judged-lines"), per_group


def _by_groups(lines: DataFrame, min_docs: int) -> list[DataFrame]:
    """Lines to drop, one frame a round; ``lines`` has doc, tag, i, tokens, the hashes of the line and of its leaf."""
    found, group = [], ["g1", "g2"]
    lines = lines.select("doc", "tag", "i", "tokens", "h1", "h2", F.col("leaf1").alias("g1"), F.col("leaf2").alias("g2"))
    while True:
        active = stored(_kinds(lines, group, min_docs), "active-groups")
        held = stored(lines.join(active, group, "left_semi"), "group-lines")
        if held.isEmpty():
            discard(active, held)
            return found
        judged, per_group = _judged(held)
        recurring = _recurring(judged.where("near"), group, min_docs)
        found.append(stored(_dropped(judged.where("near"), recurring, group), "grouped-lines"))
        settled = recurring.select(*group, F.lit(True).alias("near"))
        parts = judged.join(settled, [*group, "near"], "left_anti").where(F.col("split").isNotNull())
        token = F.get(F.col("tokens"), F.col("split"))
        lines = stored(
            parts.select(
                "doc", "tag", "i", "tokens", "h1", "h2",
                F.xxhash64("g1", "split", token).alias("g1"), F.xxhash64(F.lit(1), "g2", "split", token).alias("g2"),
            ),
            "split-lines",
        )
        discard(active, held, judged, per_group)


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(of_doc, of_tag, gone) of the lines to drop; ``docs`` has doc, tag (a hash of the text) and body."""
    lines, leaf = _lines(docs), ["leaf1", "leaf2"]
    in_tree = F.col("n") >= TREE_TOKENS
    brief = (F.col("n") < MIN_TOKENS) & (F.octet_length("whole") < BRIEF_BYTES)
    # texts are read and masked once; what is counted is kept as hashes, beside it the tokens of lines that may go down the tree
    hashed = stored(
        lines.select(
            "doc", "tag", "i", "firm", brief.alias("brief"), F.xxhash64("whole").alias("h1"), F.xxhash64(F.lit(1), "whole").alias("h2"),
            F.when(in_tree, _leaf(1)).alias("leaf1"), F.when(in_tree, _leaf(2)).alias("leaf2"), F.when(in_tree, F.col("spaced")).alias("spaced"),
        ),
        "line-hashes",
    )
    whole = ["h1", "h2"]
    everyone = docs.select("doc").distinct().count()
    exact = _recurring_whole(hashed, everyone, min_docs)
    as_they_are = _dropped(hashed, exact, whole)

    leaves = stored(
        hashed.where(F.col("leaf1").isNotNull()).groupBy(*leaf).agg(F.count("*").alias("lines"))
        .where(F.col("lines") >= min_docs),
        "leaves",
    )
    slot = F.pmod(F.col("leaf1"), F.lit(FILTER_SIZE))
    slots = leaves.select(slot.alias("slot")).distinct()
    # at most FILTER_SIZE numbers, whatever the corpus
    near = hashed.where(F.col("leaf1").isNotNull()).join(F.broadcast(slots), slot == F.col("slot"), "left_semi")
    held = stored(
        near.select("doc", "tag", "i", "firm", *whole, "spaced", *leaf).join(leaves, leaf)
        .withColumn("tokens", F.split("spaced", " ")).withColumn("n", F.size("tokens")).drop("spaced"),
        "leaf-lines",
    )

    places = held.select(*leaf, "lines", F.posexplode("tokens").alias("p", "token"))
    counted = places.groupBy(*leaf, "lines", "p", "token").agg(F.count("*").alias("c"))
    fixed = (F.col("c") >= min_docs) & (F.col("c") >= TOKEN_SHARE * F.col("lines"))
    # at most 1 / TOKEN_SHARE tokens are fixed at a place
    per_place = counted.groupBy(*leaf, "p").agg(F.collect_list(F.when(fixed, F.col("token"))).alias("fixed"))
    per_leaf = per_place.groupBy(*leaf).agg(F.array_sort(F.collect_list(F.struct("p", "fixed"))).alias("by_place"))
    template = F.transform(
        "tokens",
        lambda t, p: F.when(F.array_contains(F.get(F.col("by_place"), p)["fixed"], t), t).otherwise(F.lit("<*>")),
    )
    # stored: it is read for what recurs and once more for the lines to drop
    generalised = stored(
        held.join(per_leaf, leaf)
        .select("doc", "tag", "i", "n", template.alias("template"), *leaf)
        .where(F.size(F.filter("template", lambda t: t != "<*>")) >= FIXED_SHARE * F.col("n"))
        .select(
            "doc", "tag", "i",
            F.xxhash64("leaf1", F.array_join("template", " ")).alias("h1"),
            F.xxhash64(F.lit(1), "leaf2", F.array_join("template", " ")).alias("h2"),
        ),
        "generalised-lines",
    )
    by_tree = _dropped(generalised, _recurring(generalised, ["h1", "h2"], min_docs), ["h1", "h2"])
    # lines that recur as they are need no template, and are no evidence for one of others
    others = hashed.where(F.col("leaf1").isNotNull() & F.col("firm")).join(exact, whole, "left_anti")
    several = stored(_kinds(others, leaf, min_docs), "contested-leaves")
    contested = held.where("firm").join(several, leaf, "left_semi")
    by_groups = _by_groups(contested.join(exact, whole, "left_anti"), min_docs)
    dropped = functools.reduce(DataFrame.unionAll, by_groups, as_they_are.unionAll(by_tree))
    gone = stored(
        dropped.groupBy(F.col("doc").alias("of_doc"), F.col("tag").alias("of_tag")).agg(
            F.collect_set("i").alias("gone")
        ),
        "recurring-lines",
    )
    discard(hashed, leaves, held, generalised, several, *by_groups)
    return gone


def without_templates(
    df: DataFrame, min_docs: int = MIN_DOCS, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Per document: its lines, how many of them are dropped, and the text that is left; ``keep`` names further columns."""
    body = F.coalesce(F.col(text_column), F.lit(""))
    docs = df.select(F.col(id_column).alias("doc"), F.xxhash64(body).alias("tag"), body.alias("body"), *[F.col(c).alias(f"kept_{c}") for c in keep])
    per_doc = recurring_lines(docs.select("doc", "tag", "body"), min_docs)
    joined = docs.join(per_doc, F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("tag") == F.col("of_tag")), "left")
    left = F.array_join(F.filter(_split(F.col("body")), lambda line, i: ~F.array_contains("gone", i)), "\n")
    return joined.select(
        F.col("doc").alias(id_column),
        F.size(_split(F.col("body"))).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("body")).otherwise(left).alias("kept"),
        *[F.col(f"kept_{c}").alias(c) for c in keep],
    )
