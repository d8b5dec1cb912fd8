"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of a fixed size. Equal blocks get the
same integer name: distinct blocks are sorted, and a block's name is its place.
Then adjacent names are paired, and distinct pairs are named the same way,
until each document has one name. Two documents of the same number of blocks
have the same last name exactly if their texts are equal, so nothing rests on
a hash. Digests only carry names from the sorted blocks back to the documents;
two different blocks with one digest are noticed and get other digests.

Edge cases: NULL text counts as empty, all texts without a character other
than white space are one group, rows with the same id are separate rows, and
of rows that tie in length and id exactly one stays. NULL ids rank last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import no_join_names, plain_names, stored, whole_text, with_names
from granary.session import scratch_path, scratch_scope

BLOCK_CHARS = 8192
WHITE_SPACE = r"[\x20\x09-\x0D]+"
ROW, DOC, CHARS, SHA, SIZE, MARKS = "_row", "_doc", "_chars", "_sha", "_blocks", "_marks"
NUMBER = "_number"  # of a row whose other columns stay behind


def normalised(text: str) -> Column:
    return F.regexp_replace(whole_text(text), WHITE_SPACE, "")


def blocks_of(norm: Column, chars: int) -> Column:
    return F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0))


def mark(block: Column, salt: int) -> Column:
    """128 bits that carry a block's name to its documents."""
    return F.struct(F.xxhash64(F.lit(salt), block).alias("a"), F.xxhash64(F.lit(-1 - salt), block).alias("b"))


def name_sorted(distinct: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Integer names by sort order: partition number, then place in the sorted partition."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def name_blocks(docs: DataFrame, text: str, chars: int, salt: int) -> DataFrame:
    """Names of the distinct blocks by their mark. Copies are combined before the shuffle."""
    blocks = docs.select(F.explode(blocks_of(normalised(text), chars)).alias("block"))
    named = name_sorted(blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n")), ["block"])
    return stored(named.select(mark(F.col("block"), salt).alias("mark"), "name"), "block-names")


def numbered_rows(docs: DataFrame, doc_id: str, text: str, chars: int, salt: int, carry: Sequence[str]) -> DataFrame:
    """One stored row per input row with its number, length, digest and block marks."""
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias(ROW),
            F.col(f"`{doc_id}`").alias(DOC),
            F.length(whole_text(text)).alias(CHARS),
            normalised(text).alias("_norm"),
            *[F.col(f"`{c}`") for c in carry],
        )
        .withColumn("_cut", blocks_of(F.col("_norm"), chars))
        .select(
            ROW,
            DOC,
            CHARS,
            F.sha2("_norm", 256).alias(SHA),
            F.size("_cut").alias(SIZE),
            F.transform("_cut", lambda b: mark(b, salt)).alias(MARKS),
            *[F.col(f"`{c}`") for c in carry],
        ),
        "rows",
    )


def fold_names(names: DataFrame, most: int) -> DataFrame:
    """One name per row: name adjacent pairs again and again, stored after each level.

    ``names`` has a row's number, its number of blocks, a position and a name.
    """
    finished, level = names.filter(F.col(SIZE) == 1).select(ROW, SIZE, "name"), 0
    names = names.filter(F.col(SIZE) > 1)
    while most > 1 << level:
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = names.groupBy(ROW, SIZE, F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"),
        )
        pairs = stored(pairs, f"pairs-{level}")
        distinct = pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("n"))
        named = stored(name_sorted(distinct, ["left", "right"]).drop("n"), f"names-{level}")
        names = stored(pairs.join(named, ["left", "right"]).select(ROW, SIZE, "pos", "name"), f"level-{level}")
        done = F.col(SIZE) <= 1 << level
        finished = finished.unionByName(names.filter(done).select(ROW, SIZE, "name"))
        names = names.filter(~done)
    return finished


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per input row: the group's survivor and size, and whether this row stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` and the columns
    in ``carry``. Of equal texts the one with the most code points before
    normalisation stays, then the smallest id.
    """
    no_join_names(docs.select(*[f"`{c}`" for c in carry]), ROW, DOC, CHARS, SHA, SIZE, MARKS, "_norm", "_cut")
    salt = 0
    while True:
        rows = numbered_rows(docs, doc_id, text, block_chars, salt, carry)
        named = name_blocks(docs, text, block_chars, salt)
        if named.groupBy("mark").count().filter("count > 1").isEmpty():
            break
        salt += 1  # two different blocks share a mark: mark all of them anew
    most = rows.agg(F.max(SIZE)).first()[0] or 0
    units = rows.select(ROW, SIZE, F.posexplode(MARKS).alias("pos", "mark"))
    names = stored(units.join(named, "mark").select(ROW, SIZE, "pos", "name"), "level-0")
    identity = fold_names(names, most)
    # Texts without blocks have no name; they are the group of size 0.
    known = rows.drop(MARKS).join(identity.drop(SIZE), ROW, "left").withColumn("name", F.coalesce("name", F.lit(-1)))
    known = stored(known, "identities")
    order = F.struct(-F.col(CHARS), F.col(DOC).isNull(), F.col(DOC), F.col(ROW))
    groups = known.groupBy(SIZE, "name").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    groups = groups.select(
        SIZE, "name", F.col(f"first.{DOC}").alias("keep_id"), F.col(f"first.{ROW}").alias("keep_row"), "group_size"
    )
    # Stored, so that the join deals both sides anew and can split a group that many rows share.
    return known.join(stored(groups, "groups"), [SIZE, "name"]).select(
        F.col(DOC).alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col(ROW) == F.col("keep_row")).alias("kept"),
        F.col(SHA).alias("text_sha256"),
        *[F.col(f"`{c}`") for c in carry],
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Groups are formed without the other columns; the stored rows only lose the
    numbers of those that go. What is stored on the way is removed.
    """
    spark = docs.sparkSession
    plain, names = plain_names(docs)
    rows = stored(plain.withColumn(NUMBER, F.monotonically_increasing_id()), "numbered")
    gone = scratch_path(spark, "copies")
    with scratch_scope(spark):
        groups = exact_groups(rows, names[doc_id], names[text], carry=[NUMBER])
        groups.filter(~F.col("kept")).select(NUMBER).write.parquet(gone)
    copies = spark.read.schema(f"{NUMBER} bigint").parquet(gone)
    return with_names(rows.join(copies, NUMBER, "left_anti"), names)
