"""Full-sync merge: make a table equal to its source, matched by key.

Matched rows are updated, new rows inserted, and rows that the source no
longer has are deleted. The result is therefore the source itself, plus the
surrogate keys of matched rows; only those need a join with the old table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granary.operators.conform import cast_to, typed_null
from granary.operators.identity import complete_key
from granary.session import stored


def to_sink(source: DataFrame, sink: StructType, generated: Sequence[str] = ()) -> DataFrame:
    """Source columns that the sink has, cast to its types, without generated ones.

    Extra source columns are left out; a sink column the source lacks raises.
    """
    wanted = StructType([f for f in sink if f.name not in generated])
    return cast_to(source, wanted)


def to_sink_in_part(source: DataFrame, sink: StructType) -> DataFrame:
    """All columns of a source that lacks some of the sink's; those of the sink are cast to its types."""
    types = {f.name: f.dataType for f in sink}
    return source.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else f"`{c}`" for c in source.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Keys that occur more than once.

    A key with a NULL part matches nothing and may repeat, unless keys match null-safely.
    """
    compared = df if null_safe else df.filter(complete_key(keys))
    copies = compared.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).filter(F.col("_copies") > 1)
    return copies.select(*keys, F.col("_copies").alias("n"))


def sync_counts(
    source: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows that a sync inserts, updates and deletes, from the key columns alone.

    Both sides are counted per key in one aggregate instead of an outer join:
    the counts are combined before the shuffle, so a key (or a NULL) that many
    rows share does not end up in one task.
    """
    s = source.select(*keys, F.lit(1).alias("s"), F.lit(0).alias("t"))
    t = target.select(*keys, F.lit(0).alias("s"), F.lit(1).alias("t"))
    per_key = s.unionByName(t).groupBy(*keys).agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    comparable = F.lit(True) if null_safe else complete_key(keys)
    matched = comparable & (F.col("s") > 0) & (F.col("t") > 0)
    total = {
        "inserted": F.when(~matched, F.col("s")).otherwise(0),
        "updated": F.when(matched, F.col("s") * F.col("t")).otherwise(0),
        "deleted": F.when(~matched, F.col("t")).otherwise(0),
    }
    return per_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in total.items()])


DIGEST = ("_digest_a", "_digest_b")
CHANGE = "_change"
INSERTED, CHANGED, UNCHANGED, DELETED = "inserted", "changed", "unchanged", "deleted"


def row_digests(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key columns of each row and 128 bits of all its columns, NULLs told apart from values."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])
    a, b = (F.xxhash64(F.lit(seed), nulls, *columns) for seed in (1, 2))
    return df.select(*[F.col(f"`{k}`") for k in keys], a.alias(DIGEST[0]), b.alias(DIGEST[1]))


def key_changes(new: DataFrame, old: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """What became of each key between two tables given as :func:`row_digests`: ``keys, _change, rows``.

    One aggregate over both sides: counts and digests are combined before the
    shuffle, so a NULL or a key that many rows share does not meet in one task.
    A repeated key is unchanged if the digests of its rows are the same on both
    sides. A key with a NULL part matches nothing unless ``null_safe``, so it
    gives a row for the inserted and one for the deleted.
    """
    both = new.withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)))
    sums: list[Column] = []
    for side, flag in (("n", 1), ("o", 0)):
        here = F.col("_new") == flag
        sums.append(F.count_if(here).alias(f"_{side}"))
        sums += [F.coalesce(F.bit_xor(F.when(here, F.col(d))), F.lit(0)).alias(f"_{side}{d}") for d in DIGEST]
    per_key = both.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*sums)
    comparable = F.lit(True) if null_safe else complete_key(keys)
    equal = (F.col("_n") == F.col("_o")) & (F.col(f"_n{DIGEST[0]}") == F.col(f"_o{DIGEST[0]}"))
    equal = equal & (F.col(f"_n{DIGEST[1]}") == F.col(f"_o{DIGEST[1]}"))
    met = comparable & (F.col("_n") > 0) & (F.col("_o") > 0)
    entry = lambda change, n: F.struct(F.lit(change).alias(CHANGE), F.col(n).alias("rows"))
    entries = F.array(
        F.when(met, F.when(equal, entry(UNCHANGED, "_n")).otherwise(entry(CHANGED, "_n"))),
        F.when(~met & (F.col("_n") > 0), entry(INSERTED, "_n")),
        F.when(~met & (F.col("_o") > 0), entry(DELETED, "_o")),
    )
    found = per_key.withColumn("_entry", F.explode(F.filter(entries, lambda e: e.isNotNull())))
    return found.select(*[F.col(f"`{k}`") for k in keys], "_entry.*")


def change_feed(
    new: DataFrame,
    old: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    new_digests: DataFrame | None = None,
    old_digests: DataFrame | None = None,
) -> DataFrame:
    """The rows that make ``old`` into ``new``: inserted and changed ones whole, deleted ones by their key.

    Rows have the columns of ``new`` and ``_change``; a deleted row has NULL
    outside its key. Unchanged rows are compared by their digests, kept ones
    where they are given, and are left out. Only rows of keys that did change
    are fetched, by a join that keeps the order of neither side.
    """
    was, now = old_digests or row_digests(old, keys), new_digests or row_digests(new, keys)
    changes = stored(key_changes(now, was, keys, null_safe).filter(F.col(CHANGE) != UNCHANGED), "changes")
    rest = [c for c in new.columns if c not in keys]
    changed = changes.filter(F.col(CHANGE) != DELETED).drop("rows").distinct()
    pairs = [F.col(f"n.`{k}`").eqNullSafe(F.col(f"c.`{k}`")) for k in keys]
    same = reduce(lambda a, b: a & b, pairs)
    fetched = new.alias("n").join(changed.alias("c"), same).select("n.*", f"c.{CHANGE}")
    times = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))  # each of several rows of a key
    gone = changes.filter(F.col(CHANGE) == DELETED).withColumn("_time", times)
    nothing = {f.name: typed_null(f.dataType) for f in new.schema if f.name in rest}
    return fetched.unionByName(gone.select(*keys, CHANGE).withColumns(nothing))


def apply_feed(old: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the changes of a feed: what a merge by key leaves."""
    touched = feed.filter(F.col(CHANGE) != INSERTED).select(*[F.col(f"`{k}`") for k in keys]).distinct()
    pairs = [F.col(f"o.`{k}`").eqNullSafe(F.col(f"f.`{k}`")) for k in keys]
    same = reduce(lambda a, b: a & b, pairs)
    kept = old.alias("o").join(touched.alias("f"), same, "left_anti")
    return kept.unionByName(feed.filter(F.col(CHANGE) != DELETED).select(*old.columns))


def align_columns(df: DataFrame, known: StructType) -> DataFrame:
    """Known columns first and in their known types, then new ones.

    A known column that ``df`` lacks becomes a typed NULL. One that comes in
    another type is cast to the known one; a value that does not fit raises.
    """
    present = set(df.columns)
    kept = [
        (F.col(f"`{f.name}`").cast(f.dataType) if f.name in present else typed_null(f.dataType)).alias(f.name)
        for f in known
    ]
    return df.select(*kept, *[f"`{c}`" for c in df.columns if c not in known.names])
