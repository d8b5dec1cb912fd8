"""Conversation prefix trie by fixed-length block hashing.

A node stands for a distinct sequence of first turns; the conversations that
start with it are its members. A prefix is known by 128 bits: the exclusive or
of one hash per turn, which covers role, text and place. So prefixes can be
put together from parts, in any order and on any number of tasks.

Conversations are grouped by blocks of ``SPAN`` turns first: conversations
with the same digests before and after a block share it, and become one row
with a count. Only where the members of such a prefix go on with different
blocks (siblings diverge) are the turns inside the blocks grouped again;
elsewhere the nodes inside a block have the members of the block.

Sums over subtrees need no walk. A node belongs to its smallest member, so a
conversation owns the nodes from some depth of its path on, and the nodes
below a node are those that its members own from its depth on. Sums per member
are sums over its later blocks, and members are added up per block, then per
turn where siblings diverge.

A conversation of very many turns is spread: turns are numbered across range
partitions, and running values go through lanes of ``LANE`` blocks each. The
ids that end at a node are put together in chunks and hashed chunk by chunk.

Edge cases: NULL role or text counts as empty, turns with the same number are
ordered by a digest of role and text, a NULL turn comes first. Rows without a
conversation id belong to no conversation. No conversations give no nodes; a
conversation without turns is a member of the root alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import stored
from granary.operators.ordered import number_rows

SPAN = 4  # turns of a block
LANE = 1024  # blocks of a conversation that one window sees
CHUNK = 1024  # consecutive ids whose text is put together at once
BLOCK = ["block", "bx", "by", "ax", "ay"]
NODE = ["depth", "x", "y"]


def turn_digests(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv, pos, x, y, bytes``: the turns of each conversation, numbered from 1, without their texts."""
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    rows = turns.select(
        F.col(f"`{conversation}`").cast("bigint").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.xxhash64(F.lit(1), *said).alias("x"),
        F.xxhash64(F.lit(2), *said).alias("y"),
        F.octet_length(said[1]).cast("bigint").alias("bytes"),
    )
    numbered = number_rows(rows.filter(F.col("conv").isNotNull()), ["conv"], ["turn", "x", "y"], "pos")
    return numbered.select("conv", "pos", "x", "y", "bytes")


def running(rows: DataFrame, sums: dict[str, tuple[str, str]], last_first: bool = False) -> DataFrame:
    """Add to each block of a conversation what the blocks ahead of it come to.

    ``sums`` gives for each new column the column it adds up and how (``sum``
    or ``bit_xor``). Blocks are in lanes: a window adds up within a lane, and
    another over the lanes' own totals.
    """
    lanes = rows.withColumn("lane", F.floor(F.col("block") / LANE))
    order = (lambda c: F.col(c).desc()) if last_first else F.col
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    across = before(Window.partitionBy("conv").orderBy(order("lane")))
    within = before(Window.partitionBy("conv", "lane").orderBy(order("block")))
    how = lambda kind, c: F.bit_xor(c) if kind == "bit_xor" else F.sum(c)
    totals = lanes.groupBy("conv", "lane").agg(*[how(kind, c).alias(name) for name, (c, kind) in sums.items()])
    zero = F.lit(0).cast("bigint")
    earlier = totals.select(
        "conv", "lane", *[F.coalesce(how(k, n).over(across), zero).alias(f"_{n}") for n, (_, k) in sums.items()]
    )
    joined = lanes.join(stored(earlier, "lanes"), ["conv", "lane"])
    both = {}
    for name, (c, kind) in sums.items():
        own, past = F.coalesce(how(kind, c).over(within), zero), F.col(f"_{name}")
        both[name] = own.bitwiseXOR(past) if kind == "bit_xor" else own + past
    return joined.withColumns(both).drop("lane", *[f"_{n}" for n in sums])


def turn_blocks(steps: DataFrame) -> DataFrame:
    """``conv, block, entries`` and the digests before (``bx, by``) and after (``ax, ay``) each block."""
    mixed = steps.select(
        "conv",
        "pos",
        F.floor((F.col("pos") - 1) / SPAN).alias("block"),
        F.xxhash64("pos", "x").alias("x"),
        F.xxhash64("pos", "y").alias("y"),
        "bytes",
    )
    blocks = mixed.groupBy("conv", "block").agg(
        F.bit_xor("x").alias("dx"),
        F.bit_xor("y").alias("dy"),
        F.sort_array(F.collect_list(F.struct("pos", "x", "y", "bytes"))).alias("entries"),
    )
    chained = running(stored(blocks, "turn-blocks"), {"bx": ("dx", "bit_xor"), "by": ("dy", "bit_xor")})
    after = {a: F.col(b).bitwiseXOR(F.col(d)) for a, b, d in (("ax", "bx", "dx"), ("ay", "by", "dy"))}
    return stored(chained.withColumns(after).drop("dx", "dy"), "chained")


def shared_blocks(chained: DataFrame) -> DataFrame:
    """One row per distinct block: members, smallest member, entries, and whether it has no sibling."""
    own = stored(
        chained.groupBy(*BLOCK).agg(
            F.count(F.lit(1)).alias("n"), F.min("conv").alias("first"), F.any_value("entries").alias("entries")
        ),
        "distinct-blocks",
    )
    after = F.struct("ax", "ay")
    siblings = own.groupBy("block", "bx", "by").agg((F.min(after) == F.max(after)).alias("alone"))
    # Stored, so that the join deals both sides anew and can split a prefix of many blocks.
    return stored(own.join(stored(siblings, "siblings"), ["block", "bx", "by"]), "shared-blocks")


def entry_digests() -> Column:
    """The prefixes that end inside or at the end of a block: depth, digest, the parent's digest, bytes."""
    up_to = "aggregate(slice(entries, 1, i - {back}), b{c}, (s, e) -> s ^ e.{c}) AS {name}"
    digests = [up_to.format(back=b, c=c, name=p + c) for c in "xy" for b, p in ((0, ""), (1, "p"))]
    return F.expr(
        "transform(sequence(1, size(entries)), i -> named_struct('depth', entries[i - 1].pos, "
        + ", ".join(f"'{d.rpartition(' ')[2]}', {d.rpartition(' AS ')[0]}" for d in digests)
        + ", 'bytes', entries[i - 1].bytes))"
    )


def along(blocks: DataFrame) -> DataFrame:
    """One row per turn of each distinct block."""
    return blocks.withColumn("at", F.explode(entry_digests()))


def refined(rows: DataFrame, *sums: Column) -> DataFrame:
    """Rows per node: those of blocks without siblings as they are, others grouped by their prefix."""
    names = rows.drop("alone").columns
    grouped = rows.filter(~F.col("alone")).groupBy(*NODE).agg(*sums)
    return rows.filter("alone").select(*names).unionByName(grouped.select(*names))


def trie_nodes(blocks: DataFrame, members: DataFrame) -> DataFrame:
    """``depth, x, y, px, py, n, first, bytes`` of all nodes, the root among them."""
    rows = along(blocks).select("alone", "n", "first", *[f"at.{c}" for c in (*NODE, "px", "py", "bytes")])
    inner = refined(
        rows,
        F.sum("n").alias("n"),
        F.min("first").alias("first"),
        *[F.any_value(c).alias(c) for c in ("px", "py", "bytes")],
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = members.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("first")).filter("n > 0").select(
        F.lit(0).alias("depth"), zero.alias("x"), zero.alias("y"), none.alias("px"), none.alias("py"),
        "n", "first", zero.alias("bytes"),
    )
    return stored(inner.unionByName(root), "nodes")


def with_family(nodes: DataFrame) -> DataFrame:
    """Add ``parent`` (its smallest member), ``n_children``, and the weights ``saved`` and ``leaf``."""
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), "px", "py")
    children = children.agg(F.count(F.lit(1)).alias("n_children")).withColumnsRenamed({"px": "x", "py": "y"})
    counted = nodes.join(stored(children, "children"), NODE, "left")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"),
        F.col("first").alias("parent"),
    )
    whole = stored(counted, "counted").join(parents, ["depth", "px", "py"], "left")
    return stored(
        whole.withColumns(
            {
                "n_children": F.coalesce("n_children", F.lit(0)),
                "saved": (F.col("n") - 1) * F.col("bytes"),
                "leaf": F.col("n_children").isNull().cast("bigint"),
            }
        ),
        "family",
    )


def subtree_sums(nodes: DataFrame, blocks: DataFrame, chained: DataFrame) -> DataFrame:
    """``depth, x, y, saved_tokens, n_leaves`` summed over each node's subtree."""
    owned = nodes.filter("depth > 0").groupBy(
        F.col("first").alias("conv"), F.floor((F.col("depth") - 1) / SPAN).alias("block")
    )
    owned = owned.agg(
        F.sum("saved").alias("w"),
        F.sum("leaf").alias("l"),
        F.collect_list(F.struct("depth", "saved", "leaf")).alias("own"),
    )
    owned = stored(owned, "owned")
    zero = F.lit(0).cast("bigint")
    paths = chained.select("conv", *BLOCK).join(owned.drop("own"), ["conv", "block"], "left")
    paths = stored(paths.withColumns({c: F.coalesce(c, zero) for c in ("w", "l")}), "paths")
    later = running(paths, {"below_w": ("w", "sum"), "below_l": ("l", "sum")}, last_first=True)
    below = later.groupBy(*BLOCK).agg(F.sum("below_w").alias("below_w"), F.sum("below_l").alias("below_l"))
    placed = stored(blocks.join(stored(below, "below"), BLOCK), "placed-blocks")
    mine = owned.select(F.col("conv").alias("first"), "block", "own")
    rows = along(placed.join(mine, ["first", "block"], "left"))
    part = "aggregate(filter(coalesce(own, array()), o -> o.depth >= at.depth), below_{0}, (s, o) -> s + o.{1})"
    rows = rows.select(
        "alone",
        *[f"at.{c}" for c in NODE],
        F.expr(part.format("w", "saved")).alias("saved_tokens"),
        F.expr(part.format("l", "leaf")).alias("n_leaves"),
    )
    inner = refined(rows, F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    root = nodes.agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"), F.count(F.lit(1)).alias("k"))
    root = root.filter("k > 0").select(
        F.lit(0).alias("depth"), zero.alias("x"), zero.alias("y"), "saved_tokens", "n_leaves"
    )
    return stored(inner.unionByName(root), "subtree-sums")


def end_digests(steps: DataFrame, members: DataFrame) -> DataFrame:
    """``depth, x, y, ends_sha256`` of the nodes at which conversations end.

    Ids are sorted and joined in chunks of neighbouring ids, many at a time;
    one task then feeds the chunks of a node to the hash, one after the other.
    """
    ends = steps.groupBy("conv").agg(
        F.max("pos").alias("depth"),
        F.bit_xor(F.xxhash64("pos", "x")).alias("x"),
        F.bit_xor(F.xxhash64("pos", "y")).alias("y"),
    )
    all_ends = members.join(stored(ends, "ends"), "conv", "left").select(
        "conv", *[F.coalesce(c, F.lit(0)).alias(c) for c in NODE]
    )
    chunks = all_ends.groupBy(*NODE, F.floor(F.col("conv") / CHUNK).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                key = (row["depth"], row["x"], row["y"])
                if key != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(row["ids"].encode())
            yield rows(done)
        yield rows([] if node is None else [(*node, state.hexdigest())])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string())
        cols = [pa.array([d[i] for d in done], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(cols, names=[*NODE, "ends_sha256"])

    dealt = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk")
    return dealt.mapInArrow(digest, "depth int, x bigint, y bigint, ends_sha256 string")


def prefix_trie(steps: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node of the trie of ``steps`` (see ``turn_digests``).

    ``members`` has the ids of all conversations in column ``conv``, those
    without turns too. Returns ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.
    """
    steps, members = stored(steps, "steps"), stored(members.select("conv").distinct(), "members")
    chained = turn_blocks(steps)
    blocks = shared_blocks(chained)
    nodes = with_family(trie_nodes(blocks, members))
    sums = subtree_sums(nodes, blocks, chained)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(sums, NODE)
        .join(stored(end_digests(steps, members), "end-digests"), NODE, "left")
        .select(
            F.col("first").alias("conv_id"),
            F.col("depth").cast("bigint").alias("depth"),
            F.col("parent").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.col("n_children").cast("bigint").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )


def shared_openings(steps: DataFrame, of: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another one: ``conv, pos, x, y, bytes`` and all ids.

    Conversation c takes its first h turns from conversation c - c % ``of``,
    where h is a checksum of c modulo ``most``, and then goes on with its own
    turns after its first h. A conversation that is not there lends no turns.
    """
    steps = stored(steps, "own-turns")
    sizes = stored(steps.groupBy("conv").agg(F.count(F.lit(1)).alias("turns")), "sizes")
    lender = F.col("conv") - F.pmod("conv", F.lit(of))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    plans = sizes.select("conv", lender.alias("lender"), h.alias("h"))
    lent = sizes.select(F.col("conv").alias("lender"), F.col("turns").alias("lent"))
    plans = plans.join(lent, "lender", "left").withColumn("lent", F.least("h", F.coalesce("lent", F.lit(0))).cast("int"))
    plans = stored(plans, "plans")
    own = steps.join(plans, "conv").filter("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("lent"))
    heads = steps.filter(F.col("pos") < most).withColumnRenamed("conv", "lender")
    taken = heads.join(plans.select("conv", "lender", "h"), "lender").filter("pos <= h")
    columns = ["conv", "pos", "x", "y", "bytes"]
    return own.select(*columns).unionByName(taken.select(*columns)), sizes.select("conv")
