"""Packing documents into training sequences: best-fit decreasing.

A document is its token ids followed by one end id. A document longer than a
window is first cut into full windows; what is left of it is shorter than one.
These rests are placed longest first, each into the open window with the least
room that still takes it. The open windows are counted in a segment tree
indexed by their remaining capacity, so the tightest one is found in as many
steps as the tree has levels.

Windows that end with more than ``slack`` tokens of room are topped up: the
emptiest of them are cut up to fill the others. At most one window per group
of rests is then left open, and it is cut into sequences whose lengths are
powers of two, which need no padding.

Each task packs the rests of its own documents, ``GROUP`` at a time, so no row
is shuffled and a task holds ``GROUP`` windows of ids at most, however long or
many its documents are.

Edge cases: NULL text counts as empty, and an empty document is its end id
alone. Rows with the same id are separate documents. A special token's string
inside a text is that token, as the tokenizer takes it by default.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import whole_text
from granary.llm.token_counts import PLAIN, byte_letters

WINDOW, END_ID = 1024, 0
GROUP = 16_384  # rests packed together, at most
SLACK = 0  # tokens of room that a window may keep
SEQUENCE_BITS = 36  # sequences of one task

Piece = tuple[int, int, int]  # document (place in the group), start in the document, length


class ByteEncoder:
    """Token ids of texts, as the tokenizer file's own library gives them.

    The ranks of the file drive a faster encoder where all Unicode versions
    agree on letters and numbers; other texts go through the library.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores already
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE tokenizer without normalisation is needed")
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        if text.isascii() or max(text) < chr(PLAIN):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


class Capacities:
    """Segment tree over remaining capacities 0 .. window; each node counts the open windows below it."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        node = self.leaves + room
        while node:
            self.counts[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the open window of least room that has ``need``, with its room."""
        counts, node = self.counts, self.leaves + need
        if not counts[node]:
            # Up to the first right neighbour that counts a window, then down its left edge.
            while node > 1 and not (node & 1 == 0 and counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if counts[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            counts[node] -= 1
            node >>= 1
        return self.open[room].pop(), room


def best_fit(lengths: Sequence[int], window: int) -> tuple[list[list[int]], list[int]]:
    """Windows, as lists of items, and their rooms. No item is longer than the window."""
    tree, windows, rooms = Capacities(window), [], []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[item])
        if found is None:
            at, room = len(windows), window
            windows.append([])
            rooms.append(room)
        else:
            at, room = found
        windows[at].append(item)
        rooms[at] = room - lengths[item]
        if rooms[at]:
            tree.add(rooms[at], at)
    return windows, rooms


def top_up(windows: list[list[Piece]], rooms: list[int], slack: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Fill windows of more room than ``slack`` from the emptiest of them.

    Returns the filled windows and the pieces of the one left over, if any.
    """
    full = [w for w, room in zip(windows, rooms) if room <= slack]
    loose = sorted((room, i) for i, room in enumerate(rooms) if room > slack)
    lo, hi = 0, len(loose) - 1
    while lo < hi:
        (room, target), donor = loose[lo], windows[loose[hi][1]]
        while room and donor:
            doc, start, length = donor.pop()
            moved = min(length, room)
            windows[target].append((doc, start + length - moved, moved))
            if moved < length:
                donor.append((doc, start, length - moved))
            room -= moved
        loose[lo] = (room, target)
        if not donor:
            hi -= 1
        if not room:
            full.append(windows[target])
            lo += 1
    return full, windows[loose[lo][1]] if lo == hi else []


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces in a row, cut into sequences whose lengths are powers of two, longest first."""
    total, out, queue = sum(n for _, _, n in pieces), [], pieces[::-1]
    for bit in reversed(range(total.bit_length())):
        need = total & (1 << bit)
        if need:
            out.append([])
        while need:
            doc, start, length = queue.pop()
            used = min(length, need)
            out[-1].append((doc, start, used))
            if used < length:
                queue.append((doc, start + used, length - used))
            need -= used
    return out


def pack_rests(rests: Sequence[tuple[int, int]], window: int, slack: int) -> list[list[Piece]]:
    """Sequences of pieces from rests given as (start in the document, length)."""
    items, rooms = best_fit([n for _, n in rests], window)
    windows = [[(i, *rests[i]) for i in w] for w in items]
    full, left = top_up(windows, rooms, slack)
    return full + powers_of_two(left)


def pack(
    docs: DataFrame,
    path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    slack: int = SLACK,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit
    integers, ready to be copied into a sequence (see ``sequences``). Each id
    of each document is in exactly one piece, and a sequence's pieces follow
    each other without gaps. The numbers of the sequences are distinct but not
    contiguous; a task that runs again gives the same ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = byte_encoder(path)
        sequence = TaskContext.get().partitionId() << SEQUENCE_BITS
        keys, starts, totals, rests = [], [], [], []

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*pieces))
            ints = [pa.array(c, pa.int64()) for c in cols[1:3] + cols[4:]]
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], key_type), *ints[:2], pa.array(cols[3], pa.binary()), *ints[2:]], names=names
            )

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            out = []
            for pieces in pack_rests([(s, len(r)) for s, r in zip(starts, rests)], window, slack):
                offset = 0
                for i, start, length in pieces:
                    at = start - starts[i]
                    out.append((keys[i], start, length, rests[i][at : at + length].tobytes(), totals[i], sequence, offset))
                    offset += length
                sequence += 1
                if len(out) >= 4000:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)
            for held in (keys, starts, totals, rests):
                held.clear()

        for batch in batches:
            out, key_type = [], batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = own.encode(text)
                ids = np.empty(len(found) + 1, dtype="<u4")
                ids[:-1], ids[-1] = found, end_id
                whole = len(ids) // window * window
                for start in range(0, whole, window):
                    out.append((key, start, window, ids[start : start + window].tobytes(), len(ids), sequence, 0))
                    sequence += 1
                if whole < len(ids):
                    keys.append(key)
                    starts.append(whole)
                    totals.append(len(ids))
                    rests.append(ids[whole:].copy())
            if out:
                yield rows(out)
            if len(rests) >= GROUP:
                yield from packed()
        if rests:
            yield from packed()

    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kind = docs.schema[doc_id].dataType.simpleString()
    longs = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(text).alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, {longs}")


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the packed sequences, padded to the window unless a power of two.

    ``ids`` are little-endian unsigned 32-bit integers. A sequence is no longer
    than a window, so its pieces are few and small.
    """
    put = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate("put", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    n = F.col("n_tokens")
    short = (n.bitwiseAND(n - 1) != 0) & (n < window)
    pad = F.expr(f"unhex(repeat('{pad_id.to_bytes(4, 'little').hex()}', cast({window} - n_tokens AS int)))")
    return (
        pieces.groupBy("sequence_id")
        .agg(put.alias("put"), F.sum("length").alias("n_tokens"))
        .select("sequence_id", "n_tokens", joined.alias("ids"))
        .withColumn("ids", F.when(short, F.concat("ids", pad)).otherwise(F.col("ids")))
    )


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
