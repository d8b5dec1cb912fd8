"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text marks the chunk borders, so a passage
that several documents share gives the same chunks in each, wherever it
starts. A worker encodes a chunk once and remembers it, within a fixed size.
A border may cut a word, and the encoding of a part is not part of the
encoding. So each join is repaired: the cut word is encoded anew together with
the whole word before and after it, and the result must agree exactly with
what the two chunks have for these words. If it doesn't, the window grows by
further words, up to the whole text.

The words of a chunk are white-space separated stretches, which this kind of
tokenizer encodes independently; each is remembered too, so a new chunk of
known words costs lookups only.

Edge cases: NULL text counts as empty and has no tokens. A special token's
string inside a text is that token, as the tokenizer takes it by default.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import forget_half, keep_only, whole_text

MEAN_CHUNK, LEAST_CHUNK, MOST_CHUNK = 1024, 256, 8192  # bytes
KNOWN_CHUNK_BYTES = 32 << 20  # of chunks that a worker remembers, and as much for their tokens
KNOWN_WORDS = 800_000  # words that a worker remembers
GEAR = np.random.default_rng(1).integers(0, 1 << 32, 256, dtype=np.uint32)  # one number per byte value


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a text in UTF-8, never inside a character.

    The hash at a byte covers the 32 bytes up to it: each doubles its weight
    per step and so leaves the 32-bit sum.
    """
    n = len(raw)
    if n <= LEAST_CHUNK:
        return [n] if n else []
    data = np.frombuffer(raw, dtype=np.uint8)
    sums = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        sums[step:] += sums[:-step] << np.uint32(step)
    marks = np.flatnonzero(sums >> np.uint32(22) == 0) + 1
    ends, start = [], 0
    for mark in (*marks.tolist(), n):
        while mark - start > MOST_CHUNK:
            start += MOST_CHUNK
            while raw[start] & 0xC0 == 0x80:
                start -= 1
            ends.append(start)
        while mark < n and raw[mark] & 0xC0 == 0x80:
            mark += 1
        if mark == n or mark - start >= LEAST_CHUNK:
            ends.append(mark)
            start = mark
    return list(dict.fromkeys(ends))


class Chunk:
    """An encoded chunk: the bytes before its first and after its last white space, and the words between."""

    __slots__ = ("head", "ids", "lengths", "tail", "words")

    def __init__(self, head: bytes, words: list[bytes], tail: bytes) -> None:
        self.head, self.words, self.tail = head, words, tail
        self.ids, self.lengths = b"", []


def cut(raw: bytes) -> Chunk | None:
    """A chunk's unsettled ends and its whole words; None where it has no white space."""
    words = raw.split()
    if len(words) == 1 and len(words[0]) == len(raw):
        return None
    head = b"" if raw[:1].isspace() or not words else words.pop(0)
    tail = b"" if raw[-1:].isspace() or not words else words.pop()
    return Chunk(head, words, tail)


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pieces = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.joined = spec.get("decoder") is None
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, Chunk | None] = {}
        self.chunk_bytes = 0

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, dtype="<i4").tobytes() for e in found]

    def learn(self, words: set[bytes]) -> None:
        """Encode the words not known yet."""
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > KNOWN_WORDS:
            forget_half(self.words)
            new = [w for w in words if w not in self.words]
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            self.words.update(zip(part, self.encode_all(part)))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as little-endian 32-bit integers."""
        documents: list[tuple[bytes, list[Chunk | bytes]]] = []
        fresh: dict[bytes, Chunk] = {}
        if self.chunk_bytes > KNOWN_CHUNK_BYTES:
            self.chunks.clear()
            self.chunk_bytes = 0
        for text in texts:
            raw, start, parts = text.encode(), 0, []
            for end in chunk_ends(raw):
                piece = raw[start:end]
                if piece not in self.chunks:
                    self.chunks[piece] = chunk = cut(piece)
                    self.chunk_bytes += len(piece)
                    if chunk:
                        fresh[piece] = chunk
                parts.append(self.chunks[piece] or piece)
                start = end
            documents.append((raw, parts))
        self.learn({w for c in fresh.values() for w in c.words})
        for chunk in fresh.values():
            ids = [self.words[w] for w in chunk.words]
            chunk.ids, chunk.lengths = b"".join(ids), [len(ids[0]), len(ids[-1])] if ids else []
            chunk.words = chunk.words[:1] + chunk.words[-1:]
        return self.join_all(documents)

    def join_all(self, documents: list[tuple[bytes, list[Chunk | bytes]]]) -> list[bytes]:
        """Put the chunks of each text together; all joins of the batch are encoded at once."""
        windows: list[bytes] = []
        layouts: list[list[bytes | tuple[int, int, int, bytes, bytes]]] = []
        for _, parts in documents:
            layout: list = []
            pending, before = b"", None

            def close(after: Chunk | None) -> None:
                """Note the join of the pending bytes between two chunks."""
                if not pending:
                    return
                first = before.words[-1] if before and before.words else b""
                last = after.words[0] if after and after.words else b""
                windows.append(b" ".join(filter(None, (first, pending, last))))
                left = before.ids[-before.lengths[1] :] if first and before.lengths[1] else b""
                right = after.ids[: after.lengths[0]] if last else b""
                layout.append((len(windows) - 1, left, right))

            for part in parts:
                if isinstance(part, bytes):
                    pending += part
                    continue
                pending += part.head
                close(part)
                layout.append(part.ids)
                pending, before = part.tail, part
            close(None)
            layouts.append(layout)
        repaired = self.encode_all(windows)
        out = []
        for (raw, _), layout in zip(documents, layouts):
            ids: list[bytes] = []
            for entry in layout:
                if isinstance(entry, bytes):
                    ids.append(entry)
                    continue
                window, left, right = repaired[entry[0]], entry[1], entry[2]
                agree = len(window) >= len(left) + len(right)
                if agree and window.startswith(left) and window.endswith(right):
                    ids.append(window[len(left) : len(window) - len(right)])
                else:
                    ids = self.encode_all([raw])  # the window grown to the whole text
                    break
            out.append(b"".join(ids))
        return out

    def decode(self, ids: list[int]) -> str:
        """What the tokenizer's own decode gives, special tokens kept."""
        if self.joined:
            return " ".join(map(self.pieces.__getitem__, ids))
        return self.tokenizer.decode(ids, skip_special_tokens=False)


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: the token ids of each text, and the text they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("bpe", encoder.cache_clear)
        own = encoder(path)
        for batch in batches:
            encoded = own.encode_batch(batch.column("text").to_pylist())
            offsets = np.cumsum([0, *[len(e) // 4 for e in encoded]], dtype=np.int32)
            flat = np.frombuffer(b"".join(encoded), dtype="<i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            decoded = [own.decode(flat[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"]
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(text).alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Count and digests of the ids and of the decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
