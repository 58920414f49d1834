"""Pack token sequences by first-fit decreasing over a tournament tree, in randomised groups.

Documents are dealt out at random into groups of bounded size, and every group is packed on its own.
Whole stretches of ``length`` tokens fill sequences by themselves. What is left of each document is
packed first-fit decreasing: a tournament tree over the bins holds the largest free space of every
subtree, so the first bin with room is found in logarithmic time. Then the emptiest bins are taken
apart and cut into the gaps of the others, until one bin at most is not full; that one becomes
sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.tokenizing import encoder

VOCABULARY = "byte_bpe_50k.json"
LENGTH = 1024
# Documents of a group, and tokens at which a group is closed before that.
GROUP_ROWS = 4096
GROUP_TOKENS = 8_000_000
# Bits of a sequence's number within its partition.
SEQUENCE_BITS = 33


class FirstFit:
    """Bins of one capacity, for at most ``most`` items, as a tournament tree of free space."""

    def __init__(self, capacity: int, most: int) -> None:
        self.leaves = 1
        while self.leaves < max(1, most):
            self.leaves *= 2
        self.free = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> int:
        """The first bin with room for ``size``, which then holds it."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        free[node] -= size
        at = node - self.leaves
        node //= 2
        while node:
            left, right = free[2 * node], free[2 * node + 1]
            best = left if left > right else right
            if free[node] == best:
                break
            free[node] = best
            node //= 2
        return at


def pack(sizes: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(item, start, length, sequence, offset) of pieces that cover every item once. Sequences are
    numbered from 0 without gaps; each is full or as long as a power of two."""
    out: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    rest: list[tuple[int, int]] = []
    for item, size in enumerate(sizes):
        whole = size // length
        for i in range(whole):
            out.append((item, i * length, length, sequence, 0))
            sequence += 1
        if size % length:
            rest.append((size % length, item))
    rest.sort(key=lambda x: (-x[0], x[1]))
    tree = FirstFit(length, len(rest))
    bins: list[list[list[int]]] = []
    for size, item in rest:
        at = tree.put(size)
        if at == len(bins):
            bins.append([])
        bins[at].append([item, sizes[item] - size, size])

    # the emptiest bins go, piece by piece, into the gaps of the fullest that have any
    used = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: (-used[b], b))
    low, high = 0, len(order) - 1
    while low < high:
        target, source = order[low], order[high]
        gap = length - used[target]
        if not gap:
            low += 1
            continue
        piece = bins[source][-1]
        take = min(gap, piece[2])
        bins[target].append([piece[0], piece[1] + piece[2] - take, take])
        piece[2] -= take
        used[target] += take
        used[source] -= take
        if not piece[2]:
            bins[source].pop()
        if not bins[source]:
            high -= 1
    for b in order[: high + 1]:
        offset = 0
        left = used[b]
        room = length if left == length else 1 << (left.bit_length() - 1)
        for item, start, size in bins[b]:
            while size:
                take = min(size, room - offset)
                out.append((item, start, take, sequence, offset))
                start, size, offset, left = start + take, size - take, offset + take, left - take
                if offset == room:
                    sequence, offset = sequence + 1, 0
                    room = 1 << (left.bit_length() - 1) if left else 0
    return out


def _encoded(vocabulary: str):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i in range(0, len(texts), 64):
                ids = own.encode([t or "" for t in texts[i : i + 64]])
                # two bytes an id while the vocabulary allows it
                width = np.dtype("<u2" if all(not len(x) or x.max() < 1 << 16 for x in ids) else "<u4")
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(i, len(ids)),
                        "width": pa.array([width.itemsize] * len(ids), pa.int32()),
                        "ids": pa.array([x.astype(width).tobytes() for x in ids], pa.binary()),
                    }
                )

    return encoded


def _pieces(doc_ids: list[pa.Array], ids: list[np.ndarray], first: int, length: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of one group, whose sequences are numbered from ``first``."""
    sizes = [len(x) for x in ids]
    packed = pack(sizes, length)
    item, start, size, sequence, offset = (np.array(c, np.int64) for c in zip(*packed, strict=True))
    crc = [
        zlib.crc32(ids[i][s : s + n].tobytes()) for i, s, n in zip(item.tolist(), start.tolist(), size.tolist(), strict=True)
    ]
    names = pa.concat_arrays(doc_ids).take(pa.array(item))
    batch = pa.RecordBatch.from_pydict(
        {
            "doc_id": names,
            "start": pa.array(start),
            "length": pa.array(size),
            "ids_crc32": pa.array(crc, pa.int64()),
            "doc_tokens": pa.array(np.array(sizes, np.int64)[item]),
            "sequence_id": pa.array(sequence + first),
            "offset": pa.array(offset),
            "ids": pa.array([ids[i][s : s + n] for i, s, n in zip(item, start, size, strict=True)], pa.list_(pa.uint32())).cast(
                pa.list_(pa.int32())
            ),
        }
    )
    return batch, first + int(sequence.max()) + 1


def _packed(length: int, with_ids: bool):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << SEQUENCE_BITS
        doc_ids: list[pa.Array] = []
        ids: list[np.ndarray] = []
        held = 0
        for batch in batches:
            widths, data = batch.column("width").to_pylist(), batch.column("ids")
            for i, width in enumerate(widths):
                own = np.frombuffer(data[i].as_buffer(), f"<u{width}").astype("<u4")
                ids.append(np.append(own, np.uint32(0)))
                doc_ids.append(batch.column("doc_id").slice(i, 1))
                held += len(own) + 1
                if len(ids) >= GROUP_ROWS or held >= GROUP_TOKENS:
                    out, first = _pieces(doc_ids, ids, first, length)
                    yield out if with_ids else out.drop_columns(["ids"])
                    doc_ids, ids, held = [], [], 0
        if ids:
            out, _ = _pieces(doc_ids, ids, first, length)
            yield out if with_ids else out.drop_columns(["ids"])

    return packed


def pack_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
    length: int = LENGTH, with_ids: bool = True,
) -> DataFrame:
    """A row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and
    the piece's token ``ids`` if asked for.

    A document is the ids of its whole text (null: empty) and an id 0 at the end. Each id is in one
    piece. Sequences hold ``length`` tokens, or a smaller power of two once or a few times a group.
    Rows are dealt out and ordered by a hash of id, tokens and, among equal rows, their number, so every
    run over the same rows gives the same pieces, a task that runs again too, and null and repeated ids
    spread like others. Other columns are ignored; no rows give no rows.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    partitions = max(1, -(-narrow.count() // GROUP_ROWS))
    encoded = narrow.mapInArrow(_encoded(vocabulary), f"doc_id {kind}, width int, ids binary")
    numbered = (
        encoded.groupBy("doc_id", "width", "ids")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("doc_id", "width", "ids", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("n"))
    )
    dealt = (
        numbered.withColumn("deal", F.xxhash64("doc_id", "ids", "n"))
        .repartition(partitions, "deal")
        .sortWithinPartitions("deal", "doc_id", "ids", "n")
    )
    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return dealt.mapInArrow(_packed(length, with_ids), schema + (", ids array<int>" if with_ids else ""))
