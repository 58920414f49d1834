"""Removal of repeated passages by distributed prefix doubling over text positions.

A position's rank at a width is a name of its first bytes. The pair (rank at p, rank at p + offset) is
the rank at a larger width, and Spark sorts ranks together with their positions, so that equal ones
meet, the earliest first. What is unique drops out, the rest is ranked again at a larger offset.

1. Width 32, on sampled positions. Of the 32-byte strings in a window of ``length`` bytes the one of
   least rank is its *anchor*; windows with equal bytes have equal anchors, so a window repeats only
   if its anchor's rank does. Neighbouring windows share an anchor and form a *run*. Runs of an anchor
   that is alone drop out. Runs equal to an earlier one in all their bytes are repeated, all windows
   of them. First runs of anchors whose runs differ stay open.
2. Width ``length`` - 7: open runs in steps of eight windows by distance from the anchor, ranked by the
   bytes common to the eight (a pair of ranks at width 64); the same three cases again.
3. Width ``length``: every window of the open steps, a pair of ranks at width 64.

A task drops what it has seen itself before anything is shuffled, so a passage in a third of all
documents reaches the sort about once for each block of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.workspace import written

LENGTH = 100
ANCHOR, HALF = 32, 64
# Bytes ranked at a time; records that are compared with one another before they are shuffled.
BLOCK, SIFTED = 1 << 18, 1 << 19
NO_ID = -(1 << 63)
_PLACE = (1 << 20) - 1
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
# Windows of a step in the second round.
STEP = 8
# ``at`` holds the first place in its upper half and, shifted by one, the length in its lower one; its
# lowest bit tells spans that need no judgement.
RANKED = "first long, second long, doc long, tie long, at long"
JUDGED = "doc long, tie long, x int, y int, open boolean"


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a pair of names."""
    out = a * _ODD[0]
    out ^= out >> np.uint64(31)
    out += b
    out *= _ODD[1]
    out ^= out >> np.uint64(29)
    return out


def ranks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 32 and of the 64 bytes from each position at which there are so many."""
    eight = np.ndarray(len(data) - 7, "<u8", data.data, strides=(1,)).copy()
    at = _pair(eight, np.full(1, _ODD[2]))
    at = _pair(at[:-8], at[8:])
    at = _pair(at[:-16], at[16:])
    return at, _pair(at[:-32], at[32:])


def anchors(names: np.ndarray, many: int) -> np.ndarray:
    """Of every ``many`` successive names the place of the least, the first one in a tie of their upper
    44 bits; for fewer than 2**20 names."""
    least = (names & ~np.uint64(_PLACE)) | np.arange(len(names), dtype=np.uint64)
    width = 1
    while 2 * width <= many:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if many > width:
        least = np.minimum(least[: width - many], least[many - width :])
    return (least & np.uint64(_PLACE)).astype(np.int64)


def _blocks(pieces: Iterator[tuple[int, int, bytes]], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Pieces (row, offset, bytes) of ``length`` bytes at least, many at a time: their bytes one after another,
    and (row, offset, size) of each. Long pieces are cut; cuts share ``length - 1`` bytes."""
    data, of, size = [], [], 0
    for row, offset, piece in pieces:
        for at in range(0, max(len(piece) - length + 1, 0), BLOCK):
            part = piece[at : at + BLOCK + length - 1]
            if data and size + len(part) > BLOCK + length:
                yield np.frombuffer(b"".join(data), np.uint8), of
                data, of, size = [], [], 0
            data.append(part)
            of.append((row, offset + at, len(part)))
            size += len(part)
    if data:
        yield np.frombuffer(b"".join(data), np.uint8), of


def _windows_of(of: list[tuple[int, int, int]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window in a block: its place there, its row and its place in the row."""
    row, offset, size = (np.array(c, np.int64) for c in zip(*of, strict=True))
    start = np.cumsum(size) - size
    many = size - length + 1
    inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(start, many) + inside, np.repeat(row, many), np.repeat(offset, many) + inside


def runs(data: np.ndarray, of: list[tuple[int, int, int]], length: int, step: int) -> np.ndarray:
    """(rank, name, row, first window, last window) of the windows of a block, in runs of one anchor and at
    most ``step`` windows; a column each. The rank is that of the bytes which all windows of a full step
    have in common, the name that of all bytes and of where they are about the anchor."""
    short, long = ranks(data)
    at, row, place = _windows_of(of, length)
    begins = np.ones(len(at), bool)
    if step == 1:
        anchor, core = at, at
    else:
        anchor = anchors(short, length - ANCHOR + 1)[at]
        core = anchor - (anchor - at) // step * step
        begins[1:] = (np.diff(at) != 1) | (np.diff(anchor) != 0) | (np.diff(core) != 0)
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(at)) - 1
    x, y, a, c = at[first], at[last], anchor[first], core[first]
    width = length - step + 1
    if width == ANCHOR:
        rank = short[a]
    else:
        rank = _pair(_pair(long[c], long[c + width - HALF]), (a - c).astype(np.uint64))
    name = np.zeros(len(x), np.uint64)
    over = length - HALF
    for part in (long[x], long[x + over], long[y], long[y + over], (y - x).astype(np.uint64), (a - x).astype(np.uint64)):
        name = _pair(name, part)
    return np.stack([rank.view(np.int64), name.view(np.int64), row[first], place[first], place[last]])


def _merged(order: np.ndarray, doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of documents, sorted by ``order``, joined where they touch."""
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    # stops reached so far within the document
    reach = np.maximum.accumulate(stop + doc * (1 << 32)) - doc * (1 << 32)
    begins = np.ones(len(doc), bool)
    begins[1:] = (np.diff(doc) != 0) | (start[1:] > reach[:-1])
    first = np.flatnonzero(begins)
    return doc[first], start[first], reach[np.append(first[1:], len(doc)) - 1]


class Sieve:
    """Records of one task, of which equal ones are told apart by place before they leave it."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.parts: list[np.ndarray] = []
        self.keys: list[tuple[int, int]] = []
        self.held = 0

    def add(self, keys: list[tuple[int, int]], records: np.ndarray) -> None:
        """``records`` as `runs` gives them; their rows count into ``keys``, the (doc, tie) of rows."""
        records = records.copy()
        records[2] += len(self.keys)
        self.keys += keys
        self.parts.append(records)
        self.held += records.shape[1]

    def flush(self) -> pa.RecordBatch:
        table = np.concatenate(self.parts, axis=1) if self.parts else np.zeros((5, 0), np.int64)
        keys = np.array(self.keys or [(0, 0)], np.int64)
        # documents in their order, rows of one document and text as one
        ids, rank = np.unique(keys, axis=0, return_inverse=True)
        first, second, row, x, y = table
        doc = rank.reshape(-1)[row]
        order = np.lexsort((x, doc, second, first))
        first, second, doc, x, y = first[order], second[order], doc[order], x[order], y[order]
        new = np.ones(len(first), bool)
        new[1:] = (np.diff(first) != 0) | (np.diff(second) != 0)
        own = np.flatnonzero(new)
        earliest = np.repeat(own, np.diff(np.append(own, len(first))))
        again = (doc != doc[earliest]) | (x != x[earliest])
        d, start, stop = doc[again], x[again], y[again] + self.length
        d, start, stop = _merged(np.lexsort((start, d)), d, start, stop)
        self.parts, self.keys, self.held = [], [], 0
        spread = _pair(ids[d, 0].view(np.uint64), start.astype(np.uint64)).view(np.int64)
        both = [
            np.concatenate(pair)
            for pair in (
                (first[new], spread), (second[new], np.zeros(len(d), np.int64)), (doc[new], d),
                (x[new] << 32 | (y[new] - x[new]) << 1, start << 32 | (stop - start) << 1 | 1),
            )
        ]
        order = np.lexsort((both[3], both[2]))  # rows of a document next to one another take less room
        first, second, doc, at = (c[order] for c in both)
        columns = (first, second, ids[doc, 0], ids[doc, 1], at)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["first", "second", "doc", "tie", "at"])


def _ranked(length: int):
    """Runs of whole texts."""

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = Sieve(length)
        for batch in batches:
            keys = list(zip(batch.column("doc").to_pylist(), batch.column("tie").to_pylist(), strict=True))
            texts = batch.column("text")
            own: list[np.ndarray] = []
            pieces = ((i, 0, texts[i].as_buffer().to_pybytes()) for i in range(len(texts)))
            for data, of in _blocks(pieces, length):
                own.append(runs(data, of, length, length - ANCHOR + 1))
                if sum(r.shape[1] for r in own) >= SIFTED:
                    sieve.add(keys, np.concatenate(own, axis=1))
                    yield sieve.flush()
                    own = []
            if own:
                sieve.add(keys, np.concatenate(own, axis=1))
            if sieve.held >= SIFTED:
                yield sieve.flush()
        yield sieve.flush()

    return ranked


def _opened(length: int, step: int, open_runs: str):
    """The windows of the runs that are open in whole texts, in smaller steps."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = Sieve(length)
        for batch in batches:
            keys = list(zip(batch.column("doc").to_pylist(), batch.column("tie").to_pylist(), strict=True))
            texts, opens = batch.column("text"), batch.column(open_runs)

            def pieces(texts=texts, opens=opens):
                for i in range(len(texts)):
                    if not opens[i].is_valid or not len(opens[i]):
                        continue
                    text = texts[i].as_buffer()
                    spans = opens[i].values
                    x, y = (spans.field(f).to_numpy().astype(np.int64) for f in ("x", "y"))
                    _, start, stop = _merged(np.argsort(x, kind="stable"), np.zeros(len(x), np.int64), x, y + 1)
                    for a, b in zip(start.tolist(), stop.tolist(), strict=True):
                        yield i, a, text[a : b - 1 + length].to_pybytes()

            for data, of in _blocks(pieces(), length):
                sieve.add(keys, runs(data, of, length, step))
                if sieve.held >= SIFTED:
                    yield sieve.flush()
        yield sieve.flush()

    return opened


def _judged(length: int):
    """What sorted records say: spans of repeats, and first runs beside others of their anchor (open)."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last record read
        waiting = None  # the only run so far of the anchor that is being read
        started = None  # place of the first record of the pair that is being read
        for batch in batches:
            first, second, doc, tie, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            x, span = at >> 32, (at & 1).astype(bool)
            y = x + ((at & 0xFFFFFFFF) >> 1)
            out = [np.stack([doc[span], tie[span], x[span], y[span], np.zeros(span.sum(), np.int64)])]
            table = np.stack([c[~span] for c in (first, second, doc, tie, x, y)])
            if table.shape[1]:
                same = np.zeros(table.shape[1], bool)
                same[1:] = table[0, 1:] == table[0, :-1]
                equal = same.copy()
                equal[1:] &= table[1, 1:] == table[1, :-1]
                if before is not None and before[0] == table[0, 0]:
                    same[0] = True
                    equal[0] = before[1] == table[1, 0]
                # repeats: any place of a pair but its first
                heads = np.maximum.accumulate(np.where(equal, -1, np.arange(len(equal))))
                origin = np.where(heads[None] >= 0, table[2:5, heads], 0)
                if started is not None:
                    origin[:, heads < 0] = started[:, None]
                again = equal & (table[2:5] != origin).any(axis=0)
                out.append(np.stack([*table[2:5, again], table[5, again] + length, np.zeros(again.sum(), np.int64)]))
                # first runs, by anchor
                runs = np.flatnonzero(~equal)
                group = np.cumsum(~same) - 1  # -1: the anchor of the batch before
                of = group[runs]
                many = np.bincount(of + 1, minlength=group[-1] + 2)
                open_run = many[of + 1] > 1
                if many[0] and waiting is not None:
                    out.append(waiting)
                    waiting = None
                open_run |= of < 0
                if not (same[0] and group[-1] < 0):
                    waiting = None  # another anchor began
                tail = runs[of == group[-1]]
                if group[-1] >= 0 and many[group[-1] + 1] == 1:
                    waiting = np.append(table[2:, tail[0]], 1)[:, None]
                out.append(np.stack([*table[2:, runs[open_run]], np.ones(open_run.sum(), np.int64)]))
                before = table[:2, -1]
                started = origin[:, -1] if equal[-1] else table[2:5, -1]
            whole = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(whole[0]), pa.array(whole[1]), *(pa.array(whole[i]).cast(pa.int32()) for i in (2, 3)), pa.array(whole[4] == 1)],
                ["doc", "tie", "x", "y", "open"],
            )

    return judged


def _kept(length: int):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, copies, ids = batch.column("text"), batch.column("n").to_pylist(), batch.column("doc_id")
            names = [n for n in batch.schema.names if n.startswith("spans")]
            rows: list[tuple] = []
            taken: list[int] = []
            for i in range(len(texts)):
                data = texts[i].as_buffer()
                spans = [(s["x"], s["y"]) for name in names for s in batch.column(name)[i].as_py() or ()]
                x, y = np.array(sorted(spans), np.int64).reshape(-1, 2).T
                _, start, stop = _merged(np.arange(len(x)), np.zeros(len(x), np.int64), x, y)
                start, stop = start.tolist(), stop.tolist()
                left = b"".join(data[a:b].to_pybytes() for a, b in zip([0, *stop], [*start, len(data)], strict=True))
                rows.append((len(data), [{"start": a, "stop": b} for a, b in zip(start, stop, strict=True)], left))
                taken.append(i)
                if copies[i] > 1:  # equal rows after the first
                    gone = len(data) >= length
                    other = (len(data), [{"start": 0, "stop": len(data)}] if gone else [], b"" if gone else left)
                    for _ in range(copies[i] - 1):
                        rows.append(other)
                        taken.append(i)
                if len(rows) >= 1024:
                    yield _filled(rows, ids, taken)
                    rows, taken = [], []
            yield _filled(rows, ids, taken)

    return kept


def _filled(rows: list[tuple], ids: pa.Array, taken: list[int]) -> pa.RecordBatch:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(taken, pa.int64())), pa.array(columns[0], pa.int64()), pa.array(columns[1], spans),
            pa.array(columns[2], pa.binary()),
        ],
        ["doc_id", "n_bytes", "removed", "kept"],
    )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_bytes, the ``removed`` spans (start, stop) in bytes, and
    the ``kept`` bytes.

    A byte goes if a string of ``length`` bytes over it also starts earlier: in a smaller ``doc_id``, or
    earlier in the same one. Strings are judged on the input and never cross documents. Null texts are
    empty, and texts shorter than ``length`` stay as they are. A null id is smaller than all others; rows
    that share an id but not the text are ordered by a hash of it, and of equal rows one is the first
    and the others go whole. Very long texts are ranked in blocks; other columns are ignored; no rows
    give no rows. ``length`` is 64 to 128.
    """
    if not HALF <= length <= 2 * HALF:
        raise ValueError(f"length has to be {HALF} to {2 * HALF}")
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")
    shared = not narrow.groupBy(doc).count().where("count > 1").isEmpty()
    tie = F.xxhash64("text", F.col("doc_id").isNull()) if shared else F.lit(0).cast("long")
    keyed = narrow.select(doc, tie.alias("tie"), "doc_id", F.col("text").cast("binary").alias("text"))

    def judged(ranked: DataFrame) -> DataFrame:
        return ranked.repartition("first").sortWithinPartitions("first", "second", "doc", "tie", "at").mapInArrow(_judged(length), JUDGED)

    def by_text(marks: DataFrame, of: int) -> DataFrame:
        span = F.struct("x", "y")
        lists = (F.collect_list(F.when(which, span)).alias(f"{name}{of}") for which, name in ((F.col("open"), "open"), (~F.col("open"), "spans")))
        return marks.groupBy("doc", "tie").agg(*lists)

    marks = written(judged(keyed.select("doc", "tie", "text").mapInArrow(_ranked(length), RANKED)), "runs")
    # the rounds and the end read texts and marks by the same exchanges; all columns go to each, or they would differ
    texts = keyed.groupBy("doc", "tie").agg(
        F.max("doc_id").alias("doc_id"), F.max("text").alias("text"), F.count(F.lit(1)).alias("n")
    )
    known = texts.join(by_text(marks, 0), ["doc", "tie"], "left")
    steps = [min(STEP, length - HALF + 1), 1][-1 if length == HALF else 0 :]  # ranks of 64 bytes at least
    for of, step in enumerate(steps):
        late = judged(known.mapInArrow(_opened(length, step, f"open{of}"), RANKED))
        known = known.join(by_text(late, of + 1), ["doc", "tie"], "left")
    kind = keyed.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, removed array<struct<start: long, stop: long>>, kept binary"
    return known.mapInArrow(_kept(length), schema)


def repeats_report(docs: DataFrame) -> DataFrame:
    """`without_repeats` in numbers: bytes, removed bytes and spans, and a hash of what is kept."""
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return without_repeats(docs).select(
        "doc_id", "n_bytes", size.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLE = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, p, md5(h[2 * p + 1 : 2 * p + 200]) AS k
  FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 99)) AS p FROM d)),
f AS (
  SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS place FROM w)
  WHERE place > 1),
s AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
        FROM (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM f))
  GROUP BY doc_id, run),
t AS (
  SELECT doc_id, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS stops, sum(b - a) AS gone, count(*) AS n
  FROM s GROUP BY doc_id),
k AS (
  SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(gone, 0) AS gone, coalesce(n, 0) AS n,
         CASE WHEN n IS NULL THEN h ELSE array_to_string(list_transform(range(1, len(starts) + 2), lambda i:
           h[2 * coalesce(stops[i - 1], 0) + 1 : 2 * coalesce(starts[i], length(h) // 2)]), '') END AS kept
  FROM d LEFT JOIN t ON d.doc_id = t.doc_id)
SELECT doc_id, n_bytes, CAST(gone AS BIGINT) AS n_removed, CAST(n AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM k"""
