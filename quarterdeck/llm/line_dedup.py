"""Drop lines that many documents repeat, with two Bloom filters in front of the exact count.

1. Tasks pass over the lines and fill two filters: keys seen once, and keys seen again in another
   document. The filters of all tasks meet segment by segment: a bit is set in the joint second
   filter if it is in any second filter, or in the first filters of two tasks.
2. A second pass looks every key up in the joint second filter. What it lacks was in one document
   only. The rest, suspects, are counted exactly by key: counts and largest ids are summed in
   the task and then by Spark, so a line in a third of all documents is one row per task.
3. The doomed keys go to the documents that hold them, and these drop the lines.

A filter that is too small for its input makes more suspects, never a wrong result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.workspace import written

# Bits of a filter: at least 2**18, twelve for each expected line, at most this many (16 MB).
MOST_BITS = 1 << 27
BITS_PER_LINE, CHARS_PER_LINE = 12, 100
HASHES = 4
# Tasks that fill filters, so that what meets is bounded; bytes of a segment; suspects summed at a time.
BUILDERS = 512
SEGMENT = 1 << 13
SUMMED = 100_000


def line_key(line: bytes) -> bytes:
    """Stripped of ASCII white space, A-Z lower-cased (bytes methods do just that)."""
    return line.strip().lower()


def keys_of(text: str | None, least: int) -> list[bytes]:
    """The key of every line, empty where it has fewer than ``least`` code points."""
    out = []
    for line in (text or "").encode("utf-8").split(b"\n"):
        key = line_key(line)
        if len(key) < least or len(key) < 4 * least and len(key.decode("utf-8")) < least:
            key = b""
        out.append(key)
    return out


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of 64-bit hashes, a row for each: double hashing over a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return (hashes[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(bits - 1)


def _set(bitmap: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))


def _has(bitmap: np.ndarray, probes: np.ndarray) -> np.ndarray:
    found = (bitmap[probes >> np.uint64(3)] >> (probes & np.uint64(7)).astype(np.uint8)) & 1
    return found.all(axis=1)


def _distinct_hashes(texts: Iterator[str | None], least: int) -> np.ndarray:
    """A hash for every document and distinct key in it."""
    found: list[int] = []
    for text in texts:
        found.extend({xxhash.xxh3_64_intdigest(k) for k in keys_of(text, least) if k})
    return np.array(found, dtype=np.uint64)


def _fill(bits: int, least: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            hashes = _distinct_hashes(batch.column(0).to_pylist(), least)
            if not len(hashes):
                continue
            own, counts = np.unique(hashes, return_counts=True)
            probes = _probes(own, bits)
            _set(twice, probes[_has(once, probes) | (counts > 1)].ravel())
            _set(once, probes.ravel())
        for i in range(0, bits // 8, SEGMENT):
            if once[i : i + SEGMENT].any():
                yield pa.RecordBatch.from_pydict(
                    {
                        "segment": pa.array([i // SEGMENT], pa.int32()),
                        "once": [zlib.compress(once[i : i + SEGMENT].tobytes(), 1)],
                        "twice": [zlib.compress(twice[i : i + SEGMENT].tobytes(), 1)],
                    }
                )

    return fill


def _meet(table: pa.Table) -> pa.Table:
    """One segment of the joint second filter."""
    once = np.zeros(SEGMENT, np.uint8)
    twice = np.zeros(SEGMENT, np.uint8)
    for o, t in zip(table.column("once").to_pylist(), table.column("twice").to_pylist(), strict=True):
        own = np.frombuffer(zlib.decompress(o), np.uint8)
        twice |= np.frombuffer(zlib.decompress(t), np.uint8) | (once & own)
        once |= own
    return pa.table(
        {"segment": table.column("segment")[:1], "twice": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())}
    )


def seen_twice(docs: DataFrame, text: str, least: int) -> tuple[bytes, int]:
    """The joint second filter, compressed, and its number of bits. It is bounded by ``MOST_BITS``."""
    chars = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    wanted = max(1 << 18, BITS_PER_LINE * chars // CHARS_PER_LINE)
    bits = min(MOST_BITS, 1 << (int(wanted) - 1).bit_length())
    parts = (
        docs.select(text)
        .coalesce(BUILDERS)
        .mapInArrow(_fill(bits, least), "segment int, once binary, twice binary")
    )
    joint = np.zeros(bits // 8, np.uint8)
    for row in parts.groupBy("segment").applyInArrow(_meet, "segment int, twice binary").toLocalIterator():
        at = row.segment * SEGMENT
        joint[at : at + SEGMENT] = np.frombuffer(zlib.decompress(row.twice), np.uint8)
    return zlib.compress(joint.tobytes(), 1), bits


def _suspects(filter_, bits: int, least: int):
    """(digest of the key, documents, largest id) summed in the task, and which documents hold them."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joint = np.frombuffer(zlib.decompress(filter_.value), np.uint8)
        for batch in batches:
            keys, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = {k for k in keys_of(text, least) if k}
                keys.extend(own)
                rows.extend([i] * len(own))
            if not keys:
                continue
            hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
            hit = np.flatnonzero(_has(joint, _probes(hashes, bits)))
            if len(hit):
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).take(pa.array([rows[j] for j in hit])),
                        "key": pa.array([xxhash.xxh3_128_digest(keys[j]) for j in hit], pa.binary()),
                    }
                )

    return look


def _rewrite(least: int):
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, gone in zip(batch.column("_text").to_pylist(), batch.column("_gone").to_pylist(), strict=True):
                lines = (text or "").encode("utf-8").split(b"\n")
                stay = lines
                if gone:
                    lost = set(gone)
                    stay = [
                        line
                        for line, k in zip(lines, keys_of(text, least), strict=True)
                        if not (k and xxhash.xxh3_128_digest(k) in lost)
                    ]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay).decode("utf-8"))
            columns = {n: batch.column(n) for n in batch.schema.names if n not in ("_text", "_gone")}
            columns |= {
                "_n_lines": pa.array(n_lines, pa.int64()),
                "_n_dropped": pa.array(n_dropped, pa.int64()),
                "_kept": pa.array(kept, pa.string()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return rewrite


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 20, documents: int = 3
) -> DataFrame:
    """(``_row``, ``_n_lines``, ``_n_dropped``, ``_kept``): the other columns of every row of ``docs`` as a
    struct, the number of its lines, how many of them go, and the text that stays.

    Lines are split at ``\\n``; null and empty texts are one empty line. A line whose key (stripped,
    lower-cased) has ``least`` code points and is in ``documents`` rows or more goes from all
    documents but the one with the largest id; null is the smallest id, and rows that share that id
    all keep it. No rows give no rows; columns of any name pass through in ``_row``.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    joint, bits = seen_twice(narrow, "text", least)
    filter_ = spark.sparkContext.broadcast(joint)
    held = written(
        narrow.mapInArrow(_suspects(filter_, bits, least), f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, key binary"),
        "suspects",
    )
    doomed = written(
        held.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= documents)
        .select("key", "keeper"),
        "doomed",
    )
    # written, so that the join deals out both sides anew and a frequent line can be split
    gone = (
        held.join(doomed, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("_gone"))
        .withColumnRenamed("doc_id", "_id")
    )
    # all suspects of one document: bounded by its lines
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_row"),
        F.col(doc_id).alias("_doc_id"),
        F.col(text).alias("_text"),
    )
    joined = packed.join(gone, F.col("_doc_id").eqNullSafe(F.col("_id")), "left").select("_row", "_text", "_gone")
    row = packed.schema["_row"].dataType.simpleString()
    return joined.mapInArrow(_rewrite(least), f"_row {row}, _n_lines long, _n_dropped long, _kept string")


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """``docs`` with the lines dropped that ``dedup_lines`` drops. Same rows and columns."""
    done = dedup_lines(docs, doc_id, text, **limits)
    return done.select(
        *[F.col("_kept" if c == text else f"_row.`{c}`").alias(c) for c in docs.columns]
    )


def line_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept, kept_sha256`` of every row, by ``dedup_lines``."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return dedup_lines(narrow).select(
        F.col("_row.doc_id").alias("doc_id"),
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.col("_kept").alias("kept"),
        F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"),
    )


# The same in SQL, by counting every line.
ORACLE = """
WITH lines AS (
  SELECT doc_id, row_no, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_no FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT row_no) >= 3),
judged AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.keeper AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id, row_no
"""
