"""Near duplicates by an LSH forest of MinHash signatures, confirmed on whole shingle sets.

1. Every text becomes its shingle set's digest and the numbers of its regions (below), from
   ``TREES * DEPTH`` MinHash values. Texts with the same set are one class from here on. Most classes
   share no region with another. A Bloom filter of the shared ones tells them apart in the task; only of
   the rest are values and a finer sketch made and kept, from their texts once more.
2. Each tree sorts the classes by its own ``DEPTH`` values. A class's first candidates are its neighbours
   in that order, which have the longest prefixes in common with it. Classes that share no prefix of
   three values with another are in no region of the tree and drop out of it; a crowded region is
   dealt out by deeper prefixes, as deep as it takes.
3. Signatures rule out candidates far below the threshold; the rest are compared on their texts' full
   shingle sets, and the links that hold make connected components. Their texts are picked out by a
   Bloom filter too, so that on any input few others travel.
4. Neighbours join a group whose members are alike; a group of near copies need not be, such as copies
   that are near one original only. So in every region that still holds several components, the
   classes of different ones are compared by sketch, block against block, once for all regions that
   hold the same classes: first the likeliest of each
   class are confirmed, then, between the components that are left, all that may be linked.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.components import components
from quarterdeck.llm.line_dedup import SEGMENT, _has, _probes, _set
from quarterdeck.llm.shingles import digest, minhashes, mix, shingle_sets
from quarterdeck.workspace import written

TREES, DEPTH = 16, 8
# Depth of a region's prefix; of the prefixes that crowded regions are dealt out by, where they hold more
# classes than CROWD.
REGION_DEPTH, DEEPER, CROWD = 3, (5, 8), 1 << 16
# Places before a class in a tree's order whose classes are its candidates; as every class has one after
# it too, this is a neighbour on either side, in each tree.
NEIGHBOURS = 1
# Classes of a block of a region, and likeliest classes of other components that each class of a block
# is compared with before all that are left.
REGION = 512
LEADERS = 1
# Bins of the sketch by which blocks are compared.
BINS = 512
# Bits of a filter: these for each key, in a power of two, within these bounds (16 MB at most). A fuller filter
# lets more rows through; what it lets through wrongly meets nothing later.
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 24, 1 << 18, 1 << 27
# Standard errors of the signature's estimate that a candidate may be below the threshold.
SLACK = 4.5
# Texts at a time, by characters; texts that one text is compared with in one chunk, on average.
BLOCK, CHUNK = 1 << 19, 64
NO_ID = -(1 << 63)


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= BLOCK):
            size += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def _classed(k: int, text: str):
    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_row").field(text).to_pylist()
            for i, j in _blocks(texts):
                sets = shingle_sets(texts[i:j], k)
                full = [s for s in sets if len(s)]
                at = iter(regions(minhashes(full, TREES * DEPTH).reshape(-1, TREES, DEPTH)) if full else ())
                yield pa.RecordBatch.from_pydict(
                    {
                        "_row": batch.column("_row").slice(i, j - i),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "digest": pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                        "regions": pa.array([next(at) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    }
                )

    return classed


def _signed(k: int, text: str):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_row").field(text).to_pylist()
            for i, j in _blocks(texts):
                sets = shingle_sets(texts[i:j], k)
                full = [s for s in sets if len(s)]
                rows = iter(minhashes(full, TREES * DEPTH)) if full else iter(())
                yield pa.RecordBatch.from_pydict(
                    {
                        "_row": batch.column("_row").slice(i, j - i),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "digest": pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                        "sig": pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                        "sketch": pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                    }
                )

    return signed


def sketch(hashes: np.ndarray) -> bytes:
    """A byte for each of ``BINS`` ranges of hashes: a hash of the least of a sorted set there, 0 for none.
    The share of equal bytes among those that either set fills estimates the sets' likeness."""
    spread = np.sort(mix(hashes))
    bounds = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
    first = np.searchsorted(spread, bounds)
    stop = np.append(first[1:], len(spread))
    least = spread[np.minimum(first, len(spread) - 1)]
    return np.where(first < stop, least % np.uint64(255) + np.uint64(1), 0).astype(np.uint8).tobytes()


def regions(sig: np.ndarray) -> np.ndarray:
    """The region of every tree (columns) for signatures by tree and depth (rows)."""
    key = np.broadcast_to(mix(np.arange(1, TREES + 1, dtype=np.uint64)), (len(sig), TREES))
    for d in range(REGION_DEPTH):
        key = mix(key ^ (sig[:, :, d].astype(np.uint64) + np.uint64(d << 40)))
    return key.view(np.int64)


def _hashes(keys: pa.Array) -> np.ndarray:
    """The 64 bits by which a filter knows a region or a digest; both are hashes themselves."""
    if pa.types.is_binary(keys.type):
        return np.frombuffer(b"".join(keys.to_pylist()), np.uint64)[::2]
    return keys.to_numpy().view(np.uint64)


def _fill(bits: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            _set(bitmap, _probes(_hashes(batch.column(0)), bits).ravel())
        for i in range(0, len(bitmap), SEGMENT):
            if bitmap[i : i + SEGMENT].any():
                packed = zlib.compress(bitmap[i : i + SEGMENT].tobytes(), 1)
                yield pa.RecordBatch.from_pydict({"segment": pa.array([i // SEGMENT], pa.int32()), "bits": [packed]})

    return fill


def _either(table: pa.Table) -> pa.Table:
    """One segment of the filters of all tasks."""
    joint = np.zeros(SEGMENT, np.uint8)
    for packed in table.column("bits").to_pylist():
        joint |= np.frombuffer(zlib.decompress(packed), np.uint8)
    return pa.table({"segment": table.column("segment")[:1], "bits": pa.array([zlib.compress(joint.tobytes(), 1)], pa.binary())})


def filter_of(keys: DataFrame) -> Broadcast:
    """A Bloom filter of the one column of a written table, regions or digests, as compressed bytes."""
    bits = min(MOST_BITS, 1 << (max(LEAST_BITS, BITS_PER_KEY * keys.count()) - 1).bit_length())
    joint = np.zeros(bits // 8, np.uint8)
    parts = keys.mapInArrow(_fill(bits), "segment int, bits binary").groupBy("segment")
    for row in parts.applyInArrow(_either, "segment int, bits binary").collect():
        at = row.segment * SEGMENT
        joint[at : at + SEGMENT] = np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return keys.sparkSession.sparkContext.broadcast(zlib.compress(joint.tobytes(), 1))


def _looked_up(held: Broadcast) -> Callable[[pa.Array], np.ndarray]:
    """Which of some keys may be among those of a filter."""
    bitmap = np.frombuffer(zlib.decompress(held.value), np.uint8)
    return lambda keys: _has(bitmap, _probes(_hashes(keys), 8 * len(bitmap)))


def _firsts(digests: pa.Array, among: np.ndarray) -> list[int]:
    """The first row of each digest among some rows of a batch."""
    seen: dict[bytes, int] = {}
    for i in np.flatnonzero(among).tolist():
        seen.setdefault(digests[i].as_py(), i)
    return list(seen.values())


def _nearby(k: int, shared: Broadcast):
    def nearby(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Size, signature and sketch of each class of a batch that may share a region."""
        has = _looked_up(shared)
        for batch in batches:
            maybe = has(batch.column("regions").flatten()).reshape(-1, TREES).any(axis=1)
            texts = batch.column("text").take(pa.array(_firsts(batch.column("digest"), maybe), pa.int64()))
            rows = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([texts], ["text"])], ["_row"])
            for signed in _signed(k, "text")([rows]):
                yield signed.select(["digest", "n", "sig", "sketch"])

    return nearby


def _picked(wanted: Broadcast):
    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows whose digest may be wanted, one for each digest of a batch."""
        has = _looked_up(wanted)
        for batch in batches:
            yield batch.take(pa.array(_firsts(batch.column("digest"), has(batch.column("digest"))), pa.int64()))

    return picked


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each tree of each class: its region there, its path through the tree as bytes that sort
    like the values, and a byte of each of its values, enough to estimate a likeness."""
    for batch in batches:
        n = batch.num_rows
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(n, TREES, DEPTH)
        path = np.frombuffer(sig.astype(">u4").tobytes(), f"S{4 * DEPTH}")
        whole = path.tobytes()
        of = pa.array(np.repeat(np.arange(n), TREES))
        yield pa.RecordBatch.from_pydict(
            {
                "digest": batch.column("digest").take(of),
                "region": pa.array(regions(sig).ravel()),
                "path": pa.array([whole[i : i + 4 * DEPTH] for i in range(0, len(whole), 4 * DEPTH)], pa.binary()),
            }
        )


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, TREES * DEPTH).astype(np.uint8)
        yield pa.RecordBatch.from_pydict(
            {"digest": batch.column("digest"), "sig": pa.array([s.tobytes() for s in sig], pa.binary())}
        )


def _beside(threshold: float):
    many = TREES * DEPTH
    least = threshold - SLACK * np.sqrt(threshold * (1 - threshold) / many)

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of neighbours in a sorted region whose signatures may reach the threshold, smaller digest
        first. Only the last places are held from batch to batch."""
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch.select(["part", "digest", "sig"])])
            new = 0 if held is None else held.num_rows
            rows = rows if held is None else pa.concat_tables([held, rows])
            held = rows.slice(max(0, rows.num_rows - NEIGHBOURS))
            part, digests = rows.column("part").to_numpy(), rows.column("digest").to_pylist()
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(-1, many)
            pairs = set()
            for back in range(1, NEIGHBOURS + 1):
                same = np.flatnonzero(part[back:] == part[:-back]) + back
                same = same[same >= new]
                alike = ((sig[same] == sig[same - back]).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
                for i in same[alike >= least].tolist():
                    x, y = digests[i], digests[i - back]
                    pairs.add((min(x, y), max(x, y)))
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())}
            )

    return beside


def _confirmed(k: int, percent: int):
    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of chunks, one text (without ``b``) and then those it is compared with, the pairs that are linked."""
        chunk, one = None, None
        for batch in batches:
            chunks, a, b = (batch.column(c).to_pylist() for c in ("chunk", "a", "b"))
            texts = batch.column("text")
            found: list[int] = []
            start = 0
            while start < len(texts):
                some: list[str] = []
                size = 0
                while start + len(some) < len(texts) and (not some or size < BLOCK):
                    some.append(texts[start + len(some)].as_py())
                    size += len(some[-1])
                for i, own in enumerate(shingle_sets(some, k), start):
                    if b[i] is None:
                        chunk, one = chunks[i], own
                    elif chunk == chunks[i] and 100 * min(len(one), len(own)) >= percent * max(len(one), len(own)):
                        both = len(np.intersect1d(one, own, assume_unique=True))
                        if 100 * both >= percent * (len(one) + len(own) - both):
                            found.append(i)
                start += len(some)
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([a[i] for i in found], pa.binary()), "b": pa.array([b[i] for i in found], pa.binary())}
            )

    return confirmed


def shared_regions(classes: DataFrame) -> DataFrame:
    """(region) of the regions that several of the ``classes`` (digest, regions) have."""
    each = classes.select(F.explode("regions").alias("region"))
    return written(each.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("region"), "shared")


def placed(classes: DataFrame) -> DataFrame:
    """(digest, region, path, part, sig): a row for each tree of each class that shares a region there.
    ``part`` is the region, or where that is crowded its part by the shallowest deeper prefix that
    is not, or by the deepest."""
    places = written(
        classes.select("digest", "sig").mapInArrow(_places, "digest binary, region long, path binary"), "places"
    )
    count = F.count(F.lit(1)).alias("n")
    shared = written(places.groupBy("region").agg(count).where("n > 1"), "regions")
    rows = written(places.join(shared, "region").withColumn("part", F.col("region")), "crowded")
    for depth in DEEPER:
        full = rows.where(F.col("n") > CROWD)
        if full.isEmpty():
            break
        parts = full.drop("n").withColumn("part", F.xxhash64("region", F.substring("path", 1, 4 * depth)))
        sizes = written(parts.groupBy("part").agg(count), "parts")
        rows = written(rows.where(F.col("n") <= CROWD).unionByName(parts.join(sizes, "part")), "dealt")
    short = classes.select("digest", "sig").join(rows.select("digest").distinct(), "digest", "left_semi")
    short = written(short.mapInArrow(_shortened, "digest binary, sig binary"), "short")
    return written(rows.drop("n").join(short, "digest"), "placed")


def candidates(place: DataFrame, percent: int) -> DataFrame:
    """(a, b) of digests, a < b, without repeats: neighbours in the trees' orders."""
    order = place.select("part", "path", "digest", "sig").repartition("part").sortWithinPartitions("part", "path", "digest")
    return written(order.mapInArrow(_beside(percent / 100), "a binary, b binary").distinct(), "candidates")


def _rows(groups: np.ndarray) -> list[tuple[int, int]]:
    ends = [*(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)]
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _apart(threshold: float, most: int | None):
    def likeness(a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Estimates for all of ``a`` with all of ``b``, whose sets have ``m`` and ``n`` members; -1 where the
        threshold is out of reach. The bins that either set fills are a sample of the union without
        repeats: the more of it they hold, the less the estimate can err."""
        step = max(1, (1 << 15) // len(b))
        same = np.concatenate(
            [((a[at : at + step, None] == b[None]) & (b != 0)[None]).sum(axis=2, dtype=np.int32) for at in range(0, len(a), step)]
        )
        filled = np.maximum(BINS - (a == 0).astype(np.float32) @ (b == 0).astype(np.float32).T, 1)
        alike = (same / filled - 1 / 255) / (1 - 1 / 255)
        union = (m[:, None] + n[None]) / (1 + threshold)  # at most, for linked sets
        unseen = np.clip((union - filled) / np.maximum(union - 1, 1), 0, 1)
        error = np.sqrt((threshold * (1 - threshold) * unseen + (1 - threshold) / 255) / filled)
        close = np.minimum(m[:, None], n[None]) >= threshold * np.maximum(m[:, None], n[None])
        return np.where(close & (alike >= threshold - SLACK * error), alike, -1)

    def best(alike: np.ndarray) -> np.ndarray:
        if most is None or alike.shape[1] <= most:
            return alike >= 0
        bar = np.partition(alike, alike.shape[1] - most, axis=1)[:, -most]
        return (alike >= bar[:, None]) & (alike >= 0)

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        sig = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
        digests = rows.column("digest").to_pylist()
        component, group, size = (rows.column(c).to_numpy() for c in ("component", "group", "size"))
        left, right = (rows.column(c).to_numpy().astype(bool) for c in ("is_left", "is_right"))
        for i, j in _rows(group):
            x, y = i + np.flatnonzero(left[i:j]), i + np.flatnonzero(right[i:j])
            if not len(x) or not len(y):
                continue
            alike = likeness(sig[x], sig[y], size[x], size[y])
            alike = np.where(component[x][:, None] == component[y][None], -1, alike)
            found = set()
            for u, v in zip(*np.nonzero(best(alike) | best(alike.T).T), strict=True):
                a, b = digests[x[u]], digests[y[v]]
                found.add((min(a, b), max(a, b)))
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([p[0] for p in found], pa.binary()), "b": pa.array([p[1] for p in found], pa.binary())}
            )

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Likely pairs of different components among the rows of a group, which follow one another."""
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows:
                groups = held.column("group").to_numpy()
                whole_until = _rows(groups)[-1][0]
                yield from pairs(held.slice(0, whole_until))
                held = held.slice(whole_until)
        if held is not None:
            yield from pairs(held)

    return apart


def rest(place: DataFrame, sketches: DataFrame, of: DataFrame, percent: int, most: int | None) -> DataFrame:
    """(a, b) of digests, a < b, without repeats: pairs that share a region and lie in different
    components by ``of`` (digest, component). For each class of two blocks the ``most`` that are likeliest
    by ``sketches`` (digest, sketch, size), or all that may reach the threshold.

    A region's largest component and its other classes are dealt into blocks of ``REGION`` rows
    on average; every block of other classes meets every block, and no class its own component. Near copies
    share many regions: of those with the same classes, one is compared.
    """
    top = "region"
    at = written(place.select("digest", top).join(of, "digest"), "members")
    # 128 bits that tell sets of classes apart
    marks = {"x": F.xxhash64("digest"), "y": F.xxhash64(F.lit(1), "digest")}
    by_component = at.groupBy(top, "component").agg(
        F.count(F.lit(1)).alias("n"), *(F.bit_xor(mark).alias(c) for c, mark in marks.items())
    )
    held = by_component.groupBy(top).agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.max("n").alias("n_main"),
        F.sum("n").alias("n"),
        *(F.bit_xor(c).alias(c) for c in marks),
    )
    same = ["main", "n_main", "n", *marks]
    parts = lambda n: F.ceil(n / REGION).cast("long")
    still = written(
        held.where("n > n_main").groupBy(*same).agg(F.min(top).alias(top)).select(top, "main", parts(F.col("n") - F.col("n_main")).alias("others"), parts(F.col("n_main")).alias("mains")),
        "open",
    )
    is_main = F.col("component") == F.col("main")
    dealt = lambda n: F.pmod(F.xxhash64("digest"), F.col(n))
    own = F.when(is_main, F.col("others") + dealt("mains")).otherwise(dealt("others"))
    last = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    rows = (
        at.join(still, top)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .select(
            "digest",
            "component",
            F.xxhash64(top, F.least("own", "other"), F.greatest("own", "other")).alias("group"),
            (F.col("own") <= F.col("other")).alias("is_left"),
            (F.col("own") >= F.col("other")).alias("is_right"),
        )
        .join(sketches, "digest")
    )
    found = rows.repartition("group").sortWithinPartitions("group").mapInArrow(_apart(percent / 100, most), "a binary, b binary")
    return written(found.distinct(), "rest")


def link(pairs: DataFrame, signed: DataFrame, k: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) of digests whose full sets, from ``signed`` (digest, text), are linked."""
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct(), "wanted")
    # not written: they come dealt out by digest, as the join below wants them
    texts = (
        signed.where("digest IS NOT NULL")
        .mapInArrow(_picked(filter_of(wanted)), "digest binary, text string")
        .groupBy("digest")
        .agg(F.min("text").alias("text"))
    )
    # a text that is in many pairs goes to each chunk of them once, not with every pair
    many = written(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "compared-with")
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / CHUNK))
    chunked = written(
        pairs.join(many, "a").select(F.xxhash64("a", part).alias("chunk"), "a", "b"), "chunks"
    )
    ones = chunked.select("chunk", "a").distinct().select("chunk", "a", F.lit(None).cast("binary").alias("b"), F.col("a").alias("digest"))
    rows = ones.unionAll(chunked.select("chunk", "a", "b", F.col("b").alias("digest"))).join(texts, "digest").drop("digest")
    order = rows.repartition("chunk").sortWithinPartitions("chunk", "a", F.asc_nulls_first("b"))
    return written(order.mapInArrow(_confirmed(k, percent), "a binary, b binary"), "linked")


def _components(links: DataFrame, ids: DataFrame) -> DataFrame:
    """(digest, component) of all of ``ids`` (digest, id)."""
    edges = (
        links.join(ids.select(F.col("digest").alias("a"), F.col("id").alias("id_a")), "a")
        .join(ids.select(F.col("digest").alias("b"), F.col("id").alias("id_b")), "b")
        .select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    )
    groups = written(components(edges), "components").withColumnRenamed("node", "id")
    return written(
        ids.join(groups, "id", "left").select("digest", F.coalesce("component", "id").alias("component")), "named"
    )


def grouped(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80,
    with_text: bool = True,
) -> DataFrame:
    """(``_row``, ``n``, ``component``): every row of ``docs`` as a struct, the size of its shingle set, and
    the smallest id of its component. Without ``with_text`` the struct lacks the text, which then does
    not travel to meet the components.

    Words are lower-cased (A-Z); a text with fewer than ``k`` words has one shingle, its whole
    sequence; null texts and texts without words have none and are linked with nothing. Sets are
    linked when 100 * intersection >= ``percent`` * union. Rows of one id are one document; null ids
    are one id below all others. Columns of any name pass through; no rows give no rows.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    row = packed.schema["_row"].dataType.simpleString()
    signed = written(
        packed.mapInArrow(_classed(k, text), f"_row {row}, n long, digest binary, regions array<bigint>"), "signed"
    )
    own = F.coalesce(F.col("_row")[doc_id].cast("long"), F.lit(NO_ID))
    classes = written(
        signed.where("n > 0")
        .select("digest", own.alias("id"), "regions")
        .groupBy("digest")
        .agg(F.min("id").alias("id"), F.min("regions").alias("regions")),
        "classes",
    )
    near = written(
        signed.where("n > 0")
        .select("digest", "regions", F.col("_row")[text].alias("text"))
        .mapInArrow(_nearby(k, filter_of(shared_regions(classes))), "digest binary, n long, sig binary, sketch binary")
        .groupBy("digest")
        .agg(F.min("sig").alias("sig"), F.min("sketch").alias("sketch"), F.min("n").alias("size")),
        "near",
    )
    texts = signed.select("digest", F.col("_row")[text].alias("text"))
    ids = classes.select("digest", "id")
    place = placed(near)
    compared = candidates(place, percent)
    links = link(compared, texts, k, percent)
    of = _components(links, ids)
    for most in (LEADERS, None):
        more = written(rest(place, near.select("digest", "sketch", "size"), of, percent, most).join(compared, ["a", "b"], "left_anti"), "more")
        if more.isEmpty():
            continue
        compared = compared.unionAll(more)
        found = link(more, texts, k, percent)
        if not found.isEmpty():
            links = links.unionAll(found)
            of = _components(links, ids)
    named = of.withColumnRenamed("digest", "_digest")
    carried = [F.col("_row")[c].alias(c) for c in docs.columns if with_text or c != text]
    joined = signed.select(F.struct(*carried).alias("_row"), "n", "digest").join(named, F.col("digest") == F.col("_digest"), "left")
    return joined.select("_row", "n", F.coalesce("component", own).alias("component"))


def near_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row, by ``grouped``."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    group = F.when(F.col("component") != NO_ID, F.col("component"))
    return grouped(narrow, percent=percent, with_text=False).select(
        F.col("_row.doc_id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        group.alias("component_id"),
        F.col("_row.doc_id").eqNullSafe(group).alias("kept"),
    )


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The row with the smallest id of every component of ``docs``, unchanged; rows that repeat an id
    stay or go together."""
    own = F.coalesce(F.col("_row")[doc_id].cast("long"), F.lit(NO_ID))
    return grouped(docs, doc_id, text, percent=percent).where(own == F.col("component")).select("_row.*")
