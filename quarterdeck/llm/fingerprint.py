"""Order MinHash fingerprints of documents, in DataFrame functions only.

A document is the sequence of its k-word windows. The o-th occurrence of a window is an element
of its own, so repeats count. Every element has a random rank; the ranks are dealt into
``2 ** bits`` buckets by their leading bits (one permutation for all buckets, as in one-permutation
MinHash) and each bucket keeps its ``tuple_size`` smallest. The kept windows of a bucket, in text
order, are hashed into the bucket's entry: two documents share an entry when they have the same
minimal windows in the same order, which is what ties the share of equal entries to the edit
distance rather than to the overlap of the sets alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterdeck.llm.text import let, whole, words

# An element is one long: 34 bits of hash above 30 bits of position. A text has fewer than 2**30
# words, as a row holds less than 2**31 bytes.
POSITION_BITS = 30


def _packed(value: Column, position: Column) -> Column:
    high = F.shiftleft(F.shiftrightunsigned(value, POSITION_BITS), POSITION_BITS)
    return high.bitwiseOR(position.cast("long"))


def _position(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")


def window_hashes(text: Column, k: int) -> Column:
    """A 34-bit hash of every window of ``k`` words, in order; of the whole sequence if it is
    shorter; nothing without words."""

    def windows(h: Column) -> Column:
        n = F.size(h)
        return (
            F.when(n == 0, F.expr("cast(array() as array<bigint>)"))
            .when(n <= k, F.array(F.xxhash64(h)))
            .otherwise(
                F.transform(
                    F.sequence(F.lit(0), n - k),
                    lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]),
                )
            )
        )

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.transform(let(hashed, windows), lambda h: F.shiftrightunsigned(h, POSITION_BITS))


def _ranked(hashes: Column) -> Column:
    """Random ranks of the (window, occurrence) pairs, each with its position in the text."""

    def numbered(s: Column) -> Column:
        # s is sorted, so equal windows are neighbours, in text order
        same = lambda j: F.shiftright(F.get(s, j), POSITION_BITS)
        heads = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1), lambda j: (j == 0) | (same(j) != same(j - 1))
        )
        return let(
            heads,
            lambda head: F.flatten(
                F.transform(
                    head,
                    lambda a, r: F.transform(
                        F.slice(s, a + 1, F.coalesce(F.get(head, r + 1), F.size(s)) - a),
                        lambda x, o: _packed(
                            F.xxhash64(F.shiftrightunsigned(x, POSITION_BITS), o), _position(x)
                        ),
                    ),
                )
            ),
        )

    once = F.transform(hashes, lambda h, i: _packed(F.xxhash64(h, F.lit(0)), i))
    several = let(
        F.sort_array(
            F.transform(
                hashes, lambda h, i: F.shiftleft(h, POSITION_BITS).bitwiseOR(i.cast("long"))
            )
        ),
        numbered,
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), once).otherwise(several)


def order_minhash(text: Column, k: int = 5, tuple_size: int = 2, bits: int = 6) -> Column:
    """The entries of a text's fingerprint: array<string>, one of eight hex digits (bucket, hash)
    for each bucket that holds anything, in bucket order. Null and texts without words: empty."""
    bucket = lambda x: F.shiftright(x, 64 - bits)

    def entries(h: Column) -> Column:
        def kept(p: Column) -> Column:
            return F.filter(
                p,
                lambda x, j: F.coalesce(bucket(F.get(p, j - tuple_size)) != bucket(x), F.lit(True)),
            )

        def hashed(c: Column) -> Column:
            heads = F.filter(
                F.sequence(F.lit(0), F.size(c) - 1),
                lambda j: (j == 0) | (bucket(F.get(c, j)) != bucket(F.get(c, j - 1))),
            )

            def entry(head: Column, a: Column, r: Column) -> Column:
                own = F.slice(c, a + 1, F.coalesce(F.get(head, r + 1), F.size(c)) - a)
                places = F.sort_array(F.transform(own, _position))
                value = F.xxhash64(F.transform(places, lambda q: F.get(h, q)))
                number = F.shiftrightunsigned(F.get(c, a), 64 - bits)
                return F.concat(
                    F.lpad(F.hex(number), 2, "0"),
                    F.lpad(F.hex(F.shiftrightunsigned(value, 40)), 6, "0"),
                )

            return let(heads, lambda head: F.transform(head, lambda a, r: entry(head, a, r)))

        ranked = let(F.sort_array(_ranked(h)), kept)
        return F.when(F.size(h) == 0, F.expr("cast(array() as array<string>)")).otherwise(
            let(ranked, hashed)
        )

    return let(window_hashes(text, k), entries)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among the buckets that either fingerprint fills, 0 to 1. Two empty
    fingerprints are alike."""
    places = lambda e: F.transform(e, lambda x: F.substring(x, 1, 2))
    filled = F.size(F.array_union(places(a), places(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def with_next(
    docs: DataFrame, doc_id: str, text: str, derived: dict[str, Column]
) -> DataFrame:
    """(doc_id, text, derived..., next_text, next_...): every document beside the one that follows
    it by ascending id (then text; nulls first), the first one following the last.

    Ids are dealt into about sqrt(n) blocks of equal width. Texts move once, to the window over
    their block; only the first document of each block, sqrt(n) in all, moves besides.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    n, low, high = base.agg(
        F.count(F.lit(1)), F.min("doc_id").cast("double"), F.max("doc_id").cast("double")
    ).first()
    low, high = low or 0.0, high or 0.0
    width = max(1.0, (high - low + 1) / max(1, math.isqrt(n)))
    block = F.coalesce(
        F.floor((F.col("doc_id").cast("double") - low) / width).cast("long"), F.lit(-1)
    )
    base = base.select(block.alias("block"), "doc_id", "text")

    heads = base.groupBy("block").agg(F.min("doc_id").alias("head"))  # sqrt(n) rows
    first = (
        base.join(F.broadcast(heads.withColumnRenamed("block", "head_block")),
                  (F.col("block") == F.col("head_block")) & F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("block")
        .agg(F.min(F.struct("text")).alias("first"))
    )
    follows = heads.select(
        F.col("block").alias("before"),
        F.coalesce(
            F.lead("block").over(W.orderBy("block")), F.min("block").over(W.partitionBy())
        ).alias("block"),
    )
    ends = follows.join(first, "block").select(
        F.col("before").alias("block"), F.col("first.text").alias("text")
    )
    ends = ends.select(
        "block",
        F.struct(F.col("text"), *[c.alias(name) for name, c in derived.items()]).alias("_end"),
    )

    order = W.partitionBy("block").orderBy("doc_id", "text")
    own = base.select("*", *[c.alias(name) for name, c in derived.items()])
    after = F.lead(F.struct("text", *derived)).over(order)
    placed = own.withColumn("_next", after)
    joined = placed.join(ends, "block", "left").withColumn(
        "_next", F.coalesce("_next", "_end")
    )
    return joined.select(
        "doc_id",
        "text",
        *derived,
        F.col("_next.text").alias("next_text"),
        *[F.col(f"_next.{name}").alias(f"next_{name}") for name in derived],
    )


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, tuple_size: int = 2
) -> DataFrame:
    """The fingerprint of every text and of its edited text, and their likeness.

    The edited text is the first part of the document with its last ``n_chars // 2`` code points
    replaced by the first as many (or all) of the next document. One row per row of ``docs``:
    ``doc_id, n_chars, edited, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. Null texts count as empty, repeated ids follow each other by text, null ids come
    first, other columns are ignored, and no rows give no rows.
    """
    entries = lambda t: order_minhash(t, k, tuple_size)
    pairs = with_next(docs, doc_id, text, {"entries": entries(F.col("text"))})
    n = F.char_length(whole(F.col("text")))
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(whole(F.col("text")), F.lit(1), n - half),
        F.substring(whole(F.col("next_text")), F.lit(1), half),
    )
    changed = pairs.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "entries", "next_entries")
    both = changed.withColumn("edited_entries", entries(F.col("edited")))
    return both.select(
        "doc_id",
        "n_chars",
        "edited",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("entries", "").alias("fingerprint"),
        F.array_join("edited_entries", "").alias("edited_fingerprint"),
        likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"),
        likeness(F.col("entries"), F.col("next_entries")).alias("near_next"),
    )
