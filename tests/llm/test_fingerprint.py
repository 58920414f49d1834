from __future__ import annotations

import hashlib
import re
import struct
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from quarterdeck.llm.fingerprint import fingerprints, order_minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
M64 = (1 << 64) - 1


def chain(seed, *parts):
    for p in parts:
        data = p.encode() if isinstance(p, str) else struct.pack("<i" if p[1] == 4 else "<Q", p[0])
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def long(x):
    return (x & M64, 8)


def expected(text, k=5, size=2):
    """The entries straight from the definition, with no packing into longs."""
    words = [chain(42, w) for w in WORD.findall(text or "")]
    if not words:
        return ""
    runs = [words] if len(words) <= k else [words[i : i + k] for i in range(len(words) - k + 1)]
    windows = [chain(42, *map(long, r)) >> 30 for r in runs]
    seen, buckets = defaultdict(int), defaultdict(list)
    for place, w in enumerate(windows):
        rank = chain(42, long(w), (seen[w], 4)) >> 30
        seen[w] += 1
        buckets[rank >> 28].append((rank, place))
    out = []
    # ranks are compared as signed numbers, which orders the buckets and not what they hold
    for b in sorted(buckets, key=lambda b: b - 64 if b >= 32 else b):
        places = sorted(p for _, p in sorted(buckets[b])[:size])
        out.append(f"{b:02X}{chain(42, *[long(windows[p]) for p in places]) >> 40:06X}")
    return "".join(out)


def near(a, b):
    x, y = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (a, b))
    filled = {e[:2] for e in x | y}
    return len(x & y) / len(filled) if filled else 1.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + after[:half]
        f, g, h = expected(t), expected(e), expected(after)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, near(f, g), near(f, h)))
    return out


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def key(r):
    return tuple((x is not None, x) for x in r)


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id % 3 = 0 or n_chars > 9000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in fingerprints(docs).select(COLUMNS).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_edge_rows(spark):
    odd = [
        (5, "a b a b a b a b a b a b a b"), (5, None), (None, "x y"), (None, None), (7, ""), (9, "  \t\n "),
        (-3, "ж 漢字 😀 é è"), (7, ""), (2**62, "one " * 4000), (-(2**62), "one two three four five"),
    ]
    docs = spark.createDataFrame(odd, "doc_id long, text string").withColumn("entries", F.lit("clash")).withColumn("block", F.lit(1))
    got = [tuple(r) for r in fingerprints(docs).select(COLUMNS).collect()]
    assert sorted(got, key=key) == sorted(brute(odd), key=key)


def test_empty_and_single(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprints(docs).count() == 0
    one = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert fingerprints(one).first().near_next == 1.0


def test_order_matters_where_sets_agree(spark):
    words = [f"w{i}" for i in range(600)]
    blocks = [words[i : i + 60] for i in range(0, 600, 60)]
    swapped = [w for b in reversed(blocks) for w in b]
    df = spark.createDataFrame([(" ".join(words), " ".join(swapped), " ".join(words[:598]))], "a string, b string, c string")
    a, b, c = df.select(*[F.array_join(order_minhash(F.col(x)), "") for x in "abc"]).first()
    assert near(a, b) < 0.7 < 0.9 < near(a, c)


@pytest.mark.parametrize("parts", [1, 7])
def test_same_over_any_partitions(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).repartition(parts)
    assert fingerprints(docs).select(COLUMNS).distinct().count() == 40
