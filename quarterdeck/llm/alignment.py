"""Alignment of two tokenizers on the same bytes, by divide and conquer at shared cuts.

A cut is a byte offset at which tokens of both end. In an interval of tokens the cut nearest its middle
is found by bisecting one tokenizer's ends with the other's; both halves follow in the same way. An
interval without a cut inside is a group: its tokens only fit together as a whole.

Corpus statistics: a pair of ids counts once for each document that holds it linked. Documents are
aligned in blocks; a block keeps its documents' links as numbers of its distinct pairs, sends those
pairs to be counted, and gets the totals back. So links never travel one by one, and a block knows the
totals of its own pairs only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.tokenizing import encoder, pieces, token_bytes
from quarterdeck.workspace import written

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Code points of text at which a block is closed, and that are aligned at a time.
BLOCK, AT_ONCE = 1 << 23, 1 << 18
# Ends beside the middle of an interval that are looked up one by one.
NEAR = 32
SHIFT = 20  # a pair of ids is one number: the first id, then 20 bits for the second


def groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Past the last token of ``a``, and of ``b``, of each group, in order. ``a`` and ``b`` are the byte offsets
    at which tokens end, ascending, with equal last ones.

    All intervals of one depth are halved in step. The middle end of each is looked up among the
    other's; those that are no cut go on to the ends beside it, in both directions, until none is left.
    """
    low, high = np.zeros(min(len(a), 1), np.int64), np.full(min(len(a), 1), len(a), np.int64)
    done = []
    while len(low):
        # tokens low..high-1; a cut is an inner end, so it is one of low..high-2
        middle = (low + high - 1) // 2
        cut = np.full(len(low), -1)
        todo = np.flatnonzero(high - low > 1)
        step = 0
        while len(todo):
            for side in (step, -step) if step else (0,):
                at = middle[todo] + side
                inside = np.flatnonzero((at >= low[todo]) & (at < high[todo] - 1) & (cut[todo] < 0))
                end = a[at[inside]]
                hit = inside[b[np.searchsorted(b, end)] == end]
                cut[todo[hit]] = at[hit]
            step = step + 1 if step < NEAR else 2 * step
            if step > NEAR:  # far from the middle: all inner ends at once
                for t in todo[cut[todo] < 0].tolist():
                    ends = a[low[t] : high[t] - 1]
                    found = np.flatnonzero(b[np.searchsorted(b, ends)] == ends) + low[t]
                    if len(found):
                        cut[t] = found[np.abs(found - middle[t]).argmin()]
                break
            todo = todo[(cut[todo] < 0) & ((middle[todo] + step < high[todo] - 1) | (middle[todo] - step >= low[todo]))]
        whole = cut < 0
        done.append(high[whole])
        low, high, cut = low[~whole], high[~whole], cut[~whole] + 1
        low, high = np.stack([low, cut], 1).ravel(), np.stack([cut, high], 1).ravel()
    last = np.sort(np.concatenate([np.zeros(0, np.int64), *done]))
    return last, np.searchsorted(b, a[last - 1]) + 1


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of ``a`` and of ``b`` whose bytes overlap, every pair once; arguments as in
    `groups`. No token is empty."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.concatenate([[0], a[:-1]])
    first = np.searchsorted(b, starts, side="right")
    last = np.searchsorted(b, a, side="left")
    many = last - first + 1
    own = np.repeat(np.arange(len(a)), many)
    return own, np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)


class Aligner:
    """Both tokenizers of one worker."""

    def __init__(self, byte_level: str, sentence_pieces: str) -> None:
        self.a, self.a_bytes = encoder(byte_level, True), token_bytes(byte_level)
        self.b, self.b_bytes = pieces(sentence_pieces)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.most = max(len(self.a_bytes), len(self.b_bytes))
        # a token's text in a group's, by what follows it and its id
        self.written = [f"{i}{sign}" for sign in ",|;" for i in range(self.most)]

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids by both; none where their bytes are not a space and the text."""
        if not text:
            return [], []
        whole = " " + text
        a, b = self.a.ids_of(whole), self.b.encode(text)
        data = whole.encode()
        if b"".join(map(self.b_bytes.__getitem__, b)) != data or b"".join(map(self.a_bytes.__getitem__, a)) != data:
            return [], []
        return a, b

    def spelled(self, a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The texts of all tokens in the order of the groups' ids, ``a1,a2|b1;a3|b2,b3;``, and where each
        group ends."""
        of_a = np.repeat(np.arange(len(m)), np.diff(m, prepend=0))
        of_b = np.repeat(np.arange(len(n)), np.diff(n, prepend=0))
        codes = np.empty(len(a) + len(b), np.int64)
        sign = np.zeros(len(a), np.int64)
        sign[m - 1] = 1
        codes[np.arange(len(a)) + (n - np.diff(n, prepend=0))[of_a]] = sign * self.most + a
        sign = np.zeros(len(b), np.int64)
        sign[n - 1] = 2
        codes[np.arange(len(b)) + m[of_b]] = sign * self.most + b
        return list(map(self.written.__getitem__, codes.tolist())), m + n

    def align(self, texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray, str]]:
        """For each text: numbers of tokens of both, groups and links; the pair of every link; the groups'
        ids. Texts are aligned one after another as one, since their ends are cuts."""
        ids = [self.tokens(t) for t in texts]
        a, b = (np.fromiter(chain.from_iterable(both[k] for both in ids), np.int64) for k in (0, 1))
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        m, n = groups(end_a, end_b)
        at_a, at_b = links(end_a, end_b)
        pairs = a[at_a] << SHIFT | b[at_b]
        parts, ends = self.spelled(a, b, m, n)
        upto = np.cumsum([len(x) for x, _ in ids])
        group, link = np.searchsorted(m, upto, side="right"), np.searchsorted(at_a, upto)
        part = np.concatenate([[0], ends])[group]
        g = l = p = 0
        for (x, y), group_end, link_end, part_end in zip(ids, group.tolist(), link.tolist(), part.tolist(), strict=True):
            yield [len(x), len(y), group_end - g, link_end - l], pairs[l:link_end], "".join(parts[p:part_end])[:-1]
            g, l, p = group_end, link_end, part_end


ALIGNED = "block string, doc_ids array<{}>, counts array<long>, shas array<string>, pairs binary, docs binary, ends binary, of binary, times binary"


def _aligned(byte_level: str, sentence_pieces: str, kind: pa.DataType):
    """A row for each block: its documents, its distinct pairs, and each document's pairs as numbers of
    those with how often they are linked."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Aligner(byte_level, sentence_pieces)
        ids: list[pa.Array] = []
        counts: list[int] = []
        shas: list[str] = []
        keys: list[np.ndarray] = []
        times: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            every = np.concatenate(keys)
            distinct, of = np.unique(every, return_inverse=True)
            docs = np.bincount(of, minlength=len(distinct)).astype(np.int64)
            ends = np.cumsum([len(k) for k in keys])
            binary = lambda x, dtype: pa.array([x.astype(dtype).tobytes()], pa.binary())
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(kind)),
                    pa.array([counts], pa.list_(pa.int64())), pa.array([shas], pa.list_(pa.string())),
                    binary(distinct, "<i8"), binary(docs, "<i8"), binary(ends, "<i8"), binary(of, "<u4"),
                    binary(np.concatenate(times), "<u4"),
                ],
                ["block", "doc_ids", "counts", "shas", "pairs", "docs", "ends", "of", "times"],
            )
            for x in (ids, counts, shas, keys, times):
                x.clear()
            return out

        for batch in batches:
            texts, names = batch.column("text"), batch.column("doc_id")
            i = 0
            while i < len(texts):
                some: list[str | None] = []
                size = 0
                while i + len(some) < len(texts) and size < AT_ONCE:
                    some.append(texts[i + len(some)].as_py())
                    size += len(some[-1] or "") + 64
                ids.append(names.slice(i, len(some)))
                i += len(some)
                for numbers, pairs, spelled in own.align(some):
                    distinct, many = np.unique(pairs, return_counts=True)
                    counts += numbers
                    shas.append(hashlib.sha256(spelled.encode()).hexdigest() if numbers[0] else "")
                    keys.append(distinct)
                    times.append(many)
                held += size
                if held >= BLOCK:
                    yield block()
                    held = 0
        if ids:
            yield block()

    return aligned


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, pair, documents) of every block."""
    for batch in batches:
        for i in range(batch.num_rows):
            pairs = np.frombuffer(batch.column("pairs")[i].as_buffer(), "<i8")
            docs = np.frombuffer(batch.column("docs")[i].as_buffer(), "<i8")
            block = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(pairs), np.int32)), batch.column("block").slice(i, 1))
            yield pa.RecordBatch.from_arrays(
                [block.cast(pa.string()), pa.array(pairs), pa.array(docs)], ["block", "pair", "n"]
            )


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of blocks with the totals of their pairs."""
    for batch in batches:
        for i in range(batch.num_rows):
            view = lambda name, dtype, i=i: np.frombuffer(batch.column(name)[i].as_buffer(), dtype)
            pairs, ends, of, times = view("pairs", "<i8"), view("ends", "<i8"), view("of", "<u4"), view("times", "<u4")
            told = batch.column("totals")[i].values
            total, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
            if told is not None and len(told):
                at = np.searchsorted(pairs, told.field("pair").to_numpy(zero_copy_only=False))
                total[at] = told.field("total").to_numpy(zero_copy_only=False)
                best[at] = told.field("best").to_numpy(zero_copy_only=False)
            weight = times.astype(np.int64)
            upto = lambda x: np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(x)])[ends]]))
            counts = np.array(batch.column("counts")[i].as_py(), np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_ids")[i].values, *(pa.array(np.ascontiguousarray(c)) for c in counts.T),
                    pa.array(upto(weight * best[of])), pa.array(upto(weight * total[of])),
                    pa.array(batch.column("shas")[i].as_py(), pa.string()),
                ],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def _blocks(docs: DataFrame, doc_id: str, text: str, byte_level: str, sentence_pieces: str) -> tuple[DataFrame, DataFrame]:
    """Aligned blocks, written; and every pair's number of documents in each block."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType
    arrow = narrow.sparkSession.createDataFrame([], narrow.schema).select("doc_id").toArrow().schema.field(0).type
    blocks = written(
        narrow.mapInArrow(_aligned(byte_level, sentence_pieces, arrow), ALIGNED.format(kind.simpleString())), "aligned"
    )
    return blocks, blocks.select("block", "pairs", "docs").mapInArrow(_asked, "block string, pair long, n long")


def _totals(asked: DataFrame) -> DataFrame:
    """(pair, total, best): documents that hold the pair linked, and whether no pair of its first id has more."""
    totals = asked.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("a", F.shiftright("pair", SHIFT))
    # a row for each id of the first vocabulary at most
    most = F.broadcast(totals.groupBy("a").agg(F.max("total").alias("most")))
    return totals.join(most, "a").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def pair_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_level: str = BYTE_LEVEL, sentence_pieces: str = PIECES,
) -> DataFrame:
    """(a, b, documents, best): the translation table of the two vocabularies. Rows as in `align`."""
    _, asked = _blocks(docs, doc_id, text, byte_level, sentence_pieces)
    return _totals(asked).select(
        F.shiftright("pair", SHIFT).cast("int").alias("a"), F.expr(f"CAST(pair & {(1 << SHIFT) - 1} AS int)").alias("b"),
        F.col("total").alias("documents"), "best",
    )


def align(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_level: str = BYTE_LEVEL, sentence_pieces: str = PIECES,
) -> DataFrame:
    """A row for each document: tokens by both vocabularies, groups, links, how many links are of a pair
    that is its first id's commonest, the sum of the links' counts, and a hash of the groups' ids.

    Texts are encoded whole, strings of special tokens as plain text; the first vocabulary reads the text
    after a space, as the second does by itself. Texts that are null, empty, or not rebuilt to the byte by
    both have no tokens: zeros and an empty hash. Null and repeated ids are rows like others, repeated rows
    count each; other columns are ignored; no rows give no rows.
    """
    blocks, asked = _blocks(docs, doc_id, text, byte_level, sentence_pieces)
    answer = F.struct("pair", "total", "best")
    answers = asked.select("block", "pair").join(_totals(asked), "pair").groupBy("block").agg(F.collect_list(answer).alias("totals"))
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocks.drop("docs").join(answers, "block", "left").mapInArrow(_reported, schema)
