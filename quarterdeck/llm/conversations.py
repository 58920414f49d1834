"""Repair of conversation structure by generalised LR parsing with weighted edits.

The roles of a conversation are read by the LR automaton of

    S -> nothing | s P | P        P -> u a | P u a

Every row may be kept, re-roled or deleted, and rows may be inserted before it; each choice shifts (and
reduces) on the stacks that are alive. Stacks of equal top are one node of a graph-structured stack: of
the ways into it the one of least (cost, audit) is linked. What all tops have in common below them is
decided, so it is given out and forgotten while the conversation is still being read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quarterdeck.llm.text import BLANKS

# The automaton's shifts, what state 5 and 7 reduce to P (symbols popped), where P leads,
# the states that may end; role names by initial; costs of the edits.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
REDUCE = {5: 2, 7: 3}
GOTO = {0: 3, 1: 4}
ENDS = {0, 3, 4}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
# Rows after which what is decided is given out.
HELD = 256
FAULTS = ("", "blank", "duplicate", "truncated")


def push(stack: tuple[int, ...], symbol: str) -> tuple[int, ...] | None:
    """The stack after a shift and the reduction it allows; None where the symbol does not fit."""
    state = SHIFT.get((stack[-1], symbol))
    if state is None:
        return None
    stack = (*stack, state)
    if state in REDUCE:
        stack = stack[: -REDUCE[state]]
        stack = (*stack, GOTO[stack[-1]])
    return stack


def _inserted(stack: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int]]:
    """The stack after 0, 1, ... insertions, until tops repeat."""
    seen, many, at = set(), 0, [stack]
    while at:
        fresh = [s for s in at if s[-1] not in seen]
        seen |= {s[-1] for s in fresh}
        for s in fresh:
            yield s, many
        at = [t for s in fresh for t in (push(s, "u"), push(s, "a")) if t]
        many += 1


@lru_cache(maxsize=4096)
def moves(stack: tuple[int, ...], initial: str, must_go: bool) -> list[tuple[tuple[int, ...], str, int, bool]]:
    """(stack, letters, cost, row stays) for every way to read one row."""
    out = []
    for s, many in _inserted(stack):
        before, cost = "I" * many, INSERT * many
        out.append((s, before + "D", cost + DELETE, False))
        if must_go:
            continue
        if kept := push(s, initial):
            out.append((kept, before + "K", cost, True))
        for role in ROLES:
            if role != initial and (other := push(s, role)):
                out.append((other, before + "R", cost + REROLE, True))
    return out


class Parse:
    """One conversation, read row by row."""

    def __init__(self) -> None:
        # top state -> (cost, rank of the audit among the tops, stack, link); a link is [link before, letters]
        self.tops = {0: (0, 0, (0,), None)}
        self.base = None  # the last link that all tops share
        self.held: deque[tuple[int | None, str, str]] = deque()  # rows after it
        self.stack: tuple[int, ...] = (0,)

    def read(self, turn: int | None, role: str, text: str, must_go: bool, truncated: bool) -> None:
        """Audits of equally many rows that end in a row's letter are never prefixes of each other, so
        their order stays when letters are added and a rank can stand for them."""
        self.held.append((turn, role, text))
        best: dict[int, tuple] = {}
        for cost, rank, stack, link in self.tops.values():
            for after, letters, more, stays in moves(stack, role[:1], must_go):
                key = (cost + more + (TRUNCATED if truncated and stays else 0), rank, letters)
                if after[-1] not in best or key < best[after[-1]][0]:
                    best[after[-1]] = (key, after, link)
        order = sorted(best, key=lambda top: best[top][0][1:])
        self.tops = {}
        for rank, top in enumerate(order):
            (cost, _, letters), stack, link = best[top]
            self.tops[top] = (cost, rank, stack, [link, letters])

    def end(self) -> tuple[int, str, tuple | None]:
        """Cost, letters of the last insertions, and the link of the cheapest way to end."""
        return min(
            ((cost + INSERT * many, rank, "I" * many), link)
            for cost, rank, stack, link in self.tops.values()
            for s, many in _inserted(stack)
            if s[-1] in ENDS
        )

    def decided(self, tops: list | None = None) -> list[str]:
        """Letters, row by row, of what all tops (or these links) share; their links then begin after it."""
        paths = []
        for link in tops or [top[3] for top in self.tops.values()]:
            path = []
            while link is not self.base:
                path.append(link)
                link = link[0]
            paths.append(path[::-1])
        shared = 0
        while shared < len(paths[0]) and all(len(p) > shared and p[shared] is paths[0][shared] for p in paths):
            shared += 1
        if shared:
            self.base = paths[0][shared - 1]
            self.base[0] = None
        return [link[1] for link in paths[0][:shared]]

    def give(self, letters: list[str]) -> Iterator[tuple[str, int | None, str, str]]:
        """The edits that decided letters stand for, in order, and their effect on the lowest stack."""
        for own in letters:
            for letter in own:
                if letter == "I":
                    role = "u" if push(self.stack, "u") else "a"
                    yield "I", None, ROLES[role], ""
                    self.stack = push(self.stack, role)
                    continue
                turn, name, text = self.held.popleft()
                if letter == "K":
                    self.stack = push(self.stack, name[:1])
                elif letter == "R":
                    role = "u" if push(self.stack, "u") else "a"
                    self.stack, name = push(self.stack, role), ROLES[role]
                yield letter, turn, name, text


class Reader:
    """The conversation that a task is at: counts, the parse, and what was given out of it."""

    def __init__(self, conv_id, with_rows: bool) -> None:
        self.conv_id, self.with_rows = conv_id, with_rows
        self.parse = Parse()
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal = self.turns = 0
        self.first = self.last = self.before = None
        self.audit, self.sha = bytearray(), hashlib.sha256()
        self.place = self.lines = 0
        self.rows: list[tuple] = []

    def read(self, turn: int | None, role: str, text: str, copies: int, earlier: bool, blank: bool, truncated: bool) -> None:
        if copies and turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        for copy in range(copies):
            fault = "blank" if blank else "duplicate" if earlier or copy else "truncated" if truncated else ""
            self.counts[fault] += 1
            self.illegal += self.before is not None and self.before + role[:1] not in LEGAL
            self.before = role[:1]
            self.parse.read(turn, role, text, fault in ("blank", "duplicate"), fault == "truncated")
            if len(self.parse.held) >= HELD and len(self.parse.held) % HELD == 0:
                self.give(self.parse.decided())

    def give(self, letters: list[str]) -> None:
        for letter, turn, role, text in self.parse.give(letters):
            self.audit += letter.encode()
            if letter != "D":
                self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
                self.lines += 1
            if self.with_rows:
                self.rows.append((self.conv_id, self.place, letter, turn, role, text))
                self.place += 1

    def finish(self) -> tuple:
        (cost, _, last), link = self.parse.end()
        if link is not None:
            self.give(self.parse.decided([link]))
        self.give([last])
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (
            self.conv_id, gaps, self.counts["blank"], self.counts["duplicate"], self.counts["truncated"],
            self.illegal, cost, self.audit.decode(), self.sha.hexdigest(),
        )


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROWS = "place long, edit string, turn long, role string, text string"


def _read(with_rows: bool, kinds: pa.Schema):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: Reader | None = None
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out, strict=True)] or [[] for _ in kinds]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

        for batch in batches:
            names = ("conv_id", "turn", "role", "text", "copies", "earlier", "blank", "truncated")
            for conv_id, *row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if at is None or at.conv_id != conv_id:
                    if at is not None:
                        done = at.finish()
                        out.extend(at.rows if with_rows else [done])
                    at = Reader(conv_id, with_rows)
                at.read(*row)
                if at.rows:
                    out.extend(at.rows)
                    at.rows = []
                if len(out) >= 1024:
                    yield flushed()
        if at is not None:
            done = at.finish()
            out.extend(at.rows if with_rows else [done])
        yield flushed()

    return read


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after planted damage, which a hash of each row's
    conversation and turn decides, equal rows as one with their number. A row that is dropped leaves
    one of no copies, so that its conversation stays known. Null roles and texts are one space."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    kind, gone = F.col("kind"), F.col("kind") == 0
    return (
        rows.select(
            "conv_id",
            F.when(~gone, F.col("turn").cast("long")).alias("turn"),
            F.when(gone, "").when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(gone | (kind == 1), "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.when(gone, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
    )


def _judged(rows: DataFrame) -> DataFrame:
    """The rows with their faults, in the order in which they are read."""
    digest = F.sha2(F.to_json(F.struct("conv_id", "role", "text")), 256)
    rows = rows.withColumn("digest", digest)
    first = F.min(F.struct("turn")).alias("first")
    again = rows.where("copies > 0").groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    return (
        rows.join(again.select("digest", "first"), "digest", "left")
        .select(
            "conv_id", "turn", "role", "text", "copies",
            (F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("earlier"),
            (bare == "").alias("blank"),
            (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    )


def _repaired(rows: DataFrame, columns: str, with_rows: bool) -> DataFrame:
    kind = rows.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, {columns}"
    names = rows.sparkSession.createDataFrame([], schema).schema
    return _judged(rows).mapInArrow(_read(with_rows, to_arrow_schema(names)), schema)


def repair(conversations: DataFrame) -> DataFrame:
    """Every row of the repaired conversations and every edit on the way: (conv_id, place, edit, turn,
    role, text). ``edit`` is K (kept), R (re-roled), D (deleted, with its old role and text) or I
    (inserted, without text or turn); the conversation reads on without the D rows.

    Blank and repeated rows go; others are kept or go, whichever is cheapest for roles that read
    ``(s?(ua)+)?`` by their initials. Of ways of equal cost the one whose edits are first in ASCII order.

    Rows are read by turn (null first), then role and text. Null roles and texts are one space; a role
    that is empty or has another initial has to be re-roled or go; a null ``conv_id`` is a conversation
    of its own; other columns are ignored; no rows give no rows. Equal rows travel as one row with
    their number. A conversation is one ordered stream, so one task reads it, whatever its length, and
    holds only what its stack tops do not yet agree on (and the letters of its audit, for `repair_report`).
    """
    plain = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    return _repaired(plain.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")), ROWS, True)


def repair_report(conversations: DataFrame) -> DataFrame:
    """A row for each conversation after planted damage (`damaged`): gaps in its turns, faults, illegal
    neighbours, the cheapest repair's cost and letters, and the repaired text's hash. Conversations
    without a row left have zeros, no letters and the hash of nothing. Rows as in `repair`."""
    return _repaired(damaged(conversations), REPORT, False)


# The same in SQL, from the definition: the cheapest way to every state of the role grammar, row by row.
ORACLE = """
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations),
kinds AS (
  SELECT *, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(k) + 1), lambda i: ascii(k[i])::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, j: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind
  FROM named),
after AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
faulty AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
  FROM after),
rows AS (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS initial,
         CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM faulty),
-- states: 0 nothing read, 1 system, 2 a user waits for an answer, 3 answered
shifts(p, symbol, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts(p, q, letters, lines) AS (
  VALUES (0, 0, '', []::VARCHAR[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
         (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']), (3, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']),
         (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:']),
         (3, 3, 'II', ['user:', 'assistant:']), (2, 2, 'II', ['assistant:', 'user:'])),
edits AS (
  SELECT conv_id, i, 'D' AS letter, NULL AS symbol, 2 AS cost, []::VARCHAR[] AS line FROM rows
  UNION ALL
  SELECT conv_id, i, 'K', initial, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, [role || ':' || text]
  FROM rows WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv_id, i, 'R', r.symbol, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, [r.name || ':' || text]
  FROM rows, (VALUES ('u', 'user'), ('a', 'assistant')) r(symbol, name) WHERE fault NOT IN ('blank', 'duplicate')),
steps AS (
  SELECT e.conv_id, e.i, n.p, CASE WHEN letter = 'D' THEN n.q ELSE s.q END AS q,
         n.letters || letter AS letters, 5 * len(n.letters) + cost AS cost, n.lines || line AS lines
  FROM edits e, inserts n LEFT JOIN shifts s ON s.p = n.q AND s.symbol = e.symbol
  WHERE letter = 'D' OR s.q IS NOT NULL),
parse AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM conversations
  UNION ALL
  SELECT t.conv_id, s.i, s.q, t.cost + s.cost, t.audit || s.letters, t.lines || s.lines
  FROM parse t JOIN steps s ON s.conv_id IS NOT DISTINCT FROM t.conv_id AND s.i = t.i + 1 AND s.p = t.state
  QUALIFY row_number() OVER (PARTITION BY t.conv_id, s.q ORDER BY t.cost + s.cost, t.audit || s.letters) = 1),
ended AS (
  SELECT t.conv_id, t.i, t.cost + 5 * len(n.letters) AS cost, t.audit || n.letters AS audit, t.lines || n.lines AS lines
  FROM parse t JOIN inserts n ON n.p = t.state WHERE n.q IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY t.conv_id ORDER BY t.i DESC, t.cost + 5 * len(n.letters), t.audit || n.letters) = 1),
counted AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM rows)
  GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit,
       sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
