"""Conversation repair against trying every sequence of edits, and rows that are not like the others."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from oracle import connect, oracle_rows, spark_rows
from quarterdeck.llm.conversations import HELD, ORACLE, damaged, repair, repair_report

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def broken(rows):
    """The planted damage, row by row."""
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv_id, turn, role, text


def every_edit(rows, faults):
    """The least (cost, audit, repaired) over all edits, by trying them."""
    fitting = re.compile("(s?(ua)+)?")
    best = None
    inserts = [(i, "I" * len(i), 5 * len(i)) for n in range(3) for i in itertools.product("ua", repeat=n)]
    slots = []
    for (role, text), fault in zip(rows, faults, strict=True):
        own = [(None, "D", 2)]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            own += [((role, text), "K", more)] + [((r, text), "R", 1 + more) for r in ("user", "assistant")]
        slots.append(own)
    for choice in itertools.product(*slots):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(c for _, _, c in choice) + sum(c for _, _, c in gaps)
            if best and cost > best[0]:
                continue
            audit, out, names = "", [], ""
            for i in range(len(rows) + 1):
                for r in gaps[i][0]:
                    out.append(({"u": "user", "a": "assistant"}[r], ""))
                audit += gaps[i][1]
                if i < len(rows):
                    audit += choice[i][1]
                    if choice[i][0]:
                        out.append(choice[i][0])
            names = "".join(r[:1] or "-" for r, _ in out)
            if fitting.fullmatch(names) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
    return best


def expected(rows):
    out = {}
    after = list(broken(rows))
    for conv_id in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults, seen = [], set()
        for _, _, role, text in own:
            bare = text.rstrip(BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            faults.append(fault)
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, repaired = every_edit([r[2:] for r in own], faults)
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256(repaired.encode()).hexdigest(),
        )
    return out


def reported(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    out = []
    for conv_id in [*range(60), None]:
        for turn in range(rng.randint(1, 3)):
            turn = rng.choice([turn, turn, turn + 3, None])
            role = rng.choice(["user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "Why? ", "\t ", "", None, "One. Two!", "a\x00b.", "é漢."])
            out.append((conv_id, turn, role, text))
    return out


def test_against_every_edit(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert reported(repair_report(df)) == expected(rows)


def test_extra_columns_and_order_do_not_matter(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    more = df.selectExpr("'x' AS copies", "1 AS digest", "2 AS first", "*", "3 AS place").repartition(5)
    assert reported(repair_report(more)) == reported(repair_report(df))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair_report(none).count() == 0 and repair(none).count() == 0


def test_conversation_without_rows_left(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = reported(repair_report(spark.createDataFrame([(gone, 0, "user", "Yes.")], SCHEMA)))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_equal_rows_travel_as_one(spark):
    """A third of a table in one conversation and one row of it, many times."""
    df = spark.range(20_000).selectExpr("1L AS conv_id", "0L AS turn", "'user' AS role", "'Same.' AS text")
    assert damaged(df).count() == 1
    assert repair(df).groupBy("edit").count().collect()[0]["count"] == 20_000


@pytest.mark.parametrize("middle", ["user", "tool"])
def test_long_conversation_is_given_out_while_it_is_read(spark, middle):
    n = 10 * HELD + 1
    rows = [(7, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(n)]
    rows[n // 2] = (7, n // 2, middle, "Odd.")
    got = repair(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()
    left = [r for r in got if r["edit"] != "D"]
    assert [r["place"] for r in got] == list(range(len(got)))
    assert re.fullmatch("(ua)+", "".join(r["role"][0] for r in left))
    assert sum(r["edit"] != "K" for r in got) <= 2
    assert [r["turn"] for r in got if r["edit"] != "I"] == list(range(n))


def test_whole_table_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    columns, want = oracle_rows(connect(sf), ORACLE)
    got = repair_report(spark.read.parquet(f"{sf}/conversations.parquet"))
    assert sorted(columns) == sorted(got.columns) and spark_rows(got) == want


def test_odd_rows_against_sql(spark, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert spark_rows(repair_report(spark.createDataFrame(rows, SCHEMA))) == oracle_rows(con, ORACLE)[1]


def test_report_of_a_whole_table_agrees_with_its_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    after = damaged(df).selectExpr("conv_id", "turn", "role", "text", "explode(sequence(1, copies)) AS n").where("copies > 0")
    told: dict = {}
    for r in repair(after).orderBy("conv_id", "place").collect():
        told.setdefault(r["conv_id"], []).append(r)
    got = reported(repair_report(df))
    for conv_id, rows in told.items():
        repaired = "\n".join(f"{r['role']}:{r['text']}" for r in rows if r["edit"] != "D")
        assert got[conv_id][-2:] == ("".join(r["edit"] for r in rows), hashlib.sha256(repaired.encode()).hexdigest())
    assert all(got[c][-2] == "" for c in set(got) - set(told))
