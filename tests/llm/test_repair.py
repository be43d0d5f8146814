"""Conversation repair: the automaton against a search over all edits, the query against plain loops and SQL."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import zlib

from netpulse.llm import queries, repair
from verification.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
SPACE = repair.SPACE
TARGET = {"": "u", "s": "u", "u": "a", "a": "u"}
ALLOWED = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def cheapest(turns: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Cost and audit over (initial, must go, truncated), by search over all edit sequences."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, last = heapq.heappop(heap)
        if at == len(turns) and last in ("", "a"):
            return cost, audit
        if (at, last) in seen:  # the first to get here is cheapest, and least among those
            continue
        seen.add((at, last))
        heapq.heappush(heap, (cost + 3, audit + "I", at, TARGET[last]))
        if at < len(turns):
            initial, must_go, truncated = turns[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, last))
            if not must_go:
                extra = 3 if truncated else 0
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, TARGET[last]))
                if (last, initial) in ALLOWED:
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, initial))
    raise AssertionError


def damage(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        out += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))


def expected(conv: int | None, rows: list[tuple]) -> tuple:
    turns = damage(rows)
    faults, seen = [], set()
    for _, role, text in turns:
        if not text.strip(SPACE):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if text.rstrip(SPACE)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    marks = [(r[:1], f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(turns, faults)]
    cost, audit = cheapest(marks)
    story, at, last = [], 0, ""
    for edit in audit:
        if edit == "I":
            last = TARGET[last]
            story.append(({"u": "user", "a": "assistant"}[last], ""))
            continue
        _, role, text = turns[at]
        at += 1
        if edit == "D":
            continue
        last = role[:1] if edit == "K" else TARGET[last]
        story.append((role if edit == "K" else {"u": "user", "a": "assistant"}[last], text))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in story).encode()).hexdigest()
    return (conv, gaps, *(faults.count(n) for n in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def by_plain_loops(rows: list[tuple]) -> list[tuple]:
    conversations: dict = {}
    for row in rows:
        conversations.setdefault(row[0], []).append(row)
    return sorted((expected(conv, own) for conv, own in conversations.items()), key=repr)


def result(df) -> list[tuple]:
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_automaton_against_all_edits_and_suffixes_made_once():
    rng = random.Random(5)
    made = {"".join(rng.choices("suaoSUAOxuauaua", k=rng.randint(0, 8))) for _ in range(500)}
    automaton = repair.SuffixAutomaton()
    for signature in sorted(made, key=lambda s: s[::-1]):
        node = automaton.node(signature)
        marks = [(c.lower(), c == "x", c.isupper()) for c in signature]
        assert (node.cost[repair.START], node.audit()) == cheapest(marks), signature
    assert automaton.made == len({s[i:] for s in made for i in range(len(s))})


def test_query_against_plain_loops(spark, tables):
    rows = [tuple(r) for r in tables("conversations").select("conv_id", "turn", "role", "text").collect()]
    assert result(repair.repaired(tables("conversations"))) == by_plain_loops(rows)


def test_query_against_sql(spark):

    assert differences(queries.op11_repair(spark, SMALL), connect(SMALL), queries.ORACLES["op11_repair"]) == []


ODD = [
    (1, 0, None, None), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 1, "assistant", "No end"),
    (2, None, "user", "First?"), (2, None, "assistant", "Second!"), (2, 7, "tool", "x."), (2, 9, "system", "Late."),
    (3, 5, "", "No role."), (3, 6, "user", " . "), (3, 7, "assistant", ".\x1c"),
    (None, 0, "user", "No id?"), (None, None, "assistant", "None."), (None, None, None, ""),
    (-4, -3, "assistant", "é" * 200_000 + "."), (-4, 40, "userland", "\n ok. \n"),
]


def test_odd_rows(spark, folder):
    from pyspark.sql import functions as F

    # many conversations of one row: each damage is met, some are left without rows
    rows = ODD + [(100 + n, 0, "user", f"Text {n}.") for n in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = df.withColumns({name: F.lit("mine") for name in ("cost", "audit", "kind", "digest", "place", "signature", "dropped")})
    got = result(repair.repaired(extra))
    assert got == by_plain_loops(rows)
    nothing = hashlib.sha256(b"").hexdigest()
    assert any(r[1:] == (0, 0, 0, 0, 0, 0, "", nothing) for r in got)
    where = folder("conversations", df)
    assert differences(repair.repaired(df), connect_folder(where), queries.ORACLES["op11_repair"]) == []


def connect_folder(where: str):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{where}/conversations.parquet/*.parquet')")
    return con


def test_empty_table(spark):
    assert repair.repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_long_conversation_and_many_alike(spark):
    """One conversation with a third of all rows, and a signature that most conversations share."""
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(300)]
    rows += [(2 + c, t, ("user", "assistant")[t % 2], f"Same {t}.") for c in range(300) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert result(repair.repaired(df)) == by_plain_loops(rows)
