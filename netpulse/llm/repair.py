"""Conversation structure repair: least-cost edits from an automaton that shares suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import stored

#: ASCII white space.
SPACE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Grammar states: nothing yet, after the system turn, a user's turn, an assistant's turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state a kept turn of an initial leads to.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state that a changed or inserted turn leads to; it says the turn's role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Signature letters: a turn that has to go; else its initial, in capitals where the turn is truncated.
MUST_GO, OTHER = "x", "o"
#: Edits, as in the audit.
KEEP_EDIT, REROLE_EDIT, DELETE_EDIT, INSERT_EDIT = "KRDI"
DAMAGE_KINDS = 20


# --- turns ---------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: rows with the faults that their CRC32 says.

    Nulls count as one space, also in the hashed text. A row that goes stays as a marker with
    ``dropped`` so that its conversation is not forgotten.
    """
    blank = F.lit(" ")
    place = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(place.cast("binary")) % DAMAGE_KINDS).alias("kind"),
    )
    kind, text = F.col("kind"), F.col("text")
    copies = rows.withColumn("copy", F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return copies.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("dropped"),
    )


def _trimmed() -> Column:
    return F.rtrim(F.col("text"), F.lit(SPACE))


def _digest() -> Column:
    return F.md5("text")


#: Rows of a conversation: by turn, null first; ties by role and by the MD5 of the text.
ORDER = ["turn", "role", "digest"]


def signatures(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, signature.

    Texts do not travel, only their digests and last letters. Windows keep their place over sorted
    rows, so a long conversation costs its task time but no memory beyond the signature.
    """
    last = F.right(_trimmed(), F.lit(1))
    live = ~F.col("dropped")
    rows = turns.select(
        "conv_id", "dropped", F.when(live, F.col("turn")).alias("turn"), "role", _digest().alias("digest"),
        F.when(live, F.substring("role", 1, 1)).alias("initial"), (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
    )
    by_turn = Window.partitionBy("conv_id").orderBy(F.desc("dropped"), F.asc_nulls_first("turn"), "role", "digest")
    alike = Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy("place")
    placed = rows.withColumns(
        {
            "place": F.row_number().over(by_turn),
            "pair": F.concat(F.lag("initial").over(by_turn), "initial"),
            "fresh": F.col("turn").isNotNull() & ~F.lag("turn").over(by_turn).eqNullSafe(F.col("turn")),
        }
    ).withColumn("seen", F.row_number().over(alike) > 1)
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit(OTHER))
    fault = F.when(F.col("blank"), "blank").when(F.col("seen"), "duplicate").when(F.col("cut"), "truncated")
    known = placed.withColumn("fault", F.when(live, fault)).withColumn(
        "letter",
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit(MUST_GO))
        .when(F.col("fault") == "truncated", F.upper(letter))
        .otherwise(letter),
    )
    legal = ("su", "ua", "au")
    marks = F.sort_array(F.collect_list(F.when(live, F.struct("place", "letter"))))
    spread = F.max("turn") - F.min("turn") + 1 - F.count_if("fresh")
    return known.groupBy("conv_id").agg(
        F.coalesce(spread, F.lit(0)).cast("bigint").alias("gaps"),
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")],
        F.count_if(~F.col("pair").isin(*legal)).alias("illegal"),
        F.array_join(F.transform(marks, lambda mark: mark["letter"]), "").alias("signature"),
    )


# --- the automaton -------------------------------------------------------------------------------------


@dataclass
class Node:
    """A suffix of signatures: its first letter and the rest; per grammar state the cost to go and the first edit.

    An edit is (letter, state after it, whether a turn is used up). The best audit of a suffix is its
    first edit followed by that of a node behind it, so suffixes that nodes share are stored once.
    """

    rest: "Node | None"
    cost: list[float] = field(default_factory=list)
    edit: list[tuple[str, int, bool] | None] = field(default_factory=list)

    @classmethod
    def end(cls) -> "Node":
        node = cls(None, [0, float("inf"), float("inf"), 0], [None] * 4)
        node._insert()
        return node

    @classmethod
    def before(cls, letter: str, rest: "Node") -> "Node":
        node = cls(rest)
        own, extra = letter.lower(), TRUNCATED if letter.isupper() else 0
        for state in range(4):
            options = [(DELETE + rest.cost[state], DELETE_EDIT, state)]
            if letter != MUST_GO:
                options.append((REROLE + extra + rest.cost[NEXT[state]], REROLE_EDIT, NEXT[state]))
                if (state, own) in STEP:
                    to = STEP[state, own]
                    options.append((extra + rest.cost[to], KEEP_EDIT, to))
            cost, edit, to = min(options)  # ties: the least letter, which also decides between whole audits
            node.cost.append(cost)
            node.edit.append((edit, to, True))
        node._insert()
        return node

    def _insert(self) -> None:
        """Insertions stay at the node. A pair of states cannot both gain from inserting into the other."""
        plain = list(self.cost)
        for state in (USER, ASSISTANT, START, SYSTEM):
            source = plain if state in (USER, ASSISTANT) else self.cost
            cost = INSERT + source[NEXT[state]]
            edit = self.edit[state]
            if cost < self.cost[state] or (cost == self.cost[state] and edit is not None and INSERT_EDIT < edit[0]):
                self.cost[state], self.edit[state] = cost, (INSERT_EDIT, NEXT[state], False)

    def audit(self) -> str:
        """The cheapest edits of the whole suffix from the start state, of equal ones the ASCII-least."""
        letters, node, state = [], self, START
        while node.edit[state] is not None:
            letter, state, used = node.edit[state]
            letters.append(letter)
            if used:
                node = node.rest
        return "".join(letters)


class SuffixAutomaton:
    """Nodes for signatures that come sorted by their reversed text: a suffix and its state costs are made once."""

    def __init__(self) -> None:
        self.path = [Node.end()]
        self.letters: list[str] = []
        self.made = 0

    def node(self, signature: str) -> Node:
        backward = signature[::-1]
        shared = 0
        for mine, its in zip(self.letters, backward):
            if mine != its:
                break
            shared += 1
        del self.path[shared + 1 :]
        for letter in backward[shared:]:
            self.path.append(Node.before(letter, self.path[-1]))
            self.made += 1
        self.letters = list(backward)
        return self.path[-1]


def _audit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = SuffixAutomaton()
    signature, audit, cost = None, "", 0
    for batch in batches:
        costs, audits = [], []
        for found in batch.column(batch.schema.names.index("signature")).to_pylist():
            if found != signature:
                node, signature = automaton.node(found), found
                audit, cost = node.audit(), int(node.cost[START])
            costs.append(cost)
            audits.append(audit)
        columns = [c for name, c in zip(batch.schema.names, batch.columns) if name != "signature"]
        names = [name for name in batch.schema.names if name != "signature"]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(costs, pa.int64()), pa.array(audits, pa.string())], names=[*names, "cost", "audit"]
        )


def audited(marked: DataFrame) -> DataFrame:
    """:func:`signatures` with cost and audit instead of the signature.

    Conversations are dealt out by ranges of the reversed signature and the conversation: those that
    share suffixes meet, and a signature that a large share of them has spreads over many tasks.
    """
    kept = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal"]
    backward = F.reverse("signature")
    dealt = marked.repartitionByRange(backward, "conv_id").sortWithinPartitions(backward, "conv_id")
    longs = ", ".join(f"{name} bigint" for name in kept)
    return dealt.select(*kept, "signature").mapInArrow(_audit_batches, f"{longs}, cost bigint, audit string")


# --- repaired text -------------------------------------------------------------------------------------


@dataclass
class Replay:
    """One conversation's edits replayed over its turns, one turn at a time."""

    audit: str
    state: int = START
    at: int = 0

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == INSERT_EDIT:
            self.at += 1
            self.state = NEXT[self.state]
            yield ROLE[self.state], ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """What stands for this turn: insertions before it, and the turn itself if it stays."""
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == DELETE_EDIT:
            return
        if edit == KEEP_EDIT:
            self.state = STEP[self.state, role[:1]]
        else:
            self.state = NEXT[self.state]
            role = ROLE[self.state]
        yield role, text

    def rest(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()


class _Digest:
    """SHA-256 of ``role:text`` lines; holds no text."""

    def __init__(self) -> None:
        self.sha, self.empty = hashlib.sha256(), True

    def add(self, turns: Iterator[tuple[str, str]]) -> None:
        for role, text in turns:
            if not self.empty:
                self.sha.update(b"\n")
            self.sha.update(f"{role}:{text}".encode())
            self.empty = False


_RESULT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _replay_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its audit row (null role) and then its turns, to result rows."""
    head, replay, digest = None, None, None
    for batch in batches:
        done = []
        at = {name: i for i, name in enumerate(batch.schema.names)}
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if row[at["role"]] is None:
                if head is not None:
                    digest.add(replay.rest())
                    done.append((*head, digest.sha.hexdigest()))
                head = tuple(row[at[name]] for name in _RESULT)
                replay, digest = Replay(head[-1]), _Digest()
            else:
                digest.add(replay.turn(row[at["role"]], row[at["text"]]))
        yield _result(done)
    if head is not None:
        digest.add(replay.rest())
        yield _result([(*head, digest.sha.hexdigest())])


def _result(rows: list[tuple]) -> pa.RecordBatch:
    names = [*_RESULT, "repaired_sha256"]
    kinds = [pa.string() if name in ("audit", "repaired_sha256") else pa.int64() for name in names]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _audits_and_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    turns = damaged(conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"))
    return stored(audited(stored(signatures(turns), "signatures")), "audits"), turns


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    Rows are damaged first (:func:`damaged`). Only conv_id, turn, role and text are read; other
    columns may have any name. Null roles and texts are one space: such a role can only be changed or
    deleted, such a text is blank. An empty role has no initial and cannot be kept. Null turns come
    first and count in no gap; rows of one turn are taken by role and MD5 of the text; rows without
    conv_id are one conversation. A conversation whose rows all go has zeros, an empty audit and the
    digest of nothing. An empty table gives no rows. A conversation is read in order by one task,
    as its digest asks for, but only its signature and audit (a letter per turn or edit) are held.
    """
    audits, turns = _audits_and_turns(conversations)
    live = turns.where("NOT dropped").select("conv_id", "turn", "role", "text", _digest().alias("digest"))
    heads = audits.withColumns({"role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
    rows = heads.unionByName(live, allowMissingColumns=True)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_last("audit"), F.asc_nulls_first("turn"), "role", "digest"]
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order).select(*_RESULT, "role", "text")
    longs = ", ".join(f"{name} bigint" for name in _RESULT[:-1])
    return dealt.mapInArrow(_replay_batches, f"{longs}, audit string, repaired_sha256 string")
