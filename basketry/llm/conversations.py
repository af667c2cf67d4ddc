"""Repairs the order of roles in conversations by the cheapest edits.

The rows of a conversation go by in order. A Viterbi search keeps one survivor per state of the role
pattern, the cheapest edits that lead there and of equally cheap ones the least audit. Survivors are
leaves of a tree of back pointers whose nodes count who refers to them: a node nobody refers to
goes, and once all survivors descend from one child of the root its edit is settled and given out. So
only the edits that are still open are held, and two equally cheap survivors are compared by
all of their open edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# Costs of the edits, and of a truncated row that is not deleted.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
ROLES = {"s": "system", "u": "user", "a": "assistant"}
# By state, the states that the role initials lead to: s?(ua)+ or nothing at all.
EMPTY, OPENED, ASKED, ANSWERED = range(4)
NEXT = {
    EMPTY: {"s": OPENED, "u": ASKED},
    OPENED: {"u": ASKED},
    ASKED: {"a": ANSWERED},
    ANSWERED: {"u": ASKED},
}
COMPLETE = (EMPTY, ANSWERED)
LEGAL = {"su", "ua", "au"}
GAP_CHARACTERS = " \t\n\v\f\r"
ENDS = ".!?"
FAULTS = ("blank", "duplicate", "truncated")
# Edits given out at a time.
BATCH_ROWS = 4096
EDITS = (
    "conv_id long, edit string, role string, text string, done boolean, gaps long, blank long,"
    " duplicate long, truncated long, illegal long, cost long"
)


@dataclass(eq=False)
class Node:
    """One edit, and the way back to those before it."""

    parent: Node | None
    letter: str
    depth: int
    role: str | None = None
    text: str | None = None
    survivors: int = 0
    children: set[Node] = field(default_factory=set)


def _open_letters(one: Node, other: Node) -> tuple[str, str]:
    """The letters of both since they parted."""
    mine: list[str] = []
    theirs: list[str] = []
    while one is not other:
        if one.depth >= other.depth:
            mine.append(one.letter)
            one = one.parent
        else:
            theirs.append(other.letter)
            other = other.parent
    return "".join(reversed(mine)), "".join(reversed(theirs))


class Survivors:
    """The cheapest edits of a conversation so far, by state."""

    def __init__(self) -> None:
        self.root = Node(None, "", 0, survivors=1)
        self.best: dict[int, tuple[int, Node]] = {EMPTY: (0, self.root)}

    def _better(self, one: tuple, other: tuple | None) -> bool:
        """Whether (cost, parent, letter, ...) comes before the other; ties go by the whole open audit."""
        if other is None or one[0] != other[0]:
            return other is None or one[0] < other[0]
        mine, theirs = _open_letters(one[1], other[1])
        return mine + one[2] < theirs + other[2]

    def _attach(self, cost: int, parent: Node, letter: str, role: str | None, text: str | None) -> tuple[int, Node]:
        node = Node(parent, letter, parent.depth + 1, role, text, survivors=1)
        parent.children.add(node)
        return cost, node

    def _release(self, node: Node) -> None:
        """A survivor less: what only it referred to goes."""
        node.survivors -= 1
        while node.parent is not None and not node.survivors and not node.children:
            node.parent.children.discard(node)
            node = node.parent

    def insert(self) -> None:
        """Insertions before the next row, as many as make any state cheaper."""
        settled = set()
        while len(settled) < len(self.best):
            state = min((s for s in self.best if s not in settled), key=lambda s: (self.best[s][0], s))
            settled.add(state)
            cost, node = self.best[state]
            for initial, after in NEXT[state].items():
                if initial == "s":
                    continue
                candidate = (cost + INSERT_COST, node, INSERT)
                known = self.best.get(after)
                if after in settled:
                    continue
                if known is None or self._better(candidate, (known[0], known[1], "")):
                    self.best[after] = self._attach(*candidate, ROLES[initial], "")
                    if known is not None:
                        self._release(known[1])

    def row(self, role: str, text: str, fault: str | None) -> None:
        """One row more: it is kept, given another role, or deleted."""
        self.insert()
        candidates: dict[int, tuple] = {}

        def offer(state: int, *candidate: object) -> None:
            if self._better(candidate, candidates.get(state)):
                candidates[state] = candidate

        stay = TRUNCATED_COST if fault == "truncated" else 0
        for state, (cost, node) in self.best.items():
            offer(state, cost + DELETE_COST, node, DELETE, None, None)
            if fault in ("blank", "duplicate"):
                continue
            for initial, after in NEXT[state].items():
                if role[:1] == initial:
                    offer(after, cost + stay, node, KEEP, role, text)
                elif initial != "s":
                    offer(after, cost + stay + REROLE_COST, node, REROLE, ROLES[initial], text)
        before = self.best
        self.best = {state: self._attach(*candidate) for state, candidate in candidates.items()}
        for _, node in before.values():
            self._release(node)
        self._forget()

    def _forget(self) -> None:
        """Drops survivors that can win no more, else the one that deletes all rows would live on.

        Whatever follows the start or the system's row can as well follow an answer; only a system's
        row kept as the first must then be deleted.
        """
        if ANSWERED not in self.best:
            return
        limit = self.best[ANSWERED][0]
        for state, more in ((EMPTY, DELETE_COST), (OPENED, 0)):
            if state in self.best and self.best[state][0] > limit + more:
                self._release(self.best.pop(state)[1])

    def settled(self) -> Iterator[Node]:
        """The edits that all survivors share, given out once."""
        while not self.root.survivors and len(self.root.children) == 1:
            (node,) = self.root.children
            node.parent = None
            self.root = node
            yield node

    def finish(self) -> tuple[int, list[Node]]:
        """The least cost, and the edits not yet given out."""
        self.insert()
        best = None
        for state in COMPLETE:
            if state in self.best:
                cost, node = self.best[state]
                if self._better((cost, node, ""), best):
                    best = (cost, node, "")
        edits = []
        node = best[1]
        while node is not self.root:
            edits.append(node)
            node = node.parent
        return best[0], edits[::-1]


class Conversation:
    """One conversation while its rows go by."""

    def __init__(self) -> None:
        self.search = Survivors()
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.last_initial = None

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> Iterator[Node]:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in LEGAL:
            self.illegal += 1
        self.last_initial = initial
        end = text.rstrip(GAP_CHARACTERS)[-1:]
        fault = "blank" if not end else "duplicate" if repeated else None if end in ENDS else "truncated"
        if fault:
            self.counts[fault] += 1
        self.search.row(role, text, fault)
        yield from self.search.settled()

    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation, in order; per edit a row, and one with the counts behind the last."""
    schema = pa.schema(
        [("conv_id", pa.int64()), *((n, pa.string()) for n in ("edit", "role", "text")), ("done", pa.bool_())]
        + [(n, pa.int64()) for n in ("gaps", *FAULTS, "illegal", "cost")]
    )
    out: list[tuple] = []
    none = (None,) * 6
    talk: Conversation | None = None
    current = None

    def close() -> None:
        cost, rest = talk.search.finish()
        out.extend((current, e.letter, e.role, e.text, False, *none) for e in rest)
        counts = [talk.counts[f] for f in FAULTS]
        out.append((current, None, None, None, True, talk.gaps(), *counts, talk.illegal, cost))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    for batch in batches:
        rows = zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "gone", "repeated")))
        for conv_id, turn, role, text, gone, repeated in rows:
            if talk is None or conv_id != current:
                if talk is not None:
                    close()
                talk, current = Conversation(), conv_id
            if not gone:
                out.extend((current, e.letter, e.role, e.text, False, *none) for e in talk.add(turn, role, text, repeated))
            if len(out) >= BATCH_ROWS:
                yield flush()
    if talk is not None:
        close()
    yield flush()


def repair(rows: DataFrame) -> DataFrame:
    """Edits that give each conversation roles s?(ua)+ or none, and counts of what was wrong.

    rows: conv_id, turn, role, text; `gone`, if there is such a column, marks rows that count for nothing but
    their conversation's name. Rows go by turn, null turns first; of one turn by role and text. Null
    roles and texts are one blank. Per edit a row comes back, in order: its letter (Keep, Rerole, Delete,
    Insert), the role and text it leaves (nulls if deleted). After those of a conversation, `done`
    marks the row with its counts: gaps, blank, duplicate, truncated, illegal, cost. A row's first fault
    counts. Conversations may be null, which is one conversation; repeated rows are duplicates.
    One task sees a conversation's rows one after the other and holds only the open edits.
    """
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    blank = F.lit(" ")
    dealt = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        "gone",
    ).repartition("conv_id")
    # Rows of a conversation are together, so the two orders below need no further exchange.
    return _in_order(dealt).mapInArrow(_edits, EDITS)


def _in_order(dealt: DataFrame) -> DataFrame:
    in_turn = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    same = W.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    return dealt.withColumn("repeated", F.row_number().over(same) > 1).sortWithinPartitions(
        "conv_id", *in_turn, "repeated"
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with a twentieth each dropped (`gone`), emptied, without [.!?], twice, or given to the user.

    Which one follows from the checksum of `conv_id:turn`; nulls there and elsewhere are one blank.
    """
    blank = F.lit(" ")

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), blank)

    key = F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))
    kind = F.col("kind")
    text = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"))
        .withColumn("kind", F.crc32(key.cast("binary")) % 20)
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            (kind == 0).alias("gone"),
            F.explode(times).alias("time"),
        )
        .drop("time")
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = ["gaps", *FAULTS, "illegal", "cost"]
    audit: list[str] = []
    checksum, lines = hashlib.sha256(), 0
    for batch in batches:
        found: list[tuple] = []
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "edit", "role", "text", "done", *counts)]
        for conv_id, edit, role, text, done, *numbers in zip(*columns, strict=True):
            if done:
                found.append((conv_id, *numbers, "".join(audit), checksum.hexdigest()))
                audit, checksum, lines = [], hashlib.sha256(), 0
                continue
            audit.append(edit)
            if edit != DELETE:
                checksum.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        kinds = [pa.int64()] * (1 + len(counts)) + [pa.string()] * 2
        columns = list(zip(*found, strict=True)) if found else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["conv_id", *counts, "audit", "repaired_sha256"],
        )


def repair_digest(edits: DataFrame) -> DataFrame:
    """Per conversation its counts, the edits' letters in order and the checksum of the repaired rows.

    edits: as `repair` gives them, in its partitions and order; they stream by once.
    """
    numbers = ", ".join(f"{n} long" for n in ("conv_id", "gaps", *FAULTS, "illegal", "cost"))
    return edits.mapInArrow(_digest, f"{numbers}, audit string, repaired_sha256 string")
