"""Conversation structure repair: the lightest derivation of a legal conversation, by Knuth's agenda.

An item (place, state) says that the rows before ``place`` are repaired and their role initials lead to ``state`` of
the language ``(s?(ua)+)?``. A deduction joins an item with the next row by an edit, or inserts a turn. Its superior
function adds the edit's cost and writes its initial behind the audit; weights (cost, audit) are compared in that order.
The result is never less than what it comes from, and it grows with it: at one item no audit of equal cost is the
beginning of another, as the longer one would have more insertions and so a higher cost. The agenda pops the least
weight; the first weight popped for an item is its final one, and the search ends as the goal is popped.

Long conversations are cut into segments. A segment starts from the final items of the one before (one a state) and
ends as every state has its final item behind the last row. Each item carries the digest of its repaired turns so far,
and what all audits begin with is written off, so that a task holds one segment of texts however long a conversation
is. The audit says everything: ``repaired_turns`` makes the turns from it with joins only.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ready

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
CUT_SHORT = 1
ROLES = {"u": "user", "a": "assistant"}
#: States: nothing yet, after s, after u, after a. The next turn that may be made up, and where it leads.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {START: ("u", AFTER_U), AFTER_S: ("u", AFTER_U), AFTER_U: ("a", AFTER_A), AFTER_A: ("u", AFTER_U)}
GOALS = (START, AFTER_A)
LEGAL = {"su", "ua", "au"}
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
SEGMENT = 256
WHITE = " \t\n\x0b\x0c\r"

# ------------------------------------------------------------------ rows


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, dropped) after damage by the remainder of crc32(``conv_id:turn``) by 20.

    0 drops the row (it stays with ``dropped``, so that its conv_id is known), 1 empties its text, 2 removes ``.!?``
    from it, 3 repeats the row, 4 sets the role ``user``. Null values count as one space, but for conv_id and turn only
    within the key. Other columns go.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(filled[0], F.lit(":"), filled[1])) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), filled[2].alias("role"), filled[3].alias("text"), kind.alias("_kind")
    )
    text = F.when(F.col("_kind") <= 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("_kind") == 0).alias("dropped"), times.alias("_copy")
    ).drop("_copy")


def turn_order() -> list[Column]:
    """Rows of a conversation: by turn, null first; rows of equal turns by role and text."""
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with ``fault``: the first that holds of blank (1), duplicate (2), truncated (3), or 0.

    One exchange by conv_id serves this and the order of rows; equal rows of a conversation meet by sorting.
    """
    ended = F.rtrim("text", F.lit(WHITE))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text", "dropped").orderBy(F.asc_nulls_first("turn"))) > 1
    fault = (
        F.when(ended == "", BLANK).when(seen, DUPLICATE).when(~F.substring(ended, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    )
    return rows.repartition("conv_id").withColumn("fault", F.when(F.col("dropped"), NONE).otherwise(fault))


# ------------------------------------------------------------------ the agenda


def moves(state: int, initial: str, fault: int) -> Iterator[tuple[int, str, int]]:
    """(cost, edit, state behind) of each edit of a row in ``state``."""
    yield COST[DELETE], DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    more = CUT_SHORT * (fault == TRUNCATED)
    made, behind = NEXT[state]
    yield COST[REROLE] + more, REROLE, behind
    if initial == made:
        yield COST[KEEP] + more, KEEP, behind
    elif initial == "s" and state == START:
        yield COST[KEEP] + more, KEEP, AFTER_S
    elif not initial:
        yield COST[KEEP] + more, KEEP, state


def lightest(rows: list[tuple[str, int]], entries: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str, int]]:
    """state -> (cost, audit, entry state) of the final items behind ``rows`` (initial, fault), from ``entries`` state -> (cost, audit).

    In the ``last`` segment only the goal is wanted: the first item popped there in which a conversation may end.
    """
    agenda = [(cost, audit, 0, state, state) for state, (cost, audit) in entries.items()]
    agenda.sort()
    final: set[tuple[int, int]] = set()
    behind: dict[int, tuple[int, str, int]] = {}
    while agenda:
        cost, audit, place, state, entry = heappop(agenda)
        if (place, state) in final:
            continue
        final.add((place, state))
        if place == len(rows):
            if not last or state in GOALS:
                behind[state] = (cost, audit, entry)
            if last and behind or len(behind) == len(NEXT):
                return behind
        else:
            for more, edit, after in moves(state, *rows[place]):
                if (place + 1, after) not in final:
                    heappush(agenda, (cost + more, audit + edit, place + 1, after, entry))
        after = NEXT[state][1]
        if (place, after) not in final:
            heappush(agenda, (cost + COST[INSERT], audit + INSERT, place, after, entry))
    return behind


class Conversation:
    """What is known of one conversation as its rows come in order."""

    def __init__(self, conv_id: int | None, segment: int):
        self.conv_id, self.segment = conv_id, segment
        self.rows: list[tuple[str, str, int]] = []
        self.items = {START: (0, "", hashlib.sha256(), False)}
        self.written: list[str] = []
        self.faults = [0, 0, 0, 0]
        self.illegal = self.distinct = 0
        self.low = self.high = self.before = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high, self.distinct = turn if self.low is None else self.low, turn, self.distinct + 1
        self.faults[fault] += 1
        self.illegal += self.before is not None and self.before + role[:1] not in LEGAL
        self.before = role[:1]
        self.rows.append((role, text, fault))
        if len(self.rows) > self.segment:
            self.close(self.rows[:-1], last=False)
            del self.rows[:-1]

    def close(self, rows: list[tuple[str, str, int]], last: bool) -> None:
        found = lightest([(role[:1], fault) for role, _, fault in rows], {s: x[:2] for s, x in self.items.items()}, last)
        items = {}
        for state, (cost, audit, entry) in found.items():
            _, before, digest, begun = self.items[entry]
            digest = digest.copy()
            begun = self.replay(digest, begun, rows, audit[len(before) :], entry)
            items[state] = (cost, audit, digest, begun)
        common = os.path.commonprefix([x[1] for x in items.values()])
        self.written.append(common)
        self.items = {s: (cost, audit[len(common) :], *rest) for s, (cost, audit, *rest) in items.items()}

    @staticmethod
    def replay(digest, begun: bool, rows: list[tuple[str, str, int]], audit: str, state: int) -> bool:
        """Add the repaired lines to the digest; whether it has a line now."""
        place = 0
        for edit in audit:
            role, text = ("", "") if edit == INSERT else rows[place][:2]
            place += edit != INSERT
            if edit == DELETE:
                continue
            made, behind = NEXT[state]
            if edit == KEEP:
                behind = AFTER_S if role[:1] == "s" else behind if role else state
            else:
                role = ROLES[made]
            digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun, state = True, behind
        return begun

    def result(self) -> tuple:
        self.close(self.rows, last=True)
        ((cost, audit, digest, _),) = self.items.values()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, cost, "".join(self.written) + audit, digest.hexdigest())


REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
RESULT_ROWS = 1000


def repair_batches(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Rows of REPAIRED from rows (conv_id, turn, role, text, dropped, fault) in the order of conversations and turns."""
    now: Conversation | None = None
    done: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, pa.string() if k >= 7 else pa.int64()) for k, c in enumerate(zip(*done, strict=True))]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in REPAIRED.split(", ")])

    for batch in batches:
        for conv_id, turn, role, text, dropped, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.result())
                now = Conversation(conv_id, segment)
            if not dropped:
                now.add(turn, role, text, fault)
        if len(done) >= RESULT_ROWS:
            yield flush()
    if now is not None:
        done.append(now.result())
    if done:
        yield flush()


# ------------------------------------------------------------------ the operator


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row of REPAIRED for each conv_id of ``rows`` (conv_id, turn, role, text, dropped), a null conv_id being one too.

    ``gaps`` counts missing turns between the least and the greatest, ``blank``, ``duplicate`` and ``truncated`` rows by
    first fault, ``illegal`` neighbours whose role initials are none of su, ua, au. ``cost`` and ``audit`` are those of
    the cheapest edits that make the role initials ``(s?(ua)+)?``; among equal costs the audit least in ASCII counts.
    ``repaired_sha256`` is of the repaired ``role:text`` lines. A conversation without rows (all dropped) has zeros, an
    empty audit and the hash of the empty text. Repeated rows are duplicates, other rows of equal turns are ordered by role
    and text; an empty role adds no initial, so its rows may be kept anywhere, and its pairs count as ``illegal``. An empty table gives an empty one.

    A conversation is read by one task, as its digest is one hash over all its texts; it is streamed, never held.
    """
    ready(rows.sparkSession)
    ordered = with_faults(rows).sortWithinPartitions("conv_id", *turn_order())
    columns = ("conv_id", "turn", "role", "text", "dropped", "fault")
    return ordered.select(*columns).mapInArrow(lambda b: repair_batches(b, segment), REPAIRED)


def repaired_turns(rows: DataFrame, repaired: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, edit, role, text), ``place`` from 1, deleted rows left out.

    Edits are taken from the audits of ``repair(rows)`` and meet their rows by number; null conv_ids included.
    """
    number = Window.partitionBy("conv_id").orderBy(*turn_order())
    numbered = rows.filter("NOT dropped").withColumn("_row", F.row_number().over(number)).select("conv_id", "_row", "role", "text")
    edits = repaired.filter("audit <> ''").select("conv_id", F.posexplode(F.split("audit", "")).alias("_at", "edit"))
    so_far = Window.partitionBy("conv_id").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    edits = edits.withColumn("_row", F.when(F.col("edit") != INSERT, F.sum((F.col("edit") != INSERT).cast("long")).over(so_far)))
    met = edits.alias("e").join(numbered.alias("r"), F.col("e.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("e._row") == F.col("r._row")), "left")
    kept = met.filter(F.col("edit") != DELETE).select("e.conv_id", "_at", "edit", "role", "text")
    behind = Window.partitionBy("conv_id").orderBy("_at")
    # Turns with an initial alternate from the first on, but for a kept s, which is before all of them.
    own = F.col("edit") == KEEP
    counts = ~(own & ((F.col("role") == "") | F.col("role").startswith("s")))
    placed = kept.withColumn("place", F.row_number().over(behind)).withColumn("_nth", F.sum(counts.cast("int")).over(so_far))
    made = F.when(F.col("_nth") % 2 == 1, ROLES["u"]).otherwise(ROLES["a"])
    return placed.select(
        "conv_id", "place", "edit", F.when(F.col("edit") == KEEP, F.col("role")).otherwise(made).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
