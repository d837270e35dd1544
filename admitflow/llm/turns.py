"""Repair the structure of conversations with the cheapest edits, found by iterative-deepening A*.

A conversation's rows become two letters each: the role's initial and the row's fault. The edits are D delete, I insert,
K keep and R rerole; the roles they leave have to read ``(s?(ua)+)?``. A depth-first search takes the edits in that
(ASCII) order under a cost bound; the bound grows until a path is accepted, so the first one is the cheapest, and of the
cheapest the least. A transposition table holds for every place and role state the cost that is proven too small.

Long conversations are cut twice. Rows are range partitioned by conversation and turn into segments, so that a
conversation of any size is spread over tasks and only its two letters a row meet in one place. There the search runs
over stretches of a few rows from the last to the first, each ending in the exact remaining costs of the next, so its
work grows with the rows and not with the cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admitflow.llm.common import stored

WHITE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

# Rows that one segment, the unit of storage and repair, holds at most, and the bytes after which it ends.
SEGMENT_ROWS = 4_096
SEGMENT_BYTES = 8 << 20
# Rows that one search goes over.
STRETCH = 32

# Role states: nothing yet, after system, after user, after assistant. What may be kept, and what has to come.
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_NEXT = (2, 2, 3, 2)
_ACCEPTED = (0, 3)
_ROLE = {2: "user", 3: "assistant"}
_INFINITE = 1 << 60


def _moves(initial: str, fault: str) -> list[list[tuple[str, int, int, int]]]:
    """Per role state the edits of one row in ASCII order: (edit, cost, rows taken, next state)."""
    moves = []
    for state in range(4):
        own = [("D", DELETE, 1, state), ("I", INSERT, 0, _NEXT[state])]
        if fault not in "bd":
            extra = TRUNCATED if fault == "t" else 0
            if initial in _KEEP[state]:
                own.append(("K", extra, 1, _KEEP[state][initial]))
            own.append(("R", REROLE + extra, 1, _NEXT[state]))
        moves.append(own)
    return moves


_MOVES = {(initial, fault): _moves(initial, fault) for initial in "suao" for fault in "bdt-"}
_ONLY_INSERT = [[("I", INSERT, 0, _NEXT[state])] for state in range(4)]


class Stretch:
    """The search over a few rows. ``after`` holds the exact remaining cost per state behind them; None at the end."""

    def __init__(self, rows: list[tuple[str, str]], after: list[int] | None):
        self._after = after
        self._moves = [_MOVES[row] for row in rows] + [_ONLY_INSERT if after is None else [[]] * 4]
        # The transposition table, at first the least that each row costs by itself.
        self._proven = [list(after) if after else [0] * 4]
        for row in reversed(rows):
            least = min(cost for own in _MOVES[row] for _, cost, taken, _ in own if taken)
            self._proven.append([least + min(self._proven[-1])] * 4)
        self._proven.reverse()

    def cheapest(self, state: int) -> tuple[int, str, int]:
        """(cost with what follows, edits, last state) of the cheapest path, the ASCII-least of equal ones."""
        bound = self._proven[0][state]
        while (found := self._search(state, bound)) is None:
            bound = max(bound + 1, self._proven[0][state])
        return (bound, *found)

    def _accepts(self, at: int, state: int, left: int) -> bool:
        if at < len(self._moves) - 1:
            return False
        return state in _ACCEPTED if self._after is None else self._after[state] <= left

    def _search(self, state: int, bound: int) -> tuple[str, int] | None:
        proven, moves = self._proven, self._moves
        # Frames: row, state, cost left, number of the next edit, edit that led here, its cost, least cost found open.
        stack = [[0, state, bound, 0, "", 0, _INFINITE]]
        while stack:
            frame = stack[-1]
            at, state, left, number = frame[:4]
            if not number and self._accepts(at, state, left):
                return "".join(f[4] for f in stack), state
            own = moves[at][state]
            while number < len(own):
                edit, cost, taken, then = own[number]
                number += 1
                needs = cost + proven[at + taken][then]
                if needs <= left:
                    frame[3] = number
                    stack.append([at + taken, then, left - cost, 0, edit, cost, _INFINITE])
                    break
                frame[6] = min(frame[6], needs)
            else:
                # No edit leads on with what was left: the least that any edit needs is proven.
                proven[at][state] = max(proven[at][state], frame[6])
                stack.pop()
                if stack:
                    stack[-1][6] = min(stack[-1][6], frame[5] + proven[at][state])
        return None


def cheapest_edits(initials: str, faults: str, stretch: int = STRETCH) -> tuple[int, str]:
    """(cost, edits) of one conversation. ``initials``: s, u, a, or o for others; ``faults``: b, d, t or -."""
    rows = list(zip(initials, faults))
    starts = list(range(0, len(rows), stretch)) or [0]
    found: list[list[tuple[int, str, int]]] = []
    after = None
    for start in reversed(starts):
        search = Stretch(rows[start : start + stretch], after)
        found.append([search.cheapest(state) for state in range(4 if start else 1)])
        after = [cost for cost, _, _ in found[-1]]
    found.reverse()
    edits, state = [], 0
    for own in found:
        _, part, state = own[state]
        edits.append(part)
    return found[0][0][0], "".join(edits)


def illegal_pairs(initials: str) -> int:
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


def edited(edits: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[tuple[str, str]], int]:
    """The rows that ``edits`` leave of a segment entered in ``state``, and the state behind it."""
    rows, at = [], 0
    for edit in edits:
        if edit == "I":
            state = _NEXT[state]
            rows.append((_ROLE[state], ""))
            continue
        if edit == "K":
            state = _KEEP[state][roles[at][:1]]
            rows.append((roles[at], texts[at]))
        elif edit == "R":
            state = _NEXT[state]
            rows.append((_ROLE[state], texts[at]))
        at += 1
    return rows, state


# --- damage, as the query's contract asks ---


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): one fault for one row in four, chosen by crc32 of ``conv_id:turn`` % 20.

    0 drops the row (it stays as a mark, so that its conversation does), 1 empties its text, 2 removes ``.!?``, 3 repeats
    it, 4 makes it the user's. A null role or text, and a null in the hashed name, is one space.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    named = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), filled("role").alias("role"),
        filled("text").alias("text"), kind.alias("__kind"),
    )
    text = F.when(F.col("__kind") == 1, F.lit("")).when(F.col("__kind") == 2, F.translate("text", ".!?", ""))
    copies = F.when(F.col("__kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return named.select(
        "conv_id",
        "turn",
        F.when(F.col("__kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        (F.col("__kind") == 0).alias("dropped"),
        F.explode(copies).alias("__copy"),
    ).drop("__copy")


# --- segments ---

_SEGMENT_SCHEMA = (
    "conv_id long, segment long, initials string, faults string, roles array<string>, texts array<string>,"
    " firsts array<struct<at: int, digest: binary>>, turn_first long, turn_last long, turn_count long"
)


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


class _OpenSegment:
    def __init__(self, conv_id: int | None, number: int):
        self.conv_id, self.number, self.bytes = conv_id, number, 0
        self.initials: list[str] = []
        self.faults: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.firsts: dict[bytes, int] = {}
        self.turns: list[int] = []  # first and last, nulls aside
        self.turn_count = 0

    def full(self, most_rows: int) -> bool:
        return len(self.roles) >= most_rows or self.bytes >= SEGMENT_BYTES

    def add(self, row: dict) -> None:
        if row["dropped"]:
            return
        turn, digest = row["turn"], row["digest"]
        if turn is not None:
            if not self.turns or self.turns[1] != turn:
                self.turn_count += 1
            self.turns = [self.turns[0] if self.turns else turn, turn]
        fault = row["fault"]
        if fault != "b" and self.firsts.setdefault(digest, len(self.roles)) != len(self.roles):
            fault = "d"
        initial = row["role"][:1]
        self.initials.append(initial if initial and initial in "sua" else "o")
        self.faults.append(fault)
        self.roles.append(row["role"])
        self.texts.append(row["text"])
        self.bytes += len(row["text"]) + len(row["role"]) + 64

    def row(self) -> dict:
        first, last = self.turns or (None, None)
        return {
            "conv_id": self.conv_id,
            "segment": self.number,
            "initials": "".join(self.initials),
            "faults": "".join(self.faults),
            "roles": self.roles,
            "texts": self.texts,
            "firsts": [{"at": at, "digest": digest} for digest, at in self.firsts.items()],
            "turn_first": first,
            "turn_last": last,
            "turn_count": self.turn_count,
        }


def _cut_task(schema: pa.Schema, most_rows: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, opened = TaskContext.get().partitionId() << 40, None
        done: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if opened is None or row["conv_id"] != opened.conv_id or opened.full(most_rows):
                    if opened is not None:
                        done.append(opened.row())
                        size += opened.bytes
                        if size >= SEGMENT_BYTES:
                            yield pa.RecordBatch.from_pylist(done, schema)
                            done, size = [], 0
                    opened = _OpenSegment(row["conv_id"], number)
                    number += 1
                opened.add(row)
        if opened is not None:
            done.append(opened.row())
            yield pa.RecordBatch.from_pylist(done, schema)

    return cut


def segments(rows: DataFrame, most_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The rows of each conversation by turn (nulls first, then by digest), cut into numbered segments; stored.

    Range partitions cut a conversation wherever it has many rows; a running number tells copies apart, so a run of them
    can be cut as well.
    """
    rest = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(rest == "", F.lit("b")).when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), F.lit("t")).otherwise("-")
    digest = F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
    keyed = rows.select(
        "conv_id", "turn", "role", "text", "dropped", fault.alias("fault"), digest.alias("digest"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tie")]
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    schema = _arrow_schema(rows.sparkSession, _SEGMENT_SCHEMA)
    return stored(sorted_rows.mapInArrow(_cut_task(schema, most_rows), _SEGMENT_SCHEMA), "segments")


def later_copies(cut: DataFrame) -> DataFrame:
    """(segment, later): places whose role and text an earlier segment of the conversation has.

    A segment offers each text once, so a text that fills a conversation comes as one row a segment.
    """
    offered = cut.select("conv_id", "segment", F.explode("firsts").alias("first"))
    places = offered.groupBy("conv_id", F.col("first.digest").alias("digest")).agg(
        F.array_sort(F.collect_list(F.struct("segment", F.col("first.at").alias("at")))).alias("places")
    )
    repeated = places.where(F.size("places") > 1).select(F.explode(F.expr("slice(places, 2, size(places) - 1)")))
    return repeated.groupBy(F.col("col.segment").alias("segment")).agg(F.collect_list("col.at").alias("later"))


# --- search ---

_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_EDIT_SCHEMA = f"conv_id long, segment long, edits string, state int, {_SUMMARY}"


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Neighbouring rows of one conversation."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv_id"] != row["conv_id"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _marked(faults: str, later: list[int] | None) -> str:
    if not later:
        return faults
    marks = list(faults)
    for at in later:
        marks[at] = "d"
    return "".join(marks)


def _turn_gaps(parts: list[dict]) -> int:
    filled = [p for p in parts if p["turn_count"]]
    if not filled:
        return 0
    shared = sum(a["turn_last"] == b["turn_first"] for a, b in zip(filled, filled[1:]))
    distinct = sum(p["turn_count"] for p in filled) - shared
    return filled[-1]["turn_last"] - filled[0]["turn_first"] + 1 - distinct


def _repair(parts: list[dict]) -> list[dict]:
    """Edits of each segment of one conversation; the first one carries the summary."""
    initials = "".join(p["initials"] for p in parts)
    faults = "".join(_marked(p["faults"], p["later"]) for p in parts)
    cost, audit = cheapest_edits(initials, faults)
    rows, at, state = [], 0, 0
    for number, part in enumerate(parts):
        end, wanted = at, len(part["initials"])
        while wanted and end < len(audit):
            wanted -= audit[end] != "I"
            end += 1
        if number == len(parts) - 1:
            end = len(audit)
        own = audit[at:end]
        rows.append({"conv_id": part["conv_id"], "segment": part["segment"], "edits": own, "state": state})
        letters = list(part["initials"])
        _, state = edited(own, state, letters, letters)
        at = end
    rows[0] |= {
        "gaps": _turn_gaps(parts),
        "blank": faults.count("b"),
        "duplicate": faults.count("d"),
        "truncated": faults.count("t"),
        "illegal": illegal_pairs(initials),
        "cost": cost,
        "audit": audit,
    }
    return rows


# Letters after which a batch of edits is handed on.
_BATCH_LETTERS = 1 << 20


def _search_task(schema: pa.Schema):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        size = 0
        for parts in _groups(batches):
            done.extend(_repair(parts))
            size += 64 + sum(len(p["initials"]) for p in parts)
            if size >= _BATCH_LETTERS:
                yield pa.RecordBatch.from_pylist(done, schema)
                done, size = [], 0
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return search


def edits(cut: DataFrame) -> DataFrame:
    """Per segment its edits and the role state before it; the first segment of a conversation carries the summary."""
    letters = cut.select("conv_id", "segment", "initials", "faults", "turn_first", "turn_last", "turn_count")
    marked = letters.join(later_copies(cut), "segment", "left")
    grouped = marked.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    schema = _arrow_schema(cut.sparkSession, _EDIT_SCHEMA)
    return stored(grouped.mapInArrow(_search_task(schema), _EDIT_SCHEMA), "edits")


# --- results ---


def _with_texts(cut: DataFrame, found: DataFrame, by: str) -> DataFrame:
    """Each segment's edits (``roles`` is null) directly followed by its rows, in tasks dealt by ``by``."""
    summary = [c for c in found.columns if c not in ("conv_id", "segment")]
    texts = cut.select("conv_id", "segment", "roles", "texts")
    both = found.unionByName(texts, allowMissingColumns=True)
    order = [F.col("conv_id"), F.col("segment"), F.col("roles").isNotNull()]
    return both.repartition(by).sortWithinPartitions(*order).select("conv_id", "segment", *summary, "roles", "texts")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of a few at a time: a row can be a whole segment."""
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            yield from batch.slice(start, 64).to_pylist()


_TURN_SCHEMA = "conv_id long, segment long, place int, role string, text string"


def repaired_turns(cut: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, segment, place, role, text): the rows after the edits, ordered by segment and place."""
    schema = _arrow_schema(cut.sparkSession, _TURN_SCHEMA)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for row in _rows(batches):
            if row["roles"] is None:
                own = row
                continue
            left, _ = edited(own["edits"], own["state"], row["roles"], row["texts"])
            found = [
                {"conv_id": row["conv_id"], "segment": row["segment"], "place": i, "role": role, "text": text}
                for i, (role, text) in enumerate(left)
            ]
            yield pa.RecordBatch.from_pylist(found, schema)

    return _with_texts(cut, found, "segment").mapInArrow(turns, _TURN_SCHEMA)


_RESULT_SCHEMA = f"conv_id long, {_SUMMARY}, repaired_sha256 string"


def digests(cut: DataFrame, found: DataFrame) -> DataFrame:
    """One row per conversation: its summary and the sha256 of its repaired ``role:text`` lines.

    A digest is a chain over the whole conversation, so its segments pass one task, one after the other; none is held.
    """
    schema = _arrow_schema(cut.sparkSession, _RESULT_SCHEMA)
    wanted = [f.name for f in schema][1:-1]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        row_open, chain, lines, own = None, hashlib.sha256(), 0, None
        for row in _rows(batches):
            if row["roles"] is None:
                own = row
                if row["audit"] is not None:  # the first segment of a conversation
                    if row_open is not None:
                        done.append(row_open | {"repaired_sha256": chain.hexdigest()})
                    row_open = {"conv_id": row["conv_id"], **{name: row[name] for name in wanted}}
                    chain, lines = hashlib.sha256(), 0
                    if len(done) >= 4096:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done = []
                continue
            left, _ = edited(own["edits"], own["state"], row["roles"], row["texts"])
            for role, text in left:
                chain.update((f"\n{role}:{text}" if lines else f"{role}:{text}").encode())
                lines += 1
        if row_open is not None:
            done.append(row_open | {"repaired_sha256": chain.hexdigest()})
            yield pa.RecordBatch.from_pylist(done, schema)

    return _with_texts(cut, found, "conv_id").mapInArrow(digest, _RESULT_SCHEMA)


def repair(rows: DataFrame, most_rows: int = SEGMENT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(segments, edits) of conversations given as (conv_id, turn, role, text, dropped); both are stored.

    ``repaired_turns`` gives the repaired rows of both, ``digests`` one row per conversation. Rows go by turn, nulls
    first; rows of one turn by the digest of role and text, so equal rows are neighbours. Role and text are not null
    here (``damage`` makes them one space). A role other than system, user and assistant, or an empty one, cannot be
    kept. The rows of a null conv_id are one conversation. A conversation whose rows are all dropped has no edits and
    costs nothing. An empty table gives no rows. Other columns are not read. An audit is one string, so a conversation
    has at most as many edits as a string has letters.
    """
    cut = segments(rows, most_rows)
    return cut, edits(cut)


def audit(conversations: DataFrame) -> DataFrame:
    """Damage the conversations as the contract says, repair them and report on each."""
    cut, found = repair(damage(conversations))
    return digests(cut, found)
