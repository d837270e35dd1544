import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from admitflow.llm import queries, turns

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, segment string, edits int"


def brute_edits(initials, faults):
    """Cheapest edits by Dijkstra's algorithm over (cost, edits)."""
    heap, seen = [(0, "", 0, 0)], set()
    need, keep = (2, 2, 3, 2), ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    while heap:
        cost, done, at, state = heapq.heappop(heap)
        if at == len(initials) and state in (0, 3):
            return cost, done
        if (at, state) in seen:
            continue
        seen.add((at, state))
        heapq.heappush(heap, (cost + 5, done + "I", at, need[state]))
        if at < len(initials):
            heapq.heappush(heap, (cost + 2, done + "D", at + 1, state))
            if faults[at] in "t-":
                extra = 5 * (faults[at] == "t")
                heapq.heappush(heap, (cost + extra + 1, done + "R", at + 1, need[state]))
                if initials[at] in keep[state]:
                    heapq.heappush(heap, (cost + extra, done + "K", at + 1, keep[state][initials[at]]))


def written(value):
    return " " if value is None else str(value)


def brute_report(rows):
    """{conv_id: result} of the contract, row by row."""
    conversations = {}
    for conv_id, turn, role, text in rows:
        kept = conversations.setdefault(conv_id, [])
        role, text = written(role), written(text)
        kind = zlib.crc32(f"{written(conv_id)}:{written(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        kept += [((turn is not None, turn or 0, digest), turn, role, text)] * (2 if kind == 3 else 1)
    results = {}
    for conv_id, kept in conversations.items():
        kept.sort(key=lambda row: row[0])
        initials, faults, seen = "", "", set()
        for _, _, role, text in kept:
            rest = text.rstrip(WHITE)
            fault = "b" if not rest else "d" if (role, text) in seen else "t" if rest[-1] not in ".!?" else "-"
            seen.add((role, text))
            initials += role[:1] if role[:1] in ("s", "u", "a") else "o"
            faults += fault
        numbers = [turn for _, turn, _, _ in kept if turn is not None]
        cost, audit = brute_edits(initials, faults)
        lines, at, state = [], 0, 0
        for edit in audit:
            if edit == "K":
                lines.append(f"{kept[at][2]}:{kept[at][3]}")
                state = {"s": 1, "u": 2, "a": 3}[initials[at]]
            elif edit in "IR":
                state = 3 if state == 2 else 2
                lines.append(f"{'user' if state == 2 else 'assistant'}:{kept[at][3] if edit == 'R' else ''}")
            at += edit != "I"
        results[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *[faults.count(f) for f in "bdt"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return results


def results(df):
    rows = df.collect()
    found = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("stretch", [1, 2, 5, 32])
def test_the_first_path_is_the_cheapest_and_least(stretch):
    rng = random.Random(stretch)
    for _ in range(1500):
        rows = rng.randint(0, 12)
        initials = "".join(rng.choice("suuuaaao") for _ in range(rows))
        faults = "".join(rng.choice("bdt-----") for _ in range(rows))
        assert turns.cheapest_edits(initials, faults, stretch) == brute_edits(initials, faults), (initials, faults)
        _, audit = turns.cheapest_edits(initials, faults, stretch)
        left, _ = turns.edited(audit, 0, list(initials), list(initials))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in left))


def test_the_search_of_a_long_conversation_grows_with_its_rows():
    rng = random.Random(5)
    initials = "".join("ua"[i % 2] if rng.random() > 0.1 else "u" for i in range(20_000))
    faults = "".join(rng.choice("bdt" + 10 * "-") for _ in range(20_000))
    assert turns.cheapest_edits(initials, faults) == turns.cheapest_edits(initials, faults, stretch=7)


def odd_rows():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "why", "", None, " \t", "Same.", "Same.", "a?\n", "\x1f", "e.　", "x" * 200_000 + "."]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "unknown"]
    rows = []
    for conv_id in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            turn = None if rng.random() < 0.1 else turn - rng.randint(0, 1)
            rows.append((conv_id, turn, rng.choice(roles), rng.choice(texts)))
    return rows + rows[:20]


@pytest.mark.parametrize("most_rows", [1, 3, 4096])
def test_odd_rows_equal_brute_force(spark, most_rows):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    cut, found = turns.repair(turns.damage(df), most_rows)
    assert results(turns.digests(cut, found)) == brute_report(rows)


def test_a_conversation_that_holds_most_rows_is_spread(spark):
    rows = [(7, i // 2, "user" if i % 2 else "assistant", f"{i % 11}.") for i in range(3000)]
    rows += [(i, 0, "user", "Hi.") for i in range(100, 200)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    cut, found = turns.repair(turns.damage(df), 100)
    assert cut.where("conv_id = 7").count() > 25
    assert cut.agg(F.max(F.size("roles"))).first()[0] <= 100
    assert results(turns.digests(cut, found)) == brute_report(rows)


def test_repaired_rows_are_those_of_the_digest(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    cut, found = turns.repair(turns.damage(df), 2)
    left = {}
    for row in turns.repaired_turns(cut, found).orderBy("segment", "place").collect():
        left.setdefault(row["conv_id"], []).append(f"{row['role']}:{row['text']}")
    for conv_id, expected in brute_report(rows).items():
        assert hashlib.sha256("\n".join(left.get(conv_id, [])).encode()).hexdigest() == expected[-1]


def test_an_empty_table_and_a_dropped_conversation(spark):
    assert results(turns.audit(spark.createDataFrame([], SCHEMA))) == {}
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.", "x", 1)], SCHEMA)
    assert results(turns.audit(df)) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_the_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert results(queries.op11_conversation_repair(spark, folder)) == brute_report([tuple(r) for r in rows])
