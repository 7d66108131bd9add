"""Conversation repair against a plain search over all edits, pieces of all sizes, and edge cases."""

import hashlib
import heapq
import random
import zlib
from itertools import count

import numpy as np
import pytest

from tideferry.llm import conversation_repair
from tideferry.llm.conversation_repair import ranked_paths

SCHEMA = "conv_id bigint, turn bigint, role string, text string, id string, block string, kind string, audit string"
WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    found = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if code == 4:
            role = "user"
        found += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return found


def cheapest(rows):
    """The least (cost, audit) by Dijkstra over rows, states and audits, and the repaired lines."""
    order, heap = count(), [(0, "", 0, 0, next(count()), ())]
    done = set()
    step = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    while heap:
        cost, audit, i, state, _, lines = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, lines
        if (i, state) in done:
            continue
        done.add((i, state))

        def push(more, letter, j, to, line):
            heapq.heappush(heap, (cost + more, audit + letter, j, to, next(order), lines + line))

        name, to = step[state]
        push(5, "I", i, to, (f"{name}:",))
        if i < len(rows):
            role, text, fault = rows[i]
            push(2, "D", i + 1, state, ())
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                push(extra + 1, "R", i + 1, to, (f"{name}:{text}",))
                if role[:1] == name[0]:
                    push(extra, "K", i + 1, to, (f"{role}:{text}",))
                if role[:1] == "s" and state == 0:
                    push(extra, "K", i + 1, 1, (f"{role}:{text}",))
    raise AssertionError("no way to the end")


def plain(rows, damaged):
    found = []
    for conv in {row[0] for row in rows}:
        own = sorted(((turn is not None, turn or 0, role, text) for c, turn, role, text in damaged if c == conv))
        turns = [turn for known, turn, _, _ in own if known]
        judged, seen = [], set()
        for _, _, role, text in own:
            bare = text.rstrip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        faults = [fault for _, _, fault in judged]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, lines = cheapest(judged)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest))
    return sorted(found, key=str)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*row, "clash", "clash", "clash", "clash") for row in rows], SCHEMA).repartition(parts)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def some_rows(seed, conversations, longest):
    chance, rows = random.Random(seed), []
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "Assistant", "sys", "", None]
    texts = ["Yes.", "No!", "and", "Why?", "", " \t", "Yes.", None, "so on.\n", "…"]
    for conv in range(conversations):
        for _ in range(chance.randint(1, longest)):
            turn = None if chance.random() < 0.05 else chance.randint(-2, longest)
            rows.append((None if conv == 3 else conv, turn, chance.choice(roles), chance.choice(texts)))
    return rows


@pytest.mark.parametrize(("seed", "longest"), [(1, 4), (2, 9), (3, 25)])
def test_equal_to_a_plain_search(spark, seed, longest):
    rows = some_rows(seed, 60, longest)
    assert rows_of(conversation_repair.report(table(spark, rows))) == plain(rows, plain_damage(rows))


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_conversations_over_many_pieces(spark, monkeypatch, bits):
    monkeypatch.setattr(conversation_repair, "BLOCK_BITS", bits)
    rows = some_rows(4, 12, 40) + [(7, i, "user" if i % 3 else "assistant", f"{i}.") for i in range(300)]
    given = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert rows_of(conversation_repair.repaired(table(spark, rows))) == plain(rows, given)


def test_a_conversation_that_loses_all_rows(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = conversation_repair.report(table(spark, [(lost, 0, "user", "Hello.")])).collect()
    assert [tuple(row) for row in found] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_texts_and_extremes(spark):
    rows = [(1, 0, "user", "long " * 200_000 + "."), (1, 1, "assistant", "word" * 100_000), (2, -(1 << 62), "user", "A."), (2, 1 << 62, "assistant", "B.")]
    given = [tuple(row) for row in rows]
    assert rows_of(conversation_repair.repaired(table(spark, rows[:2]))) == plain(rows[:2], given[:2])
    assert rows_of(conversation_repair.repaired(table(spark, rows[2:])))[0][6:8] == (0, "KK")


def test_empty_table(spark):
    found = conversation_repair.report(table(spark, []))
    assert found.collect() == [] and "repaired_sha256" in found.columns


def test_ranks_tell_audits_apart():
    # Two chains of equal letters, one of others, and an end.
    letter = np.array([4, 3, 1, 0, 3, 1, 0, 3, 2, 1, 0])
    target = np.array([1, 2, 3, 3, 5, 6, 6, 8, 9, 10, 10])
    index, audits, ends = ranked_paths(letter, target, np.array([0, 1, 4, 7]), 4)
    assert [audits[i] for i in index] == [b"RKD", b"KD", b"KD", b"KID"]
    assert index[1] == index[2] and ends.tolist() == [3, 3, 6, 10]
