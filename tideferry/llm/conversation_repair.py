"""Repair of conversations: the cheapest edits that make their roles alternate, by prefix-doubling path ranking.

A conversation's rows, in order, are to give the role initials
``(s?(ua)+)?``. Edits are Keep, Rerole, Delete and Insert; a row is a step of a
graph over four states (nothing yet, after system, after user, after
assistant), and an insertion is an arc within a step. The cost to the end is
computed backwards; arcs that attain it are optimal.

Optimal-arc nodes are then ranked by their least audits of one letter, of two,
of four and so on: an audit of twice the length is a pair of ranks, its own and
that of the node its doubled pointer leads to. A letter and a state name the
next state, so the least letter leaves one arc, and equal ranks mean equal
audits. Audits are read through the doubled pointers, each distinct one once.

Rows are sorted over all tasks, and blocks of ``BLOCK`` rows, whole or partial
conversations alike, are worked on by themselves: first each piece's cost
matrix between its ends; then, per conversation, the costs behind each piece;
then audits for each state a piece may be entered in; last, per conversation,
the chain of pieces. What meets in one place for a conversation are its pieces,
a matrix each, and the result itself: its audit, and one running hash over its
repaired lines, which stream by in order.

Defined results: a null role, text or id in a key counts as one space; null
conversations are one conversation, null turns come first. Rows of one turn are
ordered by role, then text. A role's initial is its first character; only s, u
and a can be kept. A conversation that lost all rows has zeros, an empty audit
and the hash of nothing. Repeated rows are rows of their own. Texts of any length
are read whole; an empty table has no rows. Only the four columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideferry.llm.checksums import sql_crc32
from tideferry.llm.ordering import sorted_rows
from tideferry.llm.words import parts
from tideferry.sources.shared import scratch_path

# What edits cost, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# Rows of a block, as a power of two.
BLOCK_BITS = 11

STATES = 4
NOTHING, SYSTEM, USER, ASSISTANT = range(STATES)
# The state an added or reroled turn leads to, from each state.
NEXT = np.array([USER, USER, ASSISTANT, USER])
NEVER = 1 << 40

# A row's kind, in bits: its role's initial, what is wrong with it.
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
BLANK, DUPLICATE, CUT = 4, 8, 16

WHITE = " \t\n\x0b\x0c\r"
LETTERS = np.frombuffer(b"\0DIKR", dtype=np.uint8)
D, I, K, R = 1, 2, 3, 4


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage: dropped, emptied, cut, repeated, or given to the user, by a checksum of conversation and turn."""
    blank = F.lit(" ")
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), blank).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )
    key = F.concat_ws(":", "conv", F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("code", F.crc32(key) % 20).filter("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")


def as_given(conversations: DataFrame) -> DataFrame:
    """The rows as they are, nulls as one space."""
    blank = F.lit(" ")
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), blank).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )


def _kinds(rows: DataFrame) -> DataFrame:
    """id, conversation, turn and kind of sorted rows."""
    ending = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    initial = F.left("role", F.lit(1))
    number = F.lit(0)
    for letter, state in INITIALS.items():
        number = F.when(initial == letter, state).otherwise(number)
    seen = rows.select("id", "conv", "turn", number.alias("initial"), ending.alias("ending"), same.alias("same"))
    first = seen.groupBy("conv", "same").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("first"))
    fault = F.when(F.col("ending") == "", BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("ending").isin(".", "!", "?"), CUT).otherwise(0)
    return seen.join(first, "id", "left").select("id", "conv", "turn", (F.col("initial") + fault).cast("int").alias("kind"))


def _row_arcs(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and states, the costs of deleting, keeping and reroling, and the states keeping leads to."""
    initial = kind & 3
    costs = np.full((len(kind), STATES, 3), NEVER, dtype=np.int64)
    costs[:, :, 0] = DELETE
    undeleted = np.where(kind & (BLANK | DUPLICATE), NEVER, np.where(kind & CUT, TRUNCATED, 0))
    costs[:, :, 2] = (undeleted + REROLE)[:, None]
    costs[:, NOTHING, 1] = np.where((initial == SYSTEM) | (initial == USER), undeleted, NEVER)
    for state in (SYSTEM, ASSISTANT):
        costs[:, state, 1] = np.where(initial == USER, undeleted, NEVER)
    costs[:, USER, 1] = np.where(initial == ASSISTANT, undeleted, NEVER)
    return np.minimum(costs, NEVER), initial


def _with_insertions(costs: np.ndarray) -> np.ndarray:
    """Costs to the end from states (last axis but what follows), if turns may be added first; two are enough."""
    once = INSERT + costs[..., NEXT]
    return np.minimum(np.minimum(costs, once), INSERT + once[..., NEXT])


# Costs from each state where a conversation ends.
AT_END = _with_insertions(np.array([0, NEVER, NEVER, 0], dtype=np.int64))


class Segments:
    """Consecutive rows of one conversation within a block, of all blocks in a batch."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        rows = batch.column("rows")
        block = np.repeat(np.arange(len(rows)), np.diff(rows.offsets.to_numpy()))
        fields = rows.flatten()
        self.ids = fields.field("id").to_numpy(zero_copy_only=False)
        self.kind = fields.field("kind").to_numpy(zero_copy_only=False).astype(np.int64)
        conv = fields.field("conv").to_numpy(zero_copy_only=False)
        changes = np.ones(len(self.ids), dtype=bool)
        changes[1:] = (conv[1:] != conv[:-1]) | (block[1:] != block[:-1])
        self.begin = np.flatnonzero(changes)
        self.length = np.diff(np.append(self.begin, len(self.ids)))
        self.conv, self.first = conv[self.begin], self.ids[self.begin]
        self.costs, self.initial = _row_arcs(self.kind)

    def __len__(self) -> int:
        return len(self.begin)

    def before_row(self, at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Costs to the end before rows, given those after them; ``after`` may have axes between rows and states."""
        costs, initial = self.costs[at], self.initial[at]
        shape = (len(at),) + (1,) * (after.ndim - 2)
        kept = np.take_along_axis(after, np.broadcast_to(initial.reshape(*shape, 1), (*after.shape[:-1], 1)), -1)
        spread = [costs[:, :, i].reshape(*shape, STATES) for i in range(3)]
        least = np.minimum(np.minimum(spread[0] + after, spread[1] + kept), spread[2] + after[..., NEXT])
        return np.minimum(_with_insertions(least), NEVER)

    def backwards(self, after: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row by row from the segments' ends: segments, their rows, and the costs before these rows."""
        for step in range(int(self.length.max(initial=0))):
            own = np.flatnonzero(self.length > step)
            at = self.begin[own] + self.length[own] - 1 - step
            after[own] = self.before_row(at, after[own])
            yield own, at, after[own]


_PIECE = "conv string, first bigint, matrix array<bigint>, head int, tail int, illegal bigint, blank bigint, duplicate bigint, truncated bigint"
_BEHIND = "conv string, first bigint, is_first boolean, behind array<bigint>, is_last boolean, cost bigint"
_AUDIT = "conv string, first bigint, entry int, exit int, audit string"
_CHAIN = "conv string, pieces array<struct<first: bigint, audit: string>>"


def _lists(values: np.ndarray) -> pa.Array:
    values = np.ascontiguousarray(values, dtype=np.int64)
    width = values.shape[1]
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * width, pa.array(values.ravel()))


def _pieces(blocks: DataFrame) -> DataFrame:
    """Every segment's least costs between its ends, and its counts."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Segments(batch)
            n = len(found)
            matrix = np.where(np.eye(STATES, dtype=bool), 0, NEVER).astype(np.int64)
            after = np.repeat(matrix[None], n, axis=0)  # segment, state at the end, state now
            for _ in found.backwards(after):
                pass
            kind, initial = found.kind, found.initial
            legal = np.isin(initial[:-1] * 4 + initial[1:], [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
            inside = np.ones(len(kind), dtype=bool)
            inside[found.begin] = False
            illegal = np.zeros(len(kind), dtype=np.int64)
            illegal[1:] = inside[1:] & ~legal
            tail = initial[found.begin + found.length - 1]
            sums = [np.add.reduceat(x, found.begin) for x in (illegal, (kind & BLANK) > 0, (kind & DUPLICATE) > 0, (kind & CUT) > 0)] if n else [np.empty(0)] * 4
            columns = [pa.array(found.conv, pa.string()), pa.array(found.first), _lists(after.reshape(n, -1)), pa.array(initial[found.begin], pa.int32()), pa.array(tail, pa.int32())]
            columns += [pa.array(x.astype(np.int64)) for x in sums]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _PIECE.split(", ")])

    return blocks.mapInArrow(measure, _PIECE)


def _behind(pieces: DataFrame) -> DataFrame:
    """For every piece, the least costs behind it to its conversation's end, and the whole conversation's."""
    own = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("first", "matrix"))).alias("pieces"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pieces")
            count = np.diff(lists.offsets.to_numpy())
            begin, fields = np.cumsum(count) - count, lists.flatten()
            matrices = fields.field("matrix").flatten().to_numpy().reshape(-1, STATES, STATES)
            behind = np.empty((len(matrices), STATES), dtype=np.int64)
            now = np.repeat(AT_END[None], len(count), axis=0)
            for step in range(int(count.max(initial=0))):
                own = np.flatnonzero(count > step)
                at = begin[own] + count[own] - 1 - step
                behind[at] = now[own]
                now[own] = np.minimum((matrices[at] + now[own][:, :, None]).min(axis=1), NEVER)
            place = np.arange(len(matrices)) - np.repeat(begin, count)
            conv = batch.column("conv").take(pa.array(np.repeat(np.arange(len(count)), count)))
            columns = [conv, fields.field("first"), pa.array(place == 0), _lists(behind), pa.array(place == np.repeat(count - 1, count))]
            columns.append(pa.array(np.repeat(now[:, NOTHING], count)))
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _BEHIND.split(", ")])

    return own.mapInArrow(chain, _BEHIND)


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].reshape(values.shape)


def ranked_paths(letter: np.ndarray, target: np.ndarray, starts: np.ndarray, longest: int) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Audits of graph nodes whose least arcs have a letter and a target; ends have letter 0 and lead to themselves.

    Returns the audits' index for every start, the distinct audits, and the
    node where each start's path ends. Ranks double their reach until they
    cover the longest path; nodes of one rank then share an audit.
    """
    rank, pointers = letter.astype(np.int64), [target]
    while 1 << (len(pointers) - 1) < longest:
        rank = _dense(rank * (len(rank) + 5) + rank[pointers[-1]])
        pointers.append(pointers[-1][pointers[-1]])
    _, one, index = np.unique(rank[starts], return_index=True, return_inverse=True)
    # Distinct audits, step by step: the node after j steps is found by the bits of j.
    chosen = starts[one]
    steps = np.arange(longest)
    at = np.repeat(chosen[:, None], longest, axis=1)
    for bit, pointer in enumerate(pointers):
        taken = (steps >> bit) & 1 == 1
        at[:, taken] = pointer[at[:, taken]]
    letters = LETTERS[letter[at]]
    return index, [row.tobytes().rstrip(b"\0") for row in letters], pointers[-1][starts]


def _graph(found: Segments, behind: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Least optimal letter and target of every node, the segments' first nodes, and the costs there.

    A node is a row and a state before it; every segment has one row more, its
    end. There only a conversation's last piece may still add turns.
    """
    n, rows = len(found), len(found.kind)
    ends = rows + np.arange(n)
    cost = np.full((rows + n, STATES), NEVER, dtype=np.int64)
    following = np.arange(1, rows + 1)
    following[found.begin + found.length - 1] = ends
    cost[ends] = behind
    after = behind.copy()
    for _, at, before in found.backwards(after):
        cost[at] = before
    states = np.arange(STATES)
    letter = np.zeros((rows + n, STATES), dtype=np.int64)
    target = np.arange((rows + n) * STATES).reshape(-1, STATES)
    # The least letter that attains the cost: from the last in order to the first.
    behind_row, here = cost[following], cost[:rows]
    choices = [
        (R, found.costs[:, :, 2] + behind_row[:, NEXT], following[:, None] * STATES + NEXT),
        (K, found.costs[:, :, 1] + np.take_along_axis(behind_row, found.initial[:, None], 1), (following * STATES + found.initial)[:, None] + 0 * states),
        (I, INSERT + here[:, NEXT], np.arange(rows)[:, None] * STATES + NEXT),
        (D, found.costs[:, :, 0] + behind_row, following[:, None] * STATES + states),
    ]
    for name, costs, to in choices:
        best = (costs == here) & (here < NEVER)
        letter[:rows][best] = name
        target[:rows][best] = np.broadcast_to(to, best.shape)[best]
    added = (INSERT + cost[ends][:, NEXT] == cost[ends]) & last[:, None]
    letter[ends] = np.where(added, I, 0)
    target[ends] = np.where(added, ends[:, None] * STATES + NEXT, ends[:, None] * STATES + states)
    return letter.ravel(), target.ravel(), found.begin * STATES, cost[found.begin]


def _audits(blocks: DataFrame, behind: DataFrame) -> DataFrame:
    """Every piece's audit and exit for each state in which it may be entered."""
    known = behind.groupBy(F.shiftright("first", BLOCK_BITS).alias("block")).agg(F.collect_list(F.struct("first", "is_first", "behind", "is_last")).alias("pieces"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                found = Segments(one)
                fields = one.column("pieces").flatten()
                order = np.argsort(fields.field("first").to_numpy())
                costs = fields.field("behind").flatten().to_numpy().reshape(-1, STATES)[order]
                is_first, last = (fields.field(name).to_numpy(zero_copy_only=False)[order] for name in ("is_first", "is_last"))
                letter, target, starts, cost = _graph(found, costs, last)
                # The first piece of a conversation is entered with nothing; the others in any state that can end well.
                entered = (cost < NEVER) & (~is_first[:, None] | (np.arange(STATES) == NOTHING))
                segment, state = np.nonzero(entered)
                longest = int(found.length.max()) * 3 + 3
                index, audits, ends = ranked_paths(letter, target, starts[segment] + state, longest)
                texts = pa.array([audit.decode() for audit in audits], pa.string()).take(pa.array(index))
                columns = [pa.array(found.conv[segment], pa.string()), pa.array(found.first[segment]), pa.array(state, pa.int32()), pa.array(ends % STATES, pa.int32()), texts]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _AUDIT.split(", ")])

    return blocks.join(known, "block").select("rows", "pieces").mapInArrow(rank, _AUDIT)


def _chained(audits: DataFrame) -> DataFrame:
    """The audits of the pieces that a conversation's path enters, one after another."""
    own = audits.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("first", "entry", "exit", "audit"))).alias("pieces"))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                state, place, firsts, chosen = NOTHING, None, [], []
                for piece in batch.column("pieces")[row].as_py():
                    if piece["first"] != place and piece["entry"] == state:
                        state, place = piece["exit"], piece["first"]
                        firsts.append(place)
                        chosen.append(piece["audit"])
                pieces = [{"first": first, "audit": audit} for first, audit in zip(firsts, chosen)]
                kind = pa.list_(pa.struct([("first", pa.int64()), ("audit", pa.string())]))
                yield pa.RecordBatch.from_arrays([batch.column("conv").slice(row, 1), pa.array([pieces], kind)], names=["conv", "pieces"])

    return own.mapInArrow(follow, _CHAIN)


def _hashed(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The hash of every conversation's repaired lines, which pass in order, each row behind its edits."""
    nothing = F.lit(None).cast("string")
    both = rows.select("conv", "id", F.lit(1).alias("side"), "role", "text", nothing.alias("edits"))
    both = both.unionByName(edits.select("conv", "id", F.lit(0).alias("side"), nothing.alias("role"), nothing.alias("text"), "edits"))
    both = both.repartition("conv").sortWithinPartitions("conv", "id", "side")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = digest = None
        state, lines, todo = NOTHING, 0, ""
        done: tuple[list, list] = ([], [])
        names = {USER: "user", ASSISTANT: "assistant"}

        def line(role: str, text: str) -> None:
            nonlocal lines
            digest.update(("\n" if lines else "").encode() + f"{role}:{text}".encode())
            lines += 1

        for batch in batches:
            for part in parts(iter([batch])):
                for own, side, role, text, edits in zip(*(part.column(name).to_pylist() for name in ("conv", "side", "role", "text", "edits"))):
                    if own != conv or digest is None:
                        if digest is not None:
                            done[0].append(conv)
                            done[1].append(digest.hexdigest())
                        conv, digest, state, lines = own, hashlib.sha256(), NOTHING, 0
                    if not side:
                        todo = edits
                        continue
                    for edit in todo:
                        if edit == "D":
                            continue
                        state = INITIALS[role[0]] if edit == "K" else int(NEXT[state])
                        line(role if edit == "K" else names[state], "" if edit == "I" else text)
            if done[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in done], names=["conv", "repaired_sha256"])
                done = ([], [])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

    return both.mapInArrow(stream, "conv string, repaired_sha256 string")


def repaired(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Faults, cost, audit and hash of the repaired lines for every conversation; ``rows`` are its rows if not as given."""
    spark = conversations.sparkSession
    rows = as_given(conversations) if rows is None else rows
    rows = sorted_rows(rows, ["conv", F.col("turn").asc_nulls_first(), "role", "text"])

    path = scratch_path(spark, "turn-blocks")
    block = F.shiftright("id", BLOCK_BITS).alias("block")
    blocks = _kinds(rows).groupBy(block).agg(F.sort_array(F.collect_list(F.struct("id", "conv", "kind"))).alias("rows"))
    blocks.write.parquet(path)
    blocks = spark.read.schema(blocks.schema).parquet(path)
    path = scratch_path(spark, "turn-pieces")
    _pieces(blocks.select("rows")).write.parquet(path)
    pieces = spark.read.schema(_PIECE).parquet(path)
    path = scratch_path(spark, "turn-costs")
    _behind(pieces).write.parquet(path)
    behind = spark.read.schema(_BEHIND).parquet(path)
    path = scratch_path(spark, "turn-audits")
    _audits(blocks, behind.drop("cost")).write.parquet(path)
    audits = spark.read.schema(_AUDIT).parquet(path)
    path = scratch_path(spark, "turn-chains")
    _chained(audits).write.parquet(path)
    chains = spark.read.schema(_CHAIN).parquet(path)

    edits = chains.select("conv", F.inline("pieces"))
    edits = edits.select("conv", "first", F.posexplode(F.regexp_extract_all("audit", F.lit("I*[DKR](?:I+$)?"), F.lit(0))).alias("place", "edits"))
    hashes = _hashed(rows.select("conv", "id", "role", "text"), edits.select("conv", (F.col("first") + F.col("place")).alias("id"), "edits"))

    ordered = Window.partitionBy("conv").orderBy("first")
    before = F.lag("tail").over(ordered) * 4 + F.col("head")
    across = pieces.select("*", F.coalesce(~before.isin(SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER), F.lit(False)).cast("bigint").alias("across"))
    counts = across.groupBy("conv").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"), F.sum(F.col("illegal") + F.col("across")).alias("illegal")
    )
    turns = rows.groupBy("conv").agg(F.min("turn").alias("least"), F.max("turn").alias("most"), F.count_distinct("turn").alias("turns"))
    gaps = F.try_subtract(F.try_subtract("most", "least"), F.col("turns") - 1)
    audit = F.array_join(F.transform("pieces", lambda piece: piece["audit"]), "").alias("audit")
    costs = behind.filter("is_first").select("conv", "cost")

    found = counts.join(turns.select("conv", gaps.alias("gaps")), "conv").join(chains.select("conv", audit), "conv").join(costs, "conv").join(hashes, "conv")
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    found = ids.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))).join(found, "conv", "left")
    zero = F.lit(0).cast("bigint")
    numbers = [F.coalesce(name, zero).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(""), 256)
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def report(conversations: DataFrame) -> DataFrame:
    """The repair of a table's conversations after damage."""
    return repaired(conversations, damaged(conversations))


def _sql_arcs() -> str:
    """All ways from a state over one row: turns added first, then the row's edit."""
    names = {USER: "user", ASSISTANT: "assistant"}
    found = []
    for state in range(STATES):
        now, letters, lines, cost = state, "", "", 0
        for _ in range(3):
            follows = int(NEXT[now])
            found.append((state, letters + "D", "any", now, cost + DELETE, lines, "none"))
            found.append((state, letters + "R", "undeleted", follows, cost + REROLE, lines, names[follows]))
            for initial, to in INITIALS.items():
                if to == follows or (to == SYSTEM and now == NOTHING):
                    found.append((state, letters + "K", initial, to, cost, lines, "own"))
            now, letters, cost = follows, letters + "I", cost + INSERT
            lines += f"\\n{names[now]}:"
    return ", ".join(f"({a}, '{b}', '{c}', {d}, {e}, E'{f}', '{g}')" for a, b, c, d, e, f, g in found)


def sql(conversations: str) -> str:
    """The same repair in DuckDB: all states row by row, the least audit of each."""
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ')"
    return f"""
    WITH RECURSIVE given AS (SELECT conv_id, {key} AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM ({conversations}) AS given),
    coded AS (SELECT *, {sql_crc32("(conv || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS code FROM given),
    damaged AS (
        SELECT conv, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
               CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM coded, unnest(range(CASE code WHEN 3 THEN 2 ELSE 1 END)) AS t(copy) WHERE code <> 0),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
    seen AS (
        SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before,
               right(rtrim(text, E' \\t\\n\\x0B\\x0C\\r'), 1) AS ending, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again
        FROM ordered),
    judged AS MATERIALIZED (
        SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
               coalesce(before || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
        FROM seen),
    arcs(state, letters, wants, follows, cost, lines, role) AS (VALUES {_sql_arcs()}),
    path AS (
        SELECT DISTINCT conv, CAST(0 AS BIGINT) AS i, {NOTHING} AS state, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': ''}} AS best FROM judged
        UNION ALL
        SELECT p.conv, j.i, a.follows, min({{
            'cost': CAST(p.best.cost + a.cost + CASE WHEN a.wants <> 'any' AND j.fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS BIGINT),
            'audit': p.best.audit || a.letters,
            'lines': p.best.lines || a.lines || CASE a.role WHEN 'none' THEN '' WHEN 'own' THEN chr(10) || j.role || ':' || j.text ELSE chr(10) || a.role || ':' || j.text END}})
        FROM path AS p JOIN judged AS j ON j.conv = p.conv AND j.i = p.i + 1
        JOIN arcs AS a ON a.state = p.state AND (a.wants = 'any' OR (j.fault NOT IN ('blank', 'duplicate') AND a.wants IN ('undeleted', j.initial)))
        GROUP BY p.conv, j.i, a.follows),
    counts AS (
        SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal, max(i) AS n
        FROM judged GROUP BY conv),
    ended AS (
        SELECT c.conv, min({{'cost': CAST(p.best.cost + e.cost AS BIGINT), 'audit': p.best.audit || e.letters, 'lines': p.best.lines || e.lines}}) AS best
        FROM counts AS c JOIN path AS p ON p.conv = c.conv AND p.i = c.n
        JOIN (VALUES ({NOTHING}, 0, '', ''), ({ASSISTANT}, 0, '', ''), ({USER}, {INSERT}, 'I', E'\\nassistant:'), ({SYSTEM}, {2 * INSERT}, 'II', E'\\nuser:\\nassistant:'))
             AS e(state, cost, letters, lines) ON e.state = p.state
        GROUP BY c.conv)
    SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost, coalesce(e.best.audit, '') AS audit, sha256(substr(coalesce(e.best.lines, ''), 2)) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, conv FROM given) AS g LEFT JOIN counts AS c ON c.conv = g.conv LEFT JOIN ended AS e ON e.conv = g.conv"""


QUERY_SQL = sql("SELECT * FROM conversations")
