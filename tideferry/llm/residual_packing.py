"""Best-fit packing of tokenised documents into sequences, by shares whose underfull sequences are packed again.

A document is its tokens and an end; one longer than a sequence is cut, so that
all pieces but the first are full. Pieces are dealt to shares by a hash. Every
share packs its own by best fit, longest first. Sequences that are nearly full
are final; the underfull ones become items, as long as their content, of a node
above ``FAN_IN`` shares, and are packed there again, round after round, until
the one node of the last round closes all it gets.

What a node packs is a histogram: pieces of one length are alike, so there are
at most as many kinds as a sequence has tokens. Sequences filled alike are one
group with a count, and a length can split only two groups, so a node's plan is
a few thousand rows at most, however many pieces it stands for. The pieces
themselves stay distributed: each finds its sequence by its rank among those of
its length and node, in a join that has one row per node and length.

Ids are those of the byte-level vocabulary file. Its merges are run by
``tiktoken``, which gives the same ids as ``tokenizers`` at several times the
speed (a test compares them); a special token's name in a text is plain text.

Defined results: a null or empty text is a piece of one token, the end. Rows
without an id are documents, equal rows are separate ones; rows that agree in
id, place and tokens take any of each other's places. Texts of any length are
tokenised whole. An empty table has no pieces. Only ``doc_id`` and ``text`` are
read.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideferry.llm.joins import with_index
from tideferry.llm.token_counts import PATTERN
from tideferry.llm.words import id_and_text, parts, texts
from tideferry.sources.shared import scratch_path

VOCABULARY = "byte_bpe_50k.json"
END = 2
MAX_TOKENS = 1024

# A sequence with at most this many tokens left free is final in its round.
SLACK = 2

# Pieces of a share on average, and shares, or nodes, that the next round packs as one.
SHARE = 1 << 16
FAN_IN = 16

# Pieces of one length and share are numbered in so many slices, as most may have the same length.
SLICES = 64

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_FILL = "array<struct<length: bigint, first: bigint, each: bigint, offset: bigint>>"
PLAN = f"node bigint, first_bin bigint, bins bigint, fill bigint, content {_FILL}"

_ENCODERS: dict[bytes, object] = {}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _bytes_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


def encoder_of(content: bytes):
    """An encoder of plain text for a byte-level vocabulary file; one per worker."""
    key = zlib.crc32(content).to_bytes(4, "big") + len(content).to_bytes(8, "big")
    if key not in _ENCODERS:
        import tiktoken

        described = json.loads(content)
        special = {token["content"] for token in described["added_tokens"]}
        byte = _bytes_of()
        ranks = {bytes(byte[c] for c in name): rank for name, rank in described["model"]["vocab"].items() if name not in special}
        _ENCODERS[key] = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def pieces(docs: DataFrame, vocabulary: str | None = None, most: int = MAX_TOKENS, end: int = END) -> DataFrame:
    """Pieces of at most ``most`` tokens, with the checksum of their ids."""
    with open(vocabulary or vocabulary_path(), "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file, about 1 MB
    names = [field.split()[0] for field in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(sent.value)
        for part in parts(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts(part)):
                ids = encoder.encode_to_numpy(text.decode("utf-8", "replace"), disallowed_special=())
                ids = np.append(ids, end).astype("<u4").tobytes()
                total = len(ids) // 4
                begins = [0, *range(total % most or most, total, most)]
                for piece, (begin, stop) in enumerate(zip(begins, [*begins[1:], total])):
                    rows.append((doc_id, piece, begin, stop - begin, zlib.crc32(ids[4 * begin : 4 * stop])))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return id_and_text(docs).mapInArrow(cut, PIECES)


def best_fit(histogram: list[tuple[int, int]], most: int = MAX_TOKENS) -> list[tuple[int, int, list[tuple[int, int, int, int]]]]:
    """Groups of sequences packed alike for (length, count) pairs, longest first.

    A group is its fill, its number of sequences, and its content: for each
    length, the rank of the first item in its first sequence, the items in each
    sequence, and where they begin. An item goes where it leaves least room.
    """
    open_: dict[int, list[tuple[int, list]]] = {}
    rooms: list[int] = []

    def put(room: int, bins: int, content: list) -> None:
        if not bins:
            return
        if room not in open_:
            insort(rooms, room)
        open_.setdefault(room, []).append((bins, content))

    def later(content: list, bins: int) -> list:
        """The content of a group's sequences after its first ``bins``."""
        return [(length, first + bins * each, each, offset) for length, first, each, offset in content]

    for length, count in sorted(histogram, reverse=True):
        first = 0
        while first < count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                room, bins, content = most, count, []
            else:
                room = rooms[at]
                bins, content = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            each = room // length
            full, rest = divmod(min(count - first, bins * each), each)
            put(room - each * length, full, [*content, (length, first, each, most - room)])
            if rest:
                put(room - rest * length, 1, [*later(content, full), (length, first + full * each, rest, most - room)])
            used = full + (1 if rest else 0)
            if content:
                put(room, bins - used, later(content, used))
            first += full * each + rest
    return [(most - room, bins, content) for room in rooms for bins, content in open_[room]]


def _plans(histogram: DataFrame, most: int) -> DataFrame:
    """The groups of every node's sequences, for its counts of items by length."""
    nodes = histogram.groupBy("node").agg(F.collect_list(F.struct("length", "n")).alias("lengths"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, lengths in zip(batch.column("node").to_pylist(), batch.column("lengths").to_pylist()):
                groups, rows, first = best_fit([(row["length"], row["n"]) for row in lengths], most), [], 0
                for fill, bins, content in groups:
                    fields = ("length", "first", "each", "offset")
                    rows.append({"node": node, "first_bin": first, "bins": bins, "fill": fill, "content": [dict(zip(fields, c)) for c in content]})
                    first += bins
                content = pa.list_(pa.struct([(name, pa.int64()) for name in ("length", "first", "each", "offset")]))
                kinds = pa.schema([("node", pa.int64()), ("first_bin", pa.int64()), ("bins", pa.int64()), ("fill", pa.int64()), ("content", content)])
                yield pa.RecordBatch.from_pylist(rows, kinds)

    return nodes.mapInArrow(pack, PLAN)


def packed(rows: DataFrame, most: int = MAX_TOKENS, share: int = SHARE, fan_in: int = FAN_IN, slack: int = SLACK) -> DataFrame:
    """Pieces with the sequence each is put into, and its offset there."""
    spark = rows.sparkSession
    names = rows.columns
    alike = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    path = scratch_path(spark, "pieces")
    alike.write.parquet(path)
    alike = spark.read.schema(alike.schema).parquet(path)
    nodes = (alike.agg(F.sum("copies")).first()[0] or 0) // share + 1

    # A piece's rank among those of its share and length: behind the slices before its own. Copies follow each other.
    node, slice_ = F.pmod(F.xxhash64(*names), F.lit(nodes)), F.pmod(F.xxhash64(F.lit(1), *names), F.lit(SLICES))
    items = alike.select("*", node.alias("node"), slice_.alias("slice"))
    cell = ("node", "length", "slice")
    sizes = items.groupBy(*cell).agg(F.sum("copies").alias("n"))
    starts = sizes.withColumn("ahead", F.coalesce(F.sum("n").over(Window.partitionBy("node", "length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    order = Window.partitionBy(*cell).orderBy(*[name for name in names if name != "length"]).rowsBetween(Window.unboundedPreceding, -1)
    items = items.withColumn("begin", F.coalesce(F.sum("copies").over(order), F.lit(0)))
    items = items.join(starts.select(*cell, "ahead"), list(cell))
    first = F.col("ahead") + F.col("begin")
    ranks = F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("rank")
    histogram = sizes.groupBy("node", "length").agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("bigint")
    items = items.select(*names, "node", F.col("length").alias("size"), zero.alias("offset"), ranks)

    rounds, done = 1, []
    left = nodes
    while left > 1:
        left, rounds = -(-left // fan_in), rounds + 1
    for number in range(rounds):
        last = number == rounds - 1
        path = scratch_path(spark, "packing-plan")
        _plans(histogram, most).write.parquet(path)
        plan = spark.read.schema(PLAN).parquet(path)
        above = F.expr(f"node div {fan_in}")
        final = F.lit(True) if last else F.col("fill") >= most - slack
        plan = plan.withColumn("final", final)
        # Where the underfull sequences of a group begin among the items of their length in the node above.
        earlier = Window.partitionBy(above, "fill", "final").orderBy("node", "first_bin").rowsBetween(Window.unboundedPreceding, -1)
        plan = plan.withColumn("base", F.coalesce(F.sum("bins").over(earlier), F.lit(0)))
        parts_ = plan.select("node", "first_bin", "fill", "final", "base", F.inline("content"))
        run = F.struct("first", "each", "offset", "first_bin", "fill", "final", "base")
        index = parts_.groupBy((F.col("node") * (most + 1) + F.col("length")).alias("key")).agg(F.sort_array(F.collect_list(run)).alias("runs"))
        placed = with_index(items.withColumn("key", F.col("node") * (most + 1) + F.col("size")), index, "key")
        placed = placed.withColumn("run", F.expr("element_at(filter(runs, r -> r.first <= rank), -1)"))
        within = F.col("rank") - F.col("run.first")
        placed = placed.select(
            *names,
            (F.col("run.first_bin") + F.expr("(rank - run.first) div run.each")).alias("bin"),
            (F.col("offset") + F.col("run.offset") + within % F.col("run.each") * F.col("size")).alias("offset"),
            F.col("run.final").alias("final"),
            F.col("run.fill").alias("size"),
            "node",
            (F.col("run.base") - F.col("run.first_bin")).alias("shift"),
        )
        sequence = (F.col("bin") * nodes + F.col("node")) * rounds + number
        placed = placed.select(
            *names,
            "offset",
            F.when(F.col("final"), sequence).alias("sequence_id"),
            above.alias("node"),
            "size",
            (F.col("bin") + F.col("shift")).alias("rank"),
        )
        path = scratch_path(spark, "packing-round")
        placed.write.parquet(path)
        placed = spark.read.schema(placed.schema).parquet(path)
        done.append(placed.filter(F.col("sequence_id").isNotNull()).select(*names, "sequence_id", "offset"))
        items = placed.filter(F.col("sequence_id").isNull()).drop("sequence_id")
        histogram = plan.filter(~F.col("final")).groupBy(above.alias("node"), F.col("fill").alias("length")).agg(F.sum("bins").alias("n"))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def of_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """All pieces of a table's documents, packed."""
    return packed(pieces(docs, vocabulary))
