"""How much the Jaccard join writes on its way, read from the event log of a session of its own."""

import json
import os
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from tideferry.llm import jaccard_join

REPO = Path(__file__).resolve().parents[2]

RUN = """
import sys
from tideferry.llm import jaccard_join
from tideferry.session import build_session
folder = sys.argv[1]
spark = build_session("disk", "local[4]", spark__sql__shuffle__partitions="4", spark__eventLog__enabled="true", spark__eventLog__dir=f"file://{folder}/events",
    spark__eventLog__compress="false", spark__eventLog__rolling__enabled="false", spark__checkpoint__dir=f"file://{folder}/shared", spark__sql__autoBroadcastJoinThreshold="16k")
jaccard_join.report(spark.read.schema("doc_id bigint, text string").json(f"{folder}/documents")).write.parquet(f"{folder}/out")
spark.stop()
"""


def test_jaccard_writes_little(tmp_path):
    """Prefixes move once, and of the texts only those that may have a partner."""
    draw = random.Random(1)
    texts = [" ".join(f"{draw.randrange(16**5):05x}" for _ in range(300)) for _ in range(1500)]
    texts += [text.rsplit(" ", 3)[0] + f" end {n}" for n, text in enumerate(texts[:30])]
    for folder in ("events", "documents"):
        (tmp_path / folder).mkdir()
    (tmp_path / "documents/part.json").write_text("".join(json.dumps({"doc_id": n, "text": text}) + "\n" for n, text in enumerate(texts)))
    subprocess.run([sys.executable, "-c", RUN, str(tmp_path)], cwd=REPO, env=os.environ | {"PYTHONPATH": str(REPO)}, check=True, capture_output=True, timeout=300)
    moved = 0
    for line in next((tmp_path / "events").iterdir()).read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            metrics = event["Task Metrics"]
            moved += metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"] + metrics["Output Metrics"]["Bytes Written"]
    assert moved < 2.5 * sum(map(len, texts)), moved / sum(map(len, texts))


def test_possibly_keeps_what_is_wanted(spark):
    rows = spark.range(20000).select((F.col("id") - 1).alias("doc_id"), F.xxhash64("id").alias("digest"))
    wanted = rows.filter("doc_id % 100 = 99 OR doc_id = -1")
    for n_wanted in (200, 10**9):
        left = [tuple(row) for row in jaccard_join._possibly(rows, wanted, ["doc_id", "digest"], n_wanted).collect()]
        assert len(left) == len(set(left)) < 1000 and set(left) >= {tuple(row) for row in wanted.collect()}
    # Wanted ones outnumber the bits: all of them stay.
    assert jaccard_join._possibly(rows, rows, ["doc_id", "digest"], 1).count() == 20000
    assert jaccard_join._possibly(rows, rows.limit(0), ["doc_id", "digest"], 0).count() == 0


def test_long_lists_are_whole(spark):
    """A list of more nodes than a window holds in memory, each node in it once."""
    n = 5000
    rows = spark.range(n).select("id", F.lit(0).alias("digest"), F.col("id").alias("node"), (F.lit(100) + F.col("id") % 2).alias("size"), F.lit(1).alias("chosen"), F.expr("array(-7L, -8L - id)").alias("prefix"))
    found = Counter((row.shingle, row.indexed) for row in jaccard_join._lists(rows.unionByName(rows.limit(50))).collect())
    assert found == {(-7, True): n}
