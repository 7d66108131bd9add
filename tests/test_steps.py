"""Pairing of starts and ends against a plain pass over the sorted log."""

import datetime
import random

from pyspark.sql import functions as F

from tideferry.operators.steps import open_steps, step_pairs, with_next

SCHEMA = "seq bigint, run_id string, phase string, step_name string, status string, rows_processed bigint, logged_at timestamp_ntz, _next string"
BEGIN = datetime.datetime(2024, 1, 1)


def log_of(spark, rows, parts=6):
    full = [(seq, run, phase, step, status, seq * 10, BEGIN + datetime.timedelta(seconds=seq), "clash") for seq, run, phase, step, status in rows]
    return spark.createDataFrame(full, SCHEMA).drop("_next").repartition(parts)


def plain(rows):
    pairs, left, last = set(), set(), {}
    for seq, run, phase, step, status in sorted(rows):
        key = (run, phase, step)
        if status == "STARTED":
            if key in last:
                left.add((*key, last[key]))
            last[key] = seq
        elif key in last:
            pairs.add((*key, last.pop(key), seq, status))
    return pairs, left | {(*key, seq) for key, seq in last.items()}


def check(spark, rows, parts=6):
    log = log_of(spark, rows, parts)
    pairs, left = plain(rows)
    assert {(r.run_id, r.phase, r.step_name, r.started_seq, r.ended_seq, r.status) for r in step_pairs(log).collect()} == pairs
    assert {(r.run_id, r.phase, r.step_name, r.started_seq) for r in open_steps(log).collect()} == left


def test_starts_meet_their_own_ends(spark):
    chance = random.Random(1)
    rows = [
        (seq, chance.choice(["hot", "hot", "hot", "a", "b", None]), chance.choice(["LOAD", "LOAD", None]), chance.choice("xyz"), chance.choice(["STARTED", "SUCCESS", "FAILED"]))
        for seq in range(3000)
    ]
    check(spark, rows)


def test_one_step_over_all_parts(spark):
    check(spark, [(seq, "r", "LOAD", "x", "STARTED" if seq % 3 else "SUCCESS") for seq in range(2000)], 16)


def test_small_and_empty_logs(spark):
    check(spark, [])
    check(spark, [(1, "r", "LOAD", "x", "STARTED")])
    check(spark, [(1, "r", "LOAD", "x", "SUCCESS")])
    check(spark, [(1, "r", "LOAD", "x", "STARTED"), (2, "r", "LOAD", "y", "SUCCESS"), (3, "q", "LOAD", "x", "FAILED")])


def test_seconds_and_rows_are_those_of_the_end(spark):
    row = step_pairs(log_of(spark, [(1, "r", "LOAD", "x", "STARTED"), (90, "r", "LOAD", "x", "SUCCESS")])).first()
    assert (row.seconds, row.rows_processed, row.status) == (89, 900, "SUCCESS")


def test_the_next_row_of_all(spark):
    rows = spark.range(500).select((F.col("id") * 7919 % 500).alias("n"), F.lit(1).alias("k")).repartition(9)
    found = {row.n: row._next and row._next.n for row in with_next(rows, ["k"], ["n"], ["n"]).collect()}
    assert found == {n: n + 1 if n < 499 else None for n in range(500)}
