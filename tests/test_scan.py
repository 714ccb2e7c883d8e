"""The ordered scan against plain Python loops, with hot, crowded and null keys."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.plans.scan import (
    OrderedScan,
    first_value,
    last_value,
    running_count,
    running_max,
    running_min,
    running_sum,
    whole_count,
)

SCHEMA = "k string, t bigint, seq bigint, v int"


def made_rows(seed, n=400):
    """A third of all rows has key ``hot``; many of them share one time or a narrow span."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = rng.choice(["hot", "hot", None, *[f"k{i}" for i in range(4)]])
        t = rng.choice([500, 500 + rng.randrange(5), rng.randrange(1_000_000), -seq])
        v = rng.choice([None, rng.randrange(-50, 50)])
        rows.append((key, t, seq, v))
    rng.shuffle(rows)
    return rows


def by_hand(rows, keyed):
    out = {}
    groups = {}
    for row in rows:
        groups.setdefault(row[0] if keyed else "all", []).append(row)
    for members in groups.values():
        members.sort(key=lambda r: (r[1], r[2]))
        for i, row in enumerate(members):
            upto = [r[3] for r in members[: i + 1] if r[3] is not None]
            earlier = [r[3] for r in members[:i] if r[3] is not None]
            out[row[2]] = (
                sum(upto) if upto else None,
                max(upto, default=None),
                min(upto, default=None),
                members[0][3],
                earlier[-1] if earlier else None,
                i + 1,
                len(members),
                sorted(upto, reverse=True)[:3],
            )
    return out


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("chunk_rows", [7, 100_000])
def test_scan_equals_loop(spark, seed, keyed, chunk_rows):
    rows = made_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    v = F.col("v")
    scan = OrderedScan(df, ["k"] if keyed else [], ["t", "seq"], chunk_rows)
    assert scan.split == (chunk_rows == 7)
    done = (
        scan.add(
            s=running_sum(v),
            hi=running_max(v),
            lo=running_min(v),
            first=first_value(v),
            last=last_value(v, before=True),
            n=running_count(),
            size=whole_count(),
        )
        .add_top("top", v, 3)
        .result()
    )
    assert sorted(done.columns) == sorted(
        ["k", "t", "seq", "v", "s", "hi", "lo", "first", "last", "n", "size", "top"]
    )
    got = {
        r["seq"]: (r["s"], r["hi"], r["lo"], r["first"], r["last"], r["n"], r["size"], list(r["top"]))
        for r in done.collect()
    }
    assert got == by_hand(rows, keyed)


def test_chunks_stay_small_where_rows_crowd(spark):
    n, limit = 4_000, 50
    crowded = spark.range(n).select(
        F.lit("one").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") * 1_000).alias("t"),
        F.col("id").alias("seq"),
    )
    scan = OrderedScan(crowded, ["k"], ["t", "seq"], chunk_rows=limit)
    sizes = scan.rows.groupBy(*scan.chunks).count().agg(F.max("count")).first()[0]
    assert sizes <= 4 * limit


def test_cold_keys_leave_the_plain_window(spark):
    df = spark.createDataFrame(made_rows(3), SCHEMA)
    plan = OrderedScan(df, ["k"], ["t", "seq"]).add(n=running_count()).result()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for keys in (["k"], []):
        done = OrderedScan(empty, keys, ["t", "seq"]).add(n=running_count()).result()
        assert done.count() == 0


def test_order_must_be_countable(spark):
    df = spark.createDataFrame([("a", 1.5)], "k string, t double")
    with pytest.raises(TypeError):
        OrderedScan(df, ["k"], ["t"])
