import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import GOLDEN, filter_in_order, message, records
from tidelog.operators import versions as V
from tidelog.operators.envelope import parse_envelopes
from tidelog.streaming.version_filter import keep_new_versions

SCHEMA = "topic string, dedup_key string, partition int, offset bigint, version bigint, type string, note string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def make(seed, n, keys=5, top=30, delete_share=0.25, hot=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(keys)}"
        kind = "delete" if rng.random() < delete_share else "UPDATE"
        rows.append((f"t{rng.randrange(2)}", key, 0, i, rng.randrange(top), kind, f"n{i}"))
    return rows


def expected(rows, scoped=True, state=None):
    steps = [((r[0], r[1]) if scoped else r[1], r[3], r[4], r[5].upper() == "DELETE") for r in rows]
    accepted, left = filter_in_order(steps, state)
    return sorted(order for _, order in accepted), left


@pytest.mark.parametrize("bits", [(1,), (3,), (2, 4), (1, 2, 4), (10, 22)])
@pytest.mark.parametrize("seed", [1, 2])
def test_filter_equals_one_at_a_time(spark, bits, seed):
    rows = make(seed, 300)
    found = V.filter_versions(frame(spark, rows), chunk_bits=bits)
    assert sorted(r.offset for r in found.collect()) == expected(rows)[0]


@pytest.mark.parametrize("seed", range(4))
def test_hot_key_with_many_lifecycles(spark, seed):
    rows = make(seed, 3000, top=6 if seed % 2 else 3000, delete_share=0.3, hot=0.6)
    found = V.filter_versions(frame(spark, rows), chunk_bits=(4, 8))
    assert sorted(r.offset for r in found.collect()) == expected(rows)[0]


def test_shared_scope(spark):
    rows = make(5, 400)
    found = V.filter_versions(frame(spark, rows), scope=(), order=("offset",), chunk_bits=(4,))
    assert sorted(r.offset for r in found.collect()) == expected(rows, scoped=False)[0]


def test_columns_and_bypass(spark):
    rows = [("t", None, 0, 0, 1, "INSERT", "no key"), ("t", "k", 0, 1, None, "INSERT", "no version"),
            ("t", "k", 0, 2, 1, "INSERT", "kept"), ("t", "k", 0, 3, 1, "UPDATE", "equal version"),
            ("t", "k", 0, 4, 2, None, "no type")]
    found = V.filter_versions(frame(spark, rows), chunk_bits=(1,))
    assert found.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(r.note for r in found.collect()) == ["kept", "no key", "no type", "no version"]


@pytest.mark.parametrize("cut", [0, 1, 57, 200, 399])
def test_batches_give_what_one_pass_gives(spark, cut):
    rows = make(9, 400)
    first = V.filter_versions(frame(spark, rows[:cut]), chunk_bits=(5,))
    states = V.latest_states(first)
    second = V.filter_versions(frame(spark, rows[cut:]), chunk_bits=(5,), initial=states)
    assert sorted(r.offset for r in first.union(second).collect()) == expected(rows)[0]


def test_previous_versions_without_deletes_are_a_running_maximum(spark):
    rows = make(3, 300, delete_share=0)
    found = V.version_states(frame(spark, rows), chunk_bits=(3, 6)).collect()
    seen = {}
    for r in sorted(found, key=lambda r: r.offset):
        assert r.prev_version == seen.get((r.topic, r.dedup_key))
        seen[r.topic, r.dedup_key] = max(r.version, seen.get((r.topic, r.dedup_key), -1))


def test_golden_messages(spark):
    values = [message(*m) for batch in GOLDEN for m in batch]
    kept = V.filter_versions(parse_envelopes(records(spark, values)))
    assert sorted(r.offset for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 8]


def test_input_is_read_once(spark, tmp_path):
    frame(spark, make(1, 50)).write.parquet(str(tmp_path / "rows"))
    found = V.filter_versions(spark.read.parquet(str(tmp_path / "rows"))).groupBy().count()
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("FileScan") == 1


@given(st.lists(st.tuples(st.integers(0, 6), st.booleans()), max_size=30), st.one_of(st.none(), st.integers(0, 6)))
def test_stretch_summary(steps, state):
    """The claim behind the chunks: a stretch sends states below its largest version to one outcome."""
    _, after = keep_new_versions([v for v, _ in steps], [d for _, d in steps], state)
    if not steps:
        assert after == state
    elif state is not None and state >= max(v for v, _ in steps):
        assert after == state
    else:
        assert after == keep_new_versions([v for v, _ in steps], [d for _, d in steps], None)[1]


# --- classification -----------------------------------------------------------------------------

CASES = [
    ("INSERT", 1000, None, "INSERT"), ("INSERT", 1000, 500, "ERROR"), ("INSERT", 1000, 2000, "ERROR"),
    ("UPDATE", 1000, None, "INSERT"), ("UPDATE", 1000, 500, "UPDATE"), ("UPDATE", 1000, 1000, "SKIP"),
    ("UPDATE", 1000, 2000, "SKIP"), ("DELETE", 1000, None, "SKIP"), ("DELETE", 1000, 500, "DELETE"),
    ("DELETE", 1000, 1000, "SKIP"), ("DELETE", 1000, 2000, "SKIP"), ("UNKNOWN", 1000, None, "ERROR"),
    ("UNKNOWN", 1000, 500, "ERROR"), ("insert", 1000, None, "INSERT"),
]


def test_actions(spark):
    rows = spark.createDataFrame(CASES, "type string, version bigint, existing bigint, wanted string")
    found = rows.withColumn("action", V.action(F.col("type"), F.col("version"), F.col("existing")))
    assert found.where("action <> wanted").count() == 0 and found.count() == len(CASES)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(1000, 1010), st.sampled_from(["INSERT", "UPDATE", "DELETE"])),
                min_size=1, max_size=20),
       st.dictionaries(st.sampled_from("abcdef"), st.integers(1000, 1010), max_size=6))
def test_classified_batch_applies_and_repeats(spark, batch, existing):
    rows = spark.createDataFrame([(k, v, t, 0, i) for i, (k, v, t) in enumerate(batch)],
                                 "dedup_key string, version bigint, type string, partition int, offset bigint")
    table = spark.createDataFrame([(k, v, "INSERT", 0, -1) for k, v in existing.items()], rows.schema)
    incoming, known = V.dedup_batch(rows), V.existing_versions(table)
    first = V.classify(incoming, known).select("dedup_key", "action").collect()
    assert sorted(first) == sorted(V.classify(incoming, known).select("dedup_key", "action").collect())
    assert len(first) == len({k for k, _, _ in batch})
    newest = {k: max((v, i) for i, (kk, v, _) in enumerate(batch) if kk == k) for k, _, _ in batch}
    want = dict(existing)
    for key, (version, at) in newest.items():
        kind, old = batch[at][2], existing.get(key)
        if kind == "DELETE" and old is not None and version > old:
            want.pop(key)
        elif (kind == "INSERT" and old is None) or (kind == "UPDATE" and (old is None or version > old)):
            want[key] = version
    left = V.apply_classified(table, V.classify(incoming, known)).collect()
    assert {r.dedup_key: r.version for r in left} == want and len(left) == len(want)


def test_counters_and_conflict_rate(spark):
    rows = spark.createDataFrame([("t", a) for a in ["INSERT"] * 7 + ["SKIP"] + ["ERROR"] * 2], "tbl string, action string")
    counts = V.action_counts(rows, ["tbl"]).first()
    assert (counts.inserts, counts.skipped, counts.conflicts, counts.updates) == (7, 1, 2, 0)
    rate = V.conflict_rate(rows).first()
    assert rate.conflict_share == 0.2 and rate.alarm


def test_chunk_levels(spark):
    assert V.chunk_levels(spark.range(10).withColumnRenamed("id", "offset")) == (10,)
    wide = spark.createDataFrame([(0,), (2**33,)], "offset bigint")
    assert V.chunk_levels(wide) == (10, 22)
    assert V.chunk_levels(spark.createDataFrame([], "offset bigint")) == (10,)
