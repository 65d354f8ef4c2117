import random

import pytest

from ledgerlens.session import scratch
from ledgerlens.sources import key_index, sinks
from ledgerlens.sources.key_index import KeyIndex
from ledgerlens.sources.scans import file_names

DDL = "transaction_id string, amount int, is_flagged_fraud boolean, fraud_score decimal(5,4), time_sk int"


def batch(spark, rows):
    return spark.createDataFrame([(k, a, False, None, p) for k, a, p in rows], DDL).na.fill({"amount": 0}).selectExpr(
        "transaction_id", "amount", "is_flagged_fraud", "cast(0 as decimal(5,4)) as fraud_score", "time_sk")


def content(spark, path):
    return sorted((r["transaction_id"], r["amount"], r["time_sk"]) for r in spark.read.schema(DDL).parquet(path).collect())


def test_upserts_with_and_without_an_index_agree(spark, tmp_path, monkeypatch):
    """New, repeated, moved and vanished rows in changing order of days, over more runs than are kept."""
    monkeypatch.setattr(key_index, "MOST_RUNS", 3)
    rng = random.Random(2)
    plain, indexed, index = str(tmp_path / "plain"), str(tmp_path / "indexed"), KeyIndex(str(tmp_path / "index"))
    for step in range(7):
        days = rng.sample(range(1, 6), 2)
        rows = {rng.randrange(60): None for _ in range(25)}
        rows = [(f"k{i}", step, rng.choice(days)) for i in rows]
        whole = days if step % 2 else None
        got = [sinks.upsert_partitions(batch(spark, rows), path, whole=whole, index=ix) for path, ix in ((plain, None), (indexed, index))]
        assert got[0] == got[1]
        assert content(spark, plain) == content(spark, indexed)
        held = {(k, p) for k, _, p in content(spark, indexed)}
        known = {(r[0], r[1]) for r in index.lookup(spark.createDataFrame([(k,) for k, _ in held], "transaction_id string")).collect()}
        assert held <= known  # never behind the table
        assert len([n for n in file_names(spark, index.path) if n.startswith("run=")]) <= 3


def test_only_buckets_of_the_batch_are_read(spark, tmp_path):
    index = KeyIndex(str(tmp_path / "index"))
    index.build(spark.range(5000).selectExpr("concat('k', id) as transaction_id", "cast(id % 30 as int) as time_sk"))
    some = spark.createDataFrame([("k7",), ("k8",), ("new",), (None,)], "transaction_id string")
    found = index.lookup(some)
    want = {r[0] for r in some.where("transaction_id is not null").select(key_index._bucket("transaction_id", 16)).collect()}
    read = {f.split("bucket=")[1].split("/")[0] for f in spark.read.parquet(index._folder(0, 16)).inputFiles()}
    assert len(read) == 16
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in found.inputFiles() if "bucket=" in f} == want and len(want) <= 3
    assert sorted(tuple(r) for r in found.collect()) == [("k7", 7), ("k8", 8)]
    index.add(spark.createDataFrame([("k7", 7), ("k7", 9), ("new", 1)], "transaction_id string, time_sk int"), found)
    assert spark.read.parquet(index._folder(1, 16)).count() == 2
    assert sorted(tuple(r) for r in index.lookup(some).collect()) == [("k7", 7), ("k7", 9), ("k8", 8), ("new", 1)]


def test_facts_are_read_for_named_days_only(spark, tmp_path):
    path, index = str(tmp_path / "t"), KeyIndex(str(tmp_path / "index"))
    sinks.upsert_partitions(batch(spark, [(f"k{i}", 1, i % 20) for i in range(400)]), path, index=index)
    with scratch(spark) as keep:
        incoming = batch(spark, [("k5", 2, 3), ("k25", 2, 5), ("n", 2, 30)])
        target = spark.read.schema(DDL).parquet(path)
        held = sinks._held(target, incoming, "transaction_id", "time_sk", index, keep)
        text = held._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(time_sk" in text and "(time_sk#" in text
        assert sorted(tuple(r) for r in held.collect()) == [("k25", 5), ("k5", 5)]


def test_buckets_follow_the_number_of_pairs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "PAIRS_PER_BUCKET", 20)
    index = KeyIndex(str(tmp_path / "index"))
    pairs = lambda a, b: spark.range(a, b).selectExpr("id as transaction_id", "cast(id % 5 as int) as time_sk")
    index.build(pairs(0, 100))
    more = pairs(50, 1000)
    index.add(more, index.lookup(more))
    assert index._runs(spark) == [(0, 16), (1, 64)]
    assert index.lookup(pairs(0, 1100)).count() == 1000
    index.merge(spark)
    assert index._runs(spark) == [(2, 64)] and index.lookup(pairs(0, 1100)).count() == 1000


@pytest.mark.parametrize("built", [False, True])
def test_a_table_without_index_is_indexed_first(spark, tmp_path, built):
    path, index = str(tmp_path / "t"), KeyIndex(str(tmp_path / "index"))
    sinks.upsert_partitions(batch(spark, [("a", 1, 1), ("b", 1, 2)]), path, index=index if built else None)
    assert index.is_built(spark) == built
    sinks.upsert_partitions(batch(spark, [("a", 2, 3)]), path, index=index)
    assert index.is_built(spark) and content(spark, path) == [("a", 2, 3), ("b", 1, 2)]
