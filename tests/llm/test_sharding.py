from pyspark.sql import functions as F

from almanac.llm import sharding
from tests.llm import cases


def sizes(out):
    found = out.groupBy("shard").agg(F.sum("n_bytes"), F.count(F.lit(1)))
    return {shard: (total, rows) for shard, total, rows in found.collect()}


def test_shards_fit_and_only_oversized_buckets_split(spark):
    docs = cases.documents(spark)
    out = sharding.assign_shards(docs, "doc_id", 3000)
    assert out.count() == docs.count()
    assert set(out.columns) == set(docs.columns) | {"n_bytes", "depth"}
    found = sizes(out)
    assert len(found) > 2
    for name, (total, rows) in found.items():
        assert total <= 3000 or rows == 1
        if name:  # the bucket one bit shorter was over the limit
            parent = [v for k, v in found.items() if k.startswith(name[:-1])]
            assert sum(v[0] for v in parent) > 3000
    assert not any(a != b and b.startswith(a) for a in found for b in found)


def test_one_key_over_the_limit_splits_by_content_and_place(spark):
    rows = [(1, f"text {i % 5} " * 10) for i in range(60)] + [(2, "x"), (None, "y"), (None, None)]
    out = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", 400)
    assert out.count() == 63
    assert all(total <= 400 or n == 1 for total, n in sizes(out).values())
    assert out.agg({"depth": "max"}).first()[0] > 120


def test_rows_over_the_limit_stand_alone_and_empty_tables(spark):
    out = sharding.assign_shards(spark.createDataFrame([(1, "a" * 50), (2, "b" * 50)], "doc_id long, text string"), "doc_id", 10)
    assert out.select("shard").distinct().count() == 2
    assert sharding.assign_shards(cases.empty(spark), "doc_id", 10).count() == 0


def test_written_shards_read_back(spark, tmp_path):
    docs = cases.documents(spark).drop("shard")
    sharding.write_shards(sharding.assign_shards(docs, "doc_id", 3000), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == docs.count()
