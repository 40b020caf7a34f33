"""Revisits against DuckDB and by case; the pipeline stage by stage."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import common, queries, revisits


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_revisits_equal_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{sf}/pages.parquet'")
    rel = con.sql(revisits.ORACLE)
    found = revisits.op6_warc_revisits(spark, sf).select(*rel.columns)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, rel.fetchall()))


def records(spark):
    day = dt.datetime(2024, 1, 1)
    full, again = {"etag": '"a"', "content-length": "9", "x": "old"}, {"etag": 'W/"a"', "content-length": "0", "x": "new", "connection": "close"}
    rows = [
        (1, "http://www.a.org/p?b=2&a=1", day, False, full, "d1", 9), (2, "https://a.org/p/?a=1&b=2&utm_source=x#top", day + dt.timedelta(days=3), True, again, None, None),
        (3, "http://a.org/p?a=1&b=2", day + dt.timedelta(days=4), True, {"etag": '"zz"'}, None, None), (4, "http://b.org/", day, True, again, None, None),
        (5, "http://c.org/", day, False, {"last-modified": "m"}, "d5", 5), (6, "http://c.org", day, True, {"last-modified": "m"}, None, None), (7, "http://c.org", day + dt.timedelta(seconds=1), True, None, None, None),
        (8, None, day, True, again, None, None), (9, "http://a.org/p?a=1&b=2", None, False, full, "d9", 1), (10, "http://a.org/p?a=1&b=2", day + dt.timedelta(days=9), None, full, "d10", 2), (2, "https://a.org/p/?a=1&b=2", day + dt.timedelta(days=3), True, again, None, None),
    ]
    return spark.createDataFrame(rows, "record_id long, url string, date timestamp, revisit boolean, headers map<string,string>, digest string, length long").withColumn("status", F.lit("clash"))


def test_revisit_cases(spark):
    found = {}
    rows = revisits.resolve_revisits(records(spark)).collect()
    assert len(rows) == 11
    found = {r["record_id"]: r for r in rows}
    assert {k: r["status"] for k, r in found.items()} == {
        1: "full", 2: "resolved", 3: "validator_mismatch", 4: "no_earlier_response", 5: "full", 6: "resolved", 7: "no_validator", 8: "no_earlier_response", 9: "full", 10: "full"}
    assert (found[2]["refers_to"], found[2]["digest"], found[2]["length"]) == (1, "d1", 9)
    assert found[2]["headers"] == {"etag": 'W/"a"', "content-length": "9", "x": "new"}
    assert found[6]["refers_to"] == 5 and found[3]["digest"] is None
    assert revisits.resolve_revisits(records(spark).limit(0)).count() == 0
    bodies = records(spark).select("record_id", F.concat(F.lit("body"), F.col("record_id").cast("string")).alias("payload")).distinct()
    assert {r["payload"] for r in revisits.with_payload(revisits.resolve_revisits(records(spark)), bodies).where("record_id = 2").collect()} == {"body1"}


def test_time_buckets_do_not_matter(spark):
    some = records(spark)
    sets = [sorted(str((r["record_id"], r["status"], r["refers_to"])) for r in revisits.resolve_revisits(some, size).collect()) for size in (60, 4096, 10**9)]
    assert sets[0] == sets[1] == sets[2]


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "decontamination", "sentencepiece"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() <= left and (k == 4 or docs.columns == columns)
        left = docs.count()
    assert docs.columns == ["doc_id", "n_tokens", "ids", "round_trip"] and left > 50
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(r["doc_id"] for r in whole.collect()) == sorted(r["doc_id"] for r in docs.collect())


def test_pipeline_on_empty_tables_and_edge_rows(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = ["_found_id", "_dropped", "path_key", "score", "component", "label"]
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (2, None, "xx", "s", None), (None, "a " * 30_000, None, "s", 3)], docs.schema)
    longest = docs.where("text is not null").orderBy(F.length("text").desc()).limit(1)
    tables = {"empty": docs.limit(0), "edge": docs.unionByName(odd).unionByName(longest).unionByName(longest.withColumn("doc_id", F.lit(None).cast("long")))}
    for which, rows in tables.items():
        folder = str(tmp_path / which)
        rows.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)]).write.parquet(f"{folder}/documents.parquet")
        for other in ("labels", "benchmark"):
            spark.read.parquet(f"{sf}/{other}.parquet").write.parquet(f"{folder}/{other}.parquet")
        left = spark.read.parquet(f"{folder}/documents.parquet")
        columns = left.columns
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, left, folder).write.parquet(f"{folder}/{name}")
            before, left = left.count(), spark.read.parquet(f"{folder}/{name}")
            assert left.count() <= before and (k == 4 or left.columns == columns)
            if name == "near_dedup":
                assert left.where("doc_id is not null").select("doc_id", "text").distinct().groupBy("text").count().where("count > 1 and text > ''").count() == 0
        assert (left.count() == 0) == (which == "empty")
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0


def test_no_machine_local_folders_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_folder(Session)
