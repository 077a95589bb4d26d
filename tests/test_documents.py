"""Issue files as variants, type rules, pruning of a snapshot table."""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import types
from tidemark.sources import archive, documents, snapshots


def test_files_are_written_row_by_row_and_read_by_name(spark, tmp_path):
    items = [{"id": f"i{k}", "n": k, "t": 'quote " and \\ é'} for k in range(1000)]
    rows = [("2024-01-02.json", '{"items":[', json.dumps(i), '],"x":1}', i["n"]) for i in items] + [
        ("2024-01-03.json", '{"items":[', None, "]}", 0), ("notes.json", '{"items":[', "5", "]}", 0), ("2024-01-04.json", '{"items":', '{"a":1}', "}", 0)
    ]
    df = spark.createDataFrame(rows, "name string, head string, item string, tail string, k int").repartition(4)
    path = str(tmp_path / "docs")
    assert documents.write_documents(df, path, [F.col("k")]) == 1002
    assert json.load(open(f"{path}/2024-01-02.json")) == {"items": items, "x": 1} and json.load(open(f"{path}/2024-01-03.json")) == {"items": []}
    docs = documents.read_documents(spark, path, archive.DAILY_NAME)
    assert sorted(r.name for r in docs.collect()) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    found = documents.typed(documents.exploded(docs, "items", "name"), "struct<id:string,n:int,t:string>", "name", "pos").collect()
    assert [(r.name, r.pos, r.id, r.n, r.t) for r in sorted(found, key=lambda r: r.pos)] == [("2024-01-02", k, i["id"], k, i["t"]) for k, i in enumerate(items)]


GOOD = {"id": "a-b", "title": "t", "summary": "s", "why_it_matters": "w", "entities": ["E"], "impact": 0.5, "novelty": 1, "coverage": 3, "published_at": "2024", "sources": [{"url": "u"}]}


@pytest.mark.parametrize(("change", "broken"), [
    ({}, []), ({"title": 5}, ["title must be a string"]), ({"title": True}, ["title must be a string"]), ({"title": None}, ["missing title"]), ({"title": ""}, ["missing title"]),
    ({"follow_up_of": 7}, ["follow_up_of must be a string"]), ({"follow_up_of": None}, []), ({"follow_up_of": {"a": 1}}, ["follow_up_of must be a string"]),
    ({"key_numbers": None}, ["key_numbers must be a list of non-empty strings"]), ({"tickers": ["A", None]}, ["tickers must be a list of non-empty strings"]),
    ({"tickers": []}, []), ({"entities": "E"}, ["entities must be a list of non-empty strings"]), ({"impact": "0.5"}, ["impact must be a number in [0, 1]"]),
    ({"impact": True}, ["impact must be a number in [0, 1]"]), ({"impact": 1.01}, ["impact must be a number in [0, 1]"]), ({"coverage": 3.0}, ["coverage must be a positive integer"]),
    ({"coverage": False}, ["coverage must be a positive integer"]), ({"coverage": 10**25}, []), ({"coverage": 0}, ["coverage must be a positive integer"]),
    ({"sources": []}, ["sources must be a non-empty list"]), ({"sources": {"url": 1}}, ["sources must be a non-empty list"]), ({"id": 12}, ["id must be a string"]),
    ({"published_at": 2024}, ["published_at must be a string"]),
])
def test_types_of_an_item(spark, change, broken):
    rows = spark.createDataFrame([(1, json.dumps(GOOD | change))], "k int, j string").select("k", F.parse_json("j").alias("value"))
    assert [r.rule for r in types.item_type_violations(rows, ["k"]).collect()] == broken


def test_an_item_that_is_no_object(spark):
    rows = spark.createDataFrame([(1, "[1]"), (2, '"x"'), (3, "null")], "k int, j string").select("k", F.parse_json("j").alias("value"))
    assert sorted((r.k, r.rule) for r in types.item_type_violations(rows, ["k"]).collect()) == [(k, "item must be an object") for k in (1, 2, 3)]


def test_pruned_partitions_are_gone_from_storage(spark):
    name = f"pruned_{uuid.uuid4().hex}"
    snapshots.create_snapshot_table(spark, name, "id BIGINT")
    stamps = [dt.datetime(2024, 3, 1), dt.datetime(2024, 1, 31, 17), dt.datetime(2024, 1, 30, 12), dt.datetime(2023, 6, 1)]
    rows = spark.createDataFrame(list(enumerate(stamps)), "id bigint, at timestamp")
    snapshots.append_snapshot(rows, name, F.col("at"))
    snapshots.append_snapshot(rows.filter("id = 0"), name, F.col("at"))  # the same day again replaces it
    place = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first().data_type.removeprefix("file:")
    assert len([d for d in os.listdir(place) if d.startswith("harvest_date=")]) == 4
    reading = spark.table(name).filter("harvest_date = DATE'2024-03-01'")
    assert snapshots.prune(spark, name, keep_days=30) == [dt.date(2023, 6, 1), dt.date(2024, 1, 30)]
    assert sorted(d for d in os.listdir(place) if d.startswith("harvest_date=")) == ["harvest_date=2024-02-01", "harvest_date=2024-03-01"]
    assert reading.count() == 1 and spark.table(name).count() == 2 and snapshots.prune(spark, name) == []
    spark.sql(f"DROP TABLE {name}")
