"""Whole JSON documents as files with names of their own, read as VARIANT.

An issue is one file, whatever its size: it is written row by row from sorted rows, so no task collects its items, and it is
read as one variant from which the items are exploded. Types are still those of the document, so rules can look at
them before anything is cast.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _writer(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        name, out, tail, n = None, None, "", 0

        def close() -> pa.RecordBatch:
            out.write(tail.encode())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["name", "n"])

        for batch in batches:
            for own, head, item, end in zip(*(batch.column(c).to_pylist() for c in ("name", "head", "item", "tail")), strict=True):
                if own != name:
                    if out is not None:
                        yield close()
                    name, tail, n, out = own, end, 0, system.open_output_stream(f"{root}/{own}")
                    out.write(head.encode())
                if item is not None:
                    out.write(("," * (n > 0) + item).encode())
                    n += 1
        if out is not None:
            yield close()

    return run


def write_documents(rows: DataFrame, path: str, order: list[Column]) -> int:
    """One file a name: head, the items in `order` with commas between, tail; returns the number of items.

    rows: name, head, item, tail (the same head and tail for all rows of a name; a null item adds none). A task that is run
    again writes its files again."""
    uri = path if "://" in path else "file://" + path.removeprefix("file:")
    dealt = rows.repartition("name").sortWithinPartitions("name", *order).select("name", "head", "item", "tail")
    return dealt.mapInArrow(_writer(uri), "name string, n long").agg(F.sum("n")).first()[0] or 0


def read_documents(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(name, doc): every file whose name matches, as a variant; `name` is the pattern's first group. Others are ignored."""
    docs = spark.read.format("json").option("singleVariantColumn", "doc").option("multiLine", True).load(path)
    return docs.select(F.regexp_extract("_metadata.file_name", pattern, 1).alias("name"), "doc").filter("name <> ''")


def exploded(docs: DataFrame, field: str, *keep: str) -> DataFrame:
    """(keep, pos, value): the elements of an array field of `doc`, as variants; documents without such an array give none."""
    spark = docs.sparkSession
    part = F.try_variant_get("doc", f"$.{field}", "variant")
    lists = docs.select(*keep, F.when(F.schema_of_variant(part).startswith("ARRAY"), part).alias("__list"))
    return lists.lateralJoin(spark.tvf.variant_explode(F.col("__list").outer())).select(*keep, "pos", "value")


def typed(rows: DataFrame, schema: str, *keep: str) -> DataFrame:
    """(keep, columns of the schema) of variants; a value that doesn't fit gives nulls."""
    return rows.select(*keep, F.try_variant_get("value", "$", schema).alias("__v")).select(*keep, "__v.*")
