import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tunesmith.llm import bit_planes, queries, tokens

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_planes_round_trip(unit):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 9, 1000):
        for top in (1, 300, 1 << 16, 1 << 32):
            ids = rng.integers(0, top, n).astype("<u4")
            assert (bit_planes.ids_of(bit_planes.planes_of(ids, unit), n, unit) == ids).all()


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_file_round_trip(spark, tmp_path, unit, monkeypatch):
    rows = [(3, "a b"), (None, "x"), (1, None), (2, ""), (1, "z " * 200_000), (3, "a b"), (-5, "\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("IDS", F.lit(1)).repartition(3)
    path = str(tmp_path / "planes")
    bit_planes.write_planes(df, path, lambda: lambda t: np.frombuffer(t.encode(), "u1").astype("<u4").tobytes(), 70_000, unit=unit)
    got = sorted(bit_planes.read_planes(spark, path).collect(), key=lambda r: (r["part"], r["before"]))
    texts = [bytes(i for i in np.frombuffer(r["ids"], "<u4")[:-1]).decode() for r in got]
    assert [r["doc_id"] for r in got] == [None, -5, 1, 1, 2, 3, 3]
    assert texts[:2] == ["x", "\n"] and sorted(texts[2:4], key=len) == ["", "z " * 200_000] and texts[4:] == ["", "a b", "a b"]
    assert all(np.frombuffer(r["ids"], "<u4")[-1] == 70_000 for r in got)


def test_many_files_and_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bit_planes, "FILE_BYTES", 3000)
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), F.col("id").cast("int") % 17).alias("text"))
    path = str(tmp_path / "many")
    bit_planes.write_planes(df, path, lambda: lambda t: np.frombuffer(t.encode(), "u1").astype("<u4").tobytes(), 0)
    docs = bit_planes.read_planes(spark, path)
    assert docs.select("part").distinct().count() > 2
    got = sorted(map(tuple, bit_planes.document_starts(docs).collect()))
    start = 0
    for k, (doc, first, n, _) in enumerate(got):
        assert (doc, first, n) == (k, start, 3 * (k % 17) + 1)
        start += n


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    bit_planes.write_planes(spark.createDataFrame([], "doc_id long, text string"), path, lambda: str.encode, 0)
    assert bit_planes.document_starts(bit_planes.read_planes(spark, path)).collect() == []


def test_query_against_the_library(spark):
    whole = tokens.library(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    got = sorted(map(tuple, queries.op7_bit_planes(spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    assert len(got) == len(docs)
    for (doc, text), row in zip(docs, got):
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        assert row == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
