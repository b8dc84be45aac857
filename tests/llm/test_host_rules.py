import collections
import random
import re

from pyspark.sql import functions as F, types as T

from tunesmith.llm import host_rules as H
from tunesmith.llm.common import lookup_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(windows)
    hit = {p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), len(lines), failed)


def test_counts_equal_brute_force(spark):
    rng, bits = random.Random(4), [*"abcd", "a b c d e", "\n", "\t", "\x0b", "#*", "é", "\U0001f600", "  ", "\x1c", "\xa0", "|", "x y"]
    texts = [None, "", " ", "\n\n", "a", "a b c d", "a b c d e", "a b c d e " * 3]
    texts += ["".join(rng.choice(bits) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(map(tuple, H.with_counts(df).drop("text").collect()))
    assert [g[1:] for g in got] == [brute(t) for t in texts]


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "w " * 300_000), (2, " ".join(map(str, range(100_000))))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in H.with_counts(df).collect()}
    assert got[1]["n_repeat_words"] == 300_000 and got[2]["n_repeat_words"] == 0 and got[2]["n_words"] == 100_000



def test_host_names(spark):
    given = ["http://A.example:80/x", "https://u:p@b.org?q", "src1", "", None, "ftp://c"]
    df = spark.createDataFrame([(k, g) for k, g in enumerate(given)], "k int, s string")
    assert [r[0] for r in df.orderBy("k").select(H.host_of(F.col("s"))).collect()] == ["a.example", "b.org", "src1", "", None, "c"]


GOOD = " ".join(f"word{k}" for k in range(30))
SCHEMA = T.StructType([T.StructField(n, T.LongType() if n == "doc_id" else T.IntegerType() if n in ("host", "n") else T.StringType()) for n in ("doc_id", "text", "source", "KEPT", "host", "n")])


def rows():
    found = [(k, GOOD, "good", None, 1, 1) for k in range(300)] + [(300 + k, "few", "bad", "x", None, None) for k in range(200)]
    found += [(500 + k, GOOD, "bad", None, None, 2) for k in range(20)]
    return found + [(600, GOOD, None, None, None, None), (600, GOOD, None, None, None, None), (None, None, "good", None, None, None), (601, "few", "small", None, None, None), (602, GOOD, "small", None, None, None)]


def test_rejected_hosts_take_their_documents_along(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    kept = H.quality(df).where("kept")
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [*range(300), 600, 600, 602]
    rest = H.kept_rows(df)
    assert rest.columns == df.columns and sorted(r["doc_id"] for r in rest.collect()) == [*range(300), 600, 600, 602]


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert H.quality(empty).collect() == [] and H.kept_rows(empty).collect() == []
    nulls = spark.createDataFrame([(None,) * 6] * 2, SCHEMA)
    assert [tuple(r) for r in H.quality(nulls).collect()] == [(None, 0, 0, 0, 0, 0, True, False)] * 2


def test_no_python_on_the_way(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(2)
    plan = H.with_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lookup_join_with_hot_cold_null_and_missing_keys(spark):
    left = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("k"))
    right = left.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")).where("k != 'k1'")
    got = {r["id"]: r["top"] for r in lookup_join(left, right, "k", "n").collect()}
    tops = {r["k"]: r["top"] for r in right.collect()}
    assert got == {r["id"]: tops.get(r["k"]) for r in left.collect()} and len(got) == 5000
