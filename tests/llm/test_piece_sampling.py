import collections
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F, types as T

from tunesmith.llm import piece_sampling as S, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


def ways(vocabulary, text):
    """All segmentations of a text without blanks inside, with their shares."""
    units = S.BLANK + text
    found = {}

    def walk(at, ids, weight):
        if at == len(units):
            found[tuple(ids)] = weight
        for end in range(at + 1, len(units) + 1):
            if (piece := vocabulary.pieces.get(units[at:end])) is not None:
                walk(end, [*ids, piece[0]], weight * piece[1])

    walk(0, [], 1.0)
    total = sum(found.values())
    return {k: w / total for k, w in found.items()}


@pytest.mark.parametrize("text", ["the", "hello,", "und.The"])
@pytest.mark.parametrize("alpha", [1.0, 0.3])
def test_draws_follow_the_weights(text, alpha):
    sampler, n = S.Sampler(PATH, alpha), 20_000
    got = collections.Counter(tuple(x.tolist()) for x in sampler.sample(list(range(n)), [text] * n))
    want = ways(sampler.vocabulary, text)
    assert set(got) <= set(want) and len(want) > 3
    for ids, share in want.items():
        assert abs(got[ids] / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 1e-4


def texts():
    rng = random.Random(9)
    bits = [*"abcäöß é中文\n\t▁\0\x7f", "  ", "the ", " und", "\U0001f600", "ﬁ", "<s>", "<0x41>", "</s>", "▁▁"]
    return ["", " ", "▁", "\n\n ", "x" * 5000, "ab " * 3000] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(1000)]


def test_lossless_and_independent_of_the_batch():
    given, model = texts(), sentencepiece.SentencePieceProcessor(model_file=PATH)
    together = S.Sampler(PATH).sample(list(range(len(given))), given)
    one = S.Sampler(PATH)
    for k, (text, ids) in enumerate(zip(given, together)):
        assert one.decode(ids) == text
        assert not len(ids) or ids.max() < 32000 and ids.min() > 2
        if "▁" not in text:
            assert model.decode(ids.tolist()) == text
        if k % 7 == 0:
            assert (one.sample([k], [text])[0] == ids).all()


def test_forgetting_changes_nothing(monkeypatch):
    given = texts()
    want = S.Sampler(PATH).sample(list(range(len(given))), given)
    monkeypatch.setattr(S, "EDGES", 100)
    small = S.Sampler(PATH)
    got = [small.sample([k], [t])[0] for k, t in enumerate(given)]
    assert all((a == b).all() for a, b in zip(got, want))


def test_rows(spark):
    schema = T.StructType([T.StructField(n, T.LongType() if n == "doc_id" else T.StringType()) for n in ("doc_id", "text", "N_PIECES", "lossless")])
    rows = [(1, None, "x", None), (1, "", "x", None), (None, "hello world", None, None), (2, "hello world", None, None), (2, "hello world", None, None), (3, "é " * 50_000, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, S.round_trips(df, PATH).collect()), key=str)
    assert len(got) == 6 and all(r[3] for r in got) and [r[1] for r in got if r[0] == 1] == [0, 0]
    assert len({r for r in got if r[0] == 2}) == 1
    assert S.round_trips(df.limit(0), PATH).collect() == []
    back = df.select("text", S.decoded(S.sampled_ids(F.col("doc_id"), F.col("text"), PATH), PATH).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in back)


def test_query_does_not_depend_on_partitions(spark):
    folder = "/root/testdata/sf0.001"
    got = sorted(map(tuple, queries.op5_piece_sampling(spark, folder).collect()))
    again = S.round_trips(spark.read.parquet(f"{folder}/documents.parquet").repartition(5), PATH)
    assert got == sorted(map(tuple, again.collect())) and len(got) == 200 and all(r[3] for r in got)


def units(text):
    """The mark of a blank for each blank of a text and the one before it, as the lattices have them."""
    return (" " + text).replace(" ", S.BLANK)


@pytest.mark.parametrize("text", ["a" + " " * n + "b" for n in range(1, 20)] + ["   ", " " * 16 + "y", "if x:\n        return  y  \n\n    \nend   ", " | a    |   b |\n|--|     "])
def test_the_librarys_own_blank_runs_are_ways(text):
    model, sampler = sentencepiece.SentencePieceProcessor(model_file=PATH), S.Sampler(PATH)
    for line in text.split("\n"):
        own = model.encode(line)
        assert [sampler.vocabulary.pieces[model.id_to_piece(i)][0] for i in own] == own
        assert "".join(map(model.id_to_piece, own)) == (units(line) if line else "")
    n = 3000
    for ids in sampler.sample(list(range(n)), [text] * n):
        assert sampler.decode(ids) == text


@pytest.mark.parametrize("text", ["a   b", "    ", "  \n   x"])
def test_draws_of_blank_runs_follow_the_weights(text):
    sampler, n, model = S.Sampler(PATH), 20_000, sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = collections.Counter(tuple(x.tolist()) for x in sampler.sample(list(range(n)), [text] * n))
    head, *lines = text.split("\n")
    want = ways(sampler.vocabulary, head.replace(" ", S.BLANK))
    for line in lines:
        line_ways = ways(sampler.vocabulary, line.replace(" ", S.BLANK)[1:])
        want = {(*a, sampler.vocabulary.byte_ids[10], *b): x * y for a, x in want.items() for b, y in line_ways.items()}
    assert set(got) <= set(want) and len(want) > 3 and tuple(model.encode(text)) in want
    for ids, share in want.items():
        assert abs(got[ids] / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 1e-4


def test_long_blank_runs():
    texts = ["x" + " " * 20_000 + "y", " " * 3000]
    sampler = S.Sampler(PATH)
    runs = {i: p for p, (i, _) in sampler.vocabulary.pieces.items() if set(p) == {S.BLANK}}
    assert sorted(map(len, runs.values())) == [*range(1, 15), 16]
    for text, ids in zip(texts, sampler.sample([1, 2], texts)):
        assert sampler.decode(ids) == text
        assert np.isin(ids, [i for i, p in runs.items() if len(p) > 1]).sum() > len(text) / 40
