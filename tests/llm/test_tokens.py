import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T

from tunesmith.llm import token_counts, tokens

PATHS = {"byte_bpe_50k.json": tokens.byte_level_ids, "word_bpe_49k.json": tokens.word_ids}
LETTERS = [*" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　'sStTlLdDİſK\xe9\xdf\xfc٣\xbd\xb2.,;!?#$12中文̈́\U0001f600Åﬁ"]
LETTERS += ["<|endoftext|>", "'s", "'ll", "  ", "\n\n", "hello", " world", "'S"]


def texts(n):
    rng = random.Random(5)
    found = ["", " ", "\n", "a" * 3000, "ab " * 2000 + "\n\n", "it's I'll\nshe'S", "x <|endoftext|> y<|endoftext|>"]
    return found + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("name", PATHS)
def test_ids_equal_the_library(name):
    path = public_tokenizers.path(name)
    of, whole = PATHS[name](path), tokens.library(path)
    for text in texts(3000):
        assert np.frombuffer(of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", PATHS)
def test_every_character_by_itself_and_among_others(name):
    path = public_tokenizers.path(name)
    of, whole = PATHS[name](path), tokens.library(path)
    for c in [*range(0x3000), *range(0xFB00, 0x10000), *range(0x1F600, 0x1F650)]:
        text = f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1"
        assert np.frombuffer(of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, hex(c)


def test_counts_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    of, whole = token_counts.counter(path), tokens.library(path)
    for text in texts(3000):
        assert of(text) == len(whole.encode(text, add_special_tokens=False).ids)


def test_memo_forgets_but_stays_right():
    memo = tokens.Memo(lambda k: k * 2, kept=3)
    assert [memo[k] for k in ["a", "b", "c", "d", "a", "e", "f", "g", "a"]] == ["aa", "bb", "cc", "dd", "aa", "ee", "ff", "gg", "aa"]
    assert len(memo) <= 3 and memo["x" * 100] == "x" * 200 and "x" * 100 not in memo


def test_merges_take_the_leftmost_of_equal_rank():
    assert token_counts.merged_count(list("aaaa"), {("a", "a"): 0, ("aa", "aa"): 1}) == 1
    assert token_counts.merged_count(list("aaa"), {("a", "a"): 0, ("a", "aa"): 1}) == 2
    assert token_counts.merged_count([], {}) == 0 and token_counts.merged_count(["a"], {}) == 1


def test_counts_of_odd_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("N_TOKENS", "string").add("m", T.MapType(T.StringType(), T.IntegerType()))
    rows = [(1, None, "x", None), (1, "", "x", {"a": 1}), (None, "hello world", None, None), (2, "é" * 100_000, "y", None), (2, "hello world", "y", None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, token_counts.token_counts(df, path, limit=2).collect()), key=str)
    assert got[:2] == [(1, 0, 0, False), (1, 0, 0, False)]
    assert (2, 11, 2, False) in got and (None, 11, 2, False) in got
    long = next(r for r in got if r[1] == 200_000)
    assert long[2] == len(tokens.library(path).encode("é" * 100_000, add_special_tokens=False).ids) and long[3]
    assert token_counts.token_counts(df.limit(0), path).collect() == []


# Long runs that a search from each of their characters would look at again and again.
RUNS = {"marks before a letter": "x " + "." * 1_000_000 + "a", "mixed marks": "x " + ".,;:!?" * 160_000 + "a", "marks": "!" * 1_000_000, "white space": "a" + " \n\t" * 330_000, "letters": "ab" * 500_000 + "."}


@pytest.mark.parametrize("text", RUNS.values(), ids=RUNS)
def test_long_runs_take_linear_time(text):
    for name, of in [*PATHS.items(), ("byte_bpe_50k.json", token_counts.counter)]:
        path = public_tokenizers.path(name)
        of, whole = of(path), tokens.library(path)
        start = time.process_time()
        found = of(text)
        own = time.process_time() - start
        ids = whole.encode(text, add_special_tokens=False).ids
        library = time.process_time() - start - own
        assert (found if isinstance(found, int) else len(found) // 4) == len(ids)
        assert isinstance(found, int) or np.frombuffer(found, "<u4").tolist() == ids
        # The heap's merging is in Python; the rest is the library's.
        assert own < (20 if isinstance(found, int) else 2 + 3 * library), name


def test_a_worker_keeps_what_its_stage_uses(monkeypatch):
    stage = [1]
    monkeypatch.setattr(tokens.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"stageId": lambda self: stage[0]})()))
    monkeypatch.setattr(tokens, "_held", {})
    made = []
    keep = lambda name: tokens.worker_kept((name,), lambda: made.append(name) or name)
    assert [keep(x) for x in "aabba"] == list("aabba") and made == ["a", "b"]
    stage[0] = 2
    assert keep("a") == "a" and keep("a") == "a" and made == ["a", "b"]
    # What the new stage did not ask for first is gone.
    assert keep("b") == "b" and made == ["a", "b", "b"] and set(tokens._held) == {("a",), ("b",)}
    stage[0] = 3
    keep("c")
    assert set(tokens._held) == {("c",)}
