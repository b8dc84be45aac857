import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from tunesmith.llm import gram_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def counts(docs):
    found = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            word = run.translate(SMALL)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 199 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs):
    n = counts(docs)
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def frame(spark, docs):
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("WORD", "string").add("n", T.MapType(T.StringType(), T.IntegerType()))
    return spark.createDataFrame([(i, t, "x", None) for i, t in docs], schema)


def found(df):
    rows = gram_variants.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in rows)


def some_docs(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abeé", k=rng.randint(5, 9))) for _ in range(60)]
    words += [w[:k] + rng.choice("abÿ") + w[k + rng.randint(0, 1) :] for w in words for k in (1, 4)]
    chain = ["letterbox" + "s" * k for k in range(4)]
    docs = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=200)).swapcase()) for i in range(30)]
    docs += [(100 + k, f"{w} " * n) for k, (w, n) in enumerate(zip(chain, (5, 30, 160, 900)))]
    return docs + [(None, None), (None, "abcdef, " * 9), (7, ""), (7, "ABCDEG!" * 6), (7, "ABCDEG!" * 6), (8, "ÔabcdeĀfghijk" * 8), (9, "x" * 5000 + " " + ("y" * 3000 + " ") * 6)]


@pytest.mark.parametrize("block", [8192, 7])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(gram_variants, "BLOCK", block)
    docs = some_docs()
    want = brute(docs)
    assert sum(1 for r in want if r[1]) > 5 and any(r[2] != r[0] and r[2] != r[1] for r in want)
    assert found(frame(spark, docs)) == want


def test_few_words_held_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(gram_variants, "HELD", 3)
    docs = some_docs(2)
    got = sorted(map(tuple, gram_variants.word_counts(frame(spark, docs)).collect()))
    assert got == sorted(counts(docs).items())


def test_empty_tables_and_tables_without_words(spark):
    assert found(frame(spark, []).limit(0)) == [] and found(frame(spark, [(1, "a b c"), (2, None)])) == []
    assert found(frame(spark, [(1, "sunday " * 5)])) == [("sunday", "", "sunday", 5, 0, -1)]


def test_ties_go_to_the_smallest_code_points(spark):
    docs = [(1, "wordis " * 5 + "wordiz " * 25 + "wordié " * 25 + "wordia " * 25)]
    assert found(frame(spark, docs))[1][:2] == ("wordis", "wordia")


def lines(words):
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def test_near_pairs_of_long_words_are_exact():
    # Products are beyond what four bytes hold exactly.
    a = ["a" * 6000, "a" * 5999 + "b", "a" * 5998 + "bb"]
    i, j = gram_variants.near_pairs(lines(a), lines(a), True)
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 1), (1, 2)]
    b = ["a" * 6001, "b" + "a" * 6000, "a" * 3000 + "c" + "a" * 2999 + "b"]
    i, j = gram_variants.near_pairs(lines(a), lines(b))
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 0), (0, 1), (1, 2)]


def test_anagrams_are_no_neighbours():
    i, _ = gram_variants.near_pairs(lines(["abcdef"]), lines(["abcdfe", "badcfe"]))
    assert not len(i)
