import hashlib
import random
import re
import time

import pytest
from pyspark.sql import types as T

from tunesmith.llm import queries, secret_scan as S

FOLDER = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    """All matches, every rule run over the whole text."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    for k, rule in list(enumerate(S.RULES))[3:]:
        found += [(m.start(), k, m.end()) for m in re.finditer(rule.pattern, text, re.A)]
    return sorted(found)


def words(n, seed=3):
    rng = random.Random(seed)
    bits = ["password", "PassWD", "secret", "toKen", "api_key", "APIKEY", "paßword", "ſecret", "toKen", ":", "=", " ", '"', "'", "abc", "x" * 7, "AKIA", "AKIA" + "B" * 16, "AKIA" + "1" * 15]
    bits += ["0123456789abcdef" * 2, "f" * 23, "f" * 24, "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + "." + "c" * 9, "ghp_" + "Z" * 36, "\n", "é", "\U0001f600", "\0"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_blocks_equal_a_full_scan(monkeypatch):
    texts = ["", "a", "ab", None, *words(4000)]
    expected = [brute(t or "") for t in texts]
    assert S.scan_block(texts) == expected
    monkeypatch.setattr(S, "BLOCK_BYTES", 50)
    assert S.scan_block(texts) == expected
    assert sum(map(len, expected)) > 1000


def test_queries_of_patterns():
    assert S.trigram_query("[0-9a-f]+") is True and S.trigram_query("ab") is True and S.trigram_query("(abc|d)x*") is True
    assert S.trigram_query("AKIA[A-Z0-9]+") == ("and", frozenset({"aki", "kia"}))
    assert S.trigram_query("abc|xyz") == ("or", frozenset({"abc", "xyz"}))
    assert S.trigram_query("a[bc]d+e") == ("or", frozenset({"abd", "acd"})) or S.trigram_query("a[bc]d") == ("or", frozenset({"abd", "acd"}))
    assert S.trigram_query("(?:abcd)*x") is True and S.trigram_query("(?:abcd)+") == ("and", frozenset({"abc", "bcd"}))
    assert S.trigram_query("^abc$") == "abc" and S.trigram_query("(?!abc)de") is True
    assert "password"[2:5] in S.trigrams_of(S.trigram_query(S.RULES[0].pattern))


@pytest.mark.parametrize("pattern", ["ab?cde", "(ab|cd)ef", "x[0-9]{3}yzw", "q(?:rst)?uvw", "[aA]bc+d", "abc.*def", "(?i:abc)d"])
def test_queries_let_every_match_through(pattern):
    rng, query, alphabet = random.Random(1), S.trigram_query(pattern), "abcdefxyzwqrstuv019A"
    slot = S._compiled((S.Rule("r", pattern),))
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(8))
        if rng.random() < 0.5:
            text = text[:3] + rng.choice(["abcde", "acde", "abef", "cdef", "x012yzw", "quvw", "qrstuvw", "Abcd", "abcxdef", "ABCd"]) + text[3:]
        if re.search(pattern, text):
            index = S.postings([text.encode()], slot[2], slot[3])
            assert len(S.candidates(query, index, 1)) == 1


def test_rows(spark):
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("SPANS", "string").add("n", T.ArrayType(T.StringType()))
    rows = [(1, "é token: abcdef1 AKIA" + "Q" * 16, "x", None), (1, None, None, []), (None, "", None, None), (2, "0" * 100_000, None, None), (2, "0" * 100_000, None, None)]
    got = sorted(map(tuple, S.secrets(spark.createDataFrame(rows, schema)).collect()), key=str)
    empty = hashlib.sha256(b"").hexdigest()
    base = "assign:2:16,access:17:37"
    assert got.count((2, 0, 0, 1, hashlib.sha256(b"hex:0:100000").hexdigest(), "hex:0:100000")) == 2
    assert (1, 1, 1, 0, hashlib.sha256(base.encode()).hexdigest(), base) in got
    assert (1, 0, 0, 0, empty, "") in got and (None, 0, 0, 0, empty, "") in got and len(got) == 5
    assert S.secrets(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(1, "a token=abcdefgh b"), (2, None), (3, "password: " + "a" * 30 + " end"), (4, "clean")], "doc_id long, text string")
    hidden = {r[0]: r[1] for r in df.select("doc_id", S.masked(df["text"])).collect()}
    assert hidden == {1: "a [secret] b", 2: None, 3: "[secret] end", 4: "clean"}


def test_query_against_a_full_scan(spark):
    got = {r["doc_id"]: r for r in queries.op6_secret_scan(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        spans, row = brute(doc["text"]), got[doc["doc_id"]]
        own = ",".join(f"{S.RULES[k].kind}:{a}:{b}" for a, k, b in spans if k < 3)
        assert row["base_sha256"] == hashlib.sha256(own.encode()).hexdigest()
        assert row["spans"] == ",".join(f"{S.RULES[k].kind}:{a}:{b}" for a, k, b in spans)
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(sum(s[1] == k for s in spans) for k in range(3))


LONG = ["eyJ" * 340_000 + " .eyJ", "token" * 200_000, "password" + " " * 1_000_000 + "x", "AKIA" * 250_000, "-----BEGIN " + "A " * 500_000, "0" * 1_000_000, "gh" * 500_000, "token= " * 140_000 + " " * 100_000]


@pytest.mark.parametrize("text", LONG, ids=[t[:12] for t in LONG])
def test_long_runs_take_linear_time(text):
    S.scan_block(["warm"])
    start = time.process_time()
    S.scan_block([text])
    assert time.process_time() - start < 2


def test_a_token_begins_a_run_of_its_characters():
    token = ".".join(["eyJ" + "a" * 9, "eyJ" + "b" * 9, "c" * 9])
    found = [[S.RULES[k].kind for _, k, _ in spans] for spans in S.scan_block([f"x {token} y", f"({token})", "x" + token, f"{token} {token}"])]
    assert found == [["jwt"], ["jwt"], [], ["jwt", "jwt"]]
