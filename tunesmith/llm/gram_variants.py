"""Groups of spelling variants by blocked Gram matrices (op12).

1. Runs of letters of all documents are counted; words are those long and frequent enough.
2. Words of one length are laid out in cells by how many of their letters fall into each of
   ``GROUPS`` groups of letters. One edit moves a word to its own cell or to a known few cells
   of its own length or the next one, so each cell is met with those at one side of it.
3. In a task the letter counts of a block of words are multiplied with those of another (a
   Gram matrix); with the squared lengths that gives all squared distances. Pairs at a distance
   of at most two (of one length: exactly two; of adjacent lengths: one) are verified letter
   by letter. No pair is given out: only each word's number of near words and the best of them.
4. A word's form is its near word of largest count, if that is ``RATIO`` times its own or
   more; the root is found by following forms, two, four, eight steps at a time.

A cell with over ``BLOCK`` words is cut up by a hash of the word, and each piece is met with
all pieces of its neighbours.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tunesmith.llm.common import quoted
from tunesmith.sources.scratch import stored

#: Letters a word may hold once A-Z are made small: a fixed value.
LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
# In Latin-1 every such letter is one byte, and what it lacks becomes a sign that cuts.
_CUT = bytes(c + 32 if 0x41 <= c <= 0x5A else c if chr(c) in LETTERS else 0x20 for c in range(256))
# A run whose hash this divides loses a letter; letters and occurrences of a word; a form's count is that many times the word's.
DROP_EVERY, LEAST_LETTERS, LEAST_COUNT, RATIO = 199, 6, 5, 5
# Groups of letters; words of a piece of a cell; words a task counts before it gives them out; products made at once.
GROUPS, BLOCK, HELD, PRODUCTS = 5, 8192, 200_000, 1 << 22
# Up to this length all products are below 2**24, which four bytes hold exactly.
NARROW = 4095


def runs_of(doc_id: int | None, text: str) -> Iterator[tuple[bytes, int]]:
    """The words of one document in Latin-1, some without a letter, and their occurrences."""
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter(text.encode("latin-1", "replace").translate(_CUT).split()).items():
        h = crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % DROP_EVERY == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1 :]
        if len(word) >= LEAST_LETTERS:
            yield word, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[bytes, int] = {}
    size = 0

    def rows() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in found], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(found.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            for word, n in runs_of(doc_id.as_py(), text.as_py() or ""):
                if word in found:
                    found[word] += n
                else:
                    found[word] = n
                    size += len(word)
            if len(found) >= HELD or size >= HELD * 64:
                yield rows()
                found, size = {}, 0
    if found:
        yield rows()


def word_counts(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The distinct words of whole texts with ``n``, their occurrences."""
    given = df.select(quoted(key).cast("long").alias("k"), quoted(text).alias("t"))
    counts = given.mapInArrow(_counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letter_groups(words: DataFrame) -> list[str]:
    """The letters in ``GROUPS`` groups that hold about as many letters of the words each."""
    each = words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().collect()
    groups, sizes = [""] * GROUPS, [0] * GROUPS
    # At most as many rows as there are letters.
    for c, n in sorted(((r["c"], r["count"]) for r in each if r["c"]), key=lambda x: (-x[1], x[0])):
        k = sizes.index(min(sizes))
        groups[k], sizes[k] = groups[k] + c, sizes[k] + n
    return groups


def _cells(words: DataFrame, groups: list[str]) -> DataFrame:
    """``words`` with ``cell``: how many letters of each group a word has."""
    inside = [F.length("word") - F.length(F.translate("word", g, "")) if g else F.lit(0) for g in groups]
    return words.withColumn("cell", F.array(*inside))


def _homes(cell: Column) -> Column:
    """The cells that a word of ``cell`` is met in (home, role): its own, and those one edit before it."""

    def moved(step: dict[int, int]) -> Column:
        return F.transform(cell, lambda c, i: c + F.coalesce(F.get(F.array(*[F.lit(step.get(g, 0)) for g in range(GROUPS)]), i), F.lit(0)))

    steps = [{g: -1} for g in range(GROUPS)] + [{a: -1, b: 1} for a in range(GROUPS) for b in range(a + 1, GROUPS)]
    homes = [F.struct(cell.alias("home"), F.lit(0).alias("role"))] + [F.struct(moved(s).alias("home"), F.lit(1).alias("role")) for s in steps]
    return F.filter(F.array(*homes), lambda h: F.array_min(h["home"]) >= 0)


# Letter counts, distances, edits


_SLOT = np.full(0x100, -1, np.int16)
_SLOT[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


class Words:
    """Words of one block with their counts; those of a length are put together."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = np.array(words, object), n
        lengths = np.array([len(w) for w in words], np.int64)
        self.of = {int(size): np.flatnonzero(lengths == size) for size in np.unique(lengths)}

    def letters(self, rows: np.ndarray) -> np.ndarray:
        """Letters of words of one length, a line per word."""
        return np.frombuffer("".join(self.words[rows]).encode("latin-1"), np.uint8).reshape(len(rows), -1)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """How often each line holds each letter."""
    kind = np.float32 if letters.shape[1] <= NARROW else np.float64
    at = np.arange(len(letters))[:, None] * len(LETTERS) + _SLOT[letters]
    return np.bincount(at.ravel(), minlength=len(letters) * len(LETTERS)).reshape(len(letters), -1).astype(kind)


def near_pairs(a: np.ndarray, b: np.ndarray, inside: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Lines of ``a`` and ``b`` (letters) that are one edit apart; ``b`` as long as ``a`` or one longer.

    ``inside`` says that both are the same lines, of which each pair is wanted once.
    """
    long_by = b.shape[1] - a.shape[1]
    x, y = letter_counts(a), letter_counts(b)
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    found = []
    step = max(1, PRODUCTS // max(1, len(b)))
    for start in range(0, len(a), step):
        far = xx[start : start + step, None] + yy[None, :] - 2 * (x[start : start + step] @ y.T)
        i, j = np.nonzero(far == (1 if long_by else 2))
        i = i + start
        if inside:
            i, j = i[i < j], j[i < j]
        # Long words are compared a few at a time.
        some = max(1, PRODUCTS // a.shape[1])
        for at in range(0, len(i), some):
            one = _one_edit(a[i[at : at + some]], b[j[at : at + some]])
            found.append((i[at : at + some][one], j[at : at + some][one]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether lines are one replaced or one inserted letter apart."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    size = a.shape[1]
    front = np.logical_and.accumulate(a == b[:, :size], axis=1).sum(1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= size


class Found:
    """Per word: how many near words, and the best of them."""

    def __init__(self):
        self.words: list[np.ndarray] = []
        self.others: list[np.ndarray] = []
        self.n: list[np.ndarray] = []

    def add(self, left: Words, i: np.ndarray, right: Words, j: np.ndarray) -> None:
        self.words += [left.words[i], right.words[j]]
        self.others += [right.words[j], left.words[i]]
        self.n += [right.n[j], left.n[i]]

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.words:
            return
        parts = [np.concatenate(x) for x in (self.words, self.others, self.n)]
        table = pa.table([pa.array(parts[0], pa.string()), pa.array(parts[1], pa.string()), pa.array(parts[2], pa.int64())], ["word", "other", "other_n"])
        # The best near word is the one of largest count, then of smallest code points.
        table = table.sort_by([("word", "ascending"), ("other_n", "descending"), ("other", "ascending")])
        table = table.group_by("word", use_threads=False).aggregate([("other", "first"), ("other_n", "first"), ("other", "count")])
        yield from table.rename_columns(["word", "other", "other_n", "n_near"]).to_batches()


def _met(home: Words, other: Words, found: Found, own: bool) -> None:
    for size, rows in home.of.items():
        a = home.letters(rows)
        for longer in (0, 1):
            if size + longer in other.of:
                at = other.of[size + longer]
                i, j = near_pairs(a, a if own and not longer else other.letters(at), own and not longer)
                if len(i):
                    found.add(home, rows[i], other, at[j])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (group, role): the words of a home piece, then those it is met with."""
    at, held, home = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        # A piece, or a part of its neighbours, is a run of rows.
        group, role = batch.column("group").to_numpy(zero_copy_only=False), batch.column("role").to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero((group[1:] != group[:-1]) | (role[1:] != role[:-1])) + 1).tolist(), batch.num_rows]
        found = Found()
        for a, b in zip(edges, edges[1:]):
            if group[a] != at:
                if home is None and held:
                    _own(_joined(held), found)
                at, held, home = group[a], [], None
            rows = batch.slice(a, b - a)
            if role[a] == 0:
                held.append(rows)
                continue
            if home is None:
                if not held:
                    continue
                home, held = _joined(held), []
                _own(home, found)
            _met(home, _joined([rows]), found, False)
        yield from found.rows()
    if home is None and held:
        found = Found()
        _own(_joined(held), found)
        yield from found.rows()


def _own(home: Words, found: Found) -> None:
    _met(home, home, found, True)


def _joined(rows: list[pa.RecordBatch]) -> Words:
    return Words([w for r in rows for w in r.column("word").to_pylist()], np.concatenate([r.column("n").to_numpy(zero_copy_only=False) for r in rows]))


def near_words(words: DataFrame) -> DataFrame:
    """Per word with a near one: ``n_near``, and ``best`` (its count and itself)."""
    celled = stored(_cells(words, letter_groups(words)), "cells")
    # Cells of over a block's words; there are at most a block's part of the words of them.
    large = stored(celled.groupBy("cell").count().where(F.col("count") > BLOCK).select(F.col("cell").alias("home"), F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")), "large")
    sent = celled.select("word", "n", F.inline(_homes(F.col("cell")))).join(large, "home", "left")
    parts, own = F.coalesce("parts", F.lit(1)), F.col("role") == 0
    piece = F.pmod(F.xxhash64("word"), parts).cast("int")
    # A home's words are in one piece each, but meet the later pieces of their own cell too.
    met = F.filter(F.sequence(F.lit(0), parts - 1), lambda p: ~own | (p <= piece))
    sent = sent.select("home", "word", "n", "role", piece.alias("piece"), F.explode(met).alias("part"))
    role = F.when((F.col("role") == 0) & (F.col("part") == F.col("piece")), 0).otherwise(1)
    # Equal homes need equal strings only, so a string names a group.
    sent = sent.select(F.concat_ws(".", F.col("home").cast("array<string>"), F.col("part").cast("string")).alias("group"), role.alias("role"), "word", "n")
    found = sent.repartition("group").sortWithinPartitions("group", "role").mapInArrow(_search, "word string, other string, other_n long, n_near long")
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def variants(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Words, counts, nearness, form and root are as at the top of the module. A null text has no
    run; a null id is hashed as an empty one; rows that repeat count each. Texts of any length
    and words of any length are taken whole. A table without words gives no row.
    """
    words = stored(word_counts(df, text, key), "words")
    near = near_words(words).withColumnRenamed("word", "near_to")
    joined = words.join(near, F.col("word") == F.col("near_to"), "left")
    form = F.when(-F.col("best.m") >= RATIO * F.col("n"), F.col("best.word"))
    found = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"), F.when(form.isNotNull(), -F.col("best.m")).alias("form_n"))
    found = stored(found, "forms")
    # Only words with a form move; each round doubles the steps taken.
    ahead = stored(found.where("form is not null").select("word", F.col("form").alias("root")), "ahead")
    while True:
        beyond = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = ahead.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "ahead")
        ahead = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    found = found.join(ahead, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
