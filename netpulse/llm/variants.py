"""Spelling variant grouping: sorted-list dynamic programming over a distributed vocabulary."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import stored

#: Words have so many code points at least and occur so often.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A near word is a word's form if it occurs so many times as often.
FORM_RATIO = 10
#: One run in so many loses a code point.
DAMAGED_PART = 31
#: Lists with more words, or more code points in all, are split by a longer shared part.
SPLIT_WORDS, SPLIT_CODES = 8192, 1 << 20
#: Distinct words that a task holds before it hands on its partial counts.
HELD_WORDS = 200_000
#: Rows and code points of neighbouring lists that one scan takes together.
SCAN_WORDS, SCAN_CODES = 16_384, 1 << 21

_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")


# --- words ---------------------------------------------------------------------------------------------


def words_of(doc_id: int | None, text: str | None) -> Counter[str]:
    """Damaged runs of at least LEAST_LENGTH code points of one text, with their counts.

    A null doc_id has an empty text form, a null text no runs. Runs below the least length are
    skipped: damage only shortens them.
    """
    lowered = (text or "").encode().lower().decode()  # bytes: A-Z only
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter[str] = Counter()
    for run, n in Counter(_RUN.findall(lowered)).items():
        h = zlib.crc32(run.encode(), seed)
        if h % DAMAGED_PART == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        found[run] += n
    return found


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()
    for batch in batches:
        for row in range(batch.num_rows):
            found = words_of(batch.column(0)[row].as_py(), batch.column(1)[row].as_py())
            if len(held) + len(found) > HELD_WORDS:
                yield from _counts(held)
                held = Counter()
            held.update(found)
    yield from _counts(held)


def _counts(held: Counter[str]) -> Iterator[pa.RecordBatch]:
    words = list(held)
    for start in range(0, len(words), 50_000):
        part = words[start : start + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())], names=["word", "n"]
        )


def vocabulary(docs: DataFrame) -> DataFrame:
    """``(word, n)``: damaged words of all texts with LEAST_COUNT or more occurrences.

    Every task adds up what it meets, so a frequent word costs each task a few rows.
    """
    counted = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_count_batches, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- lists ---------------------------------------------------------------------------------------------


def _lists(vocab: DataFrame) -> DataFrame:
    """Every word in the lists of lengths m and m + 1, for both m it can belong to; nothing shared yet."""
    m = F.char_length("word")
    both = F.array(m, m - 1)
    return vocab.select("word", "n", F.explode(both).alias("m")).select(
        "word", "n", "m", F.lit(0).alias("lo"), F.lit(0).alias("hi")
    )


def _halved(rows: DataFrame) -> DataFrame:
    """Words once by the left and once by the right half of the part in which their list may differ.

    A list shares ``lo`` code points at the start and ``hi`` at the end. Two words one edit apart
    agree on all before the edit and on all behind it; so they share one of the halves.
    """
    open_part = F.col("m") - F.col("lo") - F.col("hi")
    left = F.floor(open_part / 2).cast("int")
    halves = F.array(
        F.struct((F.col("lo") + left).alias("lo"), F.col("hi").alias("hi")),
        F.struct(F.col("lo").alias("lo"), (F.col("hi") + open_part - left).alias("hi")),
    )
    split = rows.select("word", "n", "m", F.explode(halves).alias("h")).select("word", "n", "m", "h.lo", "h.hi")
    return split.withColumn("shared", _shared())


def _shared() -> Column:
    head = F.substring("word", F.lit(1), F.col("lo"))
    return F.concat(head, F.lit("|"), F.expr("right(word, hi)"))


_LIST = ["m", "lo", "hi", "shared"]


def word_lists(vocab: DataFrame, split_words: int = SPLIT_WORDS, split_codes: int = SPLIT_CODES) -> DataFrame:
    """Rows ``(word, n, m, lo, hi, shared)``: lists such that words one edit apart meet in one of them.

    A list above the limits is replaced by the lists of the halves of its open part, until one code
    point is open; so the number of rounds is the logarithm of the longest word's length, and the
    lists at the end hold what one place of the alphabet can tell apart.
    """
    done, pending = [], _lists(vocab)
    while True:
        keyed = _halved(pending)
        sizes = keyed.groupBy(*_LIST).agg(F.count("*").alias("words"))
        codes = F.col("words") * F.col("m")
        large = (F.col("words") > split_words) | (codes > split_codes)
        still_open = F.col("m") - F.col("lo") - F.col("hi") > 1
        hot = stored(sizes.where(large & still_open).select(*_LIST), "hot-lists")
        if hot.isEmpty():
            done.append(keyed)
            break
        done.append(keyed.join(hot, _LIST, "left_anti"))
        pending = stored(keyed.join(hot, _LIST, "left_semi").drop("shared"), "split-lists")
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    return rows


# --- the scan ------------------------------------------------------------------------------------------


def code_matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points (Latin-1, all words are within it) padded with 0, and lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.zeros((len(words), int(lengths.max(initial=0)) + 1), np.uint8)
    codes[np.arange(codes.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    return codes, lengths


@dataclass
class SortedList:
    """Sorted words of neighbouring lists; ``shared[j]`` is the common prefix with row j - 1, -1 at a list's start."""

    codes: np.ndarray
    lengths: np.ndarray
    shared: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> "SortedList":
        shared = np.full(len(lengths), -1, np.int64)
        differ = codes[1:] != codes[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), codes.shape[1])
        shared[first] = -1
        return cls(codes, lengths, shared)

    def skips(self) -> np.ndarray:
        """[d, j]: the next row after j that shares at most d code points with the row before it."""
        n, width = self.codes.shape
        rows = np.arange(n)
        table = np.full((width + 1, n + 1), n, np.int32)
        for d in range(width + 1):
            table[d, :n] = np.where(self.shared <= d, rows, n)
        later = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1]
        return later[:, 1:]


def one_edit_pairs(words: SortedList) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j), i < j, of one list whose words differ by exactly one edit.

    Every word scans the sorted words behind it with an edit matrix of three diagonals, one row per
    code point of the scanned word. The next word keeps the rows of the prefix it shares with the
    last one. Where a row has no entry of at most one edit, all words with that prefix are skipped.
    All scans advance together, one matrix row at a time.
    """
    n, width = words.codes.shape
    padded = np.zeros((n, width + 3), np.uint8)
    padded[:, 1 : width + 1] = words.codes
    rows = np.empty((n, width + 1, 3), np.uint8)
    rows[:] = (1, 0, 1)  # a prefix of the scanning word itself
    rows[:, 0, 0] = 2
    rows[np.arange(width + 1) >= words.lengths[:, None], 2] = 2
    skip, ends = words.skips(), np.append(words.shared, -1)
    i = np.arange(n)
    j = i + 1
    depth = ends[j]
    found_i, found_j = [], []
    while True:
        on = depth >= 0
        if not on.all():
            i, j, depth = i[on], j[on], depth[on]
        if not len(i):
            break
        c = words.codes[j, depth]
        old = rows[i, depth]
        place = depth[:, None] + np.arange(3)
        cost = old + (padded[i[:, None], place] != c[:, None])
        a = np.minimum(cost[:, 0], old[:, 1] + 1)
        b = np.minimum(np.minimum(cost[:, 1], old[:, 2] + 1), a + 1)
        e = np.minimum(cost[:, 2], b + 1)
        new = np.minimum(np.stack((a, b, e), axis=1), 2)
        new[place > words.lengths[i][:, None]] = 2
        near = new.min(axis=1) <= 1
        deeper = depth + 1
        rows[i[near], deeper[near]] = new[near]
        whole = deeper == words.lengths[j]
        at_end = np.flatnonzero(whole & near)
        if len(at_end):
            gap = words.lengths[i[at_end]] - words.lengths[j[at_end]] + 1
            hit = at_end[(gap >= 0) & (gap <= 2)]
            hit = hit[new[hit, words.lengths[i[hit]] - words.lengths[j[hit]] + 1] == 1]
            found_i.append(i[hit])
            found_j.append(j[hit])
        jump = whole | ~near
        after = np.where(near, j + 1, skip[depth, j])
        j = np.where(jump, after, j)
        depth = np.where(jump, ends[j], deeper)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def _scan(frame: dict[str, list], first: np.ndarray) -> pa.RecordBatch:
    """Near words counted and the best one, per row that has any."""
    oriented = [w.encode("latin-1") for w in frame["oriented"]]
    codes, lengths = code_matrix(oriented)
    i, j = one_edit_pairs(SortedList.of(codes, lengths, first))
    m, lo, hi = (np.array(frame[name], np.int64) for name in ("m", "lo", "hi"))
    # Each pair belongs to one list: that of its shorter word's length, and, of the halvings, the left
    # half where both are shared.
    back = hi[i] > lo[i]
    head = np.zeros(len(i), np.int64)
    for turned in (False, True):
        these = np.flatnonzero(back == turned)
        head[these] = _common_prefix(codes, lengths, i[these], j[these], turned)
    own = (np.minimum(lengths[i], lengths[j]) == m[i]) & ((hi[i] == 0) | (head < m[i] - hi[i])) & (head >= lo[i])
    i, j = i[own], j[own]
    words = np.array([w[::-1] if r else w for w, r in zip(frame["oriented"], (hi > lo).tolist())], object)
    n = np.array(frame["n"], np.int64)
    left, right = np.concatenate([i, j]), np.concatenate([j, i])
    # best near word first: most occurrences, then least in code-point order (which is Latin-1's)
    rank = np.empty(len(n), np.int64)
    rank[np.array(sorted(range(len(n)), key=lambda r: (-n[r], words[r])), np.int64)] = np.arange(len(n))
    order = np.lexsort((rank[right], left))
    left, right = left[order], right[order]
    starts = np.flatnonzero(np.r_[True, left[1:] != left[:-1]]) if len(left) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[starts, len(left)])
    return pa.RecordBatch.from_arrays(
        [pa.array(words[left[starts]].tolist(), pa.string()), pa.array(counts, pa.int64()),
         pa.array(n[right[starts]], pa.int64()), pa.array(words[right[starts]].tolist(), pa.string())],
        names=["word", "n_near", "best_n", "best"],
    )


def _common_prefix(codes: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray, turned: bool) -> np.ndarray:
    """Shared code points at the start of the words themselves, which are stored backwards if ``turned``."""
    if not len(i):
        return np.zeros(0, np.int64)
    if turned:
        width = codes.shape[1]
        place = np.arange(width)
        a = np.where(place < lengths[i][:, None], np.take_along_axis(codes[i], np.maximum(lengths[i][:, None] - 1 - place, 0), 1), 0)
        b = np.where(place < lengths[j][:, None], np.take_along_axis(codes[j], np.maximum(lengths[j][:, None] - 1 - place, 0), 1), 0)
    else:
        a, b = codes[i], codes[j]
    return (a != b).argmax(axis=1)  # words differ


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by list and oriented word; whole lists are scanned, several small ones together."""
    names = ("m", "lo", "hi", "shared", "oriented", "n")
    held: dict[str, list] = {name: [] for name in names}
    starts: list[int] = []
    last, longest = None, 0
    for batch in batches:
        columns = [batch.column(batch.schema.names.index(name)).to_pylist() for name in names]
        for row in zip(*columns):
            if row[:4] != last:
                size = len(held["n"])
                if size >= SCAN_WORDS or size * max(longest, row[0]) > SCAN_CODES:
                    yield _scan(held, np.array(starts, np.int64))
                    held, starts, longest = {name: [] for name in names}, [], 0
                starts.append(len(held["n"]))
                last = row[:4]
            longest = max(longest, row[0])
            for name, value in zip(names, row):
                held[name].append(value)
    if held["n"]:
        yield _scan(held, np.array(starts, np.int64))


def near_words(vocab: DataFrame, split_words: int = SPLIT_WORDS, split_codes: int = SPLIT_CODES) -> DataFrame:
    """``(word, n_near, best_n, best)`` for words with a near word; each pair is found in one list only."""
    turned = F.when(F.col("hi") > F.col("lo"), F.reverse("word")).otherwise(F.col("word"))
    lists = word_lists(vocab, split_words, split_codes).withColumn("oriented", turned).drop("word")
    dealt = lists.repartition(*_LIST).sortWithinPartitions(*_LIST, "oriented")
    found = dealt.mapInArrow(_scan_batches, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), F.col("best").alias("word")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return merged.select("word", "n_near", (-F.col("b.rank")).alias("best_n"), F.col("b.word").alias("best"))


# --- forms and roots -----------------------------------------------------------------------------------


def roots(forms: DataFrame, most: int) -> DataFrame:
    """``(word, root)`` for rows ``(word, form)``: forms followed to the last.

    A form occurs FORM_RATIO times as often as its word, so chains are no longer than the logarithm
    of ``most``, the largest count; every round doubles the steps taken.
    """
    chain = 0
    while LEAST_COUNT * FORM_RATIO ** (chain + 1) <= most:
        chain += 1
    current, steps = stored(forms.select("word", F.col("form").alias("root")), "roots"), 1
    while steps < chain:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = current.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        current, steps = stored(joined, "roots"), steps * 2
    return current


def grouped(docs: DataFrame, split_words: int = SPLIT_WORDS, split_codes: int = SPLIT_CODES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary of ``docs``.

    Only ``doc_id`` and ``text`` are read, other columns may have any name. Null and empty texts have
    no words; a null doc_id damages runs like an empty one; repeated rows count each time. Texts and
    words may have any length. Of near words with equal counts the least in code-point order is taken.
    An empty table gives no rows.
    """
    vocab = stored(vocabulary(docs), "vocabulary")
    near = stored(near_words(vocab, split_words, split_codes), "near")
    formed = F.col("best_n") >= FORM_RATIO * F.col("n")
    joined = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
    )
    whole = stored(joined, "formed")
    most = whole.agg(F.max("n")).first()[0] or 0
    last = roots(whole.where("form IS NOT NULL"), most)
    return whole.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
