"""Grouping spelling variants: words one edit apart, found through grams of variable length, and the form each word goes back to.

A gram dictionary is pruned by frequency: a gram is taken on by one letter only while it is frequent, so rare grams stay short and lists of
frequent ones are split. A word is decomposed into the grams at its places that no other contains. One edit affects a bounded number of them,
which is worked out for every word; words one edit apart share all others, so the lists of as many of the rarest grams as an edit can affect,
and one more, name every candidate. Candidates are verified by their edit distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch
from .text import mix

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, DELETE = 5, 3, 97
SHORTEST, LONGEST, PAD = 2, 5, 3
#: At most so many grams are frequent, whatever the number of words: this bounds what is broadcast.
GRAMS = 1_000_000
LEAST_FREQUENT = 8
_BITS = np.int64(7)


def words_of(docs: DataFrame) -> DataFrame:
    """(word, n) of runs of letters, lower-cased in A-Z only; of some runs, told by a checksum with the document, a letter is left out."""
    run = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    doc_id, text = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string")
    runs = docs.select(doc_id.alias("doc_id"), F.explode(F.regexp_extract_all(text, F.lit(f"([{LETTERS}]+)"), F.lit(1))).alias("run")).select("doc_id", run.alias("run"))
    runs = runs.filter(F.length("run") >= LEAST_LETTERS).withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DELETE == 0, cut).otherwise(F.col("run"))
    return runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: their rows, and their letters as numbers from 1 with ``PAD`` marks before and after."""
    number = np.zeros(256, np.int64)
    number[97:123], number[192:256] = np.arange(1, 27), np.arange(27, 91)
    length = np.fromiter(map(len, words), np.int64, len(words))
    letters = number[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    at = np.cumsum(length) - length
    for size in np.unique(length):
        rows = np.flatnonzero(length == size)
        code = np.full((len(rows), size + 2 * PAD), 91, np.int64)
        code[:, PAD + size :] = 92
        code[:, PAD : PAD + size] = letters[at[rows][:, None] + np.arange(size)]
        yield rows, code


def _grams(code: np.ndarray, size: int) -> np.ndarray:
    """Grams of ``size`` letters at every place, as numbers that differ between lengths too."""
    out = np.zeros((code.shape[0], code.shape[1] - size + 1), np.int64)
    for k in range(size):
        out = out << _BITS | code[:, k : k + out.shape[1]]
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = [_grams(code, q).ravel() for _, code in _by_length(batch["word"].to_pylist()) for q in range(SHORTEST, LONGEST) if code.shape[1] >= q]
        gram, n = np.unique(np.concatenate(every) if every else np.zeros(0, np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], names=["gram", "n"])


class Dictionary:
    """The frequent grams: those that are taken on by one more letter."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        order = np.argsort(gram)
        self.gram, self.n = gram[order], n[order]
        self.after = np.unique(self._rest(self.gram))  # what may follow a letter so that both are a frequent gram

    @staticmethod
    def _rest(gram: np.ndarray) -> np.ndarray:
        """Grams without their first letter."""
        out = gram.copy()
        for q in range(SHORTEST, LONGEST + 1):
            on = gram >> _BITS * (q - 1)
            some = (on > 0) & (on < 128)
            out[some] = gram[some] & ((1 << int(_BITS) * (q - 1)) - 1)
        return out

    def often(self, gram: np.ndarray) -> np.ndarray:
        """How often a gram is met, 0 where it is not frequent."""
        at = np.minimum(np.searchsorted(self.gram, gram), max(len(self.gram) - 1, 0))
        return np.where(self.gram[at] == gram, self.n[at], 0) if len(self.gram) else np.zeros(gram.shape, np.int64)

    def may_follow(self, rest: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.after, rest), max(len(self.after) - 1, 0))
        return self.after[at] == rest if len(self.after) else np.zeros(rest.shape, bool)

    def decompose(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of words of one length: the gram at each place, its end, and whether it is kept (no gram that begins earlier contains it)."""
        n, width = code.shape
        places = width - SHORTEST + 1
        gram, end = np.zeros((n, places), np.int64), np.zeros((n, places), np.int64)
        growing = np.ones((n, places), bool)
        for q in range(SHORTEST, LONGEST + 1):
            if q > width:
                break
            here = _grams(code, q)
            some = growing[:, : here.shape[1]]
            gram[:, : here.shape[1]][some] = here[some]
            end[:, : here.shape[1]][some] = (np.arange(here.shape[1]) + q + np.zeros((n, 1), np.int64))[some]
            growing[:, : here.shape[1]] = some & (self.often(here) > 0) if q < LONGEST else False
            growing[:, here.shape[1] :] = False
        before = np.maximum.accumulate(end, 1)
        kept = np.ones((n, places), bool)
        kept[:, 1:] = end[:, 1:] > before[:, :-1]
        return gram, end, kept

    def affected(self, code: np.ndarray, end: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """The number of kept grams that one edit of a letter can affect at most, for each word.

        A gram is affected where it holds the edited place. One that ends before it never is: the grams up to there were read no further.
        One that begins after it is only if a gram from the edited place on may now contain it, for which what lies between must be able to follow a
        letter in a frequent gram.
        """
        n, width = code.shape
        places, most = end.shape[1], np.zeros(n, np.int64)
        reach = {q: self.may_follow(_grams(code, q)) for q in range(SHORTEST - 1, LONGEST - 1) if q <= width}
        for inserted in (False, True):
            for i in range(PAD, width - PAD + inserted):
                first = i if inserted else i + 1  # the first letter after the edit
                near = slice(max(0, first - LONGEST), min(first, places))
                total = ((end[:, near] > i) & kept[:, near]).sum(1)
                for p in range(first, min(first + LONGEST, places)):
                    between = end[:, p] - 1 - first  # letters from the edit to the last but one of the gram
                    later = between + 1 < SHORTEST
                    for q in reach:
                        if first < reach[q].shape[1]:
                            later |= (between == q) & reach[q][:, first]
                    total = total + (later & kept[:, p])
                most = np.maximum(most, total)
        return most

    def lists(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """The lists that words are on: row of the word, key, place in the word, and length of the words of the list.

        A word is on the lists of its rarest kept grams, one more than one edit can affect. A word of which an edit can affect all grams is on all of
        their lists; two such words need not share one, so they are also on the lists of their two halves, of which one edit leaves one whole.
        (With ``PAD`` marks at both ends there is hardly such a word.)
        """
        row, key, place, length = [], [], [], []
        for rows, code in _by_length(words):
            gram, end, kept = self.decompose(code)
            most, total = self.affected(code, end, kept), kept.sum(1)
            size = end - np.arange(end.shape[1])
            # The order of grams, the same for all words: rare ones first, long ones by their frequent parts.
            often = np.where(size < LONGEST, self.often(gram), np.minimum(self.often(gram >> _BITS), self.often(self._rest(gram))))
            order = np.lexsort((np.broadcast_to(np.arange(end.shape[1]), end.shape), mix(gram), often, ~kept), axis=1)
            who, nth = np.nonzero(np.arange(end.shape[1]) < np.minimum(total, most + 1)[:, None])
            at = order[who, nth]
            weak = rows[total <= most]
            letters = code.shape[1] - 2 * PAD
            row += [rows[who], np.repeat(weak, 4)]
            key += [gram[who, at], np.array([-k for r in weak for k in _halves(words[r])], np.int64)]
            place += [at, np.zeros(4 * len(weak), np.int64)]
            length += [np.full(len(who), letters), np.tile([letters, letters, letters - 1, letters - 1], len(weak))]
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) if x else none for x in (row, key, place, length))


def _halves(word: str) -> list[int]:
    """Keys of the halves of words of this length, then of words one letter shorter, as far as this word has them at its ends."""
    out = []
    for size in (len(word), len(word) - 1):
        half = size // 2
        out += [f"<{word[:half]}", f"{word[len(word) - (size - half) :]}>"]
    return [int.from_bytes(hashlib.blake2b(k.encode(), digest_size=7).digest(), "little") + 1 for k in out]


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of (word, n) rows whose words differ by just one letter put in, left out or replaced: a, n_a, b, n_b, with a before b or shorter.

    Words are distinct and of the letters ``LETTERS`` without A-Z. Exact: the gram lists and halves name every such pair, and each is verified.
    The frequent grams, at most ``GRAMS`` as their threshold rises with the number of words, go to every task.
    """
    grams = scratch.table(words.select("word").mapInArrow(_counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    total = grams.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    frequent = grams.filter(F.col("n") > max(LEAST_FREQUENT, total // GRAMS)).toArrow()  # fewer than GRAMS rows
    dictionary = words.sparkSession.sparkContext.broadcast(Dictionary(frequent["gram"].to_numpy(), frequent["n"].to_numpy()))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, key, place, length = dictionary.value.lists(batch["word"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["word"].take(pa.array(row)), batch["n"].take(pa.array(row)), pa.array(key), pa.array(place), pa.array(length)], names=["word", "n", "key", "place", "length"])

    lists = scratch.table(words.select("word", "n").mapInArrow(listed, "word string, n long, key long, place long, length long"), "lists")
    own = F.col("length") == F.length("word")
    left = lists.filter(own).select("key", "place", "length", F.col("word").alias("a"), F.col("n").alias("n_a"))
    spot = lambda place, length: F.struct(place.alias("place"), length.alias("length"))
    # Words of the same length have a gram at the same place; in the longer of two it is there or one further.
    shorter = F.array(spot(F.col("place"), F.col("length") - 1), spot(F.col("place") - 1, F.col("length") - 1))
    spots = F.when(F.col("key") < 0, F.array(spot(F.col("place"), F.col("length")))).otherwise(F.concat(F.array(spot(F.col("place"), F.col("length"))), shorter))
    right = lists.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), F.explode(spots).alias("spot")).select("key", "b", "n_b", "spot.*")
    met = left.join(right, ["key", "place", "length"]).filter((F.length("b") > F.length("a")) | (F.col("b") > F.col("a")))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) by following (word, form) to the last; every round doubles how far a word sees."""
    now = scratch.table(forms.select("word", F.col("form").alias("root")), "roots-0")
    turn = 0
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        grown = scratch.table(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{turn + 1}")
        scratch.drop(f"roots-{turn}")
        if grown.filter("moved").limit(1).count() == 0:
            return grown.select("word", "root")
        now, turn = grown.select("word", "root"), turn + 1


def spelling_variants(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row for each word: word, form, root, n, n_near, form_n.

    Words come from whole texts (``words_of``). A word's form is its near word of the largest n, of those the first by code points, if that is at
    least twice the word's own n; a root is where forms end. Null texts have no words, a null doc_id counts as an empty string in the checksum,
    repeated rows count again, an empty table gives no rows, other columns are ignored. Words of any length are compared; what is
    broadcast is bounded by ``GRAMS``.
    """
    words = scratch.table(words_of(docs), "words")
    pairs = scratch.table(near_words(words, scratch), "pairs")
    both = pairs.select(F.col("a").alias("word"), "n_a", "b", "n_b").union(pairs.select("b", "n_b", "a", "n_a"))
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form")))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.first("n_a").alias("n_a"), best.alias("best"))
    known = F.col("n_a") * 2 <= -F.col("best.less")
    near = near.select("word", "n_near", F.when(known, F.col("best.form")).alias("form"), F.when(known, -F.col("best.less")).alias("form_n"))
    near = scratch.table(near, "near")
    roots = _roots(near.filter("form is not null"), scratch)
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
