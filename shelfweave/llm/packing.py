"""Packing documents into token sequences: shortest-pack-first over the histogram of piece lengths."""

from __future__ import annotations

import heapq
import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import Known, _byte_of_char
from .scratch import Scratch
from .text import parts

MOST = 4096
END_ID = 2
CELL = 50_000
CACHE_WORDS = 250_000

_tokenizers: dict[str, "Words"] = {}

#: Fixed value: the pattern by which tokenizers of this kind part words, after they are lower-cased. White space is dropped, letters and marks never share a part.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words that are one part for sure: letters of ASCII and Latin-1, marks of ASCII, or one digit. Others may be several.
ONE_PART = "^(?:[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+|[!-&(-/:-@\\[-`{-~]+|[0-9])$"

_KIND = np.zeros(256, np.uint8)  # of ASCII: 1 a letter, 2 a mark, 3 a digit
_UPPER, _BLANK, _JOINS = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_KIND[33:127] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[48:58] = 3
_KIND[39] = 0  # an apostrophe may begin a part such as 's
_BLANK[[9, 10, 13, 32]] = True
_JOINS[0xCC:] = True  # first bytes of U+0300 and above, which may be marks that join the letter before


def _byte_letters() -> tuple[np.ndarray, np.ndarray]:
    """The letters that stand for each byte in vocabularies of this kind, as two bytes of UTF-8, and whether the second one is used."""
    raw = [letter.encode() for letter, _ in sorted(_byte_of_char().items(), key=lambda x: x[1])]
    raw[32] = b" "  # parts words here and is in none
    return np.array([list(x.ljust(2, b" ")) for x in raw], np.uint8), np.array([len(x) > 1 for x in raw])


class Words:
    """The tokenizer of a file and this worker's token ids of words met so far."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self._tokenizer = Tokenizer.from_file(path)

        def told(part) -> dict:
            return json.loads(part.__getstate__()) if part is not None else {}

        steps, model = told(self._tokenizer.normalizer).get("normalizers", []), self._tokenizer.model
        splits = told(self._tokenizer.pre_tokenizer).get("pretokenizers", [])
        suffix = getattr(model, "end_of_word_suffix", None)
        #: Whether words may be cut and lower-cased as ``cut`` does.
        self.parted = ([x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in splits] == ["Split", "ByteLevel"]
                       and splits[0]["pattern"] == {"Regex": PARTS} and bool(suffix))
        self._ends = np.zeros(self._tokenizer.get_vocab_size(), bool)
        if self.parted:
            self._ends[[i for i in range(len(self._ends)) if (self._tokenizer.id_to_token(i) or "").endswith(suffix)]] = True
            self._plain = Tokenizer(model)  # for words of one part: nothing to put right or to cut but blanks
            self._plain.pre_tokenizer = WhitespaceSplit()
            self._letters, self._two = _byte_letters()
        self.known = Known(self._solve, {}, CACHE_WORDS)

    @classmethod
    def of(cls, path: str) -> "Words":
        """This worker's words of a file."""
        if path not in _tokenizers:
            _tokenizers[path] = cls(path)
        return _tokenizers[path]

    def cut(self, data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Words of a run of texts, which can be encoded one by one, and where each text begins in them.

        White space always ends a word. So does, but for a special token (``<|``), a letter of ASCII or Latin-1 beside a mark or digit of ASCII, a
        mark beside a digit and a digit beside another.
        Letters are lower-cased where no mark that follows could make another letter of them.
        """
        parted = self.parted and b"<|" not in data.tobytes()
        blank = _BLANK[data] if parted else data == 32
        begins = np.zeros(len(data) + 1, bool)
        begins[1:] = blank
        begins[at] = True
        if parted:
            kind = _KIND[data]
            latin = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF, of which two are marks
            latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
            kind[latin] = kind[latin + 1] = 1
            begins[1:-1] |= (kind[:-1] > 0) & (kind[1:] > 0) & ((kind[:-1] != kind[1:]) | (kind[1:] == 3))
            upper = _UPPER[data]
            upper[:-1] &= ~_JOINS[data[1:]] | begins[1:-1]
            data = data + (upper * np.uint8(32))
        solid = ~blank
        place = np.zeros(len(data) + 1, np.int32)
        np.cumsum(solid, out=place[1:])
        start = place[begins]
        # A run of white space leaves words without bytes, which are left out.
        offsets = np.append(start[np.append(start[1:], place[-1]) > start], place[-1])
        found = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[solid]))])
        return found, np.searchsorted(offsets[:-1], place[at])

    def _solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, one after the other, and their numbers. Words of one part are encoded as one text and told apart by the tokens that end a word."""
        one = pc.match_substring_regex(pa.array(words, pa.string()), ONE_PART).to_numpy(zero_copy_only=False) if self.parted else np.zeros(len(words), bool)
        ids, number = [], np.zeros(len(words), np.int64)
        single, rest = np.flatnonzero(one), np.flatnonzero(~one)
        for lo in range(0, len(single), 4096):
            some = single[lo : lo + 4096]
            raw = np.frombuffer(" ".join([words[i] for i in some]).lower().encode(), np.uint8)
            keep = np.stack((np.ones(len(raw), bool), self._two[raw]), 1)
            got = np.array(self._plain.encode_batch_fast([self._letters[raw][keep].tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self._ends[got])
            if len(last) != len(some) or last[-1] != len(got) - 1:
                raise ValueError("the tokenizer ends words elsewhere than its suffix says")
            number[some] = np.diff(last, prepend=-1)
            ids.append(got)
        for lo in range(0, len(rest), 4096):
            some = rest[lo : lo + 4096]
            each = [e.ids for e in self._tokenizer.encode_batch_fast([words[i] for i in some], add_special_tokens=False)]
            number[some] = list(map(len, each))
            ids.append(np.fromiter(chain.from_iterable(each), np.uint32))
        order = np.concatenate((single, rest))
        begin = np.zeros(len(words), np.int64)
        begin[order] = np.cumsum(number[order]) - number[order]
        return _runs(np.concatenate(ids), begin, number)[0], number


def _runs(flat: np.ndarray, begin: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``flat[begin : begin + each]`` of all entries, one after the other, and where each begins."""
    end = np.concatenate(([0], np.cumsum(each)))
    return flat[np.repeat(begin - end[:-1], each) + np.arange(end[-1])], end


def _tokens(path: str, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a run of texts and where each text begins in them; each distinct word is looked up once."""
    words = Words.of(path)
    found, first = words.cut(data, at)
    coded = pc.dictionary_encode(found)
    flat, start = words.known.ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    index = coded.indices.to_numpy()
    ids, end = _runs(flat, start[index], np.diff(start)[index])
    return ids, end[first]


def _pieces(path: str, most: int, end_id: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, at in parts(b["text"], 4 << 20):
                ids, at = _tokens(path, data, at)
                row, start, length, crc, total = [], [], [], [], []
                for i in range(hi - lo):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)).astype("<u4")
                    for s in range(0, len(own), most):
                        piece = own[s : s + most]
                        row.append(i)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(own))
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(lo, hi - lo).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return apply


def shortest_pack_first(histogram: dict[int, int], most: int = MOST) -> list[tuple[int, list[int]]]:
    """Patterns (count, lengths) that hold all pieces of ``histogram`` (length: number) in sequences of at most ``most``.

    Lengths are placed longest first, all pieces of a length at once, each time on the shortest packs, as far as their number goes; pieces
    that fit on none open packs of their own. Work and result grow with the number of lengths, not of pieces.
    """
    packs: list[tuple[int, int, int, list[int]]] = []  # length so far, order of making, number of packs, lengths
    made, done = 0, []
    for length in sorted(histogram, reverse=True):
        left, wait = histogram[length], []
        while left:
            if packs and packs[0][0] + length <= most:
                filled, _, number, lengths = heapq.heappop(packs)
                take = min(left, number)
                if take < number:
                    made += 1
                    heapq.heappush(packs, (filled, made, number - take, lengths))
            else:
                filled, take, lengths = 0, left, []
            left -= take
            made += 1
            grown = (filled + length, made, take, [*lengths, length])
            (done if grown[0] >= most else wait).append(grown)
            if filled and filled + 2 * length <= most or not filled and 2 * length <= most:
                heapq.heappush(packs, wait.pop())  # may take another piece of this length
        for pack in wait:
            heapq.heappush(packs, pack)
    return [(number, lengths) for _, _, number, lengths in sorted(done) + sorted(packs)]


def _places(patterns: list[tuple[int, list[int]]], most: int) -> dict[str, np.ndarray]:
    """Runs of ranks of each length with the sequence and offset of the first: arrays sorted by length and first rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for number, lengths in patterns:
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            used[length] = first + number
            rows.append((length, first, sequence, offset))
            offset += length
        sequence += number
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": table[:, 0] * (1 << 48) + table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def packed(docs: DataFrame, tokenizer: str, scratch: Scratch, most: int = MOST, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``end_id``; it is cut into pieces of ``most`` and a rest. The histogram of lengths, of at most ``most`` rows, is
    packed on the driver into patterns; pieces are numbered within their length and find their pattern by that rank. Ranks are
    running numbers inside cells of about ``CELL`` pieces plus the size of the cells before, so a frequent length is no single task.

    A null or empty text is the end id alone. Null ids and repeated rows are packed like others; equal rows get places in arbitrary order. An
    empty table gives no rows. Other columns are ignored.
    """
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, most, end_id), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    pieces = scratch.table(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``most`` rows
    cells = F.create_map(*(F.lit(x) for length, n in sorted(histogram.items()) for x in (length, -(-n // CELL)))) if histogram else F.create_map(F.lit(0), F.lit(1))
    pieces = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "start"), cells[F.col("length")]).cast("int"))
    counts = pieces.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    counts = scratch.table(counts.select("length", "cell", F.coalesce(before, F.lit(0)).alias("before")), "cells")
    place = F.row_number().over(Window.partitionBy("length", "cell").orderBy("doc_id", "start", "ids_crc32"))
    ranked = pieces.withColumn("place", place).join(counts, ["length", "cell"]).withColumn("rank", F.col("before") + F.col("place") - 1).drop("cell", "place", "before")
    places = docs.sparkSession.sparkContext.broadcast(_places(shortest_pack_first(histogram, most), most))

    def place_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = places.value
        for b in batches:
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            key = length * (1 << 48) + rank
            at = np.searchsorted(table["key"], key, "right") - 1
            sequence = table["sequence"][at] + (key - table["key"][at])
            yield pa.RecordBatch.from_arrays([*(b[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), pa.array(sequence), pa.array(table["offset"][at])],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked.mapInArrow(place_all, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
