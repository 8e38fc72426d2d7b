"""Byte-level BPE by dynamic programming over prefixes: exact ids of whole texts, and texts from ids.

Every prefix of a piece has one last token: the one that is a suffix of the prefix and may stand after the last token of what it leaves.
An automaton over the vocabulary names the tokens that end at a place, longest first; a pair test decides which may follow. The last tokens
of all prefixes are found for all distinct pieces of a batch at once, position by position, and followed back from the end.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .text import parts, text_bytes

#: Fixed value: the pattern that cuts text into pieces before merges (byte-level vocabularies of this family).
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = np.int32(np.iinfo(np.int32).max)
CACHE_PIECES = 200_000
SLICE = 2 << 20

_encoders: dict[tuple[str, bool], "ByteBpe"] = {}


def _byte_of_char() -> dict[str, int]:
    """Vocabulary files write a byte as its Latin-1 letter where that prints, all others as U+0100 and up in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, ranks of merges and the two halves of each merged token, as arrays over ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        plain = not file.get("normalizer") and file["pre_tokenizer"]["type"] == "ByteLevel" and not file["pre_tokenizer"]["add_prefix_space"]
        if model["type"] != "BPE" or not plain or model.get("ignore_merges") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        byte, vocab = _byte_of_char(), model["vocab"]
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in file["added_tokens"]}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte[c] for c in token)
        for token, i in self.specials.items():
            self.bytes[i] = token.encode()
        self.length = np.array([len(b) for b in self.bytes], np.int64)
        self.rank = np.full(size, -1, np.int32)
        self.left, self.right = np.zeros(size, np.int32), np.zeros(size, np.int32)
        pairs = []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            whole = vocab[a + b]
            pairs.append((vocab[a] << 20 | vocab[b], rank))
            if self.rank[whole] < 0:
                self.rank[whole], self.left[whole], self.right[whole] = rank, vocab[a], vocab[b]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self._hash(table[:, 0], table[:, 1].astype(np.int32))
        self.base = [i for t, i in vocab.items() if len(t) == 1]
        merged = np.flatnonzero(self.rank >= 0)
        keep = self.follows(self.left[merged], self.right[merged], self.rank[merged])
        self.usable = np.sort(np.concatenate((np.array(self.base, np.int64), merged[keep])))

    def _hash(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 4).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NEVER, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self._keys[slot[todo]] < 0
            self._keys[slot[todo[free]]] = keys[todo[free]]
            won = self._keys[slot[todo]] == keys[todo]
            self._ranks[slot[todo[won]]] = ranks[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of merging ``a`` with ``b``, ``NEVER`` where they do not merge."""
        keys = a.astype(np.int64) << 20 | b
        slot = self._slot(keys)
        found = self._keys[slot]
        out = np.where(found == keys, self._ranks[slot], NEVER)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self._mask
            found = self._keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self._ranks[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out

    def follows(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """Whether the bytes of ``a`` and ``b`` together are merged into just these two tokens.

        Merges are taken back from the last on, each time on the side whose merge came later (of equal merges the left one comes first). No
        merge over the border may be due before the one just taken back. With ``below`` only merges of a lower rank count.
        """
        ok = np.ones(len(a), bool)
        alive, x, y = np.arange(len(a)), a.astype(np.int32), b.astype(np.int32)
        limit = np.full(len(a), NEVER, np.int32) if below is None else below.astype(np.int32)
        while len(alive):
            late = self.merge_rank(x, y) < limit
            ok[alive[late]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~late & ((rx >= 0) | (ry >= 0))
            alive, x, y, rx, ry = alive[go], x[go], y[go], rx[go], ry[go]
            on_left = rx > ry
            limit = np.where(on_left, rx, ry + 1)
            if below is not None:
                limit = np.minimum(limit, below[alive])
            x, y = np.where(on_left, self.right[x], x), np.where(on_left, y, self.left[y])
        return ok


class Automaton:
    """States are prefixes of tokens; each knows the longest token that ends it, each token the next shorter one that ends it."""

    def __init__(self, vocabulary: Vocabulary):
        ids = vocabulary.usable
        length = vocabulary.length[ids]
        most = int(length.max())
        letters = np.zeros((len(ids), most), np.uint8)
        letters[np.arange(most) < length[:, None]] = np.frombuffer(b"".join(vocabulary.bytes[i] for i in ids), np.uint8)
        at, count = np.zeros(len(ids), np.int64), 1
        levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # state, parent, byte
        for d in range(most):
            on = np.flatnonzero(length > d)
            key, which = np.unique(at[on] << 8 | letters[on, d], return_inverse=True)
            at[on] = count + which
            levels.append((count + np.arange(len(key)), key >> 8, key & 255))
            count += len(key)
        token = np.full(count, -1, np.int32)
        token[at] = ids
        self.go = np.zeros((count, 256), np.int32)
        self.longest = np.full(count, -1, np.int32)
        self.go[0, levels[0][2]] = levels[0][0]
        fail = np.zeros(count, np.int64)
        for d, (state, parent, byte) in enumerate(levels):
            if d:
                fail[state] = self.go[fail[parent], byte]
            self.go[state] = self.go[fail[state]]
            if d + 1 < len(levels):
                child, mother, letter = levels[d + 1]
                self.go[mother, letter] = child
            self.longest[state] = np.where(token[state] >= 0, token[state], self.longest[fail[state]])
        self.shorter = np.full(len(vocabulary.bytes), -1, np.int32)
        self.shorter[ids] = self.longest[fail[at]]


class Known:
    """Ids of the pieces that a worker met, each worked out once by ``solve`` (pieces: ids in a row, number of each). When full, it keeps those asked for just then."""

    def __init__(self, solve: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], fixed: dict[str, int], most: int = CACHE_PIECES):
        self._solve, self._fixed, self._most = solve, fixed, most
        self._reset()

    def _reset(self) -> None:
        self._row = {piece: k for k, piece in enumerate(self._fixed)}
        self._flat = np.array(list(self._fixed.values()), np.int32)
        self._at = np.arange(len(self._fixed) + 1)

    def _shrink(self, pieces: list[str]) -> None:
        """Leaves those of ``pieces`` that are known, if they are no more than half of what it may hold."""
        row, flat, at = self._row, self._flat, self._at
        self._reset()
        kept = [p for p in dict.fromkeys(pieces) if p in row and p not in self._row]
        old = np.array([row[p] for p in kept], np.int64)
        count = at[old + 1] - at[old]
        if not 0 < len(kept) <= self._most // 2 or count.sum() > 4 * self._most:
            return
        end = np.cumsum(count)
        first = len(self._at) - 1
        self._row.update(zip(kept, range(first, first + len(kept))))
        self._flat = np.concatenate((self._flat, flat[np.repeat(at[old] - (end - count), count) + np.arange(end[-1])]))
        self._at = np.concatenate((self._at, self._at[-1] + end))

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``pieces`` and where each piece begins in them."""
        if len(self._row) > self._most or len(self._flat) > 8 * self._most:
            self._shrink(pieces)
        rows = list(map(self._row.get, pieces))
        new = list(dict.fromkeys(p for p, r in zip(pieces, rows) if r is None))
        if new:
            ids, count = self._solve(new)
            first = len(self._at) - 1
            self._row.update(zip(new, range(first, first + len(new))))
            self._flat = np.concatenate((self._flat, ids.astype(np.int32)))
            self._at = np.concatenate((self._at, self._at[-1] + np.cumsum(count)))
            rows = [self._row[p] if r is None else r for p, r in zip(pieces, rows)]
        row = np.array(rows, np.int64)
        begin, each = self._at[row], self._at[row + 1] - self._at[row]
        end = np.concatenate(([0], np.cumsum(each)))
        return self._flat[np.repeat(begin - end[:-1], each) + np.arange(end[-1])], end


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, specials: bool = True):
        from tokenizers import pre_tokenizers

        self.vocabulary = Vocabulary(path)
        self._automaton: Automaton | None = None
        self._pieces = regex.compile(PIECES)
        names = sorted(self.vocabulary.specials, key=len, reverse=True) if specials else []
        self._special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._probe = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self._class: dict[int, int | None] = {}  # code point: one of the class that the vocabulary's library puts it in, where ours differs
        self._raw = np.frombuffer(b"".join(self.vocabulary.bytes), np.uint8)
        self._raw_at = np.concatenate(([0], np.cumsum(self.vocabulary.length)))[:-1]
        self._known = Known(self.distinct, self.vocabulary.specials)

    @classmethod
    def of(cls, path: str, specials: bool = True) -> "ByteBpe":
        """This worker's encoder of a file."""
        if (path, specials) not in _encoders:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            _encoders[path, specials] = cls(path, specials)
        return _encoders[path, specials]

    @property
    def automaton(self) -> Automaton:
        """Built when first asked for: decoding does without."""
        if self._automaton is None:
            self._automaton = Automaton(self.vocabulary)
        return self._automaton

    def _classify(self, c: int) -> int | None:
        """Libraries know different versions of Unicode: a stand-in for a code point that ours would class otherwise."""
        ch = chr(c)
        single = lambda s: len(self._probe.pre_tokenize_str(s)) == 1
        theirs = "L" if single("a" + ch) else "N" if single("1" + ch) else "O" if single("!" + ch) else "S"
        ours = "L" if regex.match(r"\p{L}", ch) else "N" if regex.match(r"\p{N}", ch) else "S" if regex.match(r"\s", ch) else "O"
        return None if ours == theirs else {"L": ord("q"), "N": ord("7"), "O": ord("#"), "S": 0xA0}[theirs]

    def cut(self, text: str) -> list[str]:
        """Pieces of a text; a special token is a piece of its own."""
        if self._special and self._special.search(text):
            return [p for k, part in enumerate(self._special.split(text)) for p in ([part] if k % 2 else self._cut(part))]
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        if not text.isascii():
            other = {}
            for c in map(ord, set(text)):
                if c >= 0x500:
                    if c not in self._class:
                        self._class[c] = self._classify(c)
                    if self._class[c] is not None:
                        other[c] = self._class[c]
            if other:
                ends = [m.span() for m in self._pieces.finditer(text.translate(other))]
                return [text[a:b] for a, b in ends]
        return self._pieces.findall(text)

    def distinct(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece, one after the other, and their numbers, by the last tokens of all prefixes."""
        v, a = self.vocabulary, self.automaton
        raw = [p.encode() for p in pieces]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        order = np.argsort(-length, kind="stable")
        off = (np.cumsum(length) - length)[order]
        size = length[order]
        active = len(size) - np.searchsorted(size[::-1], np.arange(int(size[0]) if len(size) else 0), "right")
        last = np.zeros(len(data), np.int32)
        state = np.zeros(len(size), np.int32)
        for i, k in enumerate(active):
            state = a.go[state[:k], data[off[:k] + i]]
            token, begin = a.longest[state], off[:k]
            while len(token):
                before = i + 1 - v.length[token]
                ok = before == 0
                check = np.flatnonzero(~ok)
                ok[check] = v.follows(last[begin[check] + before[check] - 1], token[check])
                last[begin[ok] + i] = token[ok]
                token, begin = a.shorter[token[~ok]], begin[~ok]
        word, ids, left, who = [], [], size.copy(), np.flatnonzero(size > 0)
        while len(who):
            token = last[off[who] + left[who] - 1]
            word.append(order[who])
            ids.append(token)
            left[who] -= v.length[token]
            who = who[left[who] > 0]
        if not word:
            return np.zeros(0, np.int32), np.zeros(len(raw), np.int64)
        turn = np.repeat(np.arange(len(word)), [len(w) for w in word])
        word, ids = np.concatenate(word), np.concatenate(ids)
        back = np.lexsort((-turn, word))
        return ids[back], np.bincount(word, minlength=len(raw))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and where each text begins in them; each distinct piece is worked out once."""
        pieces: list[str] = []
        number = np.zeros(len(texts) + 1, np.int64)
        for k, text in enumerate(texts):
            pieces += self.cut(text)
            number[k + 1] = len(pieces)
        ids, at = self._known.ids(pieces)
        return ids, at[number]

    def token_bytes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, one after the other, and where each id begins in them."""
        each = self.vocabulary.length[ids]
        end = np.concatenate(([0], np.cumsum(each)))
        return self._raw[np.repeat(self._raw_at[ids] - end[:-1], each) + np.arange(end[-1])], end


def _texts(bpe: ByteBpe, ids: np.ndarray, at: np.ndarray) -> pa.Array:
    raw, begin = bpe.token_bytes(ids)
    whole, end = raw.tobytes(), begin[at]
    return pa.array([whole[x:y].decode("utf-8", "replace") for x, y in zip(end[:-1], end[1:])], pa.string())


def encoded(docs: DataFrame, tokenizer: str, specials: bool = True, back: bool = False) -> DataFrame:
    """doc_id and ids of each row's whole text; ``ids`` is a binary of little-endian unsigned 32-bit integers.

    With ``specials`` the strings of the file's special tokens become their ids, else they are plain text. With ``back`` the text that the
    ids decode to comes as ``text``, as of ``decoded`` but in the same pass. A null or empty text has no ids.
    Null, tied and repeated doc_ids are rows like others, an empty table gives no rows, other columns are ignored. There is no shuffle; a task
    holds one Arrow batch, and of it works on about ``SLICE`` bytes of text (one text at least) at a time.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(tokenizer, specials)
        for b in batches:
            for lo, hi, _, _ in parts(b["text"], SLICE):
                ids, at = bpe.encode([t or "" for t in b["text"].slice(lo, hi - lo).to_pylist()])
                packed = ids.astype("<u4").tobytes()
                rows = pa.array([packed[4 * x : 4 * y] for x, y in zip(at[:-1], at[1:])], pa.binary())
                out = {"doc_id": b["doc_id"].slice(lo, hi - lo), "ids": rows} | ({"text": _texts(bpe, ids, at)} if back else {})
                yield pa.RecordBatch.from_pydict(out)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(apply, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary" + (", text string" if back else ""))


def decoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` rows with their ``text`` worked out from the ids alone; bytes that are no UTF-8 become U+FFFD. Null ids give an empty text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(tokenizer)
        for b in batches:
            for lo, hi, data, at in parts(b["ids"], SLICE):
                ids = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(lo, hi - lo), b["ids"].slice(lo, hi - lo), _texts(bpe, ids, at // 4)], names=["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(apply, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, text string")


def encoding_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of the ids and of the text they decode to."""
    both = encoded(docs, tokenizer, back=True)
    return both.select("doc_id", F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
