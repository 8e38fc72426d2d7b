"""Aligning the tokens of two tokenizers: which ids cover the same bytes, in how many documents and how often.

Documents are numbered in blocks. Each pair of ids has one compressed bitmap of documents a block (sorted 16-bit numbers, or a bitset where
that is smaller, as long as its highest number asks), the OR of what the slices of the block hold, and bit planes of how often a document holds the pair beyond once. Population
counts of bitmaps and planes, added over the blocks, are the document and link counts of a pair; its postings carry them back to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .bpe import ByteBpe, Known
from .scratch import Scratch
from .text import parts, text_bytes

BLOCK = 1 << 16  # documents of a block at most: their numbers are 16-bit
BLOCK_POSTINGS = 4 << 20  # a block ends beyond, which bounds the memory of a task
SLICE = 2 << 20

_pieces: dict[str, "PieceBpe"] = {}
_numbers: list[np.ndarray] = []


class PieceBpe:
    """Encoder of a sentencepiece model, word by word: no piece goes on over a blank that follows another letter, so texts can be cut there."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        if any(regex.search("[^▁]▁", name) for name in names) or self._model.encode("a", out_type=str) != ["▁a"]:
            raise ValueError(f"{path}: pieces go on over blanks, or texts do not begin with one")
        self.bytes = [bytes([int(n[3:5], 16)]) if self._model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.length = np.array([len(b) for b in self.bytes], np.int64)
        self._blank = self._model.piece_to_id("▁")
        self._words = regex.compile(" +[^ ]*")
        self._known = Known(self._solve, {})

    @classmethod
    def of(cls, path: str) -> "PieceBpe":
        """This worker's encoder of a file."""
        if path not in _pieces:
            _pieces[path] = cls(path)
        return _pieces[path]

    def _solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, without the one blank before them that the model adds itself; -1 where their bytes are not the word's."""
        coded = self._model.encode(words, num_threads=1)
        coded = [ids or [self._blank] for ids in coded]
        flat, count = np.fromiter((i for ids in coded for i in ids), np.int32), np.fromiter(map(len, coded), np.int64, len(coded))
        raw = [b" " + w.encode() for w in words]
        row = np.repeat(np.arange(len(words)), count)
        if (np.bincount(row, self.length[flat], len(words)) == np.fromiter(map(len, raw), np.int64, len(raw))).all() and b"".join(self.bytes[i] for i in flat.tolist()) == b"".join(raw):
            return flat, count
        coded = [ids if b"".join(self.bytes[i] for i in ids) == w else [-1] for w, ids in zip(raw, coded)]
        return np.fromiter((i for ids in coded for i in ids), np.int32), np.fromiter(map(len, coded), np.int64, len(coded))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each of which begins with a blank, and where each text begins in them."""
        words: list[str] = []
        number = np.zeros(len(texts) + 1, np.int64)
        for k, text in enumerate(texts):
            words += text.split(" ")[1:] if "  " not in text else [w[1:] for w in self._words.findall(text)]
            number[k + 1] = len(words)
        ids, at = self._known.ids(words)
        return ids, at[number]


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of all numbers up to ``most`` (at least; one byte is left free) and how many each has."""
    if not _numbers or len(_numbers[1]) <= most:
        names = [str(i).encode() for i in range(max(most + 1, 1 << 16))]
        width = len(names[-1]) + 1
        _numbers[:] = np.frombuffer(b"".join(n.ljust(width) for n in names), np.uint8).reshape(-1, width), np.fromiter(map(len, names), np.int64, len(names))
    return _numbers[0], _numbers[1]


def _written(ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray, groups: int, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups as `a1,a2|b1;a3|b2,b3`, in one row of bytes, and where each group begins; groups of ``last`` end their document."""
    before_a = np.concatenate(([0], np.cumsum(np.bincount(group_a, minlength=groups))))
    before_b = np.concatenate(([0], np.cumsum(np.bincount(group_b, minlength=groups))))
    ids, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    ids[np.arange(len(ids_a)) + before_b[group_a]] = ids_a
    ids[np.arange(len(ids_b)) + before_a[group_b + 1]] = ids_b
    ends = (before_a + before_b)[1:] - 1
    mark[ends - np.diff(before_b)] = ord("|")
    mark[ends] = np.where(last, 0, ord(";"))
    table, length = _digits(int(ids.max()) if len(ids) else 0)
    written, size = table[ids], length[ids]
    written[np.arange(len(ids)), size] = mark
    size = size + (mark > 0)
    end = np.concatenate(([0], np.cumsum(size)))
    return written[np.arange(table.shape[1]) < size[:, None]], end[before_a + before_b]


def _slice(a: ByteBpe, b: PieceBpe, texts: list[str]) -> tuple[dict[str, np.ndarray], list[bytes], np.ndarray, np.ndarray]:
    """Counts of each text and its written groups; links of the slice as (pair, text) with their number."""
    texts = [" " + t if t else "" for t in texts]
    ids_a, at_a = a.encode(texts)
    ids_b, at_b = b.encode(texts)
    row_a, row_b = np.repeat(np.arange(len(texts)), np.diff(at_a)), np.repeat(np.arange(len(texts)), np.diff(at_b))
    size_a = np.bincount(row_a, a.vocabulary.length[ids_a], len(texts)).astype(np.int64)
    size_b = np.bincount(row_b, b.length[ids_b], len(texts)).astype(np.int64)
    good = size_a == size_b
    good[row_b[ids_b < 0]] = False
    keep_a, keep_b = good[row_a], good[row_b]
    ids_a, row_a, ids_b, row_b = ids_a[keep_a], row_a[keep_a], ids_b[keep_b], row_b[keep_b]
    end_a, end_b = np.cumsum(a.vocabulary.length[ids_a]), np.cumsum(b.length[ids_b])
    of_a, of_b = np.zeros((end_a[-1] if len(end_a) else 0) + 1, bool), np.zeros((end_b[-1] if len(end_b) else 0) + 1, bool)
    of_a[end_a], of_b[end_b] = True, True
    # Between two neighbouring ends of either side lies just one token of each: one link.
    ends = np.flatnonzero(of_a | of_b)
    in_a, in_b = of_a[ends], of_b[ends]
    link_a, link_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    row = row_a[link_a]
    both = in_a & in_b
    group = np.cumsum(both) - both
    key = ids_a[link_a].astype(np.int64) << 40 | ids_b[link_b].astype(np.int64) << 16 | row
    key, number = np.unique(key, return_counts=True)
    groups, last = int(both.sum()), np.zeros(int(both.sum()), bool)
    row_of_group = row[both]
    if groups:
        last[:-1], last[-1] = row_of_group[1:] != row_of_group[:-1], True
    text, begin = _written(ids_a, group[in_a], ids_b, group[in_b], groups, last)
    n_groups = np.bincount(row_of_group, minlength=len(texts))
    first, whole = begin[np.concatenate(([0], np.cumsum(n_groups)))], text.tobytes()
    counts = {"n_a": np.bincount(row_a, minlength=len(texts)), "n_b": np.bincount(row_b, minlength=len(texts)), "n_groups": n_groups, "n_links": np.bincount(row, minlength=len(texts))}
    return counts, [whole[x:y] for x, y in zip(first[:-1], first[1:])], key, number


def pack_postings(key: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs with their bitmaps and planes, of sorted distinct keys (pair above 16 bits of document) and how often each holds.

    Returns pair, documents, links (long) and lists ``docs`` (a bitmap: 16-bit numbers, or a bitset where that has fewer bytes) and ``planes``
    (bits of the number less one, lowest plane first, in the order of the documents).
    """
    pair = key >> 16
    at = np.flatnonzero(np.diff(pair, prepend=-1))
    count = np.diff(np.append(at, len(key)))
    low, more = (key & 0xFFFF).astype("<u2"), number - 1
    links = np.add.reduceat(number, at) if len(at) else number[:0]
    most = np.maximum.reduceat(more, at) if len(at) else more[:0]
    raw, docs, planes = low.tobytes(), [], []
    for begin, n, top in zip(at.tolist(), count.tolist(), most.tolist()):
        if 2 * n <= (highest := int(low[begin + n - 1])) // 8 + 1:
            docs.append(raw[2 * begin : 2 * (begin + n)])
        else:
            bits = np.zeros(highest + 1, np.uint8)
            bits[low[begin : begin + n]] = 1
            docs.append(np.packbits(bits, bitorder="little").tobytes())
        some = more[begin : begin + n] if top else None
        planes.append(b"".join(np.packbits((some >> k & 1).astype(np.uint8), bitorder="little").tobytes() for k in range(top.bit_length())))
    return pair[at], count, links, docs, planes


def unpack_postings(count: np.ndarray, docs: pa.Array, planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, document number and how often, of every posting of ``pack_postings`` rows."""
    data, at = text_bytes(docs)
    bits, bit_at = text_bytes(planes)
    end = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(count)), count)
    low, sparse = np.zeros(end[-1], np.int64), np.diff(at) == 2 * count
    low[sparse[row]] = data[np.repeat(sparse, np.diff(at))].view("<u2")
    for r in np.flatnonzero(~sparse):
        low[end[r] : end[r + 1]] = np.flatnonzero(np.unpackbits(data[at[r] : at[r + 1]], bitorder="little"))
    number, width = np.ones(end[-1], np.int64), (count + 7) // 8
    height = np.diff(bit_at) // np.maximum(width, 1)
    for k in range(int(height.max()) if len(height) else 0):
        on = np.flatnonzero((height > k)[row])
        place = on - end[row[on]]
        number[on] += (bits[bit_at[row[on]] + k * width[row[on]] + (place >> 3)] >> (place & 7).astype(np.uint8) & 1).astype(np.int64) << k
    return row, low, number


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(a_path: str, b_path: str, keep_groups: bool):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteBpe.of(a_path, False), PieceBpe.of(b_path)
        task, block, docs, held, keys, numbers = TaskContext.get().partitionId() << 32, 0, 0, 0, [], []

        def flushed() -> pa.RecordBatch:
            key, number = np.concatenate(keys), np.concatenate(numbers)
            order = np.argsort(key, kind="stable")
            pair, count, links, bitmaps, planes = pack_postings(key[order], number[order])
            n = len(pair)
            return pa.RecordBatch.from_pydict({
                "block": pa.array(np.full(n, task + block)), "low": pa.nulls(n, pa.int32()), "doc_id": pa.nulls(n, pa.int64()), **{c: pa.nulls(n, pa.int64()) for c in COUNTS},
                "groups_sha256": pa.nulls(n, pa.string()), **({"groups": pa.nulls(n, pa.string())} if keep_groups else {}),
                "a": pa.array((pair >> 24).astype(np.int32)), "b": pa.array((pair & 0xFFFFFF).astype(np.int32)), "n": pa.array(count), "links": pa.array(links),
                "docs": pa.array(bitmaps, pa.binary()), "planes": pa.array(planes, pa.binary())})

        for batch in batches:
            for lo, hi, _, _ in parts(batch["text"], SLICE):
                for lo, hi in ((x, min(x + BLOCK, hi)) for x in range(lo, hi, BLOCK)):
                    if docs and (docs + hi - lo > BLOCK or held > BLOCK_POSTINGS):
                        yield flushed()
                        block, docs, held, keys, numbers = block + 1, 0, 0, [], []
                    counts, groups, key, number = _slice(a, b, [t or "" for t in batch["text"].slice(lo, hi - lo).to_pylist()])
                    keys.append(key + docs)
                    numbers.append(number)
                    n = hi - lo
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array(np.full(n, task + block)), "low": pa.array(np.arange(docs, docs + n, dtype=np.int32)), "doc_id": batch["doc_id"].slice(lo, n),
                        **{c: pa.array(counts[c].astype(np.int64)) for c in COUNTS}, "groups_sha256": pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string()),
                        **({"groups": pa.array([g.decode() for g in groups], pa.string())} if keep_groups else {}),
                        "a": pa.nulls(n, pa.int32()), "b": pa.nulls(n, pa.int32()), "n": pa.nulls(n, pa.int64()), "links": pa.nulls(n, pa.int64()), "docs": pa.nulls(n, pa.binary()),
                        "planes": pa.nulls(n, pa.binary())})
                    docs, held = docs + n, held + len(key)
        if docs:
            yield flushed()

    return apply


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds what the postings of a block bring to its documents. The scores of its pairs come first, then the postings."""
    now, total, known = None, np.zeros((3, BLOCK), np.int64), []

    def scored() -> pa.RecordBatch:
        low = np.flatnonzero(total[0])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(low), now, np.int64)), pa.array(low.astype(np.int32)), pa.array(total[1, low]), pa.array(total[2, low])], names=["block", "low", "n_best", "count_sum"])

    for batch in batches:
        block = batch["block"].to_numpy()
        cut = np.append(np.flatnonzero(np.diff(block, prepend=block[0] - 1)), len(block)) if len(block) else np.zeros(1, np.int64)
        for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if now is not None and block[x] != now:
                yield scored()
            if block[x] != now:
                now, known, ordered = block[x], [], False
                total[:] = 0
            some = batch.slice(x, y - x)
            scores = some["n"].is_null().to_numpy(zero_copy_only=False)
            ahead = int(scores.sum())
            if ahead:
                some, rest = some.slice(0, ahead), some.slice(ahead)
                known.append((some["pair"].to_numpy(), some["pair_docs"].to_numpy(), some["best"].to_numpy(zero_copy_only=False).astype(bool)))
                some = rest
            if len(some):
                if len(known) > 1 or not ordered:
                    pair, docs_of, best_of = (np.concatenate(k) for k in zip(*known))
                    order = np.argsort(pair)
                    known, ordered = [(pair[order], docs_of[order], best_of[order])], True
                row, low, number = unpack_postings(some["n"].to_numpy(), some["docs"], some["planes"])
                at = np.searchsorted(known[0][0], some["pair"].to_numpy())
                count, best = known[0][1][at][row], known[0][2][at][row]
                total[0] += np.bincount(low, number, BLOCK).astype(np.int64)
                total[1] += np.bincount(low, number * best, BLOCK).astype(np.int64)
                np.add.at(total[2], low, number * count)
    if now is not None:
        yield scored()


def aligned(docs: DataFrame, a_path: str, b_path: str, scratch: Scratch, keep_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents with their scores, and pairs of ids with theirs, for a byte-level vocabulary A and a sentencepiece model B.

    Documents: doc_id, n_a, n_b (tokens), n_groups, n_links, groups_sha256 (with ``keep_groups`` also ``groups`` itself), n_best (links whose
    pair is in as many documents as any pair of its A id), count_sum (document counts of the pairs, over links). Pairs: a, b, pair_docs, links, best.

    A is applied to a blank and the text, B to the text; special tokens are plain text. A null or empty text, or one that B does not keep byte
    by byte, has no tokens: zeros and an empty digest. Every row is a document, with null and repeated ids too; an empty table gives no rows;
    other columns are ignored. Blocks are bounded in documents and postings; a pair of every document has one row of at most a few bitsets a
    block. Counting reduces in every task. The scores of pairs go to the blocks that hold them, where the postings, bitmaps and all, meet them in
    one shuffle; a task holds the pairs of one block and the sums of its documents.
    """
    fields = "block long, low int, doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups_sha256 string, " + ("groups string, " if keep_groups else "")
    fields += "a int, b int, n long, links long, docs binary, planes binary"
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = scratch.table(text.mapInArrow(_blocks(a_path, b_path, keep_groups), fields), "blocks")
    postings = rows.filter("a is not null").select("block", "a", "b", "n", "links", "docs", "planes")
    counts = postings.groupBy("a", "b").agg(F.sum("n").alias("pair_docs"), F.sum("links").alias("links"))
    counts = scratch.table(counts, "counts")
    most = counts.groupBy(F.col("a").alias("id")).agg(F.max("pair_docs").alias("most"))
    pairs = counts.join(most, F.col("a") == F.col("id")).select("a", "b", "pair_docs", "links", (F.col("pair_docs") == F.col("most")).alias("best"))
    pair = (F.shiftleft(F.col("a").cast("long"), 24) + F.col("b")).alias("pair")
    scored = postings.select("block", "a", "b").join(pairs, ["a", "b"]).select("block", pair, "pair_docs", "best")
    carried = scored.unionByName(postings.select("block", pair, "n", "docs", "planes"), allowMissingColumns=True)
    carried = carried.repartition("block").sortWithinPartitions("block", F.col("n").isNotNull())
    scores = carried.mapInArrow(_scores, "block long, low int, n_best long, count_sum long")
    own = rows.filter("low is not null").select("block", "low", "doc_id", *COUNTS, "groups_sha256", *(["groups"] if keep_groups else []))
    zero = {"n_best": 0, "count_sum": 0}
    return own.join(scores, ["block", "low"], "left").drop("block", "low").fillna(zero), pairs


def alignment_digests(docs: DataFrame, a_path: str, b_path: str, scratch: Scratch) -> DataFrame:
    """The documents of ``aligned``."""
    return aligned(docs, a_path, b_path, scratch)[0].select("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")
