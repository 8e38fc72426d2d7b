"""Substring dedup: shared word seeds, collinear chains with gap costs through a Fenwick tree, and alignment of the chains."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch
from .text import SHINGLE, mix, parts, powers, shingles, text_bytes, words

WINDOW = 12
MIN_WORDS = 50
IDENTITY = 0.8
GAP_COST = 0.1
BREAK = 40
SHIFT = 12
REACH = 64
JOIN_GAP = 3
EDGE = 2 * WINDOW
PLACES = 1 << 31
CHAINS = 4096


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) of ``x[i : i + width]`` for each i that has so many entries."""
    done, step = x, 1
    while step * 2 <= width:
        done, step = pick(done[:-step], done[step:]), step * 2
    rest = width - step
    return pick(done[: len(done) - rest], done[rest:]) if rest else done


def seeds(value: np.ndarray, row: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Places of the smallest hashes of all runs of ``width`` hashes within a row: equal runs have their seeds at equal places."""
    n = len(value)
    if n < width:
        return np.zeros(0, np.int64)
    least = _sliding(value, width, np.minimum)
    least = np.where(row[: n - width + 1] == row[width - 1 :], least, np.uint64(0))
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    return np.flatnonzero(_sliding(padded, width, np.maximum) == value)


def _in_a_row(least_words: int) -> int:
    """How many consecutive seeds, up to three, any two equal runs of ``least_words`` words share."""
    # The first lies in the first WINDOW shingles of the run, the last in the last, and none follows the one before by more than WINDOW.
    return max(1, min(3, 2 + (least_words - SHINGLE - 2 * WINDOW + 1) // WINDOW))


def _seed_rows(least_words: int):
    """Seeds with their places; ``run`` is a key of the seed and those after it (null where the text has too few), ``span`` the words from the first to the last of these."""
    more = _in_a_row(least_words) - 1

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, at in parts(b["text"]):
                w = words(data, at)
                value, row, first = shingles(w)
                at_seed = seeds(value, row)
                at_seed = at_seed[np.diff(w.first)[row[at_seed]] >= least_words]
                doc, place = row[at_seed], first[at_seed] - w.first[row[at_seed]]
                n = max(len(at_seed) - more, 0)
                run, span, whole = np.zeros(len(at_seed), np.uint64), np.zeros(len(at_seed), np.int64), np.zeros(len(at_seed), bool)
                for j in range(more + 1):
                    run[:n] = mix(run[:n] * np.uint64(0xD1342543DE82EF95) + value[at_seed[j : j + n]] + (place[j : j + n] - place[:n]).astype(np.uint64))
                span[:n], whole[:n] = place[more : more + n] - place[:n], doc[more : more + n] == doc[:n]
                yield pa.RecordBatch.from_arrays([pa.array(value[at_seed].view(np.int64)), b["doc_id"].slice(lo, hi - lo).take(pa.array(doc)), pa.array(place, pa.int32()),
                                                  pa.array(run.view(np.int64), mask=~whole), pa.array(span, pa.int32())], names=["seed", "doc_id", "place", "run", "span"])

    return apply


def _whole_runs(least_words: int):
    """Hashes of all runs of ``least_words`` words that hold one of the document's ``held`` runs of seeds."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, at in parts(b["text"]):
                w = words(data, at)
                up, down = powers(len(w.hash) + 1)
                total = np.zeros(len(w.hash) + 1, np.uint64)
                np.cumsum(w.hash * up[:-1], out=total[1:])
                held = b["held"].slice(lo, hi - lo)
                place, span = (held.flatten().field(c).to_numpy().astype(np.int64) for c in ("place", "span"))
                row = np.repeat(np.arange(hi - lo), held.value_lengths().to_numpy())
                low, high = np.maximum(place + span + SHINGLE - least_words, 0), np.minimum(place, np.diff(w.first)[row] - least_words)
                there = low <= high
                n = len(w.hash) + 1
                begins = np.bincount((w.first[row] + low)[there], minlength=n) - np.bincount((w.first[row] + high + 1)[there], minlength=n)
                begin = np.flatnonzero(np.cumsum(begins) > 0)
                value = mix((total[begin + least_words] - total[begin]) * down[begin])
                doc = w.doc[begin]
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), *(b[c].slice(lo, hi - lo).take(pa.array(doc)) for c in ("doc_id", "version")), pa.array(begin - w.first[doc], pa.int32())],
                                                 names=["whole", "doc_id", "version", "place"])

    return apply


def _predecessors(x: np.ndarray, y: np.ndarray, length: int, cost: float) -> tuple[list[float], list[int]]:
    """Score of the best rising chain that ends in each match, and the match before it there (-1: none).

    The score of a predecessor plus the cost of its place is a prefix maximum over y, which a Fenwick tree gives in logarithmic time.
    """
    rank = (np.searchsorted(np.unique(y), y) + 1).tolist()
    x, y = x.tolist(), y.tolist()
    size = max(rank, default=0)
    top, who = [-1e18] * (size + 1), [-1] * (size + 1)
    score, before = [0.0] * len(x), [-1] * len(x)
    for i in range(len(x)):
        at = cost * (x[i] + y[i])
        best, j, r = -1e18, -1, rank[i] - 1
        while r > 0:
            if top[r] > best:
                best, j = top[r], who[r]
            r -= r & -r
        got = float(length)
        if j >= 0:
            gain = min(length, x[i] - x[j], y[i] - y[j]) + best - at
            if gain > got:
                got, before[i] = gain, j
        score[i] = got
        put, r = got + at, rank[i]
        while r <= size:
            if put > top[r]:
                top[r], who[r] = put, i
            r += r & -r
    return score, before


def disjoint_chains(x: np.ndarray, y: np.ndarray, length: int = SHINGLE, cost: float = GAP_COST) -> list[list[int]]:
    """Rising chains of matches (x ascending, y any, descending where x is equal) that share none, best first: each match scores the words it
    adds, gaps cost by their length. All come from one scoring: a chain that would run into a better one begins after it.
    """
    score, before = _predecessors(x, y, length, cost)
    free, out = [True] * len(score), []
    for i in np.argsort(-np.asarray(score), kind="stable").tolist():
        chain = []
        while i >= 0 and free[i]:
            free[i] = False
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def best_chain(x: np.ndarray, y: np.ndarray, length: int = SHINGLE, cost: float = GAP_COST) -> list[int]:
    """The best rising chain of matches."""
    return next(iter(disjoint_chains(x, y, length, cost)), [])


def chains(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Disjoint chains of two matches or more, cut where a gap is long or shifts far; each as indices into ``x``.

    Matches that stay alone are scored again among themselves, as long as chains are found. So a passage that one document holds many times
    over costs one scoring for all its places, not one for each.
    """
    out, left = [], np.arange(len(x))
    at_x, at_y = x.tolist(), y.tolist()
    while len(left) > 1:
        alone, of = [], left.tolist()
        for c in disjoint_chains(x[left], y[left]):
            if len(c) < 2:
                alone += [of[i] for i in c]
                continue
            piece = [of[c[0]]]
            for i in (of[j] for j in c[1:]):
                dx, dy = at_x[i] - at_x[piece[-1]], at_y[i] - at_y[piece[-1]]
                if max(dx, dy) > BREAK or abs(dx - dy) > SHIFT:
                    out.append(piece)
                    piece = []
                piece.append(i)
            out.append(piece)
        if len(alone) < 2 or len(alone) == len(left):
            break
        left = np.sort(np.array(alone))
    return [np.array(c) for c in out if len(c) > 1]


def _grouped(batches: Iterator[pa.RecordBatch], key: str, work) -> Iterator[pa.RecordBatch]:
    """``work`` over sorted batches, cut so that rows equal in ``key`` come together: what may go on in the next batch waits for it."""
    rest = None
    for b in batches:
        b = pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0] if rest is not None and rest.num_rows else b
        if not b.num_rows:
            continue
        same = (v := b[key].to_numpy()) == v[-1]
        end = b.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if end:
            yield work(b.slice(0, end))
        rest = b.slice(end)
    if rest is not None and rest.num_rows:
        yield work(rest)


def _covered(least_words: int):
    """Maximal runs of a text's words that lie in runs of ``least_words`` words which earlier documents have too, with the ids of these."""

    def joined(b: pa.RecordBatch) -> pa.RecordBatch:
        doc, version, place, other = (b[c].to_numpy() for c in ("doc_id", "version", "place", "other"))
        order = np.lexsort((place, version, doc))
        doc, version, place, other = doc[order], version[order], place[order], other[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]) | (place[1:] > place[:-1] + least_words)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(doc))
        others = [np.unique(other[x:y]) for x, y in zip(begin, end)]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(o) for o in others]))), pa.int32()), pa.array(np.concatenate(others)))
        return pa.RecordBatch.from_arrays([pa.array(doc[begin]), pa.array(version[begin]), pa.array(place[begin], pa.int32()), pa.array(place[end - 1] + least_words, pa.int32()), lists],
                                          names=["doc_id", "version", "begin", "end", "others"])

    return lambda batches: _grouped(batches, "doc_id", joined)


def _points(x: np.ndarray, y: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal shingles of one pair of documents: a match of more words stands for its ends, and inside long runs of matches one word after
    the other only every eighth stays.
    """
    if span.any():
        far = span > 0
        x, y = np.concatenate((x, x[far] + span[far])), np.concatenate((y, y[far] + span[far]))
        order = np.lexsort((-y, x))
        x, y = x[order], y[order]
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
    x, y = x[new], y[new]
    if len(x) > 2:
        next_to = (np.diff(x) == 1) & (np.diff(y) == 1)
        keep = np.ones(len(x), bool)
        keep[1:-1] = ~(next_to[:-1] & next_to[1:]) | (x[1:-1] % 8 == 0)
        x, y = x[keep], y[keep]
    return x, y


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of each pair of documents. Rows arrive by doc_id; of covered runs ``span`` is -1, from ``place`` to ``at``.

    Matches more than ``EDGE`` words inside a covered run are passed over: their words are found already, and by its edges a run goes on.
    """

    def found(b: pa.RecordBatch) -> pa.RecordBatch:
        doc, other, x, y, span = (b[c].to_numpy() for c in ("doc_id", "other", "place", "at", "span"))
        order = np.lexsort((-y, x, other, span >= 0, doc))
        doc, other, x, y, span = doc[order], other[order], x[order], y[order], span[order]
        cut = np.flatnonzero((doc[1:] != doc[:-1]) | (other[1:] != other[:-1]) | ((span[1:] < 0) != (span[:-1] < 0))) + 1
        rows = []
        now, low, high = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for begin, end in zip(np.concatenate(([0], cut)).tolist(), np.concatenate((cut, [len(doc)])).tolist()):
            if doc[begin] != now:
                now, low, high = doc[begin], np.zeros(0, np.int64), np.zeros(0, np.int64)
            if span[begin] < 0:
                low, high = x[begin:end] + EDGE, y[begin:end] - EDGE
                continue
            u, v, far = x[begin:end], y[begin:end], span[begin:end]
            if len(low):
                run = np.searchsorted(low, u, "right") - 1
                open_ = (run < 0) | (u + far + SHINGLE > high[run])
                u, v, far = u[open_], v[open_], far[open_]
            if len(u) > 1 or far.any():
                u, v = _points(u, v, far)
                rows += [(doc[begin], other[begin], u[c], v[c]) for c in chains(u, v)]
        types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["doc_id", "other", "x", "y"])

    yield from _grouped(batches, "doc_id", found)


def _inside(first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which shingles lie whole in one of the word runs from ``first`` to ``last`` (excluded), none of which lies in another; any order."""
    order = np.argsort(first, kind="stable")
    run = np.searchsorted(first[order], place, "right") - 1
    return (run >= 0) & (place + SHINGLE <= np.append(last[order], 0)[run])


def _left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared seeds (named by their first occurrence) that no passage holds, and those within ``BREAK`` words of one. Rows arrive by doc_id; of passages ``at`` is the end
    and ``other`` null.
    """

    def found(b: pa.RecordBatch) -> pa.RecordBatch:
        doc, place, at = (b[c].to_numpy() for c in ("doc_id", "place", "at"))
        passage, other = b["other"].is_null().to_numpy(zero_copy_only=False), pc.fill_null(b["other"], 0).to_numpy()
        order = np.lexsort((place, passage, doc))
        doc, place, at, other, passage = doc[order], place[order].astype(np.int64), at[order].astype(np.int64), other[order], passage[order]
        near = np.zeros(len(doc), bool)
        cut = np.concatenate(([0], np.flatnonzero(doc[1:] != doc[:-1]) + 1, [len(doc)]))
        for begin, end in zip(cut[:-1].tolist(), cut[1:].tolist()):
            mid = begin + int(np.count_nonzero(~passage[begin:end]))
            here = place[begin:mid]
            left = here[(other[begin:mid] != doc[begin]) & ~_inside(place[mid:end], at[mid:end], here)]
            near[begin:mid] = np.searchsorted(left, here - BREAK) < np.searchsorted(left, here + BREAK, "right")
        return pa.RecordBatch.from_arrays([pa.array(other[near]), pa.array(at[near], pa.int32())], names=["other", "at"])

    yield from _grouped(batches, "doc_id", found)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a document's ``held`` seeds at most ``BREAK`` words apart: a key of both, the place of the first, the ``gap`` to the second, a hash of all words from one
    to the other, and whether one of the two is known from an earlier document and lies in no passage (``spans``).
    """
    for b in batches:
        for lo, hi, data, at in parts(b["text"]):
            w = words(data, at)
            up, down = powers(len(w.hash) + 1)
            total = np.zeros(len(w.hash) + 1, np.uint64)
            np.cumsum(w.hash * up[:-1], out=total[1:])
            number, (place, other, first) = _lists(b["held"].slice(lo, hi - lo), "place", "other", "at")
            row, place, other, first = np.repeat(np.arange(hi - lo), number), place.to_numpy().astype(np.int64), other.to_numpy(), first.to_numpy().astype(np.int64)
            number, (begin, end) = _lists(b["spans"].slice(lo, hi - lo), "first_word", "end_word")
            span_row, begin, end = np.repeat(np.arange(hi - lo), number), begin.to_numpy().astype(np.int64), end.to_numpy().astype(np.int64)
            # Of an id with several texts the seeds of all come with each.
            fits = place + SHINGLE <= np.diff(w.first)[row]
            row, place, other, first = row[fits], place[fits], other[fits], first[fits]
            order = np.lexsort((place, row))
            row, place, other, first = row[order], place[order], other[order], first[order]
            word = w.first[row] + place
            left = (other != b["doc_id"].to_numpy()[lo:hi][row]) & ~_inside(w.first[span_row] + begin, w.first[span_row] + end, word)
            name = mix(mix(other.view(np.uint64)) + first.astype(np.uint64))
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for j in range(1, len(row)):
                i = np.flatnonzero((row[j:] == row[:-j]) & (place[j:] - place[:-j] <= BREAK))
                if not len(i):
                    break
                found.append((i, i + j))
            i, j = (np.concatenate(z) for z in zip(*found))
            i, j = i[place[j] > place[i]], j[place[j] > place[i]]
            key = mix(name[i] * np.uint64(0xD1342543DE82EF95) + name[j])
            between = mix((total[word[j] + SHINGLE] - total[word[i]]) * down[word[i]])
            # Of the document's repeats of the same words, those that passages hold are told once.
            order = np.lexsort((place[i], between, key, row[i]))
            i, j, key, between = i[order], j[order], key[order], between[order]
            again = np.append(False, (row[i][1:] == row[i][:-1]) & (key[1:] == key[:-1]) & (between[1:] == between[:-1]))[: len(i)]
            told = left[i] | left[j] | ~again
            i, j, key, between = i[told], j[told], key[told], between[told]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(between.view(np.int64)), b["doc_id"].slice(lo, hi - lo).take(pa.array(row[i])), pa.array(place[i], pa.int32()),
                                              pa.array(place[j] - place[i], pa.int32()), pa.array(left[i] | left[j])], names=["key", "between", "doc_id", "place", "gap", "left"])


class _Reach:
    """How far pairs of word runs agree from their beginning, at the best score (+1 equal, -2 not), for many pairs at once.

    ``a`` and ``b`` hold the words of all; a pair goes on from ``at_a`` and ``at_b`` by ``step`` (1 or -1) for ``room_a`` and ``room_b`` words at
    most. After a difference the runs may go on at a shift of a few words. ``length`` is the number of words of ``a`` that were passed.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, room_a: np.ndarray, room_b: np.ndarray, step: int):
        self.step, self.length, self.found = step, np.zeros(len(at_a), np.int64), []
        done_a, done_b = self.length, np.zeros(len(at_a), np.int64)
        ahead, six = np.arange(REACH), step * np.arange(6)
        rows = np.arange(len(at_a))
        while True:
            room = np.minimum(np.minimum(room_a[rows] - done_a[rows], room_b[rows] - done_b[rows]), REACH)
            rows, room = rows[room > 0], room[room > 0]
            if not len(rows):
                return
            there = ahead < room[:, None]
            same = there & (a[np.where(there, (at_a[rows] + step * done_a[rows])[:, None] + step * ahead, 0)] == b[np.where(there, (at_b[rows] + step * done_b[rows])[:, None] + step * ahead, 0)])
            score = np.cumsum(np.where(same, np.int16(1), np.int16(-2)), axis=1, dtype=np.int16)
            best = np.argmax(score, axis=1)
            got = np.where(score[np.arange(len(rows)), best] > 0, best + 1, 0)
            self.found.append((rows, done_a[rows], same, got))
            done_a[rows] += got
            done_b[rows] += got
            on, left = [rows[got == room]], rows[got < room]
            for d in range(1, 4):  # words put in or left out
                for da, db in ((d, 0), (0, d), (d, d)):
                    fits = (done_a[left] + da + 6 <= room_a[left]) & (done_b[left] + db + 6 <= room_b[left])
                    u, v = (at_a[left] + step * (done_a[left] + da))[fits], (at_b[left] + step * (done_b[left] + db))[fits]
                    fits[fits] = (a[u[:, None] + six] == b[v[:, None] + six]).all(axis=1)
                    on.append(left[fits])
                    done_a[on[-1]] += da
                    done_b[on[-1]] += db
                    left = left[~fits]
            rows = np.concatenate(on)

    def put(self, mark: np.ndarray, origin: np.ndarray) -> None:
        """Writes for each word that was passed whether it is equal, from ``origin`` of its pair on."""
        ahead = np.arange(REACH)
        for rows, done, same, got in self.found:
            there = ahead < got[:, None]
            mark[((origin[rows] + self.step * done)[:, None] + self.step * ahead)[there]] = same[there]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The words of ``a`` that are in the longest common subsequence of two short word runs."""
    rows = [np.zeros(len(b) + 1, np.int64)]
    for w in a:
        row = rows[-1].copy()
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], rows[-1][:-1] + (b == w)))
        rows.append(row)
    mark, i, j = np.zeros(len(a), bool), len(a), len(b)
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            mark[i] = True
    return mark


def _counting(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one start after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(start - before, length)


def align(a: np.ndarray, first: np.ndarray, words_a: np.ndarray, b: np.ndarray, other: np.ndarray, words_b: np.ndarray, x: np.ndarray, y: np.ndarray, matches: np.ndarray,
          k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Aligns chains of matches of ``k`` words, all chains at once.

    Chain i has its text's ``words_a[i]`` words in ``a`` from ``first[i]`` on, the other's ``words_b[i]`` in ``b`` from ``other[i]`` on, and the next ``matches[i]`` of the
    matches ``x``, ``y``. Returns each chain's first word, its number of words, and for all of them, chain by chain, whether they are equal.
    """
    n = len(matches)
    last = np.cumsum(matches) - 1
    begin, end = last - matches + 1, last
    after = _Reach(a, b, first + x[end], other + y[end], words_a - x[end], words_b - y[end], 1)
    back = _Reach(a, b, first + x[begin] - 1, other + y[begin] - 1, x[begin], y[begin], -1)
    short = after.length < k
    tail = np.where(short, np.minimum(k, words_a - x[end]), after.length)
    length = back.length + x[end] - x[begin] + tail
    origin = np.cumsum(length) - length
    mark = np.zeros(int(length.sum()), bool)
    at = origin + back.length - x[begin]  # where the text's word 0 would be
    back.put(mark, at + x[begin] - 1)
    after.put(mark, at + x[end])
    mark[_counting((at + x[end])[short], tail[short])] = True
    chain = np.repeat(np.arange(n), matches)
    step = np.flatnonzero(chain[1:] == chain[:-1])
    dx, dy = x[step + 1] - x[step], y[step + 1] - y[step]
    even = step[dx == dy]
    u, v, to = ((base[chain[even]] + z[even]) for base, z in ((first, x), (other, y), (at, x)))
    far = dx[dx == dy]
    mark[_counting(to, far)] = a[_counting(u, far)] == b[_counting(v, far)]
    for i, far, wide in zip(step[dx != dy].tolist(), dx[dx != dy].tolist(), dy[dx != dy].tolist()):
        c = chain[i]
        u, v, to = first[c] + x[i], other[c] + y[i], at[c] + x[i]
        mark[to : to + far] = _common(a[u : u + far], b[v : v + wide])
    return x[begin] - back.length, length, mark


def passing_each(equal: np.ndarray, length: np.ndarray, identity: float, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``passing`` of many word runs that lie one after the other in ``equal``: number of the word run, first and end word in it."""
    row, first = np.repeat(np.arange(len(length)), length), np.cumsum(length) - length
    begins, ends = equal.copy(), equal.copy()
    begins[1:] &= ~equal[:-1] | (row[1:] != row[:-1])
    ends[:-1] &= ~equal[1:] | (row[1:] != row[:-1])
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(begin):
        return begin, begin, begin
    # A run from p to q passes where the sum of (equal - identity) is no smaller at q than at p. The sums are whole numbers of 2^-30, and those of
    # each word run lie below all before it, so that none goes on into the next.
    total, row = np.concatenate(([0], np.cumsum(equal))), row[begin]
    below = (2 * np.cumsum(length) - length + 2 * np.arange(len(length)))[row]

    def sums(at: np.ndarray) -> np.ndarray:
        return np.rint((total[at] - total[first[row]] - identity * (at - first[row])) * (1 << 30)).astype(np.int64) - below * (1 << 30)

    later = np.maximum.accumulate(sums(end)[::-1])[::-1]
    last = np.searchsorted(-later, 2 - sums(begin), "right") - 1
    whole = np.append(True, last[1:] > np.maximum.accumulate(last)[:-1])
    row, begin, end = row[whole], begin[whole], end[last[whole]]
    long = end - begin >= least_words
    return row[long], (begin - first[row])[long], (end - first[row])[long]


def passing(equal: np.ndarray, identity: float, least_words: int) -> list[tuple[int, int]]:
    """The longest runs of ``least_words`` words or more, ``identity`` of them or more equal, that begin and end with an equal word.

    Each goes as far as it can, and none lies inside another; two may overlap where both together have too few equal words.
    """
    _, begin, end = passing_each(equal, np.array([len(equal)]), identity, least_words)
    return list(zip(begin.tolist(), end.tolist()))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the other document around each chain, as hashes of 32 bits in a row, with the chain's places in them."""
    for b in batches:
        if not b.num_rows:
            continue
        # Chains with one document come one after the other: its words are worked out once for those of a batch.
        new = np.ones(b.num_rows, bool)
        new[1:] = (np.diff(b["other"].to_numpy()) != 0) | ~pc.equal(b["text"].slice(1), b["text"].slice(0, b.num_rows - 1)).fill_null(False).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(new)
        until = np.append(begins[1:], b.num_rows)
        for lo, hi, data, at in parts(b["text"].take(pa.array(begins))):
            w = words(data, at)
            around, shifted = [], []
            first, last = int(begins[lo]), int(until[hi - 1])
            row = np.repeat(np.arange(hi - lo), (until - begins)[lo:hi]).tolist()
            for i, y in zip(row, b["y"].slice(first, last - first)):
                y = y.values.to_numpy()
                begin = max(0, int(y[0]) - REACH * 8)
                own = w.hash[w.first[i] : w.first[i + 1]]
                around.append(own[begin : y[-1] + SHINGLE + REACH * 8].astype(np.uint32).tobytes())
                shifted.append(y - np.int32(begin))
            yield pa.RecordBatch.from_arrays([*(b[c].slice(first, last - first) for c in ("doc_id", "other", "x")), pa.array(shifted, pa.list_(pa.int32())), pa.array(around, pa.binary())],
                                             names=["doc_id", "other", "x", "y", "around"])


def _lists(column: pa.Array, *fields: str) -> tuple[np.ndarray, list[pa.Array]]:
    """Of a column of lists of structs: the number of entries of each row (null: none), and fields of all entries."""
    entries = column.flatten()
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(), [entries.field(f) for f in fields]


def _aligned(identity: float, least_words: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, at in parts(b["text"]):
                w = words(data, at)
                a, count = w.hash.astype(np.uint32), np.diff(w.first)
                number, (version, low, high, others) = _lists(b["covered"].slice(lo, hi - lo), "version", "begin", "end", "others")
                row = np.repeat(np.arange(hi - lo), number)
                same = np.flatnonzero(version.to_numpy() == b["version"].to_numpy()[lo:hi][row])
                run_row, run_low, run_high = row[same], low.to_numpy()[same].astype(np.int64), high.to_numpy()[same].astype(np.int64)

                number, (other, x, y, around) = _lists(b["chains"].slice(lo, hi - lo), "other", "x", "y", "around")
                row, other, matches = np.repeat(np.arange(hi - lo), number), other.to_numpy(), x.value_lengths().to_numpy().astype(np.int64)
                x, y = x.flatten().to_numpy().astype(np.int64), y.flatten().to_numpy().astype(np.int64)
                raw, place = text_bytes(around)
                end = np.cumsum(matches) - 1
                # A chain that goes beyond the words is of another text with this id.
                fits = (x[end] < count[row]) & (y[end] < np.diff(place) // 4)
                x, y = x[np.repeat(fits, matches)], y[np.repeat(fits, matches)]
                row, other, matches, around, width = row[fits], other[fits], matches[fits], place[:-1][fits] // 4, (np.diff(place) // 4)[fits]
                around_words, ends = np.frombuffer(raw.tobytes(), np.uint32), np.concatenate(([0], np.cumsum(matches)))

                # The pieces that pass, then runs of pieces that touch, then what passes of these.
                equal = np.zeros(len(a), bool)
                equal[_counting(w.first[run_row] + run_low, run_high - run_low)] = True
                ids = others.take(pa.array(same))
                number = ids.value_lengths().to_numpy()
                pieces = [(np.repeat(w.first[run_row] + run_low, number), np.repeat(w.first[run_row] + run_high, number), np.repeat(run_row, number), ids.flatten().to_numpy())]
                for c in range(0, len(row), CHAINS):
                    some = slice(c, c + CHAINS)
                    points = slice(ends[c], ends[min(c + CHAINS, len(row))])
                    begin, length, mark = align(a, w.first[row[some]], count[row[some]], around_words, around[some], width[some], x[points], y[points], matches[some])
                    chain, p, q = passing_each(mark, length, identity, SHINGLE)
                    low = (w.first[row[some]] + begin)[chain] + p
                    equal[_counting(low, q - p)[mark[_counting((np.cumsum(length) - length)[chain] + p, q - p)]]] = True
                    pieces.append((low, low + q - p, row[some][chain], other[some][chain]))
                low, high, of, ids = (np.concatenate(z) for z in zip(*pieces))
                order = np.argsort(low, kind="stable")
                low, high, of, ids = low[order], high[order], of[order], ids[order]
                reach = np.maximum.accumulate(high)
                new = np.ones(len(low), bool)
                new[1:] = (low[1:] > reach[:-1] + JOIN_GAP) | (of[1:] != of[:-1])
                span = np.flatnonzero(new)
                until = np.append(span[1:], len(low))
                wide = reach[until - 1] - low[span]
                at_span, p, q = passing_each(equal[_counting(low[span], wide)], wide, identity, least_words)
                p, q, text = low[span[at_span]] + p, low[span[at_span]] + q, of[span[at_span]]
                met = [np.unique(ids[u:v][(low[u:v] < end) & (high[u:v] > start)]) for u, v, start, end in zip(span[at_span].tolist(), until[at_span].tolist(), p.tolist(), q.tolist())]
                ended = np.append(w.start, 0)[q]
                ended = np.where(q < w.first[text + 1], ended, at[text + 1]) - at[text]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(m) for m in met]))), pa.int32()), pa.array(np.concatenate([*met, np.zeros(0, np.int64)]), pa.int64()))
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(lo, hi - lo).take(pa.array(text)), pa.array(p - w.first[text], pa.int32()), pa.array(q - w.first[text], pa.int32()), lists,
                                                  pa.array(w.start[p] - at[text], pa.int64()), pa.array(ended, pa.int64())], names=["doc_id", "first_word", "end_word", "others", "first_byte", "end_byte"])

    return apply


def repeated_passages(docs: DataFrame, scratch: Scratch, least_words: int = MIN_WORDS, identity: float = IDENTITY) -> DataFrame:
    """Passages of ``least_words`` words or more that an earlier document (by id) has too, exactly or nearly.

    One row for each passage: doc_id, first_word and end_word (from 0, the end excluded), others (ids of the earlier documents), first_byte and
    end_byte of what to cut from the UTF-8 text. Seeds are the smallest of each twelve consecutive five-word hashes, so passages share theirs.
    Each occurrence of a seed, of a run of seeds (three for 50 words) and of ``least_words`` whole words that hold a repeated run of seeds is
    matched with the first occurrence of the same in the corpus. Equal runs of ``least_words`` words share a run of
    seeds, so none is lost, wherever its seeds occur first, and matches are linear in the text however common a passage is. Passages with
    differences meet by seeds and runs of seeds; those seeds that no passage found so holds are matched a second time, in pairs, with the
    first copy of each different run of words that earlier documents have from one to the other (``_linked``), and the passages are worked out anew. One shared seed alone makes no passage. Words in such equal runs (by hashes of 64 bits) are found as they are, and what lies well inside them is
    chained no more. The other matches of two documents are chained and the chains aligned; their longest pieces with ``identity`` equal
    words or more count, and pieces that touch, though their first copies lie in different documents, are one passage where they pass together.
    Where they don't, each that passes is a passage, and two may overlap.

    The first document of a repeated passage keeps it. Repeats inside one document don't count. Null and short texts have no passages; rows
    with a null id are left out; rows that repeat an id are one document with several texts, each compared with earlier ids.
    """
    plain = docs.filter("doc_id is not null").select("doc_id", "text")
    again = scratch.table(plain.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "again")

    def versions(rows: DataFrame) -> DataFrame:
        """``version`` tells the texts of an id that has several; with 0 for all others it takes no room in a shuffle."""
        return rows.join(again.withColumn("several", F.lit(True)), "doc_id", "left").withColumn("version", F.when(F.col("several"), F.xxhash64("text")).otherwise(0)).drop("several")

    seeded = plain.mapInArrow(_seed_rows(least_words), "seed long, doc_id long, place int, run long, span int")
    places = F.lit(PLACES).cast("decimal(10,0)")

    def firsts(rows: DataFrame, key: str) -> DataFrame:
        """First occurrence of each key that several documents have."""
        # Document and place as one number: Spark finds the least number by hashing, but the least struct by sorting all rows.
        number = F.col("doc_id").cast("decimal(19,0)") * places + F.col("place")
        found = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(number).alias("f"), F.min("doc_id").alias("other"), F.max("doc_id").alias("last")).filter("other <> last")
        return scratch.table(found.select(key, "other", (F.col("f") - F.col("other").cast("decimal(19,0)") * places).cast("int").alias("at")), f"first-{key}")

    # Runs that several documents have begin with seeds that these have too.
    met = scratch.table(seeded.join(firsts(seeded, "seed"), "seed").select("doc_id", "place", "other", "at", "run", "span"), "met")
    scratch.drop("first-seed")
    runs = scratch.table(met.drop("other", "at").join(firsts(met, "run"), "run").select("doc_id", "place", "other", "at", "span"), "runs")
    scratch.drop("first-run")
    met = met.select("doc_id", "place", "other", "at", F.lit(0).alias("span"))
    held = runs.groupBy("doc_id").agg(F.collect_set(F.struct("place", "span")).alias("held"))  # at most the seeds of one document
    whole = versions(plain.join(held, "doc_id")).select("doc_id", "text", "version", "held")
    whole = scratch.table(whole.mapInArrow(_whole_runs(least_words), "whole long, doc_id long, version long, place int"), "whole")
    earliest = whole.groupBy("whole").agg(F.min("doc_id").alias("other"), F.max("doc_id").alias("last")).filter("other <> last").drop("last")
    earliest = scratch.table(earliest, "earliest")
    wholes = whole.join(earliest, "whole").filter("doc_id <> other").select("doc_id", "version", "place", "other")
    covered = wholes.repartition("doc_id").sortWithinPartitions("doc_id")
    covered = scratch.table(covered.mapInArrow(_covered(least_words), "doc_id long, version long, begin int, end int, others array<long>"), "covered")
    scratch.drop("whole")
    scratch.drop("earliest")
    # Of an id with several texts all matches are chained: a covered run of one says nothing of the other.
    pair = ("doc_id", "place", "other", "at", "span")
    inside = covered.join(again, "doc_id", "left_anti").select("doc_id", F.col("begin").alias("place"), F.lit(0).cast("long").alias("other"), F.col("end").alias("at"), F.lit(-1).alias("span"))
    matches = met.union(runs).filter("doc_id <> other").select(*pair).union(inside.select(*pair))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the chaining is heavier than its few bytes suggest

    def chained(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, "doc_id").sortWithinPartitions("doc_id").mapInArrow(_chained, "doc_id long, other long, x array<int>, y array<int>")

    def aligned(chains: DataFrame) -> DataFrame:
        """Passages by these chains and the covered runs; writes the texts they need."""
        ids = scratch.table(chains.select("doc_id").union(chains.select("other")).union(covered.select("doc_id")).distinct(), "ids")
        texts = scratch.table(plain.join(ids, "doc_id", "left_semi"), "texts")
        around = (chains.join(texts.withColumnRenamed("doc_id", "other"), "other").select("doc_id", "other", "x", "y", "text")
                  .mapInArrow(_windows, "doc_id long, other long, x array<int>, y array<int>, around binary"))
        own = around.groupBy("doc_id").agg(F.collect_list(F.struct("other", "x", "y", "around")).alias("chains"))  # at most the seeds of one document
        held = covered.groupBy("doc_id").agg(F.collect_list(F.struct("version", "begin", "end", "others")).alias("covered"))  # at most the words of one document
        rows = texts.join(own, "doc_id", "left").join(held, "doc_id", "left").filter("chains is not null or covered is not null")
        rows = versions(rows).select("doc_id", "text", "version", "chains", "covered")
        return rows.mapInArrow(_aligned(identity, least_words), "doc_id long, first_word int, end_word int, others array<long>, first_byte long, end_byte long")

    by_first = scratch.table(chained(matches), "by-first")
    scratch.drop("runs")
    found = scratch.table(aligned(by_first).select("doc_id", "first_word", "end_word"), "found")
    scratch.drop("ids")
    scratch.drop("texts")
    by_links = scratch.table(chained(_linked(plain, met, found.join(again, "doc_id", "left_anti"), scratch)), "by-links")
    for name in ("met", "found", "links"):
        scratch.drop(name)
    chains = scratch.table(by_first.union(by_links), "chained")
    scratch.drop("by-first")
    scratch.drop("by-links")
    return aligned(chains)


def _linked(plain: DataFrame, met: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Matches with all earlier documents of what first occurrences left outside of passages: doc_id, place, other, at, span (0).

    ``met`` has the seeds that several documents have, with their first occurrences, ``found`` the passages so far. Two seeds at most ``BREAK`` words apart, one of them
    in no passage, are matched wherever earlier documents have them so, at a shift of ``SHIFT`` at most: with the first copy of each different run of words from one to
    the other. So equal words on both sides of a difference meet wherever their seeds occur first, and copies of a run are not expanded into pairs: what goes on beyond its
    seeds is compared with the first of them.
    """
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("first_word", "end_word")).alias("spans"))  # at most the words of one document
    rows = met.select("doc_id", "place", "other", "at").union(found.select("doc_id", "first_word", F.lit(None).cast("long"), "end_word"))
    near = rows.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(_left_over, "other long, at int").distinct()
    held = met.join(near, ["other", "at"], "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct("place", "other", "at")).alias("held"))  # at most the seeds of one document
    linked = plain.join(held, "doc_id").join(spans, "doc_id", "left").select("doc_id", "text", "held", "spans")
    links = scratch.table(linked.mapInArrow(_links, "key long, between long, doc_id long, place int, gap int, left boolean"), "links")
    # The first copy of the same words stands for all copies.
    number = F.col("doc_id").cast("decimal(19,0)") * F.lit(PLACES).cast("decimal(10,0)") + F.col("place")
    first = links.groupBy("key", "gap", "between").agg(F.min(number).alias("f"), F.min("doc_id").alias("other"))
    first = first.select("key", F.col("gap").alias("far"), "other", (F.col("f") - F.col("other").cast("decimal(19,0)") * F.lit(PLACES).cast("decimal(10,0)")).cast("int").alias("at"))
    pairs = links.filter("left").drop("between", "left").join(first, "key").filter(f"other < doc_id and abs(far - gap) <= {SHIFT}")
    ends = F.inline(F.array(F.struct(F.col("place"), F.col("at")), F.struct((F.col("place") + F.col("gap")).alias("place"), (F.col("at") + F.col("far")).alias("at"))))
    return pairs.select("doc_id", "other", ends).distinct().select("doc_id", "place", "other", "at", F.lit(0).alias("span"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = b["text"].to_pylist()
        for i, spans in enumerate(b["spans"].to_pylist()):
            if spans:
                raw, left, at = text[i].encode(), [], 0
                for s in sorted(spans, key=lambda s: s["first_byte"]):
                    left.append(raw[at : s["first_byte"]])
                    at = max(at, s["end_byte"])
                text[i] = b"".join([*left, raw[at:]]).decode()
        yield pa.RecordBatch.from_arrays([*b["kept"].flatten(), pa.array(text, b["text"].type)], names=[*(b["kept"].type.field(i).name for i in range(b["kept"].type.num_fields)), "text"])


def cut_passages(docs: DataFrame, scratch: Scratch, least_words: int = MIN_WORDS, identity: float = IDENTITY) -> DataFrame:
    """The documents without the passages that an earlier one has, with all their columns; ``n_chars``, if there, counts what is left.

    Only rows whose id is not null and not repeated are cut; a text may be left empty.
    """
    found = scratch.table(repeated_passages(docs, scratch, least_words, identity), "passages")
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("first_byte", "end_byte")).alias("spans"))  # at most one document's
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    spans = scratch.table(spans.join(again, "doc_id", "left_anti"), "spans").withColumnRenamed("doc_id", "same")
    rest = [c for c in docs.columns if c != "text"]
    wide = docs.select(F.struct(*rest).alias("kept"), "text", F.col("doc_id").alias("same")).join(spans, "same", "left").select("kept", "text", "spans")
    out = wide.mapInArrow(_cut, docs.select(*rest, "text").schema).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
