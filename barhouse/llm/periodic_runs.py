"""Periodic runs of words, found by a suffix automaton whose link tree is a link-cut tree.

The words of a stretch are appended one by one to a suffix automaton. Its suffix links form a tree in
which the path from the newest state to the root stands for all suffixes of what was read so far, the
longest first. Every state has the place at which its words ended last as its colour; states of one
colour that follow one another are a segment of the path, kept as a preferred path of a link-cut tree
(Sleator and Tarjan 1983). Appending word ``i`` accesses the new state: all segments of its path take
the colour ``i``. A segment of colour ``c`` whose longest suffix has ``l`` words says that these words
ended at ``c`` last, ``d = i - c`` words ago. If ``d <= l``, the last ``2 d`` words are a square, and the
last ``d + l`` words have the smallest period ``d`` and cannot be extended to the left. As every word of a
run after its first two periods gives the same start and period, the last such word is the run's end.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barhouse.llm.common import slices, word_lists

MIN_LENGTH = 12
#: Text that a task looks at together, or one longer document.
SLICE_BYTES = 4 << 20

Reorder = Callable[[int | None, int], np.ndarray | None]


def runs_of(words: list[int]) -> list[tuple[int, int, int]]:
    """All runs of ``words`` as (start, length, period): smallest period, two periods long or more, maximal.

    Time O(n log n) amortised, about 60 bytes per word and a dictionary for every state with two
    successors or more.
    """
    room = 2 * len(words) + 2
    # State 0 is none, state 1 the root. One successor of a state stands in two arrays, others in ``more``.
    length, link, first, to, left, right, up, colour = (array("i", bytes(4 * room)) for _ in range(8))
    more: dict[int, dict[int, int]] = {}
    first[1] = colour[1] = -1
    states = last = 1
    found: dict[tuple[int, int], int] = {}

    def splay(x: int) -> None:
        """Make x the root of its preferred path's tree; a tree keeps its colour at its root."""
        y = up[x]
        if not y or (left[y] != x and right[y] != x):
            return
        top = y
        z = up[top]
        while z and (left[z] == top or right[z] == top):
            top, z = z, up[z]
        colour[x] = colour[top]
        above = z
        while True:
            y = up[x]
            if y == above:
                return
            z = up[y]
            if z != above and (left[z] == y) == (left[y] == x):
                turn = (y, x)
            elif z != above:
                turn = (x, x)
            else:
                turn = (x,)
            for a in turn:  # rotate a over its parent
                b = up[a]
                c = up[b]
                if left[b] == a:
                    inner = left[b] = right[a]
                    right[a] = b
                else:
                    inner = right[b] = left[a]
                    left[a] = b
                if inner:
                    up[inner] = b
                up[b] = a
                up[a] = c
                if c:
                    if left[c] == b:
                        left[c] = a
                    elif right[c] == b:
                        right[c] = a

    for i, w in enumerate(words):
        states += 1
        new = states
        length[new] = i + 1
        first[new] = -1
        p, q = last, 0
        while p:
            one = first[p]
            if one == w:
                q = to[p]
                break
            if one < 0:
                first[p], to[p] = w, new
            elif p in more:
                q = more[p].get(w, 0)
                if q:
                    break
                more[p][w] = new
            else:
                more[p] = {w: new}
            p = link[p]
        if not p:
            parent = 1
        elif length[q] == length[p] + 1:
            parent = q
        else:
            states += 1
            parent = states
            length[parent] = length[p] + 1
            first[parent], to[parent], link[parent] = first[q], to[q], link[q]
            if q in more:
                more[parent] = dict(more[q])
            link[q] = parent
            while p:
                if first[p] == w:
                    if to[p] != q:
                        break
                    to[p] = parent
                else:
                    other = more.get(p)
                    if other is None or other.get(w) != q:
                        break
                    other[w] = parent
                p = link[p]
            # The copy ended where q did, so it enters q's preferred path right above q.
            splay(q)
            over = left[q]
            left[q], up[parent], left[parent] = parent, q, over
            if over:
                up[over] = parent
        link[new] = parent
        last = new
        # Access: from the new state's parent up, one preferred path after the other.
        x, below = parent, new
        while x:
            splay(x)
            seen, most = colour[x], length[x]
            if i - seen <= most:
                found[seen + 1 - most, i - seen] = i
            cut = right[x]
            if cut:
                colour[cut] = seen
            right[x], up[below] = below, x
            below, x = x, up[x]
        colour[below] = i
    return sorted((start, end - start + 1, period) for (start, period), end in found.items())


def stretches(ids: np.ndarray, owner: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """Where a run of ``min_length`` words or more can lie: (from, to) within one owner.

    Half of such a run's least length, ``g`` words from any place on in its first part, stands again one
    period later: a period of at most ``g`` words leaves ``min_length - period >= g`` words to repeat, and
    a longer one has ``g`` words in its first occurrence. So each word of the run is in some string of
    ``g`` words that its document has twice, and runs lie within stretches of such words. Strings are told
    by a hash: equal ones always meet, so nothing is lost if others do too.
    """
    g, n = max(1, min_length // 2), len(ids)
    if n < max(2, min_length):
        return []
    key = np.zeros(n - g + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(g):
            key = key * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + len(key)].astype(np.uint64) + np.uint64(1)
            key ^= key >> np.uint64(29)
        key += owner[: len(key)].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    at = np.flatnonzero(owner[: len(key)] == owner[g - 1 :])
    if not len(at):
        return []
    order = np.argsort(key[at], kind="stable")
    sorted_key = key[at][order]
    same = sorted_key[1:] == sorted_key[:-1]
    twice = at[order[np.append(same, False) | np.append(False, same)]]
    steps = np.zeros(n + 1, dtype=np.int64)
    steps[twice] += 1
    steps[twice + g] -= 1
    inside = np.cumsum(steps[:-1]) > 0
    turn = inside[1:] != inside[:-1]
    turn |= inside[1:] & (owner[1:] != owner[:-1])
    edges = np.concatenate([[0], np.flatnonzero(turn) + 1, [n]])
    return [(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) if inside[a] and b - a >= min_length]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def _search(min_length: int, reorder: Reorder | None):
    def find(some: pa.RecordBatch) -> pa.RecordBatch:
        lists, starts, flat = word_lists(some.column(1))
        doc_ids = some.column(0).to_pylist()
        collapsed = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).to_pylist()
        ids = flat.dictionary_encode().indices.to_numpy()
        counts = np.diff(starts)
        place = np.arange(len(ids))
        moved = set()
        for k, doc_id in enumerate(doc_ids):
            order = reorder(doc_id, int(counts[k])) if reorder and counts[k] else None
            if order is not None:
                place[starts[k] : starts[k + 1]] = starts[k] + order
                moved.add(k)
        ids = ids[place]
        owner = np.repeat(np.arange(len(doc_ids)), counts)
        runs: list[list[tuple[int, int, int]]] = [[] for _ in doc_ids]
        for a, b in stretches(ids, owner, min_length):
            k = int(owner[a])
            shift = a - int(starts[k])
            some_ids = np.unique(ids[a:b], return_inverse=True)[1].tolist()
            runs[k] += [(s + shift, n, p) for s, n, p in runs_of(some_ids) if n >= min_length]
        for k in moved.union(k for k, r in enumerate(runs) if r):
            runs[k] = sorted(runs[k], key=lambda r: (r[0], r[2]))
            steps = np.zeros(int(counts[k]) + 1, dtype=np.int64)
            for s, n, p in runs[k]:
                steps[s + p] += 1
                steps[s + n] -= 1
            kept = place[starts[k] : starts[k + 1]][np.cumsum(steps[:-1]) == 0]
            collapsed[k] = " ".join(flat.take(pa.array(kept)).to_pylist())
        sizes = np.append(0, np.cumsum([len(r) for r in runs])).astype(np.int32)
        each = np.array([r for rs in runs for r in rs], dtype=np.int64).reshape(-1, 3)
        struct = pa.StructArray.from_arrays([pa.array(each[:, c].copy()) for c in range(3)], fields=list(_RUN))
        columns = [some.column(0), pa.ListArray.from_arrays(pa.array(sizes), struct), pa.array(collapsed, pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1, SLICE_BYTES):
                yield find(some)

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, reorder: Reorder | None = None) -> DataFrame:
    """(doc_id, runs array<struct<start, length, period>>, collapsed): one row per row.

    Words are what stands between ASCII white space, numbered from 0. A run has at least two periods and
    ``min_length`` words; runs are sorted by start, then period. ``collapsed`` has the text's words joined
    by one space, without those that some run contains after its first period.

    ``reorder(doc_id, n)`` may give the original word numbers that a document of n words is to be read
    as; None leaves it as it is. It is not asked for documents without words.

    A null or empty text, or one of white space alone, has no words, no runs and an empty ``collapsed``.
    Rows are independent of one another, so rows without an id and rows that repeat an id or a text get
    their own result. Other columns are ignored. There is no shuffle: a task holds a slice of
    ``SLICE_BYTES`` or one longer document.
    """
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sql = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return kept.mapInArrow(_search(min_length, reorder), sql)


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's rule: in a tenth of the documents, by a hash of the id, some part is repeated to the end."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def digests(found: DataFrame) -> DataFrame:
    """The longest run of each row and hashes of all runs and of the collapsed text."""
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )

    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.n") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
