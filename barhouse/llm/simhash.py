"""SimHash near-duplicates through an index of deletion variants."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barhouse.llm.common import Scratch, blobs, components, shuffle_width, smallest_label

SHINGLE = 3
MAX_BITS = 2
HASH_SEED = 42
#: Runs of one index key up to this many fingerprints are compared pair by pair; longer ones are cut further.
RUN = 64
_HALF = np.uint64(0xFFFFFFFF)
_WHITE = bytes.maketrans(b"\t\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"     abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits; bit i is 1 if it is set in over half of the shingles' XXH64."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WHITE).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, HASH_SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(words) - shingle + 1].tolist()
    hash_ = xxhash.xxh64_intdigest
    values = np.array(
        [hash_(line[a:b], HASH_SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], dtype="<u8"
    )
    ones = np.zeros(64, dtype=np.int64)
    for part in range(0, len(values), 1 << 15):
        bits = np.unpackbits(values[part : part + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long) of every row, and as ``own`` a hash of the text of rows without an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), batch.column(2)], names=["doc_id", "fp", "own"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text", _own_key(docs).alias("own")).mapInArrow(
        run, "doc_id long, fp long, own long"
    )


def _own_key(docs: DataFrame) -> Column:
    """Tells rows without an id apart, by their text; null for the others."""
    return F.when(docs["doc_id"].isNull(), F.xxhash64(docs["text"]))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def _slot_key(fp: np.ndarray, slot: int) -> np.ndarray:
    """The half that ``slot`` is in, without the bit of ``slot``, under the slot's number."""
    half = (fp >> np.uint64(32)) if slot >= 32 else fp & _HALF
    return (half & ~(np.uint64(1) << np.uint64(slot % 32))) | np.uint64(slot << 32)


def _send(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keys = np.concatenate([_slot_key(fp, s) for s in range(64)])
            slots = np.repeat(np.arange(64, dtype=np.uint8), len(fp))
            owner = (_mix(keys) % np.uint64(n)).astype(np.int64)
            sent = list(blobs(owner, n, np.tile(fp, 64), slots))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in sent], pa.int32()),
                    pa.array([c[0] for _, c in sent], pa.binary()),
                    pa.array([c[1] for _, c in sent], pa.binary()),
                ],
                names=["part", "fps", "slots"],
            )

    return run


def _pairs(key: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs among neighbours of equal key in ``fp``, which is sorted by ``key``."""
    left, right = [], []
    step = 1
    while step < len(key):
        same = np.flatnonzero(key[step:] == key[:-step])
        if not len(same):
            break
        near = same[np.bitwise_count(fp[same] ^ fp[same + step]) <= bits]
        left.append(fp[near])
        right.append(fp[near + step])
        step += 1
    none = np.zeros(0, dtype=np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def close_pairs(key: np.ndarray, fp: np.ndarray, bits: int, free: tuple[int, int]) -> Iterator[tuple]:
    """Close pairs of equal ``key``. ``free`` = (first bit, width) of the part that long runs are cut by.

    Members of a run agree outside its wildcard and the free part, so a close
    pair differs by at most one bit in one half of the free part; long runs are
    indexed again by the one-wildcard variants of those halves, one at a time.
    """
    order = np.argsort(key, kind="stable")
    key, fp = key[order], fp[order]
    edges = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(edges, len(key)))
    first, width = free
    long_ = sizes > RUN if width > 8 else np.zeros(len(sizes), dtype=bool)
    short = ~np.repeat(long_, sizes)
    yield _pairs(key[short], fp[short], bits)
    for start, size in zip(edges[long_].tolist(), sizes[long_].tolist()):
        members, half = fp[start : start + size], width // 2
        for at in (first, first + half):
            part = (members >> np.uint64(at)) & np.uint64((1 << half) - 1)
            other = first + half if at == first else first
            for bit in range(half):
                yield from close_pairs(part & ~(np.uint64(1) << np.uint64(bit)), members, bits, (other, half))


def _link(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fps, slots = [], []
        for batch in batches:
            fps += [np.frombuffer(b.as_py(), np.uint64) for b in batch.column(1)]
            slots += [np.frombuffer(b.as_py(), np.uint8) for b in batch.column(2)]
        if not fps:
            return
        fp, slot = np.concatenate(fps), np.concatenate(slots)
        a, b = [], []
        for s in np.unique(slot).tolist():
            own = fp[slot == s]
            for x, y in close_pairs(_slot_key(own, s), own, bits, (0 if s >= 32 else 32, 32)):
                a.append(x)
                b.append(y)
        a, b = np.concatenate(a), np.concatenate(b)
        nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = smallest_label(len(nodes), both[: len(a)], both[len(a) :])
        far = np.flatnonzero(root != np.arange(len(nodes)))  # a star per group, not all its pairs
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[far].view(np.int64)), pa.array(nodes[root[far]].view(np.int64))], names=["a", "b"]
        )

    return run


def _placed(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, fp, own, component_id) per row."""
    if not 1 <= max_bits <= 3:
        raise ValueError("two halves find pairs of at most 3 differing bits")
    scratch = Scratch(docs.sparkSession)
    n = shuffle_width(docs.sparkSession)
    rows = scratch.keep(fingerprints(docs, shingle))
    known = scratch.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    sent = known.select("fp").mapInArrow(_send(n), "part int, fps binary, slots binary")
    links = scratch.keep(
        sent.repartitionById(n, F.col("part")).mapInArrow(_link(max_bits), "a long, b long").distinct()
    )
    # Components are those of the fingerprints, so that rows without an id link others like any row.
    groups = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), scratch)
    rooted = scratch.keep(
        known.join(groups, known["fp"] == groups["node"], "left").select(
            "fp", "rep", F.coalesce("component", "fp").alias("root")
        )
    )
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    placed = scratch.keep(rooted.join(smallest, "root").select("fp", "component_id"))
    return rows.join(placed, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    Equal fingerprints are merged first. A fingerprint is cut into two halves, so
    that of two within ``max_bits`` (2 or 3) differing bits one half differs by at
    most one bit; the index holds each half 32 times with one bit left out, and
    fingerprints that share an entry are compared. Index rows travel packed, by a
    hash of the entry. Long runs of an entry are cut further by the other half
    instead of being paired in full, and a task returns a star per linked group.

    Texts without words (null, empty, blank) have fingerprint zero and are linked
    like any other. A null id is never a ``component_id`` unless its group has no
    other. Other columns are ignored.
    """
    return _placed(docs, shingle, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The row with the smallest id of each group, with all its columns.

    Rows that share an id stay if any of them does. Rows without an id stay only where no row of their group
    has one; such rows of equal text stay together.
    """
    placed = _placed(docs, shingle, max_bits).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = placed.select(F.col("doc_id").alias("_kept_id"), F.col("own").alias("_kept_own")).distinct()
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & _own_key(docs).eqNullSafe(kept["_kept_own"])
    return docs.join(kept, same, "left_semi")
