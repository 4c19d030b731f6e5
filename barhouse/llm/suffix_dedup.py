"""Removal of byte strings that an earlier document holds, by a logarithmic family of suffix arrays.

Suffixes are sampled by content: in every string of ``match`` bytes the position whose
``PREFIX`` bytes hash lowest is an anchor, so equal strings have the same anchors in all
documents. A suffix array holds the anchors of a batch in the order of a hash of their first
``PREFIX`` bytes, cut into parts by ranges of that hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barhouse.llm.common import Scratch, shuffle_width

MATCH = 50
PREFIX = 24
#: The table is added to the index family in this many batches.
BATCHES = 4
#: A block of documents is a row with this much text, or one longer document.
BLOCK_BYTES = 2 << 20
#: 2 ** HOME_BITS successive blocks of a task share a home, which is what tables of blocks are bucketed and joined by.
HOME_BITS = 3
#: A part of the tables is meant to stand for this much text at most.
PART_BYTES = 8 << 20
#: Keys that a task gathers before it sends them off.
FLUSH_KEYS = 1 << 20
_NO_ID = np.iinfo(np.int64).max
_KNOWN = np.int64(-1)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


# Packed columns: bytes of equal weight together, compressed.


def _packed(values: np.ndarray, ascending: bool = False) -> bytes:
    values = values.astype(np.uint64)
    if ascending:
        values = np.diff(values, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    values = planes.reshape(8, -1).T.copy().view(np.uint64).ravel()
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and size of every run of equal values."""
    if not len(values):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return first, np.diff(np.append(first, len(values)))


def _row_batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# Blocks of documents and their anchors.

_BLOCK_SQL = "home long, block long, batch int, ids binary, ends binary, body binary"
_BLOCK = pa.schema(
    [("home", pa.int64()), ("block", pa.int64()), ("batch", pa.int32()), *[(c, pa.binary()) for c in ("ids", "ends", "body")]]
)


def _to_blocks(n_batches: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = pc.fill_null(batch.column(0), _NO_ID).to_numpy()
            text = pc.fill_null(batch.column(1), "").cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
            data = text.buffers()[2]
            start = 0
            while start < len(ids):
                stop = int(np.searchsorted(offsets, offsets[start] + BLOCK_BYTES, "right")) - 1
                stop = min(max(stop, start + 1), len(ids))
                body = b"" if data is None else data[int(offsets[start]) : int(offsets[stop])].to_pybytes()
                ends = (offsets[start + 1 : stop + 1] - offsets[start]).astype(np.int64)
                block = part << 24 | made
                home = block >> HOME_BITS
                batch_no = (part + (made >> HOME_BITS)) % n_batches
                yield _row_batch(_BLOCK, [(home, block, batch_no, ids[start:stop].tobytes(), ends.tobytes(), body)])
                start, made = stop, made + 1

    return run


def _lanes(body: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as a number; zeros follow the end."""
    padded = np.append(body, np.zeros(16, dtype=np.uint8))
    out = np.empty(len(body), dtype=np.uint64)
    for at in range(8):
        own = out[at::8]
        own[:] = padded[at : at + 8 * len(own)].view("<u8")
    return out


def _extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Sliding minimum or maximum: element i is that of values[i : i + width]."""
    step = 1
    while 2 * step <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(body: np.ndarray, ends: np.ndarray, match: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all anchors of a block's documents, ascending, and the 64-bit hash of each prefix."""
    n = len(body)
    if n < match:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    lanes = _lanes(body)
    h = lanes[: n - PREFIX + 1] * _A
    for at in range(8, PREFIX, 8):
        h ^= h >> np.uint64(31)
        h += lanes[at : at + len(h)]
        h *= _B
    h ^= h >> np.uint64(32)
    h *= _C
    # 0 and the largest value are reserved for starts and positions that reach over a document's end.
    order = np.clip((h >> np.uint64(32)).astype(np.uint32), 1, 0xFFFFFFFE)
    tails = (ends[:, None] - np.arange(1, PREFIX)).ravel()
    order[tails[(tails >= 0) & (tails < len(order))]] = 0xFFFFFFFF
    width = match - PREFIX + 1
    low = _extreme(order, width, np.minimum)  # per start of a string of `match` bytes
    crossing = (ends[:, None] - np.arange(1, match)).ravel()
    low[crossing[(crossing >= 0) & (crossing < len(low))]] = 0
    edge = np.zeros(width - 1, dtype=np.uint32)
    high = _extreme(np.concatenate([edge, low, edge]), width, np.maximum)
    found = np.flatnonzero((order == high) & (order != 0xFFFFFFFF) & (high != 0))
    # Anchors have low hashes; mixed once more, their keys fill the parts evenly.
    key = (h[found] ^ (h[found] >> np.uint64(29))) * _B
    return found, key ^ (key >> np.uint64(32))


class Block:
    def __init__(self, ids: bytes, ends: bytes, body: bytes):
        self.ids, self.ends = np.frombuffer(ids, np.int64), np.frombuffer(ends, np.int64)
        self.starts = np.append(0, self.ends[:-1])
        self.body = np.frombuffer(body, np.uint8)

    def keys(self, match: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position, key and document number of every anchor."""
        at, key = anchors(self.body, self.ends, match)
        return at, key >> np.uint64(64 - bits), np.searchsorted(self.ends, at, "right")

    def entries(self, repeated: np.ndarray, match: int, bits: int) -> Entries:
        """The surroundings of the anchors whose key is ``repeated`` (sorted)."""
        at, key, doc = self.keys(match, bits)
        if len(repeated):
            near = np.minimum(np.searchsorted(repeated, key), len(repeated) - 1)
            on = repeated[near] == key
        else:
            on = np.zeros(len(key), dtype=bool)
        return Entries(self, at[on], key[on], doc[on], match)


class Entries:
    """Anchors with the bytes that any string of ``match`` bytes around their prefix can touch.

    ``lanes``: those bytes, zeros outside of the document, with the usable starts (bit j: the
    string that begins j bytes before the anchor lies inside the document) in the last four.
    ``group`` numbers equal lanes, ``lead`` is the entry with the smallest id of each.
    """

    def __init__(self, block: Block, at: np.ndarray, key: np.ndarray, doc: np.ndarray, match: int):
        self.at, self.key, self.ids = at, key, block.ids[doc]
        reach = match - PREFIX
        shape = 8 * -(-(reach + match + 4) // 8)
        raw = np.zeros((len(at), shape), dtype=np.uint8)
        self.usable = np.zeros(len(at), dtype=np.uint32)
        for a in range(0, len(at), 1 << 14):
            some = slice(a, a + (1 << 14))
            begin, end = block.starts[doc[some]][:, None], block.ends[doc[some]][:, None]
            where = at[some, None] + np.arange(-reach, match)
            near = block.body[np.clip(where, 0, len(block.body) - 1)]
            raw[some, : reach + match] = np.where((where >= begin) & (where < end), near, 0)
            start = at[some, None] - np.arange(reach + 1)
            self.usable[some] = _as_bits((start >= begin) & (start + match <= end))
        raw[:, shape - 4 :] = self.usable.astype("<u4").view(np.uint8).reshape(-1, 4)
        self.lanes = raw.view("<u8")
        self.group, self.lead = _grouped(self.lanes, self.ids)


def _as_bits(flags: np.ndarray) -> np.ndarray:
    return (flags.astype(np.uint32) << np.arange(flags.shape[1], dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def _hash_rows(lanes: np.ndarray) -> np.ndarray:
    h = np.zeros(len(lanes), dtype=np.uint64)
    for k in range(lanes.shape[1]):
        h = (h ^ lanes[:, k]) * _A
        h ^= h >> np.uint64(29)
    return h


def _grouped(lanes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's group of equal rows, and per group the row with the smallest id.

    Rows are sorted by a hash and compared in full with their neighbour. A collision can part
    equal rows into two groups, which only costs room.
    """
    order = np.lexsort((ids, _hash_rows(lanes)))
    sorted_ = lanes[order]
    first = np.append(True, (sorted_[1:] != sorted_[:-1]).any(axis=1)) if len(order) else np.zeros(0, bool)
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(first) - 1
    return group, order[first]


# The family of suffix arrays. A table of one has a row per part: keys ascending, and the block that
# holds each, or -1 where the key is known to repeat and all its blocks are told.

_SENT = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary())])
_ARRAY = pa.schema([*_SENT, ("hit_keys", pa.binary()), ("hit_blocks", pa.binary())])
_ARRAY_SQL = "part int, keys binary, owners binary, hit_keys binary, hit_blocks binary"


def _ranges(n_parts: int, bits: int) -> np.ndarray:
    """The first key of every part."""
    return np.array([-(-(k << bits) // n_parts) for k in range(n_parts)], dtype=np.uint64)


def _send_keys(n_parts: int, match: int, bits: int):
    """Per task: each key once per block that holds it (marked where several documents of it do)."""

    def sorted_out(keys: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        cuts = np.append(np.searchsorted(key, _ranges(n_parts, bits)), len(key))
        rows = [
            (k, _packed(key[a:b], True), _packed(owner[a:b]))
            for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
            if b > a
        ]
        return _row_batch(_SENT, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, held = [], [], 0
        for batch in batches:
            for block, *rest in zip(*batch.columns):
                _, key, doc = Block(*[c.as_py() for c in rest]).keys(match, bits)
                order = np.argsort(key, kind="stable")
                key, doc = key[order], doc[order]
                first, sizes = _runs(key)
                last = first + sizes - 1
                keys.append(key[first])
                owners.append((np.int64(block.as_py()) << 1) | (doc[first] != doc[last]))
                held += len(first)
                if held >= FLUSH_KEYS:
                    yield sorted_out(keys, owners)
                    keys, owners, held = [], [], 0
        if keys:
            yield sorted_out(keys, owners)

    return run


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffix array of one part of a batch, and the blocks of keys that repeat in the batch."""
    keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for batch in batches:
        keys += [_unpacked(b.as_py(), True) for b in batch.column(1)]
        owners += [_unpacked(b.as_py()).view(np.int64) for b in batch.column(2)]
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    first, sizes = _runs(key)
    several = (sizes > 1) | (np.maximum.reduceat(owner & 1, first) > 0 if len(first) else False)
    told = np.repeat(several, sizes)
    held = np.where(several, _KNOWN, owner[first] >> 1)
    part = TaskContext.get().partitionId()
    yield _row_batch(
        _ARRAY, [(part, _packed(key[first], True), _packed(held), _packed(key[told]), _packed(owner[told] >> 1))]
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A new array against one level, part by part: who holds the keys that both have."""
    schema = pa.schema([("hit_keys", pa.binary()), ("hit_blocks", pa.binary())])
    for batch in batches:
        for _, keys, owners, old_keys, old_owners in zip(*[c.to_pylist() for c in batch.columns]):
            new, old = _unpacked(keys, True), _unpacked(old_keys, True)
            if not len(new) or not len(old):
                continue
            near = np.minimum(np.searchsorted(old, new), len(old) - 1)
            both = old[near] == new
            held = _unpacked(owners).view(np.int64)[both]
            before = _unpacked(old_owners).view(np.int64)[near[both]]
            key, block = np.tile(new[both], 2), np.append(held, before)
            on = block >= 0
            yield _row_batch(schema, [(_packed(key[on]), _packed(block[on]))])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two arrays of equal size to one of double size. A key in both is known to repeat."""
    for batch in batches:
        for part, *arrays in zip(*[c.to_pylist() for c in batch.columns]):
            keys, owners, old_keys, old_owners = (a or _packed(np.zeros(0)) for a in arrays)
            key = np.append(_unpacked(keys, True), _unpacked(old_keys, True))
            owner = np.append(_unpacked(owners), _unpacked(old_owners)).view(np.int64)
            order = np.argsort(key, kind="stable")
            key, owner = key[order], owner[order]
            first, sizes = _runs(key)
            held = np.where(sizes == 1, owner[first], _KNOWN)
            yield _row_batch(_ARRAY, [(part, _packed(key[first], True), _packed(held), b"", b"")])


class Tables:
    """Bucketed tables of one run, below the shared checkpoint folder: joins on the bucket key move nothing."""

    def __init__(self, scratch: Scratch, buckets: int):
        self.scratch, self.buckets, self.spark = scratch, buckets, scratch.spark

    def save(self, df: DataFrame, key: str, by: list[str] = []) -> str:
        name = f"barhouse_{uuid.uuid4().hex}"
        writer = df.write.bucketBy(self.buckets, key).option("path", f"{self.scratch.root}/{name}")
        writer = writer.option("compression", "zstd")
        (writer.partitionBy(*by) if by else writer).saveAsTable(name)
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        self.scratch.drop(f"{self.scratch.root}/{name}")


class IndexFamily:
    """Suffix arrays of sizes 1, 2, 4 ... batches, as the binary digits of the number of batches added."""

    def __init__(self, tables: Tables, match: int, bits: int):
        self.tables, self.match, self.bits = tables, match, bits
        self.levels: list[tuple[int, str]] = []
        self.hits: list[DataFrame] = []

    def _beside(self, new: DataFrame, name: str, how: str = "inner") -> DataFrame:
        old = self.tables.spark.table(name).select(
            "part", F.col("keys").alias("old_keys"), F.col("owners").alias("old_owners")
        )
        return new.join(old, "part", how).select("part", "keys", "owners", "old_keys", "old_owners")

    def add(self, blocks: DataFrame) -> None:
        """Build the array of a batch, scan it against every level, then let equal sizes merge."""
        n, spark = self.tables.buckets, self.tables.spark
        sent = blocks.select("block", "ids", "ends", "body").mapInArrow(
            _send_keys(n, self.match, self.bits), "part int, keys binary, owners binary"
        )
        name = self.tables.save(sent.repartitionById(n, F.col("part")).mapInArrow(_build, _ARRAY_SQL), "part")
        array = spark.table(name)
        self.hits.append(self.tables.scratch.keep(array.select("hit_keys", "hit_blocks")))
        new = array.select("part", "keys", "owners")
        for _, level in self.levels:
            found = self._beside(new, level).mapInArrow(_scan, "hit_keys binary, hit_blocks binary")
            self.hits.append(self.tables.scratch.keep(found))
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, level = self.levels.pop()
            merged = self._beside(spark.table(name), level, "full").mapInArrow(_merge, _ARRAY_SQL)
            double = self.tables.save(merged, "part")
            self.tables.drop(level)
            self.tables.drop(name)
            name, size = double, 2 * size
        self.levels.append((size, name))

    def drop(self) -> None:
        for _, name in self.levels:
            self.tables.drop(name)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits as one row per block and batch of rows."""
    schema = pa.schema([("block", pa.int64()), ("found", pa.binary())])
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.concatenate([_unpacked(b.as_py()) for b in batch.column(0)])
        block = np.concatenate([_unpacked(b.as_py()).view(np.int64) for b in batch.column(1)])
        order = np.lexsort((key, block))
        key, block = key[order], block[order]
        runs = zip(*[x.tolist() for x in _runs(block)])
        yield _row_batch(schema, [(int(block[a]), _packed(np.unique(key[a : a + n]), True)) for a, n in runs])


# Exact comparison of the surroundings of repeated anchors.

_ENTRY = [(c, pa.binary()) for c in ("keys", "ids", "rows", "lanes")]


def _repeated(block: int, found: list[dict] | None) -> np.ndarray:
    """The keys reported to a block, from what is reported to its home."""
    own = [_unpacked(f["found"], True) for f in found or () if f["block"] == block]
    return np.unique(np.concatenate(own)) if own else np.zeros(0, dtype=np.uint64)


def _send_entries(n_parts: int, match: int, bits: int):
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), *_ENTRY])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for block, ids, ends, body, found in zip(*batch.columns):
                told = _repeated(block.as_py(), found.as_py())
                if not len(told):
                    continue
                held = Block(ids.as_py(), ends.as_py(), body.as_py()).entries(told, match, bits)
                lead = held.lead[np.argsort(held.key[held.lead], kind="stable")]
                key = held.key[lead]
                cuts = np.append(np.searchsorted(key, _ranges(n_parts, bits)), len(key)).tolist()
                rows = []
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    if b > a:
                        own = lead[a:b]
                        row = (_packed(key[a:b], True), _packed(held.ids[own]), _packed(own))
                        rows.append((k, block.as_py(), *row, press.compress(held.lanes[own].tobytes())))
                yield _row_batch(schema, rows)

    return run


def first_holders(lanes: np.ndarray, ids: np.ndarray, match: int) -> Iterator[np.ndarray]:
    """For every start j in turn: per row the smallest id of a row with the same string of ``match`` bytes.

    Strings are told apart by a hash and then by their bytes.
    """
    reach = match - PREFIX
    raw = np.ascontiguousarray(lanes).view(np.uint8)
    usable = _usable(lanes)
    width = 8 * -(-match // 8)
    for j in range(reach + 1):
        out = ids.copy()
        rows = np.flatnonzero(usable >> np.uint32(j) & np.uint32(1))
        string = np.zeros((len(rows), width), dtype=np.uint8)
        string[:, :match] = raw[rows, reach - j : reach - j + match]
        string = string.view("<u8")
        h = _hash_rows(string)
        order = np.argsort(h, kind="stable")
        h, string = h[order], string[order]
        same = h[1:] == h[:-1]
        if (string[1:][same] != string[:-1][same]).any():  # a collision: by the bytes alone
            _, kind = np.unique(string, axis=0, return_inverse=True)
            again = np.argsort(kind.ravel(), kind="stable")
            order, kind = order[again], kind.ravel()[again]
            same = kind[1:] == kind[:-1]
        if len(rows):
            first = np.flatnonzero(np.append(True, ~same))
            least = np.minimum.reduceat(ids[rows[order]], first)
            out[rows[order]] = np.repeat(least, np.diff(np.append(first, len(rows))))
        yield out


def _usable(lanes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(lanes[:, -1] >> np.uint64(32)).astype(np.uint32)


_MASKS = pa.schema([("block", pa.int64()), ("rows", pa.binary()), ("masks", pa.binary())])


def _compare(match: int):
    """One part: which starts of each entry begin a string that a smaller id holds too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = -(-(2 * match - PREFIX + 4) // 8)
        press = zstandard.ZstdDecompressor()
        keys, ids, rows, lanes, blocks = [], [], [], [], []
        for batch in batches:
            for _, block, key, id_, row, data in zip(*batch.columns):
                keys.append(_unpacked(key.as_py(), True))
                ids.append(_unpacked(id_.as_py()).view(np.int64))
                rows.append(_unpacked(row.as_py()).view(np.int64))
                lanes.append(np.frombuffer(press.decompress(data.as_py()), "<u8").reshape(-1, shape))
                blocks.append(np.full(len(keys[-1]), block.as_py(), dtype=np.int64))
        if not keys:
            return
        key, id_, row, lane, block = (np.concatenate(c) for c in (keys, ids, rows, lanes, blocks))
        group, lead = _grouped(lane, id_)
        own_key = key[lead]
        _, kind, sizes = np.unique(own_key, return_inverse=True, return_counts=True)
        mixed = np.flatnonzero(sizes[kind] > 1)
        least, mask = id_[lead], np.zeros(len(id_), dtype=np.uint32)
        for j, found in enumerate(first_holders(lane[lead[mixed]], least[mixed], match)):
            least_j = least.copy()
            least_j[mixed] = found
            mask |= (least_j[group] < id_).astype(np.uint32) << np.uint32(j)
        mask &= _usable(lane)
        order = np.argsort(block, kind="stable")
        order = order[mask[order] > 0]
        out = []
        for a, n in zip(*_runs(block[order])):
            own = order[a : a + n]
            out.append((int(block[own[0]]), _packed(row[own]), _packed(mask[own])))
        yield _row_batch(_MASKS, out)

    return run


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
)


def _cut(match: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, ends, body, found, answers in zip(*batch.columns):
                block = Block(ids.as_py(), ends.as_py(), body.as_py())
                removed = np.zeros(len(block.body), dtype=bool)
                told = _repeated(number.as_py(), found.as_py())
                if len(told):
                    held = block.entries(told, match, bits)
                    mask = np.zeros(len(held.at), dtype=np.uint32)
                    for answer in answers.as_py() or ():
                        if answer["block"] == number.as_py():
                            mask[_unpacked(answer["rows"]).astype(np.int64)] = _unpacked(answer["masks"])
                    lead = held.lead[held.group]
                    later = held.ids > held.ids[lead]  # equal surroundings in a smaller id of this block
                    mask = np.where(later, held.usable, mask[lead])
                    change = np.zeros(len(block.body) + 1, dtype=np.int32)
                    begins = np.zeros(len(block.body), dtype=bool)
                    for j in range(match - PREFIX + 1):
                        begins[held.at[(mask >> np.uint32(j) & np.uint32(1)) > 0] - j] = True
                    begins = np.flatnonzero(begins)
                    change[begins] += 1
                    change[begins + match] -= 1
                    removed = np.cumsum(change[:-1]) > 0
                n = block.ends - block.starts
                total = np.append(0, np.cumsum(removed))
                gone = total[block.ends] - total[block.starts]
                heads = removed & ~np.append(False, removed[:-1])
                firsts = block.starts[n > 0]
                heads[firsts] |= removed[firsts]
                heads = np.append(0, np.cumsum(heads))
                spans = heads[block.ends] - heads[block.starts]
                kept = block.body[~removed].tobytes()
                stops = np.cumsum(n - gone).tolist()
                pieces = [kept[a:b] for a, b in zip([0, *stops], stops)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.ids, mask=block.ids == _NO_ID),
                        pa.array(n), pa.array(gone), pa.array(spans), pa.array(pieces, pa.binary()),
                    ],
                    schema=_RESULT,
                )

    return run


def remove_repeats(docs: DataFrame, match: int = MATCH, n_batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each document without what earlier ones hold.

    A byte goes if a string of ``match`` bytes around it also starts in a document with a
    smaller id; ``kept`` holds the other bytes. Strings are judged on the whole input.

    1. Documents are written as blocks, bucketed, so that later joins move no
       text.
    2. Batch by batch the anchors' keys go to their part, once per block, and become a suffix
       array; it is merge-scanned against every level of the family, and equal-sized levels
       merge. A key that several documents hold is reported to the blocks that have it. In the
       levels such a key is one entry, however often it occurs.
    3. Blocks send the surroundings of their reported anchors, equal ones once with their
       smallest id; per part, strings are compared by their bytes, and a block gets back which
       strings an earlier document holds.

    Null text is empty. Documents that share an id do not shorten each other. A document
    without an id comes after all others and shortens none. Other columns are ignored.
    """
    if not PREFIX <= match <= PREFIX + 31:
        raise ValueError(f"match has to be {PREFIX} to {PREFIX + 31} bytes")
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_width(spark), -(-size // PART_BYTES))
    # Of n keys one in 2 ** 20 meets another by chance; what meets is compared in full.
    bits = min(64, max(1, size).bit_length() + 20)
    tables = Tables(scratch, parts)

    def by_home(rows: DataFrame, *columns: str) -> DataFrame:
        home = F.shiftright("block", HOME_BITS).alias("home")
        return rows.groupBy(home).agg(F.collect_list(F.struct("block", *columns)).alias("of_home"))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    made = rows.mapInArrow(_to_blocks(n_batches), _BLOCK_SQL)
    blocks = spark.table(tables.save(made, "home", ["batch"]))
    family = IndexFamily(tables, match, bits)
    for k in sorted(r.batch for r in blocks.select("batch").distinct().collect()):
        family.add(blocks.where(F.col("batch") == k))
    hits = spark.createDataFrame([], "hit_keys binary, hit_blocks binary")
    for more in family.hits:
        hits = hits.union(more)
    told = scratch.keep(by_home(hits.mapInArrow(_by_block, "block long, found binary"), "found"))
    told = told.withColumnRenamed("of_home", "found")
    family.drop()
    sent = (
        blocks.join(told, "home")
        .select("block", "ids", "ends", "body", "found")
        .mapInArrow(_send_entries(parts, match, bits), "part int, block long, keys binary, ids binary, rows binary, lanes binary")
    )
    answers = sent.repartitionById(parts, F.col("part")).mapInArrow(
        _compare(match), "block long, rows binary, masks binary"
    )
    answers = scratch.keep(by_home(answers, "rows", "masks")).withColumnRenamed("of_home", "answers")
    return (
        blocks.join(told, "home", "left")
        .join(answers, "home", "left")
        .select("block", "ids", "ends", "body", "found", "answers")
        .mapInArrow(_cut(match, bits), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )
