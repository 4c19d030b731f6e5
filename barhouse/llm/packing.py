"""Best-fit packing of token pieces by hierarchical residual rounds."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barhouse.llm.common import Scratch, held, slices, word_lists

LENGTH = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: A bin with at most this many free places is emitted; a fuller fit is not sought.
NEARLY_FULL = 16
#: Underfull bins that one task of a later round packs.
ROUND_ITEMS = 100_000
#: Words whose ids a Python worker remembers.
CACHE_WORDS = 600_000
#: Text whose words are numbered together, or one longer document.
SLICE_BYTES = 4 << 20
#: Words beyond Latin letters and signs, or with what may be the name of a special token.
_NOT_PLAIN = re.compile(r"[^\x20-\x7e\xa1-\u017f]|<\|")
#: Fixed value: the vocabulary's own pattern.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PARTS_AND_GAPS = regex.compile(_PATTERN + r"|\x20")


def _check_rules(vocabulary: dict) -> None:
    """Refuse a vocabulary that cuts and normalises texts in another way than is done here."""
    steps = [
        (n["type"], n.get("pattern", {}).get("Regex"), n.get("content"))
        for part in ("normalizer", "pre_tokenizer")
        for n in (vocabulary.get(part) or {}).get("normalizers" if part == "normalizer" else "pretokenizers", [])
    ]
    wanted = [
        ("NFC", None, None), ("Replace", r"\s+", " "), ("Lowercase", None, None), ("Split", _PATTERN, None), ("ByteLevel", None, None),
    ]
    if steps != wanted or vocabulary["model"]["type"] != "BPE":
        raise ValueError("the ids of a text are those of its words only for vocabularies of the known rules")


class WordTokenizer:
    """Token ids of whole texts by way of the ids of their words, which are remembered.

    The vocabulary cuts a text at white space, and then into letters, single digits and runs of
    other signs, and joins nothing across a cut, so a text's ids are those of its words one after
    another. New Latin words are cut and lower-cased here, and the tokenizer sees each part once;
    for other words it does it all.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.of_parts = Tokenizer(self.tokenizer.model)
        self.of_parts.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.is_last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # the last token of a word
        self.is_last[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True
        bytes_of = ByteLevel(add_prefix_space=False, use_regex=False)
        latin = [*map(chr, range(0x21, 0x180)), "\u0307"]  # the last one is of a lower-cased \u0130
        self.alphabet = {ord(c): "".join(p for p, _ in bytes_of.pre_tokenize_str(c)) for c in latin}
        with open(path, encoding="utf-8") as file:
            _check_rules(json.load(file))
        self.known: dict[str, int] = {}
        self.parts: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.known.clear()
        self.parts.clear()
        self.ids = np.zeros(1 << 16, dtype="<u4")
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.part_ids, self.part_sizes = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        self.n_words = self.n_ids = 0

    def _learn_parts(self, parts: list[str]) -> None:
        """Ids of new parts, all of them as one text of which each is a word."""
        text = " ".join(parts).translate(self.alphabet)
        found = self.of_parts.encode_batch_fast([text], add_special_tokens=False)[0]
        ids = np.array(found.ids, dtype="<u4")
        sizes = np.diff(np.flatnonzero(self.is_last[ids]), prepend=-1)
        if len(sizes) != len(parts):
            raise ValueError("a part of a word is not cut off by itself")
        first = len(self.part_sizes)
        self.parts.update(zip(parts, range(first, first + len(parts))))
        self.part_ids = np.append(self.part_ids, ids)
        self.part_sizes = np.append(self.part_sizes, sizes)

    def _ids_of_latin(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has: words are cut together, and only distinct parts looked up."""
        coded = pa.array(_PARTS_AND_GAPS.findall(" ".join(words).lower()), pa.string()).dictionary_encode()
        parts = coded.dictionary.to_pylist()
        new = [p for p in parts if p != " " and p not in self.parts]
        if new:
            self._learn_parts(new)
        at = np.array([self.parts.get(p, -1) for p in parts], dtype=np.int64)[coded.indices.to_numpy()]
        gap = at < 0
        word = np.cumsum(gap)[~gap]
        at = at[~gap]
        sizes = self.part_sizes[at]
        starts = (np.cumsum(self.part_sizes) - self.part_sizes)[at]
        ends = np.append(0, np.cumsum(sizes))
        ids = self.part_ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)]
        return ids, np.bincount(word, weights=sizes, minlength=len(words)).astype(np.int64)

    def _ids_of_any(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype="<u4", count=int(sizes.sum())), sizes

    def learn(self, words: list[str]) -> None:
        plain, rest = words, []
        if _NOT_PLAIN.search(" ".join(words)):
            plain = [w for w in words if not _NOT_PLAIN.search(w)]
            rest = [w for w in words if _NOT_PLAIN.search(w)]
        for some, ids_of in ((plain, self._ids_of_latin), (rest, self._ids_of_any)):
            if some:
                self._add(some, *ids_of(some))

    def _add(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        total = len(flat)
        while self.n_ids + total > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        while self.n_words + len(words) + 1 > len(self.starts):
            self.starts = np.append(self.starts, np.zeros_like(self.starts))
        self.ids[self.n_ids : self.n_ids + total] = flat
        self.starts[self.n_words + 1 : self.n_words + 1 + len(words)] = self.n_ids + np.cumsum(sizes)
        self.known.update(zip(words, range(self.n_words, self.n_words + len(words))))
        self.n_ids += total
        self.n_words += len(words)

    def encode_all(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of each text. Words are split and numbered by Arrow, so only distinct ones are looked up here.

        They are split at ASCII white space; a word with another white space is left to the tokenizer.
        """
        if self.n_words > CACHE_WORDS:
            self.clear()
        _, first, flat = word_lists(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        coded = flat.dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        if new:
            self.learn(new)
        known = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        at = known[coded.indices.to_numpy()]
        starts = self.starts[at]
        sizes = self.starts[at + 1] - starts
        ends = np.append(0, np.cumsum(sizes))
        ids = self.ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)]
        return np.split(ids, ends[first[1:-1]]) if len(first) > 1 else []


def best_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin, offset) per item and the used places per bin.

    ``open_[r]`` holds the bins with r free places and ``free`` a bit for every r
    that has some, so the tightest bin that fits is one shift and one lowest bit.
    """
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    used: list[int] = []
    open_: list[list[int]] = [[] for _ in range(room + 1)]
    free = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = free >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = open_[r].pop()
            if not open_[r]:
                free &= ~(1 << r)
        else:
            b, r = len(used), room
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        r -= n
        open_[r].append(b)
        free |= 1 << r
    return bins, offsets, np.array(used, dtype=np.int64)


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, used long"


def _encoded(batch: pa.RecordBatch, tokenizer: WordTokenizer) -> Iterator[tuple[int, np.ndarray]]:
    for some in slices(batch, 1, SLICE_BYTES):
        yield from zip(some.column(0).to_pylist(), tokenizer.encode_all(some.column(1)))


def _pack_locally(path_of: Callable[[], str], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = path_of()
        tokenizer = held(f"packing {path}", lambda: WordTokenizer(path))
        docs, pieces, starts, lengths, sums = [], [], [], [], []
        for batch in batches:
            for doc_id, found in _encoded(batch, tokenizer):
                ids = np.append(found, np.uint32(END_ID)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), length)):
                    part = ids[at : at + length]
                    docs.append(doc_id)
                    pieces.append(k)
                    starts.append(at)
                    lengths.append(len(part))
                    sums.append(zlib.crc32(part.tobytes()))
        if not docs:
            return
        own = np.array(lengths, dtype=np.int64)
        bins, offsets, used = best_fit(own, length)
        first = TaskContext.get().partitionId() << 32
        columns = [
            pa.array(docs, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(own),
            pa.array(sums, pa.int64()), pa.array(first + bins), pa.array(offsets), pa.array(used[bins]),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _PIECES.split(", ")])

    return run


def _merge(length: int, round_no: int):
    """One later round: underfull bins are the items. A bin's new place, and the new bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, used = [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy())
            used.append(batch.column(1).to_numpy())
        if not ids:
            return
        ids, lengths = np.concatenate(ids), np.concatenate(used)
        bins, offsets, full = best_fit(lengths, length)
        first = (round_no << 56) | (TaskContext.get().partitionId() << 32)
        columns = [pa.array(ids), pa.array(first + bins), pa.array(offsets), pa.array(full[bins])]
        yield pa.RecordBatch.from_arrays(columns, names=["bin", "up", "shift", "up_used"])

    return run


def _public_tokenizer(name: str) -> Callable[[], str]:
    def path() -> str:
        import public_tokenizers

        return public_tokenizers.path(name)

    return path


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    tokenizer: Callable[[], str] | None = None,
    nearly_full: int = NEARLY_FULL,
    round_items: int = ROUND_ITEMS,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row per piece of each row.

    Round 0 packs each input partition by itself as it is read; nothing but the
    placed pieces is written. Bins with more than ``nearly_full`` free places are
    the items of the next round, ``round_items`` to a task, so tasks are merged
    like a tree while the bins get fewer; the rounds end when all of them met in
    one task, or when a round saved no bin at all. No task ever holds more than its share.

    A null or empty text is one piece, the end id. Rows that repeat an id are
    packed each by itself. ``tokenizer`` gives the vocabulary's path where it runs.
    """
    scratch = Scratch(docs.sparkSession)
    path_of = tokenizer or _public_tokenizer(TOKENIZER)
    placed = scratch.keep(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pack_locally(path_of, length), _PIECES)
    )
    limit = length - nearly_full
    under = placed.where(F.col("used") < limit).select("bin", "used").distinct()
    ups: list[DataFrame] = []
    count = under.count()
    while count > 1:
        tasks = -(-count // round_items)
        # Sizes are mixed across tasks: a hash of the bin deals them out.
        step = scratch.keep(
            under.repartitionById(tasks, F.pmod(F.xxhash64("bin"), F.lit(tasks)).cast("int")).mapInArrow(
                _merge(length, len(ups) + 1), "bin long, up long, shift long, up_used long"
            )
        )
        ups.append(step.select("bin", "up", "shift"))
        under = step.where(F.col("up_used") < limit).select(F.col("up").alias("bin"), F.col("up_used").alias("used"))
        under = under.distinct()
        now = step.select("up").distinct().count()
        if tasks == 1 or now >= count:
            break
        count = under.count()
    at = placed.select("doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset")
    for up in ups:
        at = at.join(up, "bin", "left").select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            F.coalesce("up", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    return at.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset"
    )
