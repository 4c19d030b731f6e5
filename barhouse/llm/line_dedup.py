"""Repeated runs of lines, found by prefix doubling over sequences of line ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barhouse.llm.common import Scratch

#: A run of lines counts as repeated text from this many characters on (line ends not counted): any line does.
MIN_CHARS = 1
_NO_ID = np.iinfo(np.int64).max

_LINES_SQL = (
    "doc_id long, text_id binary, line int, chars int, id_a long, id_b long, ahead int, behind int"
)
_LINES = pa.schema(
    [
        ("doc_id", pa.int64()), ("text_id", pa.binary()), ("line", pa.int32()), ("chars", pa.int32()),
        ("id_a", pa.int64()), ("id_b", pa.int64()), ("ahead", pa.int32()), ("behind", pa.int32()),
    ]
)
_EDGES = "".join(chr(c) for c in (0x20, *range(0x09, 0x0E)))


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """(number, trimmed line) of the lines that are not blank."""
    cut = [(k, x.strip(_EDGES)) for k, x in enumerate((text or "").split("\n"))]
    return [x for x in cut if x[1]]


def spans_of(chars: list[int], least: int) -> tuple[list[int], list[int]]:
    """Per line, how many lines the shortest run of ``least`` characters has that begins there, and that
    ends there; 0 where the document has none."""
    total = np.append(0, np.cumsum(chars))
    n = len(chars)
    stop = np.searchsorted(total, total[:-1] + least)
    ahead = np.where(stop <= n, stop - np.arange(n), 0)
    start = np.searchsorted(total, total[1:] - least, "right") - 1
    behind = np.where(total[1:] >= least, np.arange(n) + 1 - start, 0)
    return ahead.tolist(), behind.tolist()


def _cut_lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                rows = []
                for doc_id, own, text in zip(*[c.to_pylist() for c in part.columns]):
                    lines = [x for _, x in lines_of(text)]
                    chars = [len(x) for x in lines]
                    ahead, behind = spans_of(chars, least)
                    for k, line in enumerate(lines):
                        id_ = xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))
                        a_, b_ = np.frombuffer(id_, np.int64).tolist()
                        rows.append((doc_id, own, k, chars[k], a_, b_, ahead[k], behind[k]))
                columns = zip(*rows) if rows else [[] for _ in _LINES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _LINES)], schema=_LINES
                )

    return run


def _doc_key() -> list[Column]:
    """A document is an id and a text. Null ids come last."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NO_ID))).alias("order_id"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_id"),
    ]


_KEY = ["doc_id", "text_id", "line"]
_ID = ["id_a", "id_b"]


def _as(names: list[str], prefix: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}_{c}") for c in names]


def _at(table: DataFrame, line: Column, prefix: str, names: DataFrame) -> DataFrame:
    """``table`` with the name, as ``prefix``_id_a and ``prefix``_id_b, and the characters of the run that begins at
    ``line`` of its document."""
    other = names.select(*_as([*_KEY, *_ID, "chars"], prefix))
    on = [F.col(c) == F.col(f"{prefix}_{c}") for c in _KEY[:2]] + [line == F.col(f"{prefix}_line")]
    return table.join(other, on).drop(*[f"{prefix}_{c}" for c in _KEY])


def later_copies(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text_id, runs): per document the (line, size) of its runs of lines that have an earlier copy.

    The sequence of a document holds its lines that are not blank. Doubling: round k names, for each
    line that begins a run of 2 ** k lines found at least twice in the table, that run; a name of
    round k + 1 is made of the two names of round k that stand 2 ** k lines apart. The rounds go on
    until no run repeats, whatever ``min_chars`` is. The suffixes of one name are an interval of the
    suffix array, in which they agree on 2 ** k lines at least; a suffix alone in its interval leaves
    the rounds. The first copy of each interval stays. Per line the longest run of a round with an
    earlier copy is given: a maximal repeated run of n lines is covered by those of the last round
    with 2 ** k <= n, from its first line on to the one that ends with its last line.

    A run of another size is the interval in which the names at its beginning and, overlapping, at its
    end agree. Such runs are looked up where ``min_chars`` needs them: of every maximal repeated run
    the shortest parts of that many characters, from each of its lines on and back to each of its lines.

    Names are counted with a combine before the shuffle, and the counted names are written down
    before rows are joined with them, so a line that a third of the documents hold is split like any
    skewed join.
    """
    scratch = Scratch(docs.sparkSession)
    lines = scratch.keep(docs.select(*_doc_key(), "text").mapInArrow(_cut_lines(min_chars), _LINES_SQL))
    place = F.struct(*_KEY)

    def repeated(named: DataFrame) -> DataFrame:
        names = named.groupBy(*_ID).agg(F.count("*").alias("n")).where("n > 1").select(*_ID)
        return named.join(scratch.keep(names), _ID, "left_semi")

    def copies(runs: DataFrame, interval: list[str]) -> DataFrame:
        """The runs of which the interval has an earlier one."""
        first = scratch.keep(runs.groupBy(*interval).agg(F.min(place).alias("first"), F.count("*").alias("n")))
        later = runs.join(first.where("n > 1"), interval).where(place > F.col("first"))
        return later.select("doc_id", "text_id", "line", "size")

    named = scratch.keep(repeated(lines).dropDuplicates(_KEY))
    longest = named.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 0
    wanted = named.select("doc_id", "text_id", "line", F.lit(0).alias("size")).where("false")
    gone = wanted
    if longest > 1:
        forward = F.struct("line", F.col("ahead").alias("size"))
        backward = F.struct((F.col("line") - F.col("behind") + 1).alias("line"), F.col("behind").alias("size"))
        wanted = scratch.keep(
            named.select("doc_id", "text_id", F.inline(F.array_distinct(F.array(forward, backward))))
            .where("size > 0")
            .distinct()
        )
    named = named.select(*_KEY, *_ID, "chars")
    length = 1
    while not named.isEmpty():
        whole = named.select(*_KEY, *_ID, F.lit(length).alias("size")).where(F.col("chars") >= min_chars)
        gone = gone.union(copies(whole, _ID))
        if length < longest:
            of_size = wanted.where(F.col("size").between(length + 1, 2 * length - 1))
            runs = _at(of_size, F.col("line"), "begin", named)
            runs = scratch.keep(_at(runs, F.col("line") + F.col("size") - length, "end", named))
            gone = gone.union(copies(runs, ["size", *[f"{p}_{c}" for p in ("begin", "end") for c in _ID]]))
        pairs = _at(named, F.col("line") + length, "next", named)
        ids = [*_ID, *[f"next_{c}" for c in _ID]]
        pairs = pairs.select(
            *_KEY,
            *[F.xxhash64(F.lit(k), *ids).alias(c) for k, c in enumerate(_ID)],
            (F.col("chars") + F.col("next_chars")).alias("chars"),
        )
        named = scratch.keep(repeated(scratch.keep(pairs)))
        length *= 2
    gone = gone.groupBy("doc_id", "text_id", "line").agg(F.max("size").alias("size"))
    return scratch.keep(
        gone.groupBy("doc_id", "text_id").agg(F.collect_list(F.struct("line", "size")).alias("runs"))
    )


_RESULT_SQL = "doc_id long, n_lines long, n_removed long, n_runs long, text string"


def _drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, value, runs in zip(*batch.columns):
            text = value.as_py() or ""
            lines = lines_of(text)
            gone = np.zeros(len(lines) + 1, dtype=bool)
            for run in runs.as_py() or ():
                gone[run["line"] : run["line"] + run["size"]] = True
            numbers = {n for (n, _), out in zip(lines, gone) if out}
            kept = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in numbers) if numbers else text
            heads = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(lines) else 0
            rows.append((doc_id.as_py(), len(lines), len(numbers), heads, kept))
        types = [pa.int64()] * 4 + [pa.string()]
        columns = zip(*rows) if rows else [[]] * 5
        names = [c.split()[0] for c in _RESULT_SQL.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_runs, text): every document without its later copies of line runs.

    ``n_lines`` counts lines that are not blank, ``n_runs`` the stretches of removed ones; blank lines
    stay. Null text is empty. Rows that repeat whole are one document and keep the same lines; rows
    that share an id but not the text are two, the one of smaller text id first. Rows without an id
    come last. Copies inside a document count. Other columns are ignored.
    """
    runs = later_copies(docs, min_chars).select(*_as(["doc_id", "text_id"], "of"), "runs")
    rows = docs.select("doc_id", "text", *_doc_key())
    same = (F.col("order_id") == F.col("of_doc_id")) & (F.col("text_id") == F.col("of_text_id"))
    return (
        rows.join(runs, same, "left")
        .select(F.col("doc_id").cast("long"), "text", "runs")
        .mapInArrow(_drop_lines, _RESULT_SQL)
    )
