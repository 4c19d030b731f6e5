from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as contract
from barhouse.llm import cross_align
from tests.llm import small

ODD = [
    "", " ", "\n\t", "a  b", " lead", "trail ", "tab\there", "▁ word ▁▁ x", "<|endoftext|> and <s> </s> <unk>", "<0x41> \x00 \x1c",
    "é é ﬁ ½ \U0001f600\U0001f468‍\U0001f469", "it's we'll 'S don't 12345 3.14", "日本語 の テキスト", "a b　c", "x" * 300,
    " " * 50 + "z", "line one\n\n\nline two\r\n", "﻿bom", "naïve café",
]


@pytest.fixture(scope="module")
def reference():
    """Both tokenizers by their own libraries, whole text at once, with a table of bytes each."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    printable = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 255 and c != 173]
    other = [c for c in range(256) if c not in printable]
    code = {chr(c): c for c in printable} | {chr(256 + k): c for k, c in enumerate(other)}
    a_bytes = {n: bytes(code[c] for c in t) for t, n in a.get_vocab(with_added_tokens=False).items() if all(c in code for c in t)}
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def b_bytes(n):
        piece = b.id_to_piece(n)
        return bytes([int(piece[1:-1], 16)]) if b.is_byte(n) else piece.replace("▁", " ").encode()

    def tokens(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return [(n, a_bytes[n]) for n in ids_a], [(n, b_bytes(n)) for n in ids_b]

    return tokens


def brute_groups(tokens, text):
    """(groups of ids, links) or None; by the sets of end offsets."""
    if not text:
        return None
    a, b = tokens(text)
    want = b" " + text.encode()
    if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
        return None
    ends = [np.cumsum([len(t) for _, t in x]).tolist() for x in (a, b)]
    groups, at = [], 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        groups.append([[n for (n, _), e in zip(x, es) if at < e <= end] for x, es in zip((a, b), ends)])
        at = end
    by_end = defaultdict(list)
    for (n, _), e in zip(b, ends[1]):
        by_end[e].append(n)
    links = [(n, m) for (n, _), e in zip(a, ends[0]) for m in by_end[e]]
    return len(a), len(b), groups, links


def brute(tokens, data):
    found = [(r[0], brute_groups(tokens, r[1])) for r in data]
    count = Counter(p for _, f in found if f for p in f[3])
    most = Counter()
    for (_, m), n in count.items():
        most[m] = max(most[m], n)
    out = []
    for doc_id, f in found:
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, "", 0, 0))
            continue
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in f[2])
        best = sum(count[p] == most[p[1]] for p in f[3])
        sha = hashlib.sha256(text.encode()).hexdigest()
        out.append((doc_id, f[0], f[1], len(f[2]), len(f[3]), sha, best, sum(count[p] for p in f[3])))
    return sorted(out, key=repr)


ORDER = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def run(spark, folder, data):
    small.crowded(small.docs(spark, data)).write.parquet(f"{folder}/documents.parquet")
    return small.rows(contract.queries()["op12_cross_align"](spark, str(folder)).select(*ORDER))


@given(st.lists(st.integers(1, 3), max_size=60), st.lists(st.integers(1, 3), max_size=60))
@settings(max_examples=300, deadline=None)
def test_group_ends(a, b):
    a, b = np.cumsum(a).tolist(), np.cumsum(b).tolist()
    last = max(a[-1:] + b[-1:], default=0)
    a, b = ([e for e in x if e < last] + [last] * (last > 0) for x in (a, b))
    both = sorted(set(a) & set(b))
    found = [x.tolist() for x in cross_align.group_ends(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))]
    assert found == [[a.index(e) + 1 for e in both], [b.index(e) + 1 for e in both]]


def test_stretches():
    ends = list(range(1, 100_001))
    found = cross_align.stretches(np.array(ends), np.array([3, *ends[5:50_000], *ends[50_001:]]))
    assert found == ([2, 5, 50_001], [0, 1, 49_996], [1, 49_995, 49_999])
    for n in (1, 3, 4, 5, 12, 13, 28, 29):
        assert cross_align.stretches(np.arange(1, n + 1), np.arange(1, n + 1)) == ([0], [0], [n])


def test_encoders_are_the_files_own(spark, reference):
    texts = [t for t in ODD if t]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text]
    a, b = cross_align.public_encoders()
    found = zip(a.encode(texts), b.encode(texts))
    for text, (ids_a, ids_b) in zip(texts, found):
        for ids, encoder, want in zip((ids_a, ids_b), (a, b), reference(text)):
            assert ids.tolist() == [n for n, _ in want]
            assert [encoder.pieces[n] for n in ids.tolist()] == [t for _, t in want]


def test_long_texts_in_parts(monkeypatch):
    a, b = cross_align.public_encoders()
    text = " ".join(ODD) * 3 + " " + small.LONG[:20_000] + "x" * 500
    whole = [e.encode([text])[0].tolist() for e in (a, b)]
    monkeypatch.setattr(cross_align, "PART_CHARS", 100)
    assert len(cross_align.parts_of(text)) > 100
    assert [cross_align.encode_whole(e, [text])[0].tolist() for e in (a, b)] == whole


def test_query_equals_brute_force(spark, tmp_path, reference, monkeypatch):
    monkeypatch.setattr(cross_align, "SLICE_BYTES", 3000)
    monkeypatch.setattr(cross_align, "BLOCK_BYTES", 9000)
    given_rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).collect()
    data = [tuple(r) for r in given_rows if len(r[1]) < 6000]
    data += [r for r in small.AWKWARD if len(r[1] or "") < 1000]
    data += [(700_000 + k, t, "en", "a", 0) for k, t in enumerate(ODD)]
    assert run(spark, tmp_path, data) == brute(reference, data)


def test_groups_are_the_text(spark):
    rows = cross_align.align(small.docs(spark, [(1, "Hello tokenizers, hello", "en", "a", 0)])).collect()
    a, b = cross_align.public_encoders()
    sides = [[[int(n) for n in side.split(",")] for side in g.split("|")] for g in rows[0].groups.split(";")]
    text = [[b"".join(e.pieces[n] for n in ids) for ids, e in zip(g, (a, b))] for g in sides]
    assert all(x == y for x, y in text) and b"".join(x for x, _ in text) == b" Hello tokenizers, hello"


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []
