"""Alignment of two tokenizers against whole texts encoded by the libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tripmart.llm import align, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "one", " lead", "trail ", "two  spaces", "tab\there", "line\n\nbreak \n x", "a \t b", "\n a", "x  y", "x 　y",
    "\x1c a \x1c", "a\x85 b", "Ünïcode 日本語 😀 ﬁ", "日本語のテキスト は 長い", "▁", "a▁b c", "<|endoftext|> <s> <0x41> </s>", "don't we'll 's 123 4a5 x's",
    "x" * 3000, "ab" * 2500 + "c " + "é" * 900, "A\x00B \x1f", "same text here", "same text here", "the the the", "ÀÈ 가나다 ́e", "﻿bom", "a.b,c;d  ", "1 2\n3",
]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    table = bytes_to_letters()
    raw_a = {i: bytes(table[c] for c in t) for t, i in a.get_vocab().items() if t != "<|endoftext|>"}

    def raw_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        x, y, whole = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
        if b"".join(raw_a[i] for i in x) != whole or b"".join(raw_b(i) for i in y) != whole:
            return []
        out, i, j = [], 0, 0
        while i < len(x):
            left, right, m, n = [x[i]], [y[j]], len(raw_a[x[i]]), len(raw_b(y[j]))
            i, j = i + 1, j + 1
            while m != n:
                if m < n:
                    left.append(x[i])
                    m, i = m + len(raw_a[x[i]]), i + 1
                else:
                    right.append(y[j])
                    n, j = n + len(raw_b(y[j])), j + 1
            out.append((left, right))
        return out

    return groups


def bytes_to_letters():
    """Letter to byte, written out the other way round than in the operator."""
    table, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def brute(texts, groups):
    found = [groups(t) for t in texts]
    links = [Counter((x, y) for left, right in g for x in left for y in right) for g in found]
    count = Counter(p for per in links for p in per)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for g, per in zip(found, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((
            sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(per.values()),
            sum(n for (x, y), n in per.items() if count[x, y] == best[x]), sum(n * count[p] for p, n in per.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return out


def rows(df):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return {r.doc_id: tuple(r[n] for n in names) for r in df.collect()}


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, units string, chunk int, kind string")


@pytest.mark.parametrize("chunk_bytes", [64, 8 << 20])
def test_odd_texts_equal_brute_force(spark, plain, chunk_bytes):
    random = np.random.default_rng(4)
    letters = list("ab  \t\n'1.é日▁ \x1c Zs")
    texts = ODD + ["".join(random.choice(letters, random.integers(1, 30))) for _ in range(300)]
    got = rows(align.align(frame(spark, texts).repartition(5), A, B, chunk_bytes=chunk_bytes))
    assert [got[i] for i in range(len(texts))] == brute(texts, plain)


def test_documents_equal_brute_force(spark, plain, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    got = rows(queries.op11_align(spark, small))
    assert [got[r.doc_id] for r in docs] == brute([r.text for r in docs], plain)


def test_large_groups_are_linked_by_distinct_ids(monkeypatch):
    model = align.Aligner(A, B)
    units = align.units_of("word " + "x" * 700 + " end's " + "ab" * 400)
    whole = model._aligned(units)
    monkeypatch.setattr(align, "_LARGE_GROUP", 1)
    for old, new in zip(whole, model._aligned(units)):
        assert old[:4] == new[:4] and old[6] == new[6]
        totals = []
        for held in (old, new):
            total = Counter()
            keys = np.frombuffer(held[4], np.int64).tolist()
            for key, times in zip(keys, np.frombuffer(held[5], np.int64).tolist() or [1] * len(keys)):
                total[key] += times
            totals.append(total)
        assert totals[0] == totals[1]


def test_empty_table_null_ids_and_repeated_rows(spark, plain):
    assert align.align(frame(spark, []), A, B).count() == 0
    twice = spark.createDataFrame([(None, "some words"), (None, "some words"), (7, None)], "doc_id long, text string")
    got = [tuple(r) for r in align.align(twice, A, B).collect()]
    want = brute(["some words", "some words", None], plain)
    assert sorted(map(str, got)) == sorted(str((i, *w)) for i, w in zip((None, None, 7), want))


def test_identity_map_has_the_same_bytes():
    model = align.Aligner(A, B)
    some = np.flatnonzero(model.same >= 0)
    assert len(some) > 10_000
    assert all(model.raw_a[i] == model.raw_b[model.same[i]] for i in some.tolist())
