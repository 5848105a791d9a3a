"""Collocations against counting by hand, at budgets that extend prefixes to every length."""

import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from tripmart.llm import phrases, queries

SCHEMA = "text string, lang string, word string, k1 int, n string"


def frame(spark, rows):
    return spark.createDataFrame([(t, lang, "clash", 1, "clash") for t, lang in rows], SCHEMA)


def counted(rows):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(words)
            for d in (1, 2, 3, 4):
                f[lang].update(words[i : i + d] for i in range(len(words) - d + 1))
    return f, n


def brute(rows, least, covered=80, top=2000):
    f, n = counted(rows)
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        longest = defaultdict(int)
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i : i + m]] = max(longest[p[i : i + m]], a)
        found = []
        for p, a in cand.items():
            if 100 * longest[p] >= covered * a and p in longest:
                continue
            score, _, left, right = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(found[:top])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def sample():
    random = np.random.default_rng(8)
    words = ["the", "of", "New", "york", "city", "é", "x1", "日本", "a\x1cb", " "]
    marks = [" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "? "]
    rows = []
    for i in range(400):
        size = int(random.integers(0, 25))
        text = "".join(str(random.choice(words, p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05, 0.04, 0.03, 0.03])) + str(random.choice(marks)) for _ in range(size))
        rows.append((text, (None, "und", "en", "de", "EN")[i % 5]))
    return rows + [(None, "en"), ("", None), (" .,; ", "xx"), ("new york city " * 40, "en"), ("the " * 500, "de"), ("solo", "one")]


@pytest.mark.parametrize("budget", [1, 40, 300, 1 << 19])
def test_equals_brute_force(spark, monkeypatch, budget):
    rows = sample()
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 700)
    got = rows_of(phrases.collocations(frame(spark, rows).repartition(4), budget=budget, least=5))
    assert got == brute(rows, 5)
    assert len({lang for lang, *_ in got}) == 4


def test_top_and_cover(spark):
    rows = sample()
    got = rows_of(phrases.collocations(frame(spark, rows), top=3, least=5, covered=50))
    assert got == brute(rows, 5, covered=50, top=3)


def test_ties_are_in_byte_order(spark):
    rows = [("b c. a d. é f. z g. Ａ h. 😀 i", "en")] * 30
    got = [r[2] for r in rows_of(phrases.collocations(frame(spark, rows)))]
    assert got == sorted(["b c", "a d", "é f", "z g", "Ａ h", "😀 i"], key=str.encode)


def test_more_groups_than_wanted_raise_the_budget(spark, monkeypatch):
    rows = sample()
    monkeypatch.setattr(phrases, "MOST_GROUPS", 16)
    monkeypatch.setattr(phrases, "MOST_BITS", 12)
    assert rows_of(phrases.collocations(frame(spark, rows), budget=1, least=5)) == brute(rows, 5)


def test_words_with_one_hash_are_counted_with_other_hashes(spark, monkeypatch):
    rows = sample()
    plain, seeds = phrases.word_table, []

    def table(texts, least, seed):
        seeds.append(seed)
        found = plain(texts, least, seed)
        return found.withColumn("names", found["names"] + 1) if seed == 1 else found

    monkeypatch.setattr(phrases, "word_table", table)
    assert rows_of(phrases.collocations(frame(spark, rows), least=5)) == brute(rows, 5)
    assert seeds == [1, 2]


def test_suffixes_with_one_hash_are_told_apart(monkeypatch):
    keys = np.array([[3, 1, 3, 1, 2], [5, 5, 5, 5, 5]], np.uint64)
    monkeypatch.setattr(phrases, "_prefix_hashes", lambda k: [np.zeros(k.shape[1], np.uint64)] * len(k))
    found, counts = phrases._combined(keys)
    assert found.tolist() == [[1, 2, 3], [5, 5, 5]] and counts.tolist() == [2, 1, 2]


def test_a_long_text_and_empty_tables(spark):
    rows = [("very long text of words " * 20_000, "en")]
    assert rows_of(phrases.collocations(frame(spark, rows), budget=2000)) == brute(rows, 30)
    assert rows_of(phrases.collocations(frame(spark, []))) == []
    assert rows_of(phrases.collocations(frame(spark, [(None, None)]))) == []


def test_query_equals_sql(spark, small):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
    import check

    got = queries.op13_phrases(spark, small)
    assert check.compare(got, check.connect(small).sql(queries.ORACLE["op13_phrases"])) == []
