"""Language models, near duplicates, language, quality, packing, pieces: brute force and defined cases."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripmart.llm import backoff, language, packing, partenum, pieces, quality
from tripmart.llm.grams import word_hashes

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "chunk string, doc_id long, text string, lang string, source string, slot int"
ODD = [
    None, "", "  \n\t ", "one", "two words", "Ünïcode 日本語 😀 ﬁ", "a\x1cb\x85c", "the the the the the the", "x" * 5000,
    "word, WORD! 'tis don't 123 4a5", "<|endoftext|> <s> ▁ a▁b", "ΣΑΣ İstanbul", "A\x00B \x1f", "same text here", "same text here",
]


def table(spark, texts, lang="en"):
    rows = [("c", i, t, lang, "s", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def words_of(text):
    return (text or "").encode().lower().split()


# -- n-gram helpers ----------------------------------------------------------


def test_word_hashes_tell_words_apart():
    texts = pa.array([*ODD, " lead", "Lead\x0btail "], pa.string())
    hashes, stops = word_hashes(texts)
    named, at = {}, 0
    for text, stop in zip(texts.to_pylist(), stops.tolist()):
        words = words_of(text)
        assert len(words) == stop - at
        for word, h in zip(words, hashes[at:stop].tolist()):
            assert named.setdefault(word, h) == h
        at = stop
    assert len(set(named.values())) == len(named)
    sliced, cut = word_hashes(texts.slice(3, 3))
    assert sliced.tolist() == hashes[stops[2] : stops[5]].tolist() and cut.tolist() == (stops[3:6] - stops[2]).tolist()


# -- stupid backoff -----------------------------------------------------------


def plain_scores(texts):
    counts, docs = Counter(), [words_of(t) for t in texts]
    for w in docs:
        for n in (1, 2, 3):
            counts.update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    total = sum(map(len, docs))

    def s(gram):
        if len(gram) == 1:
            return math.log(counts[gram] / total)
        if counts[gram] >= 2:
            return math.log(counts[gram] / counts[gram[:-1]])
        return math.log(0.4) + s(gram[1:])

    return [sum(s(tuple(w[max(0, i - 2) : i + 1])) for i in range(len(w))) for w in docs]


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 500, "bucket_bytes": 300}])
def test_backoff_equals_brute_force(spark, sizes):
    texts = [*ODD, "a b c d", "a b c e", "a b x", "b c d", "c d"]
    got = {r.doc_id: r for r in backoff.scores(table(spark, texts), **sizes).collect()}
    for i, value in enumerate(plain_scores(texts)):
        assert got[i].log_score == pytest.approx(value, abs=1e-9)
        assert got[i].n_words == len(words_of(texts[i]))
        assert (got[i].mean_log_score is None) == (got[i].n_words == 0)
    assert backoff.scores(table(spark, [])).count() == 0


def test_packed_keys_round_trip():
    keys = np.sort(np.random.default_rng(2).integers(0, 2**64, 1000, np.uint64))
    for part in (keys, keys[:1], keys[:0], keys >> np.uint64(20)):
        assert (backoff.unpacked_keys(backoff.packed_keys(part), len(part)) == part).all()
        assert (backoff.unpacked_numbers(backoff.packed_numbers(part)) == part).all()


# -- Jaccard join -----------------------------------------------------------


def plain_groups(ids, texts):
    sets = []
    for t in texts:
        w = words_of(t)
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set()))
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 90 * len(sets[a] | sets[b]):
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in zip(ids, sets)}


def near_copies():
    """Copies with more and more changes, so that similarities lie around the threshold."""
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = list(ODD)
    for size in (5, 12, 25, 60, 150, 400, 1200):
        base = rng.choice(vocabulary, size).tolist()
        for changes in [0, 0, *range(max(2, size // 40)), size // 30, size // 20]:
            copy = list(base)
            for at in rng.integers(0, size, changes):
                copy[at] = str(rng.choice(vocabulary))
            texts.append(" ".join(copy))
        texts.append(" ".join(base + base[: size // 30]))
    return texts


@pytest.mark.parametrize("block", [1500, 3])
def test_jaccard_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(partenum, "BLOCK", block)
    texts = near_copies()
    ids = [(37 * i) % 211 for i in range(len(texts))]
    rows = spark.createDataFrame(list(zip(ids, texts, range(len(ids)))), "doc_id long, text string, signatures int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.similar_groups(rows).collect()}
    assert got == plain_groups(ids, texts)


@pytest.mark.parametrize("block", [1500, 3])
def test_all_pairs_equal_brute_force(spark, monkeypatch, block):
    """Every link, also between texts that are connected without it."""
    monkeypatch.setattr(partenum, "BLOCK", block)
    texts = near_copies()
    ids = [(37 * i) % 211 for i in range(len(texts))]
    pairs, members = partenum.similar_pairs(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"))
    of, links = {r.doc_id: r.class_id for r in members.collect()}, {(r.a, r.b) for r in pairs.collect()}
    sets = {}
    for i, t in zip(ids, texts):
        w = words_of(t)
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    wanted = {
        (a, b) for a in ids for b in ids
        if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    }
    got = {
        (a, b) for a in ids for b in ids
        if a < b and of[a] is not None and of[b] is not None and (of[a] == of[b] or tuple(sorted((of[a], of[b]))) in links)
    }
    assert got == wanted and set(of) == set(ids)


@pytest.mark.parametrize("similarity", [90, 80])
def test_similar_sets_share_a_signature(similarity):
    """Different sets at the very threshold, in all sizes and across bands."""
    rng = np.random.default_rng(5)
    for size in [*range(1, 130), 150, 300, 500, 2000]:
        for _ in range(6):
            shared = rng.integers(0, 2**63, size, np.uint64)
            spare = (100 - similarity) * size // similarity  # union may be this much larger
            left = int(rng.integers(0, spare + 1))
            a = np.unique(np.r_[shared, rng.integers(0, 2**63, left, np.uint64)])
            b = np.unique(np.r_[shared, rng.integers(0, 2**63, spare - left, np.uint64)])
            both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            assert 100 * both >= similarity * union
            x, y = partenum.signatures([a, b], similarity)
            assert both == union or len(np.intersect1d(x, y)), (size, left, spare)


@pytest.mark.parametrize("size", [1, 2, 7, 30, 200, 1000])
def test_unrelated_sets_share_next_to_nothing(size):
    rng = np.random.default_rng(size)
    count = 4000 if size <= 200 else 1000
    for similarity in (90, 80):
        signs = partenum.signatures([np.unique(rng.integers(0, 2**63, size, np.uint64)) for _ in range(count)], similarity)
        _, held = np.unique(np.concatenate(signs), return_counts=True)
        # Signatures that two of them share, against all of their pairs.
        assert (held.astype(float) * (held - 1) / 2).sum() <= 0.002 * count * (count - 1) / 2


def test_jaccard_empty_and_repeated(spark):
    assert partenum.similar_groups(table(spark, [])).count() == 0
    text = " ".join(map(str, range(30)))
    rows = [(3, text), (3, text), (None, text), (5, text), (8, "other words here now")]
    got = partenum.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(3, 28, 3), (5, 28, 3), (8, 2, 8)]


# -- language ---------------------------------------------------------------


def test_language_on_held_out_documents(spark, documents):
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = language.learn(documents.where(~held))
    got = language.of_documents(documents.where(held), model).join(documents.withColumnRenamed("lang", "true"), "doc_id")
    right, rejected, total = got.select(
        F.count_if(F.col("lang") == F.col("true")), F.count_if("rejected"), F.count("*")
    ).first()
    assert right >= 0.95 * total and rejected <= 0.02 * total


def test_language_defined_cases(spark, documents):
    model = language.learn(documents)
    rows = [(i, t, "s") for i, t in enumerate([None, "", "12 34 !!", "the and of that with the", "the and of that with the"])]
    df = spark.createDataFrame([*rows, (None, "le de la que les", None)], "id long, text string, source string")
    got = {r.id: r for r in language.identify(df, model, "id", "text", host=F.col("source")).collect()}
    assert [got[i].lang for i in range(3)] == ["und"] * 3 and all(got[i].rejected for i in range(3))
    assert got[3].lang == "en" and got[3].probability == got[4].probability and got[None].lang == "fr"
    assert language.of_documents(table(spark, []), model).count() == 0
    nothing = language.learn(table(spark, ["text"], None))
    assert [r.lang for r in language.of_documents(table(spark, ["the and of"]), nothing).collect()] == ["und"]


def test_markup_and_host_decide_short_texts(spark, documents):
    """A text that says little follows its declared language and its host."""
    model = language.learn(documents)
    page = '<html lang="{}"><body>{}</body></html>'
    long = {r.lang: r.text for r in documents.groupBy("lang").agg(F.max_by("text", "n_chars").alias("text")).collect()}
    rows = [(i, f"http://a{i % 3}.{lang}site.{lang}/x", page.format(lang, text)) for i, (lang, text) in enumerate(list(long.items()) * 30)]
    rows += [(1000, "http://b.frsite.fr/", page.format("fr", "on")), (1001, "http://b.ensite.en/", page.format("en", "on")), (1002, None, None)]
    got = {r.page_id: r.lang for r in language.of_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    assert got[1000] == "fr" and got[1001] == "en" and got[1002] == "und"


def test_declared_language_counts_wherever_it_stands(spark, documents):
    """Blanks are no text evidence, so what stands before a declaration changes nothing."""
    model = language.learn(documents)

    def judged(blanks):
        page = F.concat(F.lit(" " * blanks), F.lit('<html lang="'), F.col("lang"), F.lit('"> '), F.substring("text", 1, 12))
        got = language.of_documents(documents.where("doc_id < 200").withColumn("text", page), model)
        return {r.doc_id: (r.lang, round(r.probability, 9)) for r in got.collect()}

    assert judged(4090) == judged(5)
    assert judged(20_000) == judged(5)


# -- quality ------------------------------------------------------------------


def test_quality_on_held_out_labels(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(docs, labels, per_class=400).join(labels, "doc_id").where("held_out")
    good, bad, hit_good, hit_bad = got.select(
        *[F.count_if(F.expr(c)) for c in ("quality = 1", "quality = 0")],
        *[F.count_if(F.expr(c)) for c in ("quality = 1 AND predicted = 1", "quality = 0 AND predicted = 0")],
    ).first()
    assert hit_good >= 0.93 * good and hit_bad >= 0.85 * bad


def test_quality_covers_the_whole_text():
    """The end of a long text and what lies across chunk and block borders count."""
    net = quality.fit([b"plain words here " * 20, b"!!!! ==== !!!! " * 20] * 20, np.array([1, 0] * 20, np.float32), rounds=4)
    text = b"plain words here " * 40_000
    whole = quality.score_texts(net, [text])[0]
    assert quality.score_texts(net, [text], block=8)[0] == pytest.approx(whole, abs=1e-6)
    assert quality.score_texts(net, [text + b"!!!! ==== !!!! " * 10])[0] != whole


def test_quality_defined_cases(spark):
    docs = table(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.quality(docs, none).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.5}
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(len(ODD))}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(3, 15)] + [(7, None, 0), (99, 1, 0), (None, 1, 1), (5, 7, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    assert rows[13].score == rows[14].score
    assert quality.quality(table(spark, []), labels).count() == 0


# -- packing ------------------------------------------------------------------


def check_packing(rows, texts, capacity=4096):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    sums = []
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        sums.append(at)
    assert max(sums) <= capacity
    return sums


def test_packing_of_odd_texts(spark):
    random = np.random.default_rng(11)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "a", "Word", "Σ", "ΑΣ", "é", "'s", " ", " ", "\n", "9", ".", "İ"]
    texts = ODD + ["a <|endoftext|> b", "x<|startoftext|>y<|endoftext|><|endoftext|>."] + ["".join(random.choice(bits, 12)) for _ in range(300)]
    check_packing(packing.pack(table(spark, texts), WORDS).collect(), texts)
    assert packing.pack(table(spark, []), WORDS).count() == 0


def test_packing_of_documents(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for capacity, group in ((4096, 2048), (512, 40)):
        rows = packing.pack(documents, WORDS, capacity=capacity, group_items=group).collect()
        sums = check_packing(rows, [texts[i] for i in range(len(texts))], capacity)
        assert len(sums) <= 1.1 * sum(sums) / capacity + 1


def test_differencing_balances():
    sizes = np.sort(np.random.default_rng(6).integers(1, 4096, 500))[::-1]
    for k in (1, 2, 7, 120):
        loads = np.bincount(packing.differencing(sizes, k), weights=sizes, minlength=k)
        assert loads.sum() == sizes.sum()
        assert loads.max() - loads.min() <= sizes.max()


def test_windows_rise_until_all_fit():
    for sizes in ([4096], [4095] * 5, [2049] * 7, [1] * 9000, [3000, 2000, 2000, 1096]):
        sizes = np.array(sizes)
        window = packing.windows_of(sizes, 4096)
        assert np.bincount(window, weights=sizes).max() <= 4096


# -- sentence pieces -----------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECES)


def long_texts():
    rng = np.random.default_rng(7)
    letters = list("abcdeinrst   \n▁é.0😀")
    texts = ["".join(rng.choice(letters, rng.integers(100, 900))) for _ in range(25)]
    return texts + ["ab" * 400, "a" * 777, " " * 500, "日" * 300, "abc " * 200, "no_space_" * 90]


def test_matrices_are_scanned_in_groups(spark):
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for doc, count in enumerate((1, 2, 3, 4, 9, 40)):
        sizes = [1, *rng.integers(2, 5, count - 1), 1]
        matrices = [np.where(rng.random((a, b)) < 0.7, rng.integers(0, 9, (a, b)) * 1.0, -np.inf) for a, b in zip(sizes, sizes[1:])]
        for m in matrices:
            m[0, 0] = 0.0
        nodes = [[x for i in range(n) for x in (i, i)] for n in sizes]
        rows += [(doc, i, nodes[i], nodes[i + 1], m.ravel().tolist()) for i, m in enumerate(matrices)]
        want[doc] = (matrices, float(pieces.prefix_products(matrices)[-1][0, 0]))
    table_ = spark.createDataFrame(rows, pieces.MATRICES)
    for fan in (2, 3, 256):
        found = defaultdict(list)
        for r in sorted(pieces.scanned(table_, fan).collect(), key=lambda r: (r.row, r.at)):
            found[r.row].append((r.entry, r.exit))
        for doc, (matrices, best) in want.items():
            path = found[doc]
            assert all(a[1] == b[0] for a, b in zip(path, path[1:])) and len(path) == len(matrices)
            assert sum(m[i, j] for m, (i, j) in zip(matrices, path)) == best


@pytest.mark.parametrize("chunk", [64, 150, 16_384])
def test_pieces_equal_the_library(spark, library, chunk):
    texts = [t for t in ODD] + long_texts()
    rows = pieces.encode(table(spark, texts), PIECES, chunk_chars=chunk)
    got = {r.doc_id: r for r in rows.collect()}
    for i, text in enumerate(texts):
        assert got[i].ids == library.encode(text or ""), repr(text)[:80]
    assert chunk == 16_384 or max(r.n_chunks for r in got.values()) > 3
    decoded = {r.doc_id: r.text for r in pieces.decode(rows, PIECES).collect()}
    assert all(decoded[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))


def test_pieces_of_documents(spark, library, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    found = pieces.encode_digests(documents, PIECES, chunk_chars=2000).collect()
    assert sorted(found) == sorted(pieces.digests(pieces.encode(documents, PIECES, chunk_chars=2000), PIECES).collect())
    assert len(found) == len(texts) and max(r.n_chunks for r in found) > 1
    for r in found:
        ids = np.array(library.encode(texts[r.doc_id]), "<i4")
        assert (r.n_ids, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        assert (r.decoded_chars, r.decoded_crc32) == (len(texts[r.doc_id]), zlib.crc32(texts[r.doc_id].encode()))
    assert pieces.encode(table(spark, []), PIECES).count() == 0 == pieces.encode_digests(table(spark, []), PIECES).count()


def test_max_plus_products_are_associative():
    rng = np.random.default_rng(8)
    matrices = [np.where(rng.random((1 if i == 0 else 4, 4)) < 0.6, rng.random((1 if i == 0 else 4, 4)), -np.inf) for i in range(9)]
    running, slow = matrices[0], [matrices[0]]
    for m in matrices[1:]:
        running = pieces.max_plus(running, m)
        slow.append(running)
    assert all(np.allclose(a, b, equal_nan=True) for a, b in zip(pieces.prefix_products(matrices), slow))


def test_sets_move_only_with_pairs_that_wide_sketches_allow(spark):
    rng = np.random.default_rng(7)
    common = rng.integers(0, 2**63, 1500).astype(np.uint64)

    def near(base, other):
        return np.unique(np.concatenate([base, rng.integers(0, 2**63, other).astype(np.uint64)]))

    sets = [near(common, 1500), near(common, 1500), near(common, 90), near(common, 90), near(common[:200], 10)]
    # The narrow sketch is as good as full of such sets: it would let all pairs of the same size through.
    rows = [(i, bytearray(s.tobytes()), len(s), bytearray(partenum.wide_sketch(s))) for i, s in enumerate(sets)]
    held = spark.createDataFrame(rows, "doc_id long, grams binary, held long, wide binary")
    pairs = spark.createDataFrame([(i, j) for i in range(5) for j in range(i + 1, 5)], "a long, b long")
    assert [tuple(r) for r in partenum.possible_pairs(pairs, held, 80).collect()] == [(2, 3)]
    assert [tuple(r) for r in partenum.verified(pairs, held, 80).collect()] == [(2, 3)]


def test_wide_sketches_never_tell_sets_further_apart_than_they_are():
    rng = np.random.default_rng(8)
    for size, gone in [(1, 0), (1, 1), (5, 2), (60, 7), (700, 100), (5000, 900), (5000, 4000)]:
        left = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        right = np.unique(np.concatenate([left[gone:], rng.integers(0, 2**63, gone // 2).astype(np.uint64)]))
        apart = len(np.setxor1d(left, right))
        told = partenum.least_apart(partenum.wide_sketch(left), partenum.wide_sketch(right))
        assert told <= apart and (size < 100 or told > apart * 0.7)


def test_ascii_words_are_looked_up_by_letters_and_marks():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    words = packing.WordIds(Tokenizer.from_file(WORDS), "</w>")
    plain = ["Word word, WORD!! (word", "a]b a-b x^ y\\ z] q- w_ [] -- ..", "don't end' 'tis", "Zwölf é. naïve, ß", "a1 1a 1, <unk> x</w>", "x" * 300 + "!", ""]
    ids, stops = words.of(pa.array([*plain, None]))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in plain] + [[]]
    assert [list(x) for x in np.split(ids, stops[:-1])] == want
    # One entry for all forms of an ASCII word, none for each form.
    words = packing.WordIds(Tokenizer.from_file(WORDS), "</w>")
    words.of(pa.array(["Word word, WORD!! word; word!!"]))
    assert len(words._known) == 0 and len(words._cores) == 4
