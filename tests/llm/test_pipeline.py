"""The pipeline against its stages' brute-force versions, and its defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import language, packing, quality


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, medium):
    """Documents of the sample, with repeated rows, nulls, empty and odd texts."""
    root = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{medium}/documents.parquet").where("doc_id < 300")
    odd = [
        (9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "12 34 -- ..", "en", "s", 11), (None, "the and of that with the", "en", None, 24),
        (None, None, None, None, None),
    ]
    extra = spark.createDataFrame(odd, docs.schema)
    docs.unionByName(extra).unionByName(docs.where("doc_id IN (1, 2)")).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{medium}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages_keep_rows_and_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, folder)
        assert kept.columns == docs.columns, name
        assert kept.exceptAll(before).isEmpty(), name
        path = f"{folder}/kept-{name}.parquet"
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert {9001, 9002, 9003}.isdisjoint(ids) and ids.count(None) == 1
    assert len(ids) == len(set(ids))

    # Each decision again, from what the stages report.
    net = quality.learned(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    judged = language.of_documents(docs, language.learn(docs)).where("NOT rejected AND doc_id IS NOT NULL").select("doc_id").distinct()
    first = spark.read.parquet(f"{folder}/kept-language_id.parquet")
    assert {r.doc_id for r in judged.collect()} == {r.doc_id for r in first.where("doc_id IS NOT NULL").collect()}
    good = quality.scored(first, net).where("score >= 0.5 AND doc_id IS NOT NULL").select("doc_id").distinct().count()
    second = spark.read.parquet(f"{folder}/kept-quality.parquet")
    assert abs(good - second.where("doc_id IS NOT NULL").select("doc_id").distinct().count()) <= 3  # learned from fewer rows
    texts = {r.doc_id: r.text for r in second.where("doc_id IS NOT NULL").collect()}
    assert brute_leaders(texts, 5, 80) == {i for i in ids if i is not None}


def test_run_packs_what_the_stages_keep(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    kept = spark.read.parquet(f"{folder}/kept-near_duplicates.parquet")
    direct = packing.pack(kept, corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(str, rows.select(*key).collect())) == sorted(map(str, direct.select(*key).collect()))
    sums = [r.s for r in rows.groupBy("sequence_id").agg(F.sum("length").alias("s")).collect()]
    assert np.max(sums) <= 4096


def brute_leaders(texts, n, least):
    """Smallest id of each group of texts that share ``least`` percent of their word n-grams, all pairs compared."""
    words = {i: t.lower().split() for i, t in texts.items()}
    sets = {i: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or {tuple(w)} for i, w in words.items()}
    leader = {i: i for i in texts}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = sorted((leader[a], leader[b]))
                leader = {i: x if v == y else v for i, v in leader.items()}
    return {i for i, v in leader.items() if i == v}


def test_near_duplicates_are_those_of_five_words_and_four_fifths(spark):
    random = np.random.default_rng(3)
    texts = {}
    for base in range(24):
        words = [f"w{k}" for k in random.integers(0, 5000, 40 + 8 * base)]
        texts[10 * base] = " ".join(words)
        for copy in range(1, 5):
            changed = list(words)
            for place in random.choice(len(words), copy, replace=False):
                changed[place] = f"x{base}y{copy}"
            texts[10 * base + copy] = " ".join(changed)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()}
    wanted = brute_leaders(texts, 5, 80)
    assert wanted != brute_leaders(texts, 3, 90)
    assert kept == wanted


def test_near_duplicates_go_by_id_and_text(spark):
    """A repeated id keeps its different texts; exact copies with null id leave one row."""
    one, two, three, four = (" ".join(f"{p}{k}" for k in range(40)) for p in "abcd")
    rows = [
        (1, one, "a"), (7, one, "a"), (7, two, "a"), (7, two, "b"), (7, three, "a"), (None, two, "a"), (None, four, "a"), (None, four, "a"),
        (None, four + " end", "a"), (8, "", "a"), (8, None, "a"), (9, "", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()]
    named = [(1, one, "a"), (7, two, "a"), (7, three, "a"), (8, "", "a"), (8, None, "a"), (9, "", "a")]
    assert sorted(map(str, (r for r in got if r[0] is not None))) == sorted(map(str, named))
    unnamed = [r for r in got if r[0] is None]
    assert len(unnamed) == 1 and unnamed[0][1].startswith(four)


def test_row_keys_tell_nulls_and_places_apart(spark):
    rows = [(1, None, "a"), (1, "a", None), (1, "a", "a"), (None, "a", "a"), (1, "", "a"), (None, None, None), (1, "a", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    keys = [r[0] for r in corpus_pipeline.keyed(docs, "doc_id", "text", "source").select(corpus_pipeline.ROW).collect()]
    assert len(set(keys)) == 6 and keys[2] == keys[6]
    with pytest.raises(ValueError):
        corpus_pipeline.keyed(docs.withColumn(corpus_pipeline.ROW, F.lit(1)), "doc_id")


def test_clashing_names_ties_and_a_very_long_text(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60")
    first = docs.where("length(text) > 300").orderBy("doc_id").first()
    long = spark.createDataFrame([(70, (first.text + " ") * 400, first.lang, first.source, 1), (71, first.text, first.lang, first.source, 1)], docs.schema)
    wide = docs.unionByName(long).withColumns({name: F.lit(7) for name in ("component_id", "score", "rejected", "sign", "row", "id", "key")})
    wide.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    got = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, str(tmp_path))
        assert got.columns == wide.columns
    ids = {r.doc_id for r in got.collect()}
    assert 71 not in ids or first.doc_id not in ids
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == len(ids)


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
