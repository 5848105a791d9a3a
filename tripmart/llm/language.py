"""Language of texts by Bayesian fusion of text, markup, address and host evidence.

Text: likelihood of byte trigrams under one smoothed table per language, learned
from all labelled documents by grouped counts, and under a flat table that
stands for "none of them".  Letters count in lower case; trigrams of marks,
digits and spaces alone do not count.  Overlapping trigrams are not
independent, so the log-likelihood is divided by three.

Markup and suffix: likelihood of the declared language and of the address
suffix given the language.  Host: prior of the language at the host, smoothed
towards its domain, which is smoothed towards the whole table.  These tables
are grouped sums of the text posteriors, each row's own share taken out when it
is judged, so nothing has to be labelled by hand; sums are combined before the
shuffle and joined back to narrow rows, so a host with a third of all rows is an
ordinary key.

Defined cases: null or empty text, and text without a letter trigram, is
rejected as ``und`` whatever the other evidence; so are texts whose best
language stays below ``least`` or behind the flat table.  Null declared
language, suffix, host or domain is no evidence.  Ties go to the first language in
alphabetical order; repeated rows are judged alike; null ids are kept; without
labelled documents every row is ``und``; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import materialise, text_blocks

CODES = 1 << 16
UNKNOWN = "und"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(65), *range(91, 97), *range(123, 128)]] = 32


@dataclass
class TextModel:
    """Languages in alphabetical order and log probabilities of trigram codes, the flat table last."""

    languages: list[str]
    table: np.ndarray


def trigram_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code (0: does not count) at each byte of a block, and first and last place of each text."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    folded = _FOLD[raw]
    begins, ends = offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - 2)
    if len(folded) < 3:
        return np.zeros(0, np.uint16), begins * 0, ends * 0
    wide = folded.astype(np.uint32)
    code = (wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA77)) + wide[2:] * np.uint32(0xC2B2AE3D)
    code = ((code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)).astype(np.uint16)
    code[code == 0] = 1
    blank = (folded == 32).view(np.int8)
    code[blank[:-2] + blank[1:-1] + blank[2:] > 1] = 0
    return code, np.minimum(begins, len(code)), np.minimum(ends, len(code))


def learn(docs: DataFrame, label_col: str = "lang", text_col: str = "text", smoothing: float = 0.5) -> TextModel:
    """Trigram tables of all labelled documents; what reaches the driver is one table per language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for block in text_blocks(batches, "text", 2 << 20):
            code, begins, ends = trigram_codes(block.column("text"))
            for label, a, b in zip(block.column("label").to_pylist(), begins.tolist(), ends.tolist()):
                if label not in totals:
                    totals[label] = np.zeros(CODES, np.int64)
                part = code[a:b]
                if len(part) > CODES // 8:
                    totals[label] += np.bincount(part, minlength=CODES)
                else:
                    np.add.at(totals[label], part, 1)
        for label, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at), pa.string()), pa.array(at), pa.array(total[at])], names=["label", "code", "n"]
            )

    rows = docs.select(F.lower(F.col(label_col).cast("string")).alias("label"), F.col(text_col).cast("binary").alias("text"))
    found = (
        rows.where(F.length("label") > 0).mapInArrow(count, "label string, code long, n long")
        .where("code > 0").groupBy("label", "code").agg(F.sum("n").alias("n")).toArrow()
    )
    labels = found.column("label").to_numpy()
    languages = sorted(set(labels.tolist()))
    counts = np.zeros((len(languages) + 1, CODES))
    index = {name: i for i, name in enumerate(languages)}
    where = np.array([index[x] for x in labels.tolist()], np.int64)
    counts[where, found.column("code").to_numpy()] = found.column("n").to_numpy()
    table = np.log((counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True))
    table[:, 0] = 0.0  # what does not count
    return TextModel(languages, table.astype(np.float32))


def log_likelihoods(model: TextModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text: log-likelihood under each table (divided by three), and the number of trigrams that count."""
    code, begins, ends = trigram_codes(texts)
    out = np.zeros((len(texts), len(model.table)))
    for i, table in enumerate(model.table):
        running = np.r_[0.0, np.cumsum(table[code], dtype=np.float64)]
        out[:, i] = (running[ends] - running[begins]) / 3
    counted = np.r_[0, np.cumsum(code > 0)]
    return out, counted[ends] - counted[begins]


def identify(
    rows: DataFrame, model: TextModel, id_col: str, text_col: str, declared: Column | None = None,
    suffix: Column | None = None, host: Column | None = None, domain: Column | None = None,
    least: float = 0.4, strength: float = 10.0,
) -> DataFrame:
    """Per row: id, lang (or ``und``), probability, text_lang, rejected.

    ``strength`` is the number of rows that the level above counts for in a
    smoothed table.
    """
    none = F.lit(None).cast("string")
    keys = {"declared": declared, "suffix": suffix, "host": host, "domain": domain}
    named = [(none if c is None else c.cast("string")).alias(k) for k, c in keys.items()]
    narrow = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"), *named)
    count = len(model.languages)
    schema = "id long, declared string, suffix string, host string, domain string, told array<double>, post array<double>, grams long"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", 2 << 20):
            told, grams = log_likelihoods(model, block.column("text"))
            shifted = np.exp(told - told.max(axis=1, keepdims=True))
            post = shifted / shifted.sum(axis=1, keepdims=True)
            post[grams == 0] = 0.0
            cuts = pa.array(np.arange(len(told) + 1, dtype=np.int32) * (count + 1))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x.ravel())) for x in (told, post)]
            held = [block.column(c) for c in ("id", "declared", "suffix", "host", "domain")]
            yield pa.RecordBatch.from_arrays([*held, *lists, pa.array(grams)], names=[f.split()[0] for f in schema.split(", ")])

    seen = materialise(narrow.mapInArrow(judge, schema), "evidence")
    own = [F.col("post")[i] for i in range(count)]
    whole = seen.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"w{i}") for i, c in enumerate(own)]).first()
    total, mass = max(whole["n"], 1), [whole[f"w{i}"] for i in range(count)]
    shares = [(m + 1.0) / (sum(mass) + count) for m in mass]
    joined = seen
    for key, given in keys.items():
        if given is not None:
            sums = seen.where(F.col(key).isNotNull()).groupBy(key).agg(
                F.count("*").alias(f"{key}_n"), *[F.sum(c).alias(f"{key}_{i}") for i, c in enumerate(own)]
            )
            joined = joined.join(sums, key, "left")

    def others(key: str, i: int) -> Column:
        """Sum of the posteriors of the other rows with this key."""
        return F.greatest(F.col(f"{key}_{i}") - own[i], F.lit(0.0))

    def likelihood(key: str, i: int) -> Column:
        base = F.col(f"{key}_n") / total
        return F.coalesce(F.log((others(key, i) + strength * base) / (F.greatest(F.lit(mass[i]) - own[i], F.lit(0.0)) + strength)) - F.log(base), F.lit(0.0))

    def prior(i: int) -> Column:
        value = F.lit(shares[i])
        for key in ("domain", "host"):
            if keys[key] is not None:
                there = reduce(lambda x, y: x + y, [others(key, j) for j in range(count)])
                value = F.coalesce((others(key, i) + strength * value) / (there + strength), value)
        return F.log(value)

    if not count:
        return seen.select(
            F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("probability"),
            F.lit(UNKNOWN).alias("text_lang"), F.lit(True).alias("rejected"),
        )
    votes = [prior(i) + F.col("told")[i] for i in range(count)]
    for key in ("declared", "suffix"):
        if keys[key] is not None:
            votes = [v + likelihood(key, i) for i, v in enumerate(votes)]
    votes.append(F.lit(float(np.log(0.01))) + F.col("told")[count])
    names = F.array(*[F.lit(x) for x in [*model.languages, UNKNOWN]])
    judged = joined.withColumn("votes", F.array(*votes)).select(
        "id", "votes", "grams", F.array_max("votes").alias("best"),
        F.when(F.col("grams") > 0, names[F.array_position("told", F.array_max("told")).cast("int") - 1]).otherwise(UNKNOWN).alias("text_lang"),
    )
    certainty = 1 / F.aggregate("votes", F.lit(0.0), lambda s, v: s + F.exp(v - F.col("best")))
    top = names[F.array_position("votes", F.col("best")).cast("int") - 1]
    lost = (F.col("grams") == 0) | (F.col("top") == UNKNOWN) | (F.col("probability") < least)
    return judged.withColumn("probability", F.when(F.col("grams") > 0, certainty).otherwise(0.0)).withColumn("top", top).select(
        F.col("id").alias(id_col), F.when(lost, UNKNOWN).otherwise(F.col("top")).alias("lang"), "probability", "text_lang",
        lost.alias("rejected"),
    )


def address(url: Column) -> tuple[Column, Column, Column]:
    """Host, domain (its last two labels) and suffix (the last) of an address; null where there is none."""
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    return host, domain, F.when(F.size(labels) > 1, F.element_at(labels, -1))


def declared_language(html: Column) -> Column:
    """Primary part of the language that the markup declares."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,8})", 1)), F.lit(""))


def visible_text(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>|&[#\w]+;", " ")


def of_documents(docs: DataFrame, model: TextModel, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Texts with a source as host; markup anywhere in a text, if there is any, declares its language."""
    text = F.col(text_col).cast("string")
    return identify(docs, model, id_col, text_col, declared=F.when(text.contains("<"), declared_language(text)), host=F.col(host_col))


def of_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """Pages with all four kinds of evidence."""
    host, domain, suffix = address(F.col("url"))
    rows = pages.select("page_id", "url", F.col("html").alias("markup"), visible_text(F.col("html")).alias("shown"))
    return identify(rows, model, "page_id", "shown", declared_language(F.col("markup")), suffix, host, domain)
