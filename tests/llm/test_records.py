"""Web archives and preference formatting."""

import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from tripmart.llm import chat, warc

# -- web archives ----------------------------------------------------------

LARGE = "<html>" + "large page " * 200 + "</html>"
PAGES = [
    (1, "http://a/1", LARGE), (2, "http://a/2", LARGE), (3, "http://a/3", "small"), (4, "http://a/4", "small"),
    (5, None, None), (6, "http://a/ b\r\nWARC-Type: evil", "é" * 499 + "x"), (7, "http://a/7", "é" * 500), (8, "http://a/8", "é" * 500),
    (9, "http://a/9", LARGE), (10, "", ""), (11, "x", "\r\n\r\nWARC/1.1\r\n" * 90), (12, "y", "\x1f\x8b\x08" * 400),
]
SCHEMA = "page_id long, url string, html string"


def expected(pages):
    payloads = {i: (h or "").encode() for i, _, h in pages}
    out = {}
    for i, p in payloads.items():
        first = max(j for j, q in payloads.items() if q == p)
        revisit = len(p) >= 1000 and first != i
        out[i] = (len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", first if revisit else None)
    return out


def written(spark, tmp_path, pages=PAGES):
    folder = str(tmp_path / "archive")
    rows = spark.createDataFrame(pages, SCHEMA).withColumn("payload", F.lit("clash")).withColumn("digest", F.lit(1))
    warc.write_archive(rows.repartition(3), folder)
    return folder


@pytest.mark.parametrize("split", [37, 1000, 1 << 24])
def test_archive_round_trip_in_any_split(spark, tmp_path, split):
    records = warc.read_archive(spark, written(spark, tmp_path), split_bytes=split)
    got = {r.page_id: tuple(r)[1:] for r in warc.page_digests(records).collect()}
    assert got == expected(PAGES)
    assert records.count() == len(PAGES)
    kept = {r.record_id: r.payload for r in records.where("payload IS NOT NULL").collect()}
    assert bytes(kept["urn:page:12"]) == PAGES[11][2].encode()


def test_archive_is_a_plain_gzip_stream(spark, tmp_path):
    folder = written(spark, tmp_path)
    text = b""
    for file in sorted((tmp_path / "archive").glob("part-*")):
        text += gzip.decompress(file.read_bytes()) if file.stat().st_size else b""
    assert text.count(b"WARC/1.1\r\nWARC-Type: response") + text.count(b"WARC/1.1\r\nWARC-Type: revisit") >= len(PAGES)
    assert b"\r\nWARC-Type: evil" not in text
    assert folder


def test_empty_archive_and_null_id(spark, tmp_path):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    pages = [(None, "u", LARGE), (4, "u", LARGE)]
    got = warc.page_digests(warc.round_trip(spark.createDataFrame(pages, SCHEMA))).orderBy("page_id").collect()
    assert [(r.page_id, r.record_type, r.refers_to) for r in got] == [(None, "revisit", 4), (4, "response", None)]


def test_magic_in_noise_and_damaged_members():
    good = [warc.gzip_member(warc.record(i, "u", b"p" * 50, "00" * 20, None, "d")) for i in range(3)]
    broken = good[1][:60] + b"\xff" * 8 + good[1][68:]
    noise = warc.MAGIC + b"noise" + warc.MAGIC
    data = noise + good[0] + noise + warc.SEPARATOR + broken + good[2] + noise
    class Held(io.BytesIO):
        def size(self):
            return len(data)

    found = [warc.parsed(*m) for m in warc.members_of(Held(data), 0, len(data))]
    assert [r["record_id"] for r in found if r["record_type"] == "response"] == ["urn:page:0", "urn:page:2"]
    whole = []
    for start in range(0, len(data), 11):
        whole += [p for p, _, _ in warc.members_of(Held(data), start, start + 11)]
    assert whole == [r["position"] for r in found]


# -- preference formatting --------------------------------------------------


def sides(spark, chosen, rejected):
    rows = [(1, "chosen", *t) for t in chosen] + [(1, "rejected", *t) for t in rejected]
    return spark.createDataFrame([(*r, "clash") for r in rows], "pair_id long, side string, turn long, role string, text string, part string")


def parts(df):
    rows = df.collect()
    key = lambda r: (r.part, -1 if r.turn is None else r.turn, r.role, r.rendered)
    return [(r.part, r.turn, r.copies, r.rendered[r.mask_start : r.mask_start + r.mask_length]) for r in sorted(rows, key=key)]


def test_prefix_is_rendered_once(spark):
    shared = [(0, "system", "s"), (1, "user", "q"), (2, "assistant", "early")]
    got = chat.preference_segments(sides(spark, [*shared, (3, "user", "a"), (4, "assistant", "good")], [*shared, (3, "user", "b"), (4, "assistant", "bad")]))
    assert parts(got) == [
        ("chosen", 3, 1, ""), ("chosen", 4, 1, "good<|im_end|>\n"),
        ("prompt", 0, 1, ""), ("prompt", 1, 1, ""), ("prompt", 2, 1, ""),
        ("rejected", 3, 1, ""), ("rejected", 4, 1, "bad<|im_end|>\n"),
    ]
    row = chat.records(got).first()
    assert row.prompt == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nearly<|im_end|>\n"
    assert [row.chosen[s.start : s.start + s.length] for s in row.chosen_spans] == ["good<|im_end|>\n"]
    assert [row.rejected[s.start : s.start + s.length] for s in row.rejected_spans] == ["bad<|im_end|>\n"]


def test_preference_defined_cases(spark):
    equal = [(None, None, None), (0, "user", "x"), (0, "user", "x")]
    assert {p for p, *_ in parts(chat.preference_segments(sides(spark, equal, equal)))} == {"prompt"}
    copies = chat.preference_segments(sides(spark, [(0, "user", "x")] * 3, [(0, "user", "x")]))
    assert parts(copies) == [("chosen", 0, 3, ""), ("rejected", 0, 1, "")]
    # A turn that only one side has ends the prefix; a later equal turn is no prefix.
    late = chat.preference_segments(sides(spark, [(1, "user", "x")], [(0, "user", "w"), (1, "user", "x")]))
    assert [p for p, *_ in parts(late)] == ["chosen", "rejected", "rejected"]
    marker = chat.preference_segments(sides(spark, [(0, "assistant", "<|im_end|>")], [])).first()
    assert marker.rendered == "<|im_start|>assistant\n< |im_end|><|im_end|>\n"
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.preference_segments(chat.swapped_replies(empty)).count() == 0


def test_swapped_replies(spark):
    rows = [
        (0, 0, "user", "q0"), (0, 1, "assistant", "r0"), (0, 2, "user", "bye"), (1, 0, "user", "q1"), (1, 1, "assistant", "a"), (1, 3, "assistant", "r1"),
        (2, 0, "user", "q2"), (4, 0, "user", "q4"), (4, 1, "assistant", "r4"),
    ]
    got = chat.swapped_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    rejected = sorted((r.pair_id, r.turn, r.text) for r in got.where("side = 'rejected'").collect())
    assert rejected == [(0, 0, "q0"), (0, 1, "r1"), (0, 2, "bye"), (1, 0, "q1"), (1, 1, "a"), (1, 3, "r0"), (2, 0, "q2"), (4, 0, "q4"), (4, 1, "")]
