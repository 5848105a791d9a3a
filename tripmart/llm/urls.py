"""Verdicts on web addresses: host and path rules, then a weighted vocabulary.

A rule names a host and the start of a path and fits that host and all of its
subdomains; of the rules that fit, the longest decides.  Addresses without a
rule are judged by their words: an Aho-Corasick automaton finds all terms in one
walk, a hit counts if no letter or digit (ASCII) stands next to it, and an
address is blocked on one strict term or on several distinct soft ones.

Few rules go to every task, checked by size; many are joined: the distinct pairs
of host and path are exploded to the host's suffixes, salted, joined on the host,
and the longest fitting rule is a maximum.

Defined cases: the host is what follows the first ``://`` up to ``/``, ``?``,
``#`` or the end, with A to Z in lower case, a port included; the path goes up to
``?`` or ``#``; a null address, or one without ``://``, has an empty host and path,
fits no rule, and is judged by its text (null: empty, allowed).  An empty path does not
start with ``/``.  Length is that of host and path together; of equally long rules
the one with the longer host wins, then the one that blocks.  Repeated rows are judged one
by one, null ids are kept, an empty table gives no rows, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)
_WORD = frozenset("0123456789" + _LOWER)
JUDGED = (
    "page_id long, host string, path string, rule string, verdict string,"
    " strict_hits long, soft_hits long, terms array<string>"
)
SALTS = 16
RULE_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def rank(self) -> tuple[int, int, bool]:
        return len(self.host) + len(self.path), len(self.host), self.verdict == "block"


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case; one strict term or ``soft_least`` different soft ones block."""

    strict: tuple[str, ...] = ()
    soft: tuple[str, ...] = ()
    soft_least: int = 2

    def __post_init__(self):
        terms = self.strict + self.soft
        if len(set(terms)) < len(terms) or any(t == "" or t != t.translate(_FOLD) for t in terms):
            raise ValueError("terms must be distinct, not empty and in lower case")


# Words that name junk by themselves, and words that do so in company.
JUNK = Vocabulary(
    strict=(
        "adult", "camgirl", "camgirls", "casino", "casinos", "cialis", "escort", "escorts", "hentai", "malware",
        "milf", "phishing", "porn", "porno", "sportsbook", "spam", "viagra", "warez", "xxx",
    ),
    soft=(
        "ads", "affiliate", "bet", "bets", "betting", "bonus", "cheap", "clicks", "coupon", "crack", "credit", "deal",
        "deals", "diet", "discount", "download", "free", "gambling", "girls", "hot", "jackpot", "keygen", "loan", "loans",
        "lottery", "nude", "payday", "pharmacy", "pill", "pills", "poker", "popup", "promo", "replica", "seo", "sex",
        "sexy", "slots", "torrent", "track", "tracker", "win", "winner",
    ),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


class Matcher:
    """Rules and terms for the rows of a task."""

    def __init__(self, rules: list[Rule], vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary = vocabulary
        self.rules: dict[str, dict[str, Rule]] = {}
        for rule in sorted(rules, key=lambda r: r.rank):
            self.rules.setdefault(rule.host, {})[rule.path] = rule
        self.sizes = {h: sorted({len(p) for p in held}, reverse=True) for h, held in self.rules.items()}
        self.labels = max((h.count(".") + 1 for h in self.rules), default=0)
        self.automaton = None
        if vocabulary.strict + vocabulary.soft:
            self.automaton = ahocorasick.Automaton()
            for term in vocabulary.strict:
                self.automaton.add_word(term, (term, True))
            for term in vocabulary.soft:
                self.automaton.add_word(term, (term, False))
            self.automaton.make_automaton()

    def rule(self, host: str, path: str) -> Rule | None:
        best, at = None, len(host)
        for _ in range(self.labels):
            if at <= 0:
                break
            at = host.rfind(".", 0, at)
            suffix = host[at + 1 :]
            held = self.rules.get(suffix)
            if held:
                for size in self.sizes[suffix]:
                    found = held.get(path[:size]) if size <= len(path) else None
                    if found is not None:
                        if best is None or found.rank > best.rank:
                            best = found
                        break
        return best

    def hits(self, url: str) -> tuple[set[str], set[str]]:
        """Distinct strict and soft terms with no letter or digit at either side."""
        strict, soft = set(), set()
        if self.automaton is not None:
            text = url.translate(_FOLD)
            for last, (term, hard) in self.automaton.iter(text):
                first = last - len(term) + 1
                if (first and text[first - 1] in _WORD) or (last + 1 < len(text) and text[last + 1] in _WORD):
                    continue
                (strict if hard else soft).add(term)
        return strict, soft


def _by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct host and path with ``rule`` and ``rule_verdict``, for those that a rule fits."""
    named = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    )
    labels = named.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 1
    places = urls.select("host", "path").distinct().where("host <> ''")
    parts = F.split("host", r"\.")
    steps = F.sequence(F.lit(1), F.least(F.lit(labels), F.size(parts)))
    suffixes = places.withColumn("n", F.explode(steps)).select(
        "host", "path", F.expr("substring_index(host, '.', -n)").alias("rule_host"),
        F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).alias("salt"),
    )
    salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("all"), F.length("rule_host").alias("of_host"),
        (F.col("rule_verdict") == "block").alias("blocks"), "rule_host", "rule_path", "rule_verdict",
    )
    return (
        suffixes.join(salted, ["rule_host", "salt"])
        .where(F.startswith("path", "rule_path"))
        .groupBy("host", "path").agg(F.max(rank).alias("best"))
        .select("host", "path", F.concat("best.rule_host", "best.rule_path").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict"))
    )


def judge(
    pages: DataFrame, rules: list[Rule] | DataFrame, vocabulary: Vocabulary = JUNK,
    id_col: str = "page_id", url_col: str = "url", rule_bytes: int = RULE_BYTES,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the terms found with their counts.

    ``rules`` are a list, or a table of host, path, verdict of any size; tables of up
    to ``rule_bytes`` go to the tasks as a list, larger ones are joined.
    """
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url")).select("page_id", "url", _rest(F.col("url")).alias("rest"))
    urls = rest.select(
        "page_id", "url", F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), _UPPER, _LOWER).alias("host"),
        F.regexp_extract(F.regexp_replace("rest", "^[^/?#]*", ""), "^[^?#]*", 0).alias("path"),
    )
    few: list[Rule] = []
    if isinstance(rules, DataFrame):
        size = rules.agg(F.sum(F.length("host") + F.length("path") + F.lit(64))).first()[0] or 0
        if size <= rule_bytes:
            few = [Rule(r.host, r.path, r.verdict) for r in rules.select("host", "path", "verdict").collect()]
            ruled = urls.withColumns({"rule": F.lit(None).cast("string"), "rule_verdict": F.lit(None).cast("string")})
        else:
            ruled = urls.join(_by_join(urls, rules), ["host", "path"], "left")
    else:
        few = list(rules)
        ruled = urls.withColumns({"rule": F.lit(None).cast("string"), "rule_verdict": F.lit(None).cast("string")})

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(few, vocabulary)
        for batch in batches:
            out = {name: [] for name in ("rule", "verdict", "strict_hits", "soft_hits", "terms")}
            columns = (batch.column(c).to_pylist() for c in ("url", "host", "path", "rule", "rule_verdict"))
            for text, host, path, rule, verdict in zip(*columns):
                found = matcher.rule(host, path) if rule is None else None
                if found is not None:
                    rule, verdict = found.host + found.path, found.verdict
                strict, soft = matcher.hits(text)
                if rule is None:
                    verdict = "block" if strict or len(soft) >= vocabulary.soft_least else "allow"
                for name, value in zip(out, (rule, verdict, len(strict), len(soft), sorted(strict | soft))):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(out["rule"], pa.string()),
                    pa.array(out["verdict"], pa.string()), pa.array(out["strict_hits"], pa.int64()),
                    pa.array(out["soft_hits"], pa.int64()), pa.array(out["terms"], pa.list_(pa.string())),
                ],
                names=["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "terms"],
            )

    return ruled.select("page_id", "url", "host", "path", "rule", "rule_verdict").mapInArrow(verdicts, JUDGED)
