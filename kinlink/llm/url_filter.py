"""URL filters: rules for hosts and paths first, then a word model of host and path.

A host's names are cut into words by unigram Viterbi (a concatenated name is several words), and multinomial naive Bayes
scores the words of host and path. The unigrams are counted over all words of the pages themselves (their texts and
addresses; ``unigrams``), mixed with the words of the labelled rows. Naive Bayes learns from labelled addresses: a table of any size with
``url, label`` (``train``), or, where none is given, the words of ``TOPICS``. Words that training never met get the
smoothed weight of an unseen word, whatever script they are in; digits separate words, and punycode is decoded.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.llm.common import materialize, release, small_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labelled words for the model where no labelled addresses are given: what unwanted and ordinary sites are about. Words of both say nothing.
TOPICS: dict[str, tuple[str, ...]] = {
    "block": (
        "porn porno xxx sex sexy nude cams adult erotic hentai fetish milf escort escorts hookup",
        "casino casinos poker slots bet bets betting jackpot roulette blackjack gamble gambling bingo wager bookmaker",
        "viagra cialis levitra pills pill pharmacy meds tramadol xanax steroids",
        "torrent torrents warez crack cracked keygen pirate pirated nulled serials",
        "spam seo backlinks ads adserver popup popunder popups clickbait tracker doorway",
        "payday replica replicas rolex counterfeit phishing malware spyware ransomware cheats doubler miracle cheap",
        "free win click track links cash money online best loans hack drugs farm bonus watch blog shop store",
    ),
    "allow": (
        "news world today daily times post journal sports weather politics business press radio",
        "school university college library history science math lessons course research study institute academy",
        "city council town state public health hospital clinic doctor government law police",
        "code docs software project data open source manual guide wiki forum developer cloud hub lab systems",
        "music art museum film review cinema books book poetry theater photo gallery",
        "garden home recipes food kitchen travel hotel maps bike family kids game games puzzles birds",
        "articles people events about contact archive community bank insurance jobs company group studio",
        "free win click track links cash money online best loans hack drugs farm bonus watch blog shop store",
    ),
}
THRESHOLD = 0.5
BLOCK_PRIOR = 0.2
SMOOTHING = 0.1  # added to every word's count in each class
LABELLED_SHARE = 0.2  # of the unigrams' mass that the labelled rows' words have
VOCABULARY = 50_000  # the model keeps so many of the most frequent words at most
LONGEST = 24  # letters of a word
PIECE = 256  # letters of a name that are cut at once
MEMO = 1 << 14
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path; it fits the host and its subdomains and all paths that start with its path."""

    verdict: str
    text: str
    host: str = field(init=False)
    path: str = field(init=False)

    def __post_init__(self) -> None:
        host, slash, path = self.text.partition("/")
        object.__setattr__(self, "host", host)
        object.__setattr__(self, "path", slash + path)


#: The rules of the query.
QUERY_RULES = tuple(Rule(*r) for r in (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")))


class RuleBook:
    """Rules by host, so that an address looks at its own host's suffixes only."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.by_host: dict[str, list[Rule]] = {}
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict)):
            self.by_host.setdefault(r.host, []).append(r)

    def find(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits (equally long ones: the first by text)."""
        best, at = None, 0
        while True:
            for r in self.by_host.get(host[at:], ()):
                if path.startswith(r.path):
                    if best is None or len(r.text) > len(best.text):
                        best = r
                    break
            at = host.find(".", at) + 1
            if not at:
                return best


def words_in(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def decoded(host: str) -> str:
    """A host with its punycode labels decoded, where they can be."""
    if "xn--" not in host:
        return host
    out = []
    for label in host.split("."):
        try:
            out.append(label[4:].encode().decode("punycode") if label.startswith("xn--") else label)
        except UnicodeError:
            out.append(label)
    return ".".join(out)


class Cutter:
    """Cuts names into their likeliest words by the words' probabilities."""

    def __init__(self, probabilities: dict[str, float], total: float) -> None:
        self.cost = {w: math.log(p) for w, p in probabilities.items() if 0 < len(w) <= LONGEST}
        self.unknown = math.log(10 / max(total, 10.0))  # a word that was never seen: ten in all, and a tenth of that for each letter
        self._memo: dict[str, tuple[str, ...]] = {}

    def cut(self, name: str) -> tuple[str, ...]:
        """The likeliest words of a name of letters (ties: the longer last word); any part of it may be one unknown word."""
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            ways = []
            for start in range(end):
                n = end - start
                known = self.cost.get(name[start:end]) if n <= LONGEST else None
                ways.append((best[start][0] + (known if known is not None else self.unknown - n * math.log(10)), -start))
            score, start = max(ways)
            best.append((score, -start))
        out, at = [], len(name)
        while at:
            out.append(name[best[at][1] : at])
            at = best[at][1]
        return tuple(reversed(out))

    def host_words(self, host: str) -> tuple[str, ...]:
        """The words of a host; names of over ``PIECE`` letters, which no host has, are cut piece by piece. The last hosts are remembered."""
        if host not in self._memo:
            if len(self._memo) >= MEMO:
                self._memo.clear()
            self._memo[host] = tuple(w for name in words_in(decoded(host)) for at in range(0, len(name), PIECE) for w in self.cut(name[at : at + PIECE]))
        return self._memo[host]

    def words(self, host: str, path: str) -> list[str]:
        return [*self.host_words(host), *words_in(path)]


class UrlModel:
    """A cutter, and each word's weight: the log ratio of its smoothed probabilities in unwanted and in ordinary addresses.

    Counts of both classes are brought to one total before they are smoothed, so that a word that neither class has is as likely in both.
    """

    def __init__(self, cutter: Cutter, block: dict[str, int], allow: dict[str, int], block_prior: float = BLOCK_PRIOR) -> None:
        self.cutter = cutter
        totals = [sum(c.values()) for c in (block, allow)]
        rate = lambda c, w, total: math.log(c.get(w, 0) * sum(totals) / 2 / max(total, 1) + SMOOTHING)
        self.unseen = 0.0
        self.weight = {w: rate(block, w, totals[0]) - rate(allow, w, totals[1]) for w in {*block, *allow}}
        self.prior = math.log(block_prior / (1 - block_prior))

    def score(self, host: str, path: str) -> float:
        """The probability that an address is unwanted."""
        s = self.prior + sum(self.weight.get(w, self.unseen) for w in self.cutter.words(host, path))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, s))))


def most_frequent(counts: DataFrame, most: int) -> dict[str, int]:
    """The most frequent words of ``counts (word, n)``, ``most`` at most: those of the highest counts, by sixteenths of a power of two, that fit."""
    ranked = counts.withColumn("level", F.floor(F.log2("n") * 16))
    levels = sorted(((r["level"], r["count"]) for r in ranked.groupBy("level").count().collect()), reverse=True)  # under 1024 rows
    fits, least = 0, None
    for level, n in levels:
        if (fits := fits + n) > most:
            break
        least = level
    return {} if least is None else {r["word"]: r["n"] for r in ranked.where(F.col("level") >= least).select("word", "n").collect()}


def unigrams(pages: DataFrame, columns: tuple[str, ...] = ("url", "html")) -> DataFrame:
    """``(word, n)``: how often each word of up to ``LONGEST`` letters stands in the given columns of all rows, tags left out."""
    text = F.concat_ws(" ", *(F.regexp_replace(F.col(f"`{c}`").cast("string"), r"<[^>]*>", " ") for c in columns))
    words = pages.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word"))
    return words.where(F.length("word").between(1, LONGEST)).groupBy("word").agg(F.count("*").alias("n"))


def topic_rows(spark: SparkSession) -> DataFrame:
    """``TOPICS`` as labelled rows."""
    rows = [(f"x://{words.replace(' ', '-')}/", label) for label, topics in TOPICS.items() for words in topics]
    return spark.createDataFrame(rows, "url string, label string")


def train(pages: DataFrame, labelled: DataFrame | None = None, block_prior: float = BLOCK_PRIOR, columns: tuple[str, ...] = ("url", "html")) -> UrlModel:
    """A model of the words of ``pages`` (all rows are counted) and of ``labelled (url, label)`` with labels ``block`` and ``allow``; others are ignored.

    Both counts are made by all machines; the ``VOCABULARY`` most frequent words of each are kept.
    """
    labelled = topic_rows(pages.sparkSession) if labelled is None else labelled
    made = materialize(unigrams(pages, columns), "unigrams")
    total = made.agg(F.sum("n")).first()[0] or 0
    corpus = most_frequent(made, VOCABULARY)
    host, path = split_url(F.coalesce(F.col("url").cast("string"), F.lit("")))
    rows = labelled.where(F.col("label").isin("block", "allow")).select("label", host.alias("host"), path.alias("path"))
    # the words between a labelled host's marks are known before the cutter is, and make its names known to it
    plain = rows.select(F.explode(F.split(F.lower(F.concat_ws(" ", "host", "path")), r"[^\p{L}]+")).alias("word"))
    seeds = most_frequent(plain.where(F.length("word").between(1, LONGEST)).groupBy("word").agg(F.count("*").alias("n")), VOCABULARY)
    share, mass = (LABELLED_SHARE if corpus else 1.0), max(sum(seeds.values()), 1)
    chance = {w: share * seeds.get(w, 0) / mass + (1 - share) * corpus.get(w, 0) / max(total, 1) for w in {*seeds, *corpus}}
    cutter = Cutter(chance, max(total, mass))
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            met = Counter((label, w) for label, h, p in zip(*(c.to_pylist() for c in b.columns), strict=True) for w in cutter.words(h, p))
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in met], pa.string()) for i in (0, 1)] + [pa.array(list(met.values()), pa.int64())], names=["label", "word", "n"])

    counted = rows.mapInArrow(run, "label string, word string, n bigint").groupBy("label", "word").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "labelled-words")
    block, allow = (most_frequent(counted.where(F.col("label") == x), VOCABULARY) for x in ("block", "allow"))
    release(made, counted)
    return UrlModel(cutter, block, allow, block_prior)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address; both empty where there is no ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = QUERY_RULES, model: UrlModel | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for every row: the longest fitting rule's verdict, else the model's.

    ``rules`` (a list of hand-kept size) and the model (a bounded vocabulary; by default one that is trained on ``pages``) travel with the code; null urls and urls without ``://`` have empty host and path; repeated rows
    are kept; other columns are ignored. ``score`` is the model's probability of an unwanted site, for every row.
    """
    own = model or train(pages, columns=tuple(c for c in (url_col, "html") if c in pages.columns))
    host, path = split_url(F.coalesce(F.col(url_col).cast("string"), F.lit("")))
    names = ["page_id", "host", "path", "rule", "verdict", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = RuleBook(rules)
        for b in batches:
            rule, verdict, scores = [], [], []
            for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found, s = book.find(h, p), own.score(h, p)
                rule.append(found and found.text)
                verdict.append(found.verdict if found else "block" if s >= THRESHOLD else "allow")
                scores.append(s)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(scores, pa.float64())], names=names)

    small_batches(pages.sparkSession)
    slim = pages.select(F.col(id_col).cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    return slim.mapInArrow(run, "page_id bigint, host string, path string, rule string, verdict string, score double")
