import itertools
import math
import random
import re
from collections import Counter

import pytest

from kinlink.llm import url_filter as u


def _parse(url):
    m = re.search("://([^/?#]*)([^?#]*)", url or "", re.DOTALL)
    return ("".join(c.lower() if c.isascii() else c for c in m[1]), m[2]) if m else ("", "")


def _rule(host, path):
    fits = [r for r in u.QUERY_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/7x?q#f", "https://example.com/en/8", "http://x.net/de/1", "http://y.example.net/de/8/9", "https://org/es/", "http://notorg/es/", "http://a.org/es",
    "http://com/en/", "ftp://Ä.COM?x://y/z", "x://h#f/en/", "http://user@com/en/1", "http://www.cheap-pills.example.com/en/1", "http://cheappills.example.net/a", "http://casinowin.example.org/", "a://b://c/d", "http://h/p\n/q?x",
]


def test_judgement_on_edges(spark):
    df = spark.createDataFrame([(i, x, "h", 1) for i, x in enumerate(URLS)], "page_id bigint, url string, host string, score int").repartition(3)
    model = u.train(df, columns=("url",))
    got = {r["page_id"]: r for r in u.judge(df).collect()}
    for i, url in enumerate(URLS):
        host, path = _parse(url)
        rule = _rule(host, path)
        want = rule.verdict if rule else "block" if _plain_score(model, host, path) >= 0.5 else "allow"
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule and rule.text, want), url
    assert u.judge(df.where("false")).count() == 0


def test_rules_against_all_rules():
    book = u.RuleBook(u.QUERY_RULES)
    hosts = ["com", "example.com", "a.example.com", "net", "example.net", "xexample.net", "b.example.net", "org", "q.org", "", "a..com"]
    for h, p in itertools.product(hosts, ["", "/", "/en/", "/en/7", "/en/70", "/de/", "/de/8", "/de/80/x", "/es/", "/es"]):
        assert book.find(h, p) == _rule(h, p)


def _cuts(s):
    yield (s,)
    for i in range(1, len(s)):
        yield from ((*head, s[i:]) for head in _cuts(s[:i]))


def _cost(model, words):
    return sum(model.cutter.cost.get(w, model.cutter.unknown - len(w) * math.log(10)) for w in words)


def _plain_score(model, host, path):
    """Naive Bayes over the best of all cuts of each name."""
    names = re.findall(r"[^\W\d_]+", host.lower())
    words = [w for n in names for w in max(_cuts(n), key=lambda c: _cost(model, c))] + re.findall(r"[^\W\d_]+", path.lower())
    odds = 0.25 * math.prod(math.exp(model.weight.get(w, model.unseen)) for w in words)
    return odds / (1 + odds)


@pytest.fixture(scope="module")
def pages(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return u.train(pages)


def test_viterbi_is_the_best_cut(model):
    for name in ("cheapmeds", "dailynews", "pokerbets", "therwin", "artmuseum", "xwinx", "zzzz", "münchennews"):
        assert _cost(model, model.cutter.cut(name)) == pytest.approx(max(_cost(model, c) for c in _cuts(name))), name
    assert model.cutter.cut("cheapmeds") == ("cheap", "meds") and model.cutter.cut("pokerbets") == ("poker", "bets")
    assert u.decoded("www.xn--mnchen-3ya.de") == "www.münchen.de" and u.decoded("xn--\u0080.de") == "xn--\u0080.de"


def test_unigrams_count_all_words(spark, pages):
    want = Counter()
    for r in pages.collect():
        text = re.sub(r"<[^>]*>", " ", r["url"]) + " " + re.sub(r"<[^>]*>", " ", r["html"])
        want.update(w for w in re.split(r"[^\w]+|[\d_]+", text.lower()) if w and len(w) <= u.LONGEST)
    got = {r["word"]: r["n"] for r in u.unigrams(pages).collect()}
    assert got == dict(want)
    few = u.most_frequent(u.unigrams(pages), 50)
    assert 30 <= len(few) <= 50 and min(few.values()) >= sorted(want.values())[-60]


#: Well-known or plainly named sites whose addresses the model's words don't hold: unwanted ones, then ordinary ones.
HELD_OUT = (
    "pornhub.com xvideos-sex.com thepiratebay.org bet365.com viagra4u.net pokerstars.com 888casino.com mycanadianpharmacymeds.com cheaprolexreplicas.net torrentfreak-downloads.to"
    " warezbb.org hotmilfcams.xxx paydayloansnow.com seobacklinkservice.info onlinecasinobonus.net freexxxmovies.com adultwebcams.tv slotsofvegas.com".split(),
    "en.wikipedia.org nytimes.com github.com bbc.co.uk stackoverflow.com openstreetmap.org mit.edu/research nature.com washingtonpost.com allrecipes.com metmuseum.org weather.gov"
    " goodreads.com wolframalpha.com gutenberg.org bücherhallen.de 36kr.com lemonde.fr imdb.com archive.org".split(),
)


def test_held_out_sites(model):
    bad, good = ([model.score(*_parse(f"http://{x}")) >= 0.5 for x in part] for part in HELD_OUT)
    assert sum(bad) >= 15 and sum(good) <= 1, (bad, good)  # 16 of 18 and 19 of 20 are right


def test_clean_hosts_of_the_table_stay(model):
    for good in ("ththre", "dailynews", "openlibrary", "thering", "tiontion", ""):
        assert model.score(f"{good}.example.net", "/fr/9") < 0.5, good


def test_learns_from_labelled_rows(spark, pages):
    """Held-out accuracy on addresses of joined words, each class with words of its own and some of both."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(4, 8)))
    both, block, allow = ([word() for _ in range(30)] for _ in range(3))
    rows = []
    for i in range(600):
        label, own = (("block", block), ("allow", allow))[i % 2]
        rows.append((f"http://{rng.choice(own)}-{rng.choice(both)}.com/{rng.choice(own + both)}/{i}", label))
    rows += [("http://nothing.org/", "maybe"), (None, "block")]
    model = u.train(pages, spark.createDataFrame(rows, "url string, label string"))
    right = 0
    for i in range(200):
        label, own = (("block", block), ("allow", allow))[i % 2]
        right += (model.score(f"www.{rng.choice(own)}{rng.choice(both)}.net", f"/{rng.choice(both)}/{i}") >= 0.5) == (label == "block")
    assert right >= 190


def test_without_words(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    model = u.train(none)
    assert model.score("", "") == pytest.approx(0.2) and model.score("pokerbets.com", "/") > 0.5 and u.judge(none).count() == 0


def test_query(spark, small_dir):
    from kinlink.llm.queries import QUERIES

    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{small_dir}/pages.parquet").collect()}
    got = QUERIES["op9_url_filter"](spark, small_dir).collect()
    assert {r["page_id"]: (r["host"], r["path"]) for r in got} == {i: _parse(x) for i, x in urls.items()}
