"""Text normalisation as Column expressions: names, addresses, countries.

Everything stays in the JVM but Unicode NFKC, which Spark lacks: an Arrow UDF sees only the texts that NFKC could
change (all others reach it as null).
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Legal forms that are stripped from names.
LEGAL_FORMS = (
    "incorporated", "corporation", "associates", "unlimited", "solutions", "holdings", "services", "partners", "group",
    "limited", "company", "corp", "inc", "ltd", "llc", "llp", "lllp", "lp", "plc", "pllc", "pc", "co", "gmbh", "ag", "sa",
    "sas", "bv", "nv", "pty", "pvt", "srl", "aps", "oy", "ab", "as",
)
#: Abbreviations in names, expanded in this order.
NAME_ABBREVIATIONS = (
    ("intl", "international"), ("nat'?l", "national"), ("mfg", "manufacturing"), ("mgmt", "management"), ("svcs", "services"),
    ("svc", "service"), ("tech", "technology"), ("dev", "development"), ("prod", "products"), ("pubs", "publications"),
    ("pub", "publication"), ("dist", "distribution"), ("corp", "corporation"),
)
#: Abbreviations in addresses, expanded in this order.
ADDRESS_ABBREVIATIONS = (
    ("st", "street"), ("ave", "avenue"), ("av", "avenue"), ("blvd", "boulevard"), ("rd", "road"), ("dr", "drive"), ("ln", "lane"),
    ("ct", "court"), ("ctr", "center"), ("pl", "place"), ("sq", "square"), ("hwy", "highway"), ("fwy", "freeway"),
    ("pkwy", "parkway"), ("expy", "expressway"), ("brg", "bridge"), ("trk", "track"), ("trce", "trace"), ("ste", "suite"),
    ("apt", "apartment"), ("fl", "floor"), ("flr", "floor"), ("bldg", "building"), ("rm", "room"), ("dept", "department"),
    ("n", "north"), ("s", "south"), ("e", "east"), ("w", "west"), ("ne", "northeast"), ("nw", "northwest"),
    ("se", "southeast"), ("sw", "southwest"),
)
#: Characters that NFKC leaves alone whatever stands beside them: ASCII and precomposed Latin letters.
NFKC_SAFE = r"^[\x00-\x7FÀ-ıĴ-ľŁ-ňŊ-ž]*$"
WORD = r"\p{L}\p{N}_"
_FORMS = "|".join(LEGAL_FORMS)


def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def nfkc(c: Column) -> Column:
    """Unicode NFKC; texts of safe characters never reach Python as more than a null."""
    return F.coalesce(F.pandas_udf(_nfkc, "string")(F.when(~c.rlike(NFKC_SAFE), c)), c)


def collapse(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def blank_to_null(c: Column) -> Column:
    return F.when(F.length(F.regexp_replace(c, r"(?U)\s+", "")) > 0, c)


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _expand(c: Column, table: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda x, p: F.regexp_replace(x, rf"(?U)\b{p[0]}\b", p[1]), table, c)


def name_punctuation(c: Column) -> Column:
    """``&`` becomes *and*; dots inside and after abbreviations go; other punctuation but the apostrophe separates."""
    c = F.regexp_replace(c, r"(?U)\s*&\s*", " and ")
    c = F.regexp_replace(c, r"(?<=[a-zA-Z])\.(?=[a-zA-Z])", "")
    c = F.regexp_replace(c, r"(?U)\.(?=\s|$)", "")
    return F.regexp_replace(F.regexp_replace(c, r"[-/|\\]", " "), rf"(?U)[^{WORD}\s']", " ")


def address_punctuation(c: Column) -> Column:
    """All punctuation but the hyphen separates."""
    return F.regexp_replace(F.regexp_replace(c, "[,.]", " "), rf"(?U)[^{WORD}\s\-]", " ")


def normalized_name(c: Column, fold: bool = True) -> Column:
    """The comparable form of a name, null if nothing is left of it. ``fold``: apply NFKC."""
    c = blank_to_null(c)
    c = collapse(F.lower(nfkc(c) if fold else c))
    c = _expand(name_punctuation(c), NAME_ABBREVIATIONS)
    c = F.regexp_replace(F.regexp_replace(c, rf"(?U)\b(?:{_FORMS})\.?\s*$", ""), r"[ .,;:\-]+$", "")
    c = F.regexp_replace(F.regexp_replace(c, rf"(?U)^(?:{_FORMS})\.?\s+", ""), r"^[ .,;:\-]+", "")
    return empty_to_null(collapse(c))


def sorted_tokens(c: Column) -> Column:
    """A text's tokens in order of their code points."""
    return F.array_join(F.array_sort(F.split(c, " ")), " ")


def normalized_address(c: Column, fold: bool = True) -> Column:
    """The comparable form of an address, null if blank."""
    c = blank_to_null(c)
    c = collapse(address_punctuation(F.lower(nfkc(c) if fold else c)))
    return empty_to_null(collapse(_expand(c, ADDRESS_ABBREVIATIONS)))


def title_case(c: Column) -> Column:
    """The first letter of each run of letters is upper case, the others lower case."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(0))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))), "")


def normalized_country(c: Column, fold: bool = True) -> Column:
    """A country in title case; any country is accepted; null if blank."""
    c = blank_to_null(c)
    return empty_to_null(title_case(collapse(nfkc(c) if fold else c)))
