import itertools
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinlink.llm import licenses as lic


def _words(text):
    return re.findall(r"[^\W_]+(?:\.[^\W_]+)*\+?", text.lower())


def _pairs(words):
    return Counter(zip(words, words[1:], strict=False))


def _brute(text, threshold, templates=lic.TEMPLATES):
    """Every run of sentences against every template, without bounds; shares no code with the operator."""
    made = [(n, _pairs(_words(t))) for n, t in templates]
    sentences, at = [], 0
    for line in text.split("\n"):
        edges = [0, *(m.end() for m in re.finditer(r"[.;!?]\s+(?=\S)", line)), len(line)]
        sentences += [(at + a, _words(line[a:b])) for a, b in zip(edges, edges[1:], strict=False)]
        at += len(line) + 1
    sentences = [x for x in sentences if x[1]]
    longest = max(b.total() for _, b in made) * (2 - threshold) / threshold
    best = {}
    for i, (start, _) in enumerate(sentences):
        run = []
        for _, more in sentences[i:]:
            run += more
            if len(run) - 1 > longest:
                break
            own = _pairs(run)
            scored = [(2 * (own & b).total() / max(1, own.total() + b.total()), n) for n, b in made if b]
            top = max(d for d, _ in scored)
            for d, n in scored:
                if d == top and d >= threshold and (n not in best or (-d, start) < (-best[n][0], best[n][1])):
                    best[n] = (d, start)
    return [(n, d, at) for n, (d, at) in sorted(best.items())]


def test_bounds_lose_nothing(spark, small_dir, edge_docs):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect() + edge_docs.where("doc_id <> 7").collect()]
    texts += [t for _, t in lic.TEMPLATES]
    texts += [f"Intro words.\n\n{a} And more.\n{b}\n\nTail" for (_, a), (_, b) in itertools.islice(itertools.combinations(lic.TEMPLATES, 2), 0, 300, 17)]
    made = lic.Templates()
    for threshold in (0.6, 0.8):
        for t in texts[:: 10 if threshold == 0.8 else 30]:
            if len(t) < 3000:
                assert lic.scan(t, made, threshold) == _brute(t, threshold)


def test_templates_find_themselves():
    made = lic.Templates()
    for name, text in lic.TEMPLATES:
        assert (name, 1.0, 0) in lic.scan(text, made, 0.8)
        assert name in {n for n, _, _ in lic.scan("Some first line.\n" + text.upper() + "\nAnd a last one.", made, 0.8)}
    assert lic.scan("nothing of the kind here", made, 0.8) == []


def test_operator(spark, edge_docs, no_docs):
    docs = edge_docs.unionByName(edge_docs.where("doc_id = 2").selectExpr("doc_id", "'x\\nReleased under the MIT License.\\ny' as text", "lang", "source", "n_chars", "fp", "score", "size", "seed", "_at", "repeats", "node"))
    assert [tuple(r) for r in lic.licence_hits(docs).collect()] == [(2, "MIT", 1.0, 2)]
    assert lic.licence_hits(no_docs).count() == 0
    assert lic.licence_hits(docs.unionAll(docs)).count() == 2


def test_query(spark, small_dir):
    from kinlink.llm.queries import QUERIES

    made = lic.Templates()
    want = sorted((r["doc_id"], *h) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect() for h in lic.scan(r["text"] or "", made, lic.THRESHOLD))
    assert sorted(map(tuple, QUERIES["op6_license_scan"](spark, small_dir).collect())) == want and want


def _wrapped(text, width=72):
    import textwrap

    return "\n".join(textwrap.wrap(text, width))


def test_long_licences_inside_long_texts():
    made = lic.Templates()
    prose = "The quick walk led them past the mill. Nobody spoke of it again until the evening came. Then they all went home.\n" * 30
    long = {name: text for name, text in lic.TEMPLATES if len(lic.words_of(text)) > 60}
    assert {"MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0", "GPL-2.0", "LGPL-3.0"} <= set(long)
    for name, text in long.items():
        parts = lic._SENTENCE.split(text)
        for inside in ("\n\n".join(parts), "\n\n".join(map(_wrapped, parts)), _wrapped(text), "\n".join(parts), text):
            for around in (f"{prose}\n\n{inside}\n\n{prose}", f"{prose}\n{inside}\n{prose}", f"{prose[:-1]} {inside} {prose}"):
                assert name in {n for n, _, _ in lic.scan(around, made, 0.8)}, (name, around)
    mit = long["MIT"].split(": ", 1)[0] + ":", "The above" + long["MIT"].split("The above")[1].split(" THE SOFTWARE IS")[0], lic._WARRANTY
    text = f"{prose}\nMIT License\n\nCopyright (c) 2020 A. Writer\n\n" + "\n\n".join(map(_wrapped, mit)) + f"\n\n{prose}"
    assert lic.scan(text, made, 0.8) == [("MIT", 1.0, text.index("Permission is"))]
    assert lic.scan(prose, made, 0.8) == []
    assert lic.scan(f"{prose}Copyright 2020 A. Writer Ltd. All rights reserved.\n{prose}", made, 0.8)[0][0] == "Proprietary"
    many = "All rights reserved.\n" * 20_000
    assert lic.scan(many, made, 0.8)[0] == ("Proprietary", 1.0, 0)


def test_every_template_wrapped_in_paragraphs():
    """Each template in wrapped lines and paragraphs inside a text, against all runs of sentences."""
    made = lic.Templates()
    for name, text in lic.TEMPLATES:
        inside = "\n\n".join(_wrapped(x, 40) for x in lic._SENTENCE.split(text))
        whole = f"One thing. Another of the kind.\n\n{inside}\n\nThe end of it. It was."
        found = lic.scan(whole, made, 0.8)
        assert found == _brute(whole, 0.8) and name in {n for n, _, _ in found}


def test_full_licence_texts_as_a_table(spark):
    folder = Path("/usr/share/common-licenses")
    texts = [(n, (folder / n).read_text(errors="replace")) for n in ("GPL-3", "GPL-2", "Apache-2.0", "MPL-2.0") if (folder / n).exists()]
    if not texts:
        pytest.skip("no licence texts on this machine")
    table = spark.createDataFrame([*texts, ("none", None), (None, "x y")], "licence string, text string")
    prose = "They went down the long road to the mill. It was late.\n" * 20
    docs = spark.createDataFrame([(i, f"{prose}\n{t}\n\n{prose}") for i, (_, t) in enumerate(texts)] + [(9, prose)], "doc_id bigint, text string")
    got = {(r["doc_id"], r["licence"]): r for r in lic.licence_hits(docs, templates=table).collect()}
    assert {k for k, r in got.items() if r["dice"] > 0.99} == {(i, n) for i, (n, _) in enumerate(texts)}
    with pytest.raises(ValueError, match="more than"):
        lic.licence_hits(docs, templates=table.select("licence", F.repeat("text", 2000).alias("text")))
