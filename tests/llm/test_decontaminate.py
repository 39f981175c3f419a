import random

from kinlink.llm import decontaminate as d

ITEM = "The shop sold apples. Alice bought 12 apples for 3 dollars and then Alice gave 4 apples to Bob who already had 7 apples at home"
BENCH = "item_id bigint, text string"


def _swap(text, **to):
    for k, v in to.items():
        text = text.replace(k.strip("_"), v)
    return text


def test_template():
    tokens, values = d.canonical("He paid Mary Ann 1,200.50 dollars. Then 5 km and 7% of x")
    assert tokens == ["<name>", "paid", "<name>", "<num>", "<unit>", "<name>", "<num>", "<unit>", "and", "<num>", "<unit>", "of", "x"]
    assert [v for v in values if v] == ["he", "mary ann", "1,200.50", "dollars", "then", "5", "km", "7", "%"]
    assert d.canonical("") == ([], [])


def test_slots():
    index = d.build_index([(1, ITEM), (2, "too short"), (3, None)])
    found = lambda t: [m[0] for m in d.matches(t, index, d.Memo(), d.Anchors(index))]
    assert found(ITEM.lower()) == found(ITEM.upper()) == found(ITEM) == [1] and found("Before it. " + ITEM.upper()[:0] + ITEM + " and after") == [1]
    changed = _swap(ITEM, Bob="Max", _12="99", _4="5").replace("then Alice", "then Zoe").replace("Alice bought", "Zoe bought")
    [(_, _, share, differs)] = d.matches(changed, index, d.Memo(), d.Anchors(index))
    assert differs and share > 0.8
    assert found("A text about other things, which has nothing to do with the item that is looked for here") == []
    words = ITEM.split()
    assert found(" ".join(words[:9])) == []  # too small a part
    index = d.build_index([(1, "we saw that Alice met Bob and that Alice told Bob of what Alice and Bob had seen")], 0.9)
    swapped = "we saw that Carl met Dora and that Emil told Fred of what Gina and Hugo had seen"
    assert d.matches(swapped, index, d.Memo()) == []  # one name can't stand for three


def _plain(text, items):
    """Windows as tuples, item by item, for items whose slots are unchanged."""
    out = []
    for i, item in items:
        for names in (False, True):
            tokens, want = d.canonical(text, names)[0], d.canonical(item or "", names)[0]
            n = min(d.WINDOW, len(want))
            if n < d.LEAST_WORDS:
                continue
            mine = {tuple(tokens[k : k + n]) for k in range(len(tokens) - n + 1)}
            windows = [tuple(want[k : k + n]) for k in range(len(want) - n + 1) if d._literal(want, k, n)]
            if windows and sum(w in mine for w in windows) >= d.COVERAGE * len(windows):
                out.append(i)
                break
    return out


def test_hashes_follow_the_templates():
    for text in (ITEM, "", "A B c 5 Km 5 KM/h 12% Mr. Bob-Jones O'Hara x_y 7\n7 kg ﬁ İx", ITEM.upper(), ITEM.title()):
        hashes = d.template_hashes(text, d.Memo())
        for kind in (d.WORDS, d.NAMES):
            assert hashes[kind].tolist() == [d._hash(t) >> 4 for t in d.canonical(text, kind == d.NAMES)[0]]


def test_query_against_plain_windows(spark, small_dir):
    from kinlink.llm.queries import QUERIES

    docs = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    want = sorted((r["doc_id"], i) for r in docs for i in _plain(r["text"] or "", items))
    assert sorted((r["doc_id"], r["item_id"]) for r in QUERIES["op10_decontamination"](spark, small_dir).collect()) == want and want


def test_blocks_and_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, ITEM), (None, "alpha beta gamma delta epsilon zeta eta theta"), (3, None), (4, "")], BENCH)
    leak = edge_docs.unionByName(edge_docs.where("doc_id = 2").selectExpr("77L as doc_id", f"'Intro. {ITEM} End.' as text", "lang", "source", "n_chars", "fp", "score", "size", "seed", "_at", "repeats", "node"))
    want = [(8, None), (9, None), (9, None), (77, 1), (100, None)]
    for block_bytes in (1 << 20, 0):  # by index, by hash join
        got = sorted(((r["doc_id"], r["item_id"]) for r in d.contaminated(leak, bench, block_bytes=block_bytes).collect()), key=repr)
        assert got == sorted(want, key=repr)
        clean = d.drop_contaminated(leak, bench, block_bytes=block_bytes)
        assert clean.columns == leak.columns and sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted([5, 3, None, 2, 7, 1], key=repr)
    assert d.contaminated(no_docs, bench).count() == 0 and d.contaminated(leak, bench.where("false")).count() == 0


def test_anchors_lose_nothing(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    index = d.build_index([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()])
    anchors, memo = d.Anchors(index), d.Memo()
    for text in [r["text"] or "" for r in docs]:
        assert d.matches(text, index, memo, anchors) == d.matches(text, index, memo)


TOM = "Tom has 12 apples and gives 5 to Jane. How many apples does Tom have left?"


def test_each_occurrence_is_judged_by_itself():
    index = d.build_index([(1, TOM)])
    found = lambda t: d.matches(t, index, d.Memo(index.known), d.Anchors(index))
    variants = [
        "Ann has 30 apples and gives 7 to Zoe. How many apples does Ann have left?",
        "Bob has 20 apples and gives 9 to Carl. How many apples does Bob have left?",
        "Eve has 80 apples and gives 4 to Dan. How many apples does Eve have left?",
    ]
    for sheet in (variants[:2], variants, variants[::-1], [*variants, TOM], [TOM, *variants * 3]):
        for gap in (" ", "\n", " Some words stand between the two of them. "):
            [(item, _, share, _)] = found(gap.join(sheet))
            assert item == 1 and share == 1
    edited = [v.replace("gives", "then gives") for v in variants]
    alone = [found(e) for e in edited]
    assert [m[0][0] for m in alone] == [1, 1, 1]
    assert found(" ".join(edited))[0][2] >= alone[0][0][2]
    assert found(" ".join(v.split(".")[0] for v in variants[:1])) == found("Ann has apples. How many are left?") == []


SUMS = ["What is 12 + 34 * 5?", "Compute 12 + 34 * 5 - 7.", "Solve 3x + 5 = 20", "17 23 42 99 103 1,024", "Convert 5 km 7 m 12 cm 3 mm 9 kg 4 g and then 6 s to 8 h"]


def test_items_of_mostly_numbers(spark):
    index = d.build_index([*enumerate(SUMS), (7, "1 + 2"), (8, None)])
    anchors = d.Anchors(index)
    found = lambda t: [m[0] for m in d.matches(t, index, d.Memo(index.known), anchors)]
    for i, item in enumerate(SUMS):
        for text in (item, f"Exercise 4. {item}\nThe end", f"Before it {item.upper()} and after 5 of them"):
            assert found(text) == [i]
    # other numbers in the same sum are found as well, other signs aren't; numbers alone only as they are
    changed = lambda t: [(m[0], m[3]) for m in d.matches(t, index, d.Memo(index.known), anchors)]
    assert changed("What is 13 + 34 * 9? Compute 12 + 34 * 6 - 7. Solve 3x - 5 = 20, or 17 23 42 99 103 1,025") == [(0, True), (1, True)]
    assert changed("solve 7 x + 9 = 30") == [(2, True)] and changed("Solve 7x + 9 = 30 x")[0][1]
    assert found("---------------------- 12 ============ 34") == []
    # fewer than four words and numbers: as a whole line
    assert found("All of\n 1 + 2 \nthis") == [7] and found("All of 1 + 2 this") == found("1 + 3") == [] and index.unseen == [8]
    bench = spark.createDataFrame([*enumerate(SUMS), (7, "1 + 2"), (8, None)], BENCH)
    assert [r["item_id"] for r in d.not_looked_for(bench).collect()] == [8]
    docs = spark.createDataFrame([(i, f"Page {i}. {t} End.") for i, t in enumerate([*SUMS, "Nothing here"])] + [(6, "a\n1 + 2"), (6, "a\n1 + 2")], "doc_id bigint, text string")
    for block_bytes in (1 << 20, 0):
        assert sorted((r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench, block_bytes=block_bytes).collect()) == [*((i, i) for i in range(5)), (6, 7), (6, 7)]
        assert [r["doc_id"] for r in d.drop_contaminated(docs, bench, block_bytes=block_bytes).collect()] == [5]


def test_numeric_questions():
    for item in ("What is 12 + 7 * 3 - 4 ?", "Solve 3 x + 5 = 20"):
        index = d.build_index([(1, item)])
        find = lambda t: [(m[0], m[3]) for m in d.matches(t, index, d.Memo(index.known), d.Anchors(index))]  # noqa: E731, B023
        assert find(f"Here: {item} And so on.") == [(1, False)]
        assert find(item.replace("3", "81").replace("20", "99")) == [(1, True)]
        assert find(item.replace("+", "-")) == []


def test_both_joins_agree(spark, small_dir):
    """The hash join gives the rows of the index, on the query's table and on items with changed slots."""
    bench = spark.read.parquet(f"{small_dir}/benchmark.parquet").select("item_id", "text")
    more = [*((1000 + i, t) for i, t in enumerate([*SUMS, ITEM, TOM, TOM, "1 + 2", None, "long " * 30 + " ".join(f"w{i}x" for i in range(200))]))]
    bench = bench.unionByName(spark.createDataFrame(more, BENCH))
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    texts = [ITEM.replace("Alice", "Zoe"), TOM.replace("12", "99") + TOM, "\n".join(SUMS), TOM.lower(), " ".join(f"w{i}x" for i in range(20, 90)), "x\n1 + 2", ITEM[: len(ITEM) // 2], "What is 1 + 2 * 3?"]
    docs = docs.unionByName(spark.createDataFrame([(10**6 + i // 2, t) for i, t in enumerate(texts + texts[:3])] + [(None, TOM)], "doc_id bigint, text string"))
    one, two = (sorted(map(repr, d.contaminated(docs, bench, block_bytes=n).collect())) for n in (1 << 20, 0))
    assert one == two and len(one) > 10


def test_planted_variants():
    """Items with repeated names and numbers: copies whose values are replaced one for one are found, those in which each place gets a value of its own aren't."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 7)))
    names = ["Ann", "Bob", "Carl", "Dora", "Emil", "Fred", "Gina", "Hugo", "Ida", "Jack"]
    right = wrong = 0
    for n in range(60):
        shape = [word() if k % 4 else ("name" if rng.random() < 0.5 else "number", rng.randrange(2)) for k in range(rng.randint(60, 90))]
        fill = lambda of: " ".join(x if isinstance(x, str) else of(x) for x in shape)  # noqa: E731, B023
        one_for_one = lambda taken: fill(lambda x: taken[x])
        draw = lambda x: rng.choice(names) if x[0] == "name" else str(rng.randint(10, 10**6))
        values = lambda: dict(zip([("name", 0), ("name", 1), ("number", 0), ("number", 1)], [*rng.sample(names, 2), *map(str, rng.sample(range(10, 10**6), 2))], strict=True))
        item = one_for_one(values())
        index = d.build_index([(n, item)])
        find = lambda t: [m[0] for m in d.matches(f"Before it, {t} and after", index, d.Memo(index.known), d.Anchors(index))]  # noqa: E731, B023
        right += find(one_for_one(values())) == [n]
        wrong += find(fill(draw)) == [n]
        assert find(item) == [n]
    assert right == 60 and wrong == 0


def test_passage_of_a_long_item():
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500)]
    index = d.build_index([(1, " ".join(words))])
    anchors = d.Anchors(index)
    found = lambda a, b: [m[0] for m in d.matches("Before it " + " ".join(words[a:b]) + " and after", index, d.Memo(index.known), anchors)]
    for a in range(0, 351, 7):
        assert found(a, a + 150) == found(a, a + d.RUN + d.WINDOW - 1) == [1]
        assert found(a, a + d.RUN + d.WINDOW - 2) == []
    scattered = " ".join(w for at in range(0, 500, 50) for w in words[at : at + 15])  # 80 windows, none in a long run
    assert d.matches(scattered, index, d.Memo(index.known), anchors) == []
