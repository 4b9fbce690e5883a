import random

from hourcast.llm import decontaminate as D

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}, len(w)


def brute(docs, items):
    out = {}
    for i, item in items:
        n = shingles(item, 1)[1]
        if not n:
            continue
        k = min(5, n)
        mine = shingles(item, k)[0]
        for d, text in docs:
            shared = len(mine & shingles(text, k)[0])
            if shared >= 0.8 * len(mine):
                out[d, i] = max(out.get((d, i), (0, 0)), (len(mine), shared))
    return {(d, i, n, s) for (d, i), (n, s) in out.items()}


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return {tuple(r)[:4] for r in D.contamination(spark, d.selectExpr("*", "1 AS h", "2 AS item_id"), i).collect()}


def cases():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 3)))
    items = [(i, " ".join(word() for _ in range(rnd.choice([1, 2, 4, 5, 6, 9, 20, 40])))) for i in range(40)]
    items += [(40, None), (41, ""), (42, items[7][1]), (None, "some item with a null id here")]
    docs = []
    for d in range(200):
        text = [word() for _ in range(rnd.randint(0, 60))]
        if d % 3 == 0:
            passage = (items[d % 40][1]).split()
            if d % 2:
                passage[len(passage) // 2] = "changed"
            if d % 5 == 0:
                passage = [p.upper() for p in passage]
            at = rnd.randint(0, len(text))
            text[at:at] = passage
        docs.append((d, rnd.choice([" ", "\t", "\n "]).join(text)))
    long = [word() for _ in range(30_000)]
    long[15_000:15_000] = items[3][1].split() + items[6][1].split()
    return docs + [(300, " ".join(long)), (301, None), (302, ""), (0, docs[0][1]), (0, "other text"), (None, items[5][1])], items


def test_against_brute_force(spark):
    docs, items = cases()
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b c d e f")]) == set()
    assert run(spark, [(1, "a b c d e f")], []) == set()


def test_drop_contaminated_keeps_clean_rows(spark):
    docs, items = cases()
    bad = {(d, t) for d, t in docs if brute([(d, t)], items)}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = [tuple(r) for r in D.drop_contaminated(spark, df, spark.createDataFrame(items, "item_id long, text string")).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(kept, key=key) == sorted((r for r in docs if r not in bad), key=key)


def test_repeated_items_and_items_that_share_an_id(spark):
    a, b = "one two three four five six seven", "red green blue black white grey pink brown"
    docs = [(1, f"x {a} y"), (2, f"x {b} y"), (3, f"{a} z {b}"), (4, "x one two three y"), (None, a)]
    found = {1: 3, None: 3, 2: 4, 3: 4}             # shingles of the item found; of two whole ones the larger
    repeated = [(7, a), (7, a), (7, a)]
    assert run(spark, docs, repeated) == {(d, 7, 3, 3) for d in (1, 3, None)}
    for shared in ([(None, a), (None, b)], [(7, a), (7, b)], [(7, a), (7, a), (7, b)]):
        assert run(spark, docs, shared) == {(d, shared[0][0], n, n) for d, n in found.items()}
    for items in (repeated, [(None, a), (None, b)]):
        df = spark.createDataFrame(docs, "doc_id long, text string")
        kept = D.drop_contaminated(spark, df, spark.createDataFrame(items, "item_id long, text string"))
        assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == ([2, 4] if items == repeated else [4])


def test_recall_of_partial_copies_of_every_length(spark):
    """Items of 10 to 200 shingles of which documents hold a share around the threshold: all
    that hold enough are found, none that does not."""
    rnd = random.Random(12)
    word = lambda: f"w{rnd.randrange(4000)}"
    items, docs = [], []
    for i in range(220):
        words = [word() for _ in range(rnd.randrange(14, 205))]
        items.append((i, " ".join(words)))
        broken = list(words)
        for _ in range(rnd.choice([0, 0, 1, 2, len(words) // 30])):
            broken[rnd.randrange(len(words))] = "changed"
        filler = lambda: [word() for _ in range(rnd.choice([0, 20, 3000]))]
        docs.append((i, " ".join([*filler(), *broken, *filler()])))
    got = D.contamination(spark, spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string"))
    grams = lambda t: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)}
    shingles = {i: grams(t) for i, t in items}
    texts = {d: grams(t) for d, t in docs}
    want = {(d, i): len(s & g) for d, g in texts.items() for i, s in shingles.items() if len(s & g) >= 0.8 * len(s)}
    assert len(want) > 100 and any(len(shingles[i]) > 100 for _, i in want)
    assert {(r.doc_id, r.item_id): r.n_shared for r in got.collect()} == want
