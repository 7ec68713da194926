"""Decontamination: exact verification and measured recall."""

import random

import numpy as np

from strata.llm import decontaminate as X


def sellers(item, region):
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for k, b in enumerate(region):
            new.append(min(row[k] + (a != b), row[k + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(1500):
        a, b = [rng.randrange(5) for _ in range(rng.randint(1, 9))], [rng.randrange(5) for _ in range(rng.randint(0, 15))]
        assert X.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64)) == sellers(a, b)
    long = np.arange(300, dtype=np.uint64)
    assert X.edit_distance(long, np.delete(long, [3, 200])) == 2


def _edited(rng, words, k):
    w = list(words)
    for _ in range(k):
        i = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[i] = f"z{rng.randrange(10**6)}"
        elif kind == 1:
            w.insert(i, f"z{rng.randrange(10**6)}")
        else:
            del w[i]
    return w


def _fixture(seed=1):
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(3000)}"
    items = [(i, [word() for _ in range(rng.choice([5, 9, 15, 30, 55, 120]))]) for i in range(60)]
    docs = []
    for d in range(260):
        body = [word() for _ in range(rng.choice([0, 20, 200]))]
        if d % 2:
            i, w = rng.choice(items)
            at = rng.randint(0, len(body))
            body[at:at] = _edited(rng, w, rng.randint(0, int(len(w) * 0.3)))
        docs.append((d, " ".join(x.upper() if rng.random() < 0.1 else x + rng.choice(["", ",", "."]) for x in body)))
    return items, docs


def _exact(items, docs):
    clean = lambda t: ["".join(c for c in x if c.isalnum()) for x in t.lower().split()]
    return {(d, i) for d, t in docs for i, w in items if sellers(w, clean(t)) <= X.budget(len(w), 0.8)}


def test_recall_and_precision(spark):
    items, docs = _fixture()
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, hits int, item_id string")
    got = {(r.doc_id, h.item_id) for r in X.find_items(df, bench).collect() for h in r.hits}
    want = _exact(items, docs)
    assert len(want) > 60
    assert not got - want  # every hit is verified
    assert len(got) >= 0.97 * len(want)
    blocks = X.find_items(df, bench, search=X.Search(block_words=500, passes=2)).collect()  # several passes find the same
    found = {(r.doc_id, h.item_id) for r in blocks for h in r.hits}
    assert not found - want and len(found) >= 0.97 * len(want)
    kept = X.clean(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_tables_reach_the_recall():
    items, _ = _fixture(2)
    index = X.Index.build([(i, " ".join(w)) for i, w in items], X.Search())
    assert 1 < index.tables < X.Search().max_tables


def test_long_items_among_many_short_ones():
    """Copies of long items are all found with an edit in each piece but one."""
    rng = random.Random(4)
    word = lambda: f"v{rng.randrange(3000)}"

    def spread(w):
        pieces, out = X.budget(len(w), 0.8) + 1, []
        intact = rng.randrange(pieces)
        for p in range(pieces):
            one, kind = list(w[p * len(w) // pieces : (p + 1) * len(w) // pieces]), rng.randrange(3)
            if p != intact:
                one[1 : 1 + (kind > 0)] = [f"z{rng.randrange(10**6)}"] * (kind < 2)
            out += one
        return out

    sizes = [12] * 300 + [250, 500, 1000]
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate(sizes)]
    docs = []
    for i, w in items[300:]:
        for _ in range(10):
            pad = [word() for _ in range(rng.randrange(300))]
            docs.append((len(docs), " ".join([*pad, *spread(w), *pad])))
    index = X.Index.build([(i, " ".join(w)) for i, w in items], X.Search())
    got = {(d, x["item_id"], x["distance"]) for (d, _), found in zip(docs, index.hits(X.pa.array([t for _, t in docs])), strict=True) for x in found}
    want = {(d, i, e) for d, t in docs for i, w in items[300:] if (e := X.edit_distance(*[X.word_hashes(X.pa.array([" ".join(x)]))[0] for x in (w, t.split())])) <= X.budget(len(w), 0.8)}
    assert len(want) == len(docs) and got == want


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, "too short"), (None, "one two three four five six seven")], "item_id long, text string")
    docs = [(1, None), (2, ""), (3, "ALPHA beta, gamma delta epsilon zeta"), (3, "ALPHA beta, gamma delta epsilon zeta"), (None, "x " * 50_000 + "alpha beta gamma delta epsilon zeta"), (5, "too short"), (6, "one two three four five six seven")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [(r.doc_id, [(h.item_id, h.distance) for h in r.hits]) for r in X.find_items(df, bench).collect()]
    twice = [(1, 0), (1, 0)]
    assert sorted(got, key=str) == sorted([(1, []), (2, []), (3, twice), (3, twice), (None, twice), (5, []), (6, [(None, 0)])], key=str)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert X.find_items(none, bench).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert all(r.hits == [] for r in X.find_items(df, empty).collect())
    assert X.clean(df, empty).count() == len(docs)


def test_query_finds_all_passages(spark):
    """Against all windows around all anchors, verified exactly."""
    from strata.llm.queries import op9_decontaminate

    sf = "/root/testdata/sf0.01"
    got = {(r.doc_id, i) for r in op9_decontaminate(spark, sf).collect() for i in r.item_ids}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    want = set()
    for d, t in docs:
        words = clean(t)
        seen = set(words)
        for i, x in items:
            w = clean(x)
            # a cheap bound first: too many words of the item are missing
            if sum(y not in seen for y in w) <= X.budget(len(w), 0.8) and sellers(w, words) <= X.budget(len(w), 0.8):
                want.add((d, i))
    assert want and got == want


def _least_cost(cost, size, pieces):
    """Every choice of separate grams, tried out."""
    def go(at, left):
        if not left:
            return 0.0
        return min((c[o] + go(o + q, left - 1) for q, c in cost.items() for o in range(at, size - q + 1)), default=float("inf"))

    return go(0, pieces)


def test_pieces_are_the_rarest_ones():
    rng = random.Random(9)
    for _ in range(150):
        size = rng.randint(1, 9)
        pieces = rng.randint(1, min(size, 4))
        cost = {q: np.array([float(rng.choice([1, 2, 5, 50])) * X.PIECE_COST[q] for _ in range(max(0, size - q + 1))]) for q in X.PIECE_COST}
        got = X._pieces(cost, size, pieces)
        assert len(got) == pieces and all(o + q <= p for (o, q), (p, _) in zip(got, got[1:], strict=False)) and got[-1][0] + got[-1][1] <= size
        assert sum(cost[q][o] for o, q in got) == _least_cost(cost, size, pieces)
    long = {q: np.ones(1300 - q + 1) for q in X.PIECE_COST}
    got = X._pieces(long, 1300, 261)
    assert len(got) == 261 and all(o + q <= p for (o, q), (p, _) in zip(got, got[1:], strict=False))


def test_items_with_a_shared_opening():
    """Thousands of items that start alike: a text full of such openings
    gives few windows, and edited copies are found all the same."""
    rng = random.Random(6)
    opening = "which of the following statements is".split()
    word = lambda: f"v{rng.randrange(20_000)}"
    items = [(i, " ".join([*opening, *[word() for _ in range(12)]])) for i in range(4000)]
    filler = " ".join(x for _ in range(500) for x in [*opening, word(), word()])
    copies = [" ".join([*[word() for _ in range(9)], *_edited(rng, t.split(), 3), *[word() for _ in range(9)]]) for _, t in items[:200]]
    few, many = (X.Index.build(items[:n], X.Search()) for n in (500, 4000))
    count = lambda x: sum(len(w[0]) for w in x.windows(*X.word_hashes(X.pa.array([filler]))))
    assert count(many) < 20_000
    assert count(few) < 20_000
    got = [{h["item_id"] for h in found} for found in many.hits(X.pa.array(copies))]
    want = [sellers(items[i][1].split(), c.split()) <= 3 for i, c in enumerate(copies)]
    assert all(want) and sum(i in found for i, found in enumerate(got)) >= 0.98 * len(copies)


def test_windows_come_in_batches(monkeypatch):
    items, docs = _fixture(5)
    index = X.Index.build([(i, " ".join(w)) for i, w in items], X.Search())
    texts = X.pa.array([t for _, t in docs])
    whole = index.hits(texts)
    monkeypatch.setattr(X, "BATCH", 7)
    assert max(len(set(w[3].tolist())) for w in index.windows(*X.word_hashes(texts))) <= 7
    assert index.hits(texts) == whole
