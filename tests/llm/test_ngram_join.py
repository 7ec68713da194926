"""Similarity join: no link lost, against brute force."""

import random
import re

import numpy as np
import pytest

from strata.llm import ngram_join as J
from strata.llm.components import components, grown


def _sets(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return frozenset()
    n = min(width, len(w))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1))


def brute(rows, num, den, width):
    """(set size, least key of the component) of each row."""
    sets = [_sets(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for k, b in enumerate(sets[:i]):
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(k)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), key) if x is not None), default=None)
    return [(key, len(s), least[find(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))]


def _corpus(seed, n=140):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    while len(rows) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 12, 30, 60, 150, 600]))]
        if rng.random() < 0.3:
            base = shared + base
        for _ in range(rng.choice([1, 2, 6])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                i = rng.randrange(len(t) + 1)
                if rng.random() < 0.5 and t:
                    t[i % len(t)] = rng.choice(vocabulary)
                else:
                    t.insert(i, rng.choice(vocabulary))
            rows.append(" ".join(x.upper() if rng.random() < 0.05 else x for x in t))
    return list(enumerate(rows))


def _check(spark, rows, num, den, width, crowd=16):
    df = spark.createDataFrame([(k, t, 9, "x") for k, t in rows], "doc_id long, text string, n int, node string")
    got = J.join(df, params=J.Join(num, den, width, crowd=crowd)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r.doc_id, r.n, r.component) for r in got], key=key) == sorted(brute(rows, num, den, width), key=key)


@pytest.mark.parametrize("seed,num,den,width", [(1, 90, 100, 3), (2, 80, 100, 5)])
def test_random_corpus(spark, seed, num, den, width):
    _check(spark, _corpus(seed), num, den, width)


def _crowded(seed):
    """Crowds of 40 to 70 texts made from one base: chains of near copies,
    texts cut at either end, edits in many places; and crowds of unrelated
    texts around one long passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(600)}"
    texts = []
    for size, n, edits in ((60, 70, 3), (130, 50, 9), (40, 60, 2)):
        base = [word() for _ in range(size)]
        t = list(base)
        for k in range(n):
            kind = k % 4
            if kind == 0:  # each a little further from the base
                t = list(t)
                t[rng.randrange(len(t))] = word()
                texts.append(list(t))
            elif kind == 1:
                texts.append(base[rng.randrange(size // 3) :])
            elif kind == 2:
                texts.append(base[: size - rng.randrange(size // 3)])
            else:
                one = list(base)
                for _ in range(rng.randint(0, edits)):
                    i = rng.randrange(len(one))
                    one[i : i + 1] = rng.choice([[], [word()], [one[i], word()]])
                texts.append(one)
    passage = [word() for _ in range(55)]
    for _ in range(50):
        texts.append([word() for _ in range(rng.randint(0, 60))] + passage + [word() for _ in range(rng.randint(0, 60))])
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,num,width,crowd", [(1, 80, 5, 2), (2, 80, 5, 16), (3, 90, 3, 2), (4, 90, 3, 16)])
def test_crowds(spark, seed, num, width, crowd):
    _check(spark, _crowded(seed), num, 100, width, crowd)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(9000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "a b c"), (8, "A B C"), (None, "a b c"), (None, "only null"), (None, "only null"), (9, "rep"), (9, "rep"), (10, long), (11, long + " y"), (12, None)]
    _check(spark, rows, 90, 100, 3)


def test_empty_table(spark):
    assert J.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_similar_sets_share_a_signature():
    """The pigeonhole holds for every size, also with skipped segments and
    deletion neighbourhoods."""
    rng = np.random.default_rng(3)
    for num, den in ((90, 100), (80, 100)):
        j = J.Join(num, den)
        for n in [*range(1, 60), 200, 700, 1500, 6000]:
            for _ in range(3 if n > 100 else 10):
                a = rng.integers(0, 1 << 63, n).astype(np.uint64)
                cut = int(rng.integers(0, n // 4 + 1))
                b = np.concatenate([a[cut:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)])
                a, b = np.unique(a), np.unique(b)
                i = len(np.intersect1d(a, b))
                if len(b) and den * i >= num * (len(a) + len(b) - i) and len(a) + len(b) > 2 * i:
                    assert len(np.intersect1d(J.signatures(a, j), J.signatures(b, j))), (n, len(a), len(b), i)


def test_light_segments_are_made_up_for():
    """Sets of a large band that differ in many segments, one of them empty
    in both, still meet: the reserve segment is matched within a deletion."""
    j, rng, met = J.Join(), np.random.default_rng(1), 0
    for _ in range(60):
        a = np.unique(rng.integers(0, 1 << 63, 900).astype(np.uint64))
        b = a[np.sort(rng.permutation(len(a))[: len(a) - len(a) // 10])]
        i = len(b)
        if 100 * i >= 90 * len(a):
            met += 1
            assert len(np.intersect1d(J.signatures(a, j), J.signatures(b, j)))
    assert met > 30


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    # links that come later join components without going through all links
    half = len(links) // 2
    edges = lambda x: spark.createDataFrame(x, "a long, b long")
    for first, later in ((links[:half], links[half:]), ([], links), (links, []), (links, links[:9])):
        assert {r.node: r.root for r in grown(components(edges(first)), edges(later)).collect()} == got


def test_components_run_no_round_that_changes_nothing(spark, monkeypatch):
    from strata.llm import components as K
    rounds, one = [], K._round
    monkeypatch.setattr(K, "_round", lambda links: rounds.append(1) or one(links))
    edges = lambda x: spark.createDataFrame(x, "a long, b long")
    of = lambda x: {r.node: r.root for r in components(edges(x)).collect()}
    assert of([(1, 5), (6, 1), (2, 9), (9, 2), (4, 4)]) == {1: 1, 5: 1, 6: 1, 2: 2, 9: 2} and not rounds
    assert of([(1, 2), (2, 3)]) == {1: 1, 2: 1, 3: 1} and len(rounds) == 1
    assert of([(1, 3), (2, 3)]) == {1: 1, 2: 1, 3: 1} and len(rounds) == 2


def test_one_of_each_keeps_rows_and_columns(spark):
    rows = [(5, "a b c d e f", "de"), (3, "a b c d e f", "en"), (3, "a b c d e f", "en"), (8, "other words here and there", None), (None, "a b c d e f", "x"), (9, None, "n"), (10, "", "m"), (None, "lonely text of five words", "l"), (None, "lonely text of five words", "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = J.one_of_each(df, params=J.Join(80, 100, 5))
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[3], rows[5], rows[6], rows[7]], key=str)


def test_one_of_each_with_null_and_repeated_keys(spark):
    """Near copies without a key; a key of several different texts, one of
    them a near copy of another document."""
    text = lambda x: [f"{x}{i}" for i in range(60)]
    near = lambda x: [*text(x)[:-1], "other"]
    rows = [(None, text("a"), 0), (None, near("a"), 0), (7, text("b"), 1), (7, text("c"), 2), (8, text("d"), 3), (8, near("e"), 4), (5, text("e"), 4), (None, near("d"), 3), (None, text("f"), 5)]
    df = spark.createDataFrame([(k, " ".join(w), g) for k, w, g in rows], "doc_id long, text string, g int").repartition(4)
    got = J.one_of_each(df, params=J.Join(80, 100, 5)).collect()
    assert sorted((r.g, r.doc_id or 0) for r in got) == [(0, 0), (1, 7), (2, 7), (3, 8), (4, 5), (5, 0)]
    assert {r.text.split()[-1] for r in got if r.g in (3, 4)} == {"d59", "e59"}
