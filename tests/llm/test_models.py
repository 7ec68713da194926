"""Toxicity, language ID and URL rules: held-out accuracy and odd rows."""

import math
import random
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import common, lang_ecoc, toxicity_ftrl, url_rules
from strata.llm.common import held_out
from strata.llm.queries import URL_RULES, op2_toxicity, op3_url_filter, op8_language_id

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    rows = op8_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(test) > 250
    assert np.mean([r.lang == r.lang_pred for r in test]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_sample_stays_off_the_driver(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("the sample came to the driver")

    monkeypatch.setattr(lang_ecoc, "_logistic", refused)  # the tasks have modules of their own
    df = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr")], "doc_id long, text string, lang string")
    monkeypatch.setattr(type(df), "toPandas", refused)
    model = lang_ecoc.fit(df)
    assert model.languages == ("en", "fr") and model.weights.shape == (1 + 2**12, 1)


def test_codewords_are_apart():
    for k in (2, 3, 4, 6, 12, 40):
        code = lang_ecoc.codewords(k)
        assert code.shape[0] == k
        apart = min((code[a] != code[b]).sum() for a, b in combinations(range(k), 2))
        assert apart >= max(1, code.shape[1] // 3 if k > 6 else (code.shape[1] + 1) // 2)


def test_decoding_mends_a_wrong_bit():
    code = lang_ecoc.codewords(4)
    model = lang_ecoc.Model(tuple("abcd"), code, np.full(code.shape, 1 / code.shape[1]), np.zeros((1, 1)), 1, 0.05)
    for k in range(4):
        for b in range(code.shape[1]):
            f = 3.0 * code[k].astype(float)
            f[b] *= -1
            best, score, ambiguous = lang_ecoc.decode(model, f[None])
            assert best[0] == k and not ambiguous[0] and score[0] > 0.5
    assert lang_ecoc.decode(model, np.zeros((1, code.shape[1])))[2][0]


def test_language_odd_rows(spark):
    df = spark.createDataFrame([(1, "the cat and the dog", "en", 0.5), (2, "le chat et le chien", "fr", 0.5), (3, None, "en", 0.5), (4, "", None, 0.5), (5, "123 !?", "fr", 0.5), (5, "123 !?", "fr", 0.5), (None, "the dog " * 200_000, None, 0.5)], "doc_id long, text string, lang string, score double")
    model = lang_ecoc.fit(df)
    got = {(r.doc_id, r.lang_pred) for r in lang_ecoc.predict(df, model).collect()}
    assert got == {(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (None, "en")}
    assert lang_ecoc.predict(df, model).count() == 7
    kept = lang_ecoc.identified(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, 2, None}
    none = df.limit(0)
    assert lang_ecoc.fit(none) is None
    assert {r.lang_pred for r in lang_ecoc.predict(df, None).collect()} == {"und"}
    assert lang_ecoc.predict(none, model).count() == 0
    one = lang_ecoc.fit(df.where("lang = 'en'"))
    assert {r.lang_pred for r in lang_ecoc.predict(df.where("doc_id < 3"), one).collect()} == {"en"}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = op2_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    score, toxic = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    order = np.empty(len(rows))
    order[np.argsort(score)] = np.arange(1, len(rows) + 1)
    n = toxic.sum()
    auc = (order[toxic == 1].sum() - n * (n + 1) / 2) / (n * (len(rows) - n))
    assert auc > 0.93
    said = score >= 0.7
    assert (said & (toxic == 1)).sum() > 0.9 * said.sum()


def test_toxicity_sparse_and_odd_rows(spark):
    clean = [(i, f"good text number {i % 7} with some plain words", 0) for i in range(300)]
    bad = [(1000 + i, f"you vile fool number {i % 7} with some plain words", 1) for i in range(150)]
    df = spark.createDataFrame([*clean, *bad, (5000, None, 1), (5001, "x", None)], "doc_id long, text string, toxic int")
    model = toxicity_ftrl.fit(df)
    assert 0 < len(model.weights) < 60  # L1 leaves few weights
    probe = spark.createDataFrame([(1, "a vile fool", 0.0), (2, "some plain text", 0.0), (3, None, 0.0), (4, "", 0.0), (4, "", 0.0), (5, "vile " * 100_000, 0.0)], "doc_id long, text string, score double")
    got = {r.doc_id: r.score for r in toxicity_ftrl.score(probe, model).collect()}
    assert got[1] > 0.7 > got[2] and got[3] == got[4] and all(0 <= s <= 1 for s in got.values())
    none = toxicity_ftrl.fit(df.limit(0))
    assert {r.score for r in toxicity_ftrl.score(probe, none).collect()} == {0.5}
    assert toxicity_ftrl.score(probe.limit(0), model).count() == 0


def _host_path(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if c.isascii() else c for c in host), tail[:stop]


def _listed(host, path):
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


def _miner(rows, m):
    """Association rules by counting all token sets of one or two."""
    n = len(rows)
    count = {}
    for items, _ in rows:
        for t in items:
            count[t] = count.get(t, 0) + 1
    vocabulary = sorted((t for t in count if count[t] >= m.min_support * n), key=lambda t: (-count[t], t))[: m.max_tokens]
    with_label, sets = {}, {}
    for items, label in rows:
        known = [t for t in vocabulary if t in items][: m.max_items]
        for k in (1, 2):
            for c in combinations(sorted(known), k):
                sets[c] = sets.get(c, 0) + 1
                with_label[c, label] = with_label.get((c, label), 0) + 1
    rules = [(c, v, round(x / sets[c], 9), round(x / n, 9)) for (c, v), x in with_label.items() if x >= m.min_support * n and x / sets[c] >= m.min_confidence]
    kept = []
    for a, v, c, s in sorted(rules, key=lambda r: (len(r[0]), -r[2], -r[3], r[0])):
        if not any(set(b) <= set(a) and v == w and d >= c for b, w, d, _ in kept):
            kept.append((a, v, c, s))
    return kept


def test_url_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "no scheme"), (10**6 + 3, "HTTP://WWW.Example.COM/en/a?x=1#b"), (10**6 + 4, "http://com"), (10**6 + 5, "x://a.com://b/c"), (10**6 + 6, "http://net/fr/É?#"), (10**6 + 7, "http://" + "a" * 50_000 + ".org/b/c")], "page_id long, url string")
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").union(odd)
    host, path = url_rules.host_and_path(F.col("url"))
    rows = pages.withColumns({"host": host, "path": path}).withColumn("t", url_rules.tokens(F.col("url"), F.col("host"), F.col("path"))).collect()
    for r in rows:
        assert (r.host, r.path) == _host_path(r.url), r.url
    rule = {r.page_id: _listed(r.host, r.path) for r in rows}
    m = url_rules.UrlRuleMiner()
    mined = _miner([(r.t, rule[r.page_id].verdict) for r in rows if rule[r.page_id]], m)
    got = {r.page_id: r for r in url_rules.judge(pages, URL_RULES).collect()}
    for r in rows:
        if rule[r.page_id]:
            want = (rule[r.page_id].name, rule[r.page_id].verdict)
        else:
            fit = [x for x in mined if set(x[0]) <= set(r.t)]
            best = min(fit, key=lambda x: (-x[2], -x[3], " & ".join(x[0])), default=(None, "allow"))
            want = (None, best[1])
        assert (got[r.page_id].rule, got[r.page_id].verdict) == want, r.url
    assert len(got) == len(rows)
    assert {r.verdict for r in got.values()} == {"allow", "block"}


def test_url_rules_on_empty_and_clashing(spark):
    df = spark.createDataFrame([], "page_id long, url string, host int, verdict int")
    out = url_rules.judge(df, URL_RULES)
    assert out.count() == 0 and dict(out.dtypes)["verdict"] == "string"
    one = spark.createDataFrame([(1, "http://a.org/x", 3)], "page_id long, url string, host int")
    assert [(r.host, r.verdict) for r in url_rules.judge(one, URL_RULES).collect()] == [("a.org", "allow")]


def test_url_rules_are_bounded_by_support_and_confidence_alone(spark):
    """A sure rule of three tokens, rarer than eight others in its URLs; and
    one less sure than hundreds of redundant pairs."""
    common = [f"path:c{i}" for i in range(8)]
    three = [(common + [t for t, on in zip(("path:x", "path:y", "path:z"), s, strict=True) if on], "block" if all(s) else "allow") for s in product((0, 1), repeat=3) for _ in range(20)]
    model = url_rules.UrlRuleMiner().fit(spark.createDataFrame(three, "tokens array<string>, label string"))
    assert model.rules == ((("path:x", "path:y", "path:z"), "block", 1.0, 0.125),)
    rng = random.Random(5)
    many = [(["path:u1", "path:u2", "path:u3", *rng.sample([f"path:t{i}" for i in range(200)], 10)], "block") for _ in range(1000)]
    many += [(["path:r"], "allow" if i < 5 else "block") for i in range(100)]
    rows = spark.createDataFrame(many, "tokens array<string>, label string")
    model = url_rules.UrlRuleMiner().fit(rows)
    assert (("path:r",), "block", 0.95, round(95 / 1100, 9)) in model.rules
    assert len(model.rules) == 204 and all(len(a) == 1 for a, *_ in model.rules)
    with pytest.raises(ValueError, match="max_rules"):
        url_rules.UrlRuleMiner(max_rules=10).fit(rows)


def test_queries_cover_their_tables(spark):
    for query, table in ((op3_url_filter, "pages"), (op2_toxicity, "documents")):
        assert query(spark, "/root/testdata/sf0.001").count() == spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").count()
    assert held_out() is not None


@pytest.mark.parametrize("key", [None, 1, 2, 3, 4])
def test_one_key_holds_a_language(spark, key):
    """Half of all rows, a language of their own, under one id (or null):
    both languages are learnt, within the documented number of rows."""
    words = {"en": "the of and to in that it was for on with as".split(), "fr": "le la les des une est dans pour que qui sur pas".split()}
    rng = random.Random(1)
    rows = [(key if y == "en" else 100 + i, " ".join(rng.choice(words[y]) for _ in range(12)), y) for y in words for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    model = lang_ecoc.fit(df, params=lang_ecoc.Params(max_train_rows=200))
    assert model.languages == ("en", "fr")
    got = lang_ecoc.predict(df, model, keep=("lang",)).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.99
    hashed = df.select(F.col("lang").alias("y"), F.xxhash64("text").alias("o"))
    counts = {r.y: r["count"] for r in common.drawn(hashed, "y", "o", 200)[0].groupBy("y").count().collect()}
    assert counts == {"en": 200, "fr": 200}


def test_languages_are_bounded(spark):
    df = spark.createDataFrame([(i, f"word{i} text", f"l{i}") for i in range(12)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="max_languages"):
        lang_ecoc.fit(df, params=lang_ecoc.Params(max_languages=11))
    assert len(lang_ecoc.fit(df, params=lang_ecoc.Params(max_languages=12, max_sample_rows=12, max_train_rows=5)).languages) == 12


def test_decoding_equals_plain_loops(spark):
    model = lang_ecoc.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect() if r.text]
    got = {r.doc_id: r for r in lang_ecoc.predict(spark.createDataFrame([(r.doc_id, r.text) for r in docs], "doc_id long, text string"), model).collect()}
    for d in docs:
        v = lang_ecoc._counts(d.text, model.bits)
        if v is None:
            assert got[d.doc_id].lang_pred == "und"
            continue
        out = [sum(float(v[i]) * float(model.weights[i][b]) for i in np.flatnonzero(v)) + 0.3 * float(model.weights[-1][b]) for b in range(model.code.shape[1])]
        far = [model.code.shape[1] * sum(model.trust[k][b] * math.log1p(math.exp(-int(model.code[k][b]) * f)) for b, f in enumerate(out)) for k in range(len(model.languages))]
        p = sorted((math.exp(min(far) - x) for x in far), reverse=True)
        r = got[d.doc_id]
        assert r.lang_pred == model.languages[far.index(min(far))] and r.score == pytest.approx(p[0] / sum(p), abs=1e-5)
        if abs((p[0] - p[1]) / sum(p) - model.margin) > 1e-4:
            assert r.ambiguous == ((p[0] - p[1]) / sum(p) < model.margin)


def _plain_ftrl(rows, p):
    """FTRL-proximal by dictionaries, one coordinate at a time."""
    z, n = {}, {}

    def weight(i):
        l1 = 0.0 if i == "bias" else p.l1
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((p.beta + math.sqrt(n[i])) / p.alpha + p.l2)

    rng = np.random.default_rng(1)
    for order in [rng.permutation(len(rows)) for _ in range(p.epochs)]:
        for k in order:
            x, y = [*rows[k][0], "bias"], rows[k][1]
            w = {i: weight(i) for i in x}
            g = 1 / (1 + math.exp(-max(-30, min(30, sum(w.values()))))) - y
            for i in x:
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / p.alpha * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_toxicity_equals_plain_ftrl(spark):
    p = toxicity_ftrl.Ftrl(max_train_rows=150, l1=1.0, epochs=2)
    rng = random.Random(2)
    docs = [(i % 400, " ".join(rng.choice("you are a vile fool and this is a plain kind text of words".split()) for _ in range(rng.randint(1, 15)))) for i in range(900)]
    labels = [(i, int(i % 5 == 0)) for i in range(400)] + [(3, 0), (3, 0), (None, 1), (7, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    model = toxicity_ftrl.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"), params=p)
    hashes = {(r.doc_id, r.text): r.o for r in d.withColumn("o", F.xxhash64(F.lit("ftrl"), F.col("doc_id").cast("string"), F.col("text"))).collect()}
    named = {(y, hashes[k, t]): t for k, t in docs for i, y in labels if i == k and y is not None}
    few = [c for y in (0, 1) for c in sorted(c for c in named if c[0] == y)[:150]]
    few.sort(key=lambda c: (c[1], c[0]))
    x = list(toxicity_ftrl._features(pa.array([named[c] for c in few]), p.bits))
    want = _plain_ftrl([([int(i) for i in v], y) for v, (y, _) in zip(x, few, strict=True)], p)
    share = [min(1, 150 / sum(c[0] == y for c in named)) for y in (0, 1)]
    assert model.bias == pytest.approx(want.pop("bias") + math.log(share[0] / share[1]))
    assert dict(zip(model.coordinates.tolist(), model.weights.tolist(), strict=True)) == pytest.approx(want, rel=1e-4)
    score = {r.text: r.score for r in toxicity_ftrl.score(d.limit(50), model, keep=("doc_id", "text")).collect()}
    for t, s in score.items():
        f = model.bias + sum(want.get(int(i), 0.0) for i in next(iter(toxicity_ftrl._features(pa.array([t]), p.bits))))
        assert s == pytest.approx(1 / (1 + math.exp(-f)), abs=1e-5)


@pytest.mark.parametrize("key", [1, 2, 3])
def test_one_key_holds_a_third_of_the_labels(spark, key):
    clean = [(1000 + i, f"good text number {i} with some plain words", 0) for i in range(2000)]
    bad = [(key, f"you vile fool number {i} with some plain words", 1) for i in range(1000)]
    df = spark.createDataFrame([*clean, *bad], "doc_id long, text string, toxic int").repartition(6)
    labels = df.select("doc_id", "toxic")
    for model in (toxicity_ftrl.fit(df, params=toxicity_ftrl.Ftrl(max_train_rows=300)), toxicity_ftrl.fit(df.drop("toxic"), labels, params=toxicity_ftrl.Ftrl(max_train_rows=300))):
        got = toxicity_ftrl.score(df, model, keep=("toxic",)).collect()
        assert np.mean([(r.score >= 0.7) == (r.toxic == 1) for r in got]) > 0.99
