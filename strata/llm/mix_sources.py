"""Mixing sources by temperature, realised as budgeted block permutations.

``temperature`` finds the exponent ``a`` in [0, 1] for the weights
``share ** a`` (normalised): the largest one whose weights reach the target
entropy, raised as far as needed to keep the most repeated source within
``max_repeats`` passes. Both conditions are monotone in ``a``, so the
interval is cut again and again; each round evaluates several cuts in one
aggregation over the source table, and only the sums reach the driver, so
the number of sources is not limited.

``plan`` gives each source its part of the token budget. A source's stream
is a sequence of passes, each a permutation of its documents by a keyed
hash; the last pass is cut where the budget ends. The stream is dealt to
blocks of equal parts, so every block of about ``block_tokens`` tokens holds
the sources by their weights. Prefix sums run in two levels, within hash
buckets of a bounded number of rows and over the bucket totals, so a hot
source is spread over many tasks.

Defined results: documents are told apart by key AND text, so rows with a
null or repeated key are placed one by one, and only rows that repeat source,
key and text are placed together; a null source is a source of its own;
documents without words count no tokens and are placed by their hash; whole
texts are counted, however long; sources without tokens get nothing; an empty
table gives an empty plan. ``mixed`` replaces input columns named ``epoch``,
``block`` or ``slot`` and keeps all others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    #: Least entropy of the weights, as a part of the largest possible one.
    entropy: float = 0.95
    max_repeats: float = 4.0
    #: Tokens to deal out; None: as many as the input holds.
    budget: int | None = None
    block_tokens: int = 1_000_000
    seed: int = 17
    #: Rows that one task sorts at a time.
    bucket_rows: int = 20_000
    #: Copies of the source table that spread a hot source over tasks.
    salts: int = 32


def _mark(text: str) -> Column:
    """What tells the texts of one key apart."""
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def temperature(shares: DataFrame, mix: Mix, repeats: float) -> float:
    """Exponent for ``shares`` (one row a source: ``p`` > 0). ``repeats`` is
    the budget in passes over the whole input."""
    n, least = shares.agg(F.count(F.lit(1)), F.min("p")).first()
    if not n or n == 1:
        return 1.0
    cuts, rounds = 16, 13  # 16 ** 13 steps: the precision of a double

    def search(holds, lo: float, hi: float) -> tuple[float, float]:
        """(last cut where it holds, first where not), it holding below."""
        for _ in range(rounds):
            at = [lo + (hi - lo) * k / cuts for k in range(1, cuts)]
            sums = []
            for k, a in enumerate(at):
                power = F.pow("p", F.lit(a))
                sums += [F.sum(power).alias(f"z{k}"), F.sum(power * F.log("p")).alias(f"m{k}")]
            row = shares.agg(*sums).first()
            good = [holds(a, row[f"z{k}"], row[f"m{k}"]) for k, a in enumerate(at)]
            k = good.index(False) if False in good else len(at)
            lo, hi = ([lo, *at][k], [*at, hi][k])
        return lo, hi

    target = mix.entropy * math.log(n)
    enough = lambda a, z, m: math.log(z) - a * m / z >= target  # noqa: E731  falls as a rises
    too_often = lambda a, z, m: repeats * least ** (a - 1) / z > mix.max_repeats  # noqa: E731  ends as a rises

    def sums_at(a: float) -> tuple[float, float, float]:
        row = shares.agg(F.sum(F.pow("p", F.lit(a))), F.sum(F.pow("p", F.lit(a)) * F.log("p"))).first()
        return a, row[0], row[1]

    a = 1.0 if enough(*sums_at(1.0)) else search(enough, 0.0, 1.0)[0]
    if a < 1 and too_often(*sums_at(a)):
        a = 1.0 if too_often(*sums_at(1.0)) else search(too_often, a, 1.0)[1]
    return a


def quotas(tokens: DataFrame, mix: Mix) -> tuple[DataFrame, dict]:
    """Per source: ``total``, ``quota`` and the share of each block, from
    ``tokens`` (source, tokens); and the figures of the mix."""
    per = staged(tokens.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("n")), "mix-sources")
    all_tokens, most = per.agg(F.sum("total"), F.max("n")).first()
    if not all_tokens:
        return per.select("source", "total", F.lit(0).cast("long").alias("quota"), F.lit(1).cast("long").alias("part")), {"alpha": 1.0, "budget": 0, "blocks": 0, "most": most or 0}
    budget = all_tokens if mix.budget is None else mix.budget
    shares = per.where(F.col("total") > 0).select((F.col("total") / F.lit(float(all_tokens))).alias("p"))
    a = temperature(shares, mix, budget / all_tokens)
    z = shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0]
    blocks = max(1, -(-budget // mix.block_tokens))
    weight = F.when(F.col("total") > 0, F.pow(F.col("total") / F.lit(float(all_tokens)), F.lit(a)) / F.lit(z)).otherwise(F.lit(0.0))
    out = per.withColumn("weight", weight).withColumn("quota", F.floor(F.col("weight") * F.lit(float(budget)) + F.lit(1e-6)))
    out = out.withColumn("part", F.greatest(F.ceil(F.col("quota") / F.lit(float(blocks))), F.lit(1)))
    return out.select("source", "total", "weight", "quota", "part"), {"alpha": a, "budget": budget, "blocks": blocks, "most": most}


def plan(docs: DataFrame, mix: Mix | None = None, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row a placement: ``source``, ``doc``, ``mark`` (the MD5 of the
    text), ``tokens``, ``epoch`` (the pass), ``block`` and ``slot`` (the
    order within a block)."""
    mix = mix or Mix()
    rows = staged(docs.select(F.col(source).alias("source"), F.col(key).alias("doc"), _mark(text).alias("mark"), words(F.col(text)).alias("tokens")), "mix-tokens")
    quota, figures = quotas(rows, mix)
    narrow = rows.groupBy("source", "doc", "mark").agg(F.sum("tokens").alias("tokens"))
    salted = quota.where(F.col("quota") > 0).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(mix.salts - 1)))).withColumnRenamed("source", "of")
    narrow = narrow.withColumn("salt", F.pmod(F.xxhash64("doc", "mark"), F.lit(mix.salts)).cast("int"))
    met = narrow.join(salted, (narrow["source"].eqNullSafe(salted["of"])) & (narrow["salt"] == salted["salt"]))
    last = F.floor((F.col("quota") - 1) / F.col("total"))
    passes = met.select("source", "doc", "mark", "tokens", "total", "quota", "part", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("epoch"))
    digits = max(0, math.ceil(math.log(max(1, figures["most"]) / mix.bucket_rows, 16))) if figures["most"] else 0
    slot = F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc").cast("string"), F.lit("")), F.col("mark")).cast("binary"))
    passes = passes.withColumn("slot", slot).withColumn("bucket", F.substring("slot", 1, digits) if digits else F.lit(""))
    here = Window.partitionBy("source", "epoch", "bucket")
    passes = passes.withColumn("within", F.sum("tokens").over(here.orderBy("slot").rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    if digits:
        totals = passes.groupBy("source", "epoch", "bucket").agg(F.sum("tokens").alias("held"))
        before = F.sum("held").over(Window.partitionBy("source", "epoch").orderBy("bucket")) - F.col("held")
        totals = totals.select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("bucket").alias("b"), before.alias("before"))
        passes = passes.join(totals, passes["source"].eqNullSafe(totals["s"]) & (passes["epoch"] == totals["e"]) & (passes["bucket"] == totals["b"]))
    else:
        passes = passes.withColumn("before", F.lit(0).cast("long"))
    end = F.col("epoch") * F.col("total") + F.col("before") + F.col("within")
    block = F.floor((end - F.col("tokens")) / F.col("part")).cast("long")
    return passes.where(end <= F.col("quota")).select("source", "doc", "mark", "tokens", "epoch", block.alias("block"), "slot")


def mixed(docs: DataFrame, mix: Mix | None = None, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The documents dealt out: every row with its ``epoch``, ``block`` and
    ``slot``, as often as its source's passes say."""
    p = plan(docs, mix, key, source, text).select(F.col("source").alias("__s"), F.col("doc").alias("__d"), F.col("mark").alias("__m"), "epoch", "block", "slot")
    taken = docs.drop("epoch", "block", "slot").withColumn("__mark", _mark(text))
    same = taken[key].eqNullSafe(p["__d"]) & taken[source].eqNullSafe(p["__s"]) & (taken["__mark"] == p["__m"])
    return taken.join(p, same).drop("__s", "__d", "__m", "__mark")
