"""URL filtering by host/path rules and mined association rules.

Listed rules decide first. For the rest, Spark's FP-growth mines
combinations of URL tokens together with the label (allow or block) that
the listed rules give; association rules with enough support and confidence
are kept, a rule that adds tokens to a kept one without being surer is
pruned, and the survivors are matched through an inverted index from each
rule's rarest token. Everything runs on DataFrame functions and the JVM's
FP-growth; only the model (the pruned rules and the tokens that reach
``min_support``) comes to the driver, and matching is row by row without a
shuffle. Support and confidence alone bound what is mined.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and gets the default verdict; equally sure rules are
ranked by support, then by their text; repeated rows are judged alike;
whole urls are read, however long; with nothing labelled there are no mined
rules, and an empty table gives an empty result. Input columns named
``host``, ``path``, ``rule``, ``verdict``, ``mined_rule`` or ``confidence``
are replaced, all others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(tail, "^[^?#]*", 0)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host, its subdomains, and paths with this start."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def listed_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest listed rule that fits, as struct(name, verdict), or null.
    ``rules`` is a configuration list, not data."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is applied last
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, the last label on its own, path parts
    (digits read as ``0``), and query keys."""
    full = lambda a: F.filter(a, lambda x: x != "")
    labels = full(F.split(host, r"\."))
    parts = full(F.split(F.regexp_replace(path, "[0-9]+", "0"), "/"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    keys = full(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0)))
    tag = lambda kind, a: F.transform(a, lambda x: F.concat(F.lit(kind), x))
    tagged = [tag("host:", labels), tag("path:", parts), tag("query:", keys)]
    top = F.when(F.size(labels) > 0, F.array(F.concat(F.lit("top:"), F.element_at(labels, -1)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*tagged, top))


@dataclass(frozen=True)
class UrlModel:
    """Mined rules: (antecedent tokens, verdict, confidence, support)."""

    rules: tuple[tuple[tuple[str, ...], str, float, float], ...]
    vocabulary: tuple[str, ...]


@dataclass(frozen=True)
class UrlRuleMiner:
    """``max_tokens`` (vocabulary), ``max_items`` (frequent tokens of one
    transaction) and ``max_rules`` (model) are limits, none by default, beyond
    which the fit fails: nothing is cut to fit them."""

    min_support: float = 0.01
    min_confidence: float = 0.9
    max_tokens: int | None = None
    max_items: int | None = None
    max_rules: int | None = None

    def fit(self, labelled: DataFrame, items: str = "tokens", label: str = "label") -> UrlModel:
        labelled = labelled.select(F.col(items).alias("items"), F.col(label).alias("label")).where(F.col("label").isNotNull())
        n = labelled.count()
        if not n:
            return UrlModel((), ())
        often = labelled.select(F.explode("items").alias("t")).groupBy("t").count().where(F.col("count") >= self.min_support * n)
        vocabulary = [r.t for r in often.orderBy(F.desc("count"), "t").collect()]
        self._within("max_tokens", len(vocabulary))
        known = F.array(*[F.lit(t) for t in vocabulary]).cast("array<string>")
        baskets = labelled.select(F.array_intersect(known, "items").alias("known"), "label")
        if self.max_items is not None:
            self._within("max_items", baskets.agg(F.max(F.size("known"))).first()[0])
        baskets = baskets.select(F.concat("known", F.array(F.concat(F.lit("label:"), "label"))).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=self.min_support, minConfidence=self.min_confidence).fit(baskets)
        found = model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit("label:")) & ~F.exists("antecedent", lambda t: F.startswith(t, F.lit("label:")))).select(
            F.array_sort("antecedent").alias("a"), F.substring(F.col("consequent")[0], 7, 1000).alias("v"), F.round("confidence", 9).alias("c"), F.round("support", 9).alias("s")
        )
        kept = [(tuple(r.a), r.v, r.c, r.s) for r in sorted(_pruned(staged(found, "rules")).collect(), key=lambda r: (len(r.a), -r.c, -r.s, r.a))]
        self._within("max_rules", len(kept))
        return UrlModel(tuple(kept), tuple(vocabulary))

    def _within(self, limit: str, n: int) -> None:
        most = getattr(self, limit)
        if most is not None and n > most:
            raise ValueError(f"{n} is beyond {limit}={most}")


def _pruned(found: DataFrame) -> DataFrame:
    """The rules (a, v, c, s) that hold no shorter one that is as sure. A
    shorter rule is met under its first token."""
    short = found.select(F.col("a")[0].alias("t"), F.col("a").alias("sa"), F.col("v").alias("sv"), F.col("c").alias("sc"))
    each = found.withColumn("t1", F.explode("a"))
    held = (F.size("sa") < F.size("a")) & (F.col("sc") >= F.col("c")) & (F.size(F.array_except("sa", "a")) == 0)
    redundant = each.join(short, (F.col("t1") == F.col("t")) & (F.col("v") == F.col("sv")) & held, "left_semi").select("a", "v").distinct()
    return found.join(redundant, ["a", "v"], "left_anti")


def mined_rule(model: UrlModel, items: Column) -> Column:
    """The surest mined rule that fits, as struct(name, verdict, confidence,
    support), or null. The index holds each rule once, under the token with
    the lowest place in the vocabulary, its rarest."""
    none = F.lit(None).cast("struct<name:string,verdict:string,confidence:double,support:double>")
    if not model.rules:
        return none
    rank = {t: i for i, t in enumerate(model.vocabulary)}
    index: dict[str, list] = {}
    for antecedent, verdict, confidence, support in model.rules:
        posting = F.struct(F.array(*map(F.lit, antecedent)).alias("needs"), F.lit(" & ".join(antecedent)).alias("name"), F.lit(verdict).alias("verdict"), F.lit(confidence).alias("confidence"), F.lit(support).alias("support"))
        index.setdefault(max(antecedent, key=rank.__getitem__), []).append(posting)
    table = F.create_map(*[x for t, postings in index.items() for x in (F.lit(t), F.array(*postings))])
    hits = F.flatten(F.filter(F.transform(items, lambda t: F.element_at(table, t)), lambda p: p.isNotNull()))
    hits = F.filter(hits, lambda r: F.size(F.array_except(r["needs"], items)) == 0)
    best = F.sort_array(F.transform(hits, lambda r: F.struct((-r["confidence"]).alias("c"), (-r["support"]).alias("s"), r["name"].alias("name"), r["verdict"].alias("verdict"))))
    b = F.get(best, 0)
    return F.when(F.size(best) > 0, F.struct(b["name"].alias("name"), b["verdict"].alias("verdict"), (-b["c"]).alias("confidence"), (-b["s"]).alias("support"))).otherwise(none)


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", miner: UrlRuleMiner | None = None, default: str = "allow") -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``verdict``, ``mined_rule`` and
    ``confidence`` to every row."""
    host, path = host_and_path(F.col(url))
    pages = pages.withColumns({"host": host, "path": path})
    read = pages.withColumns({"__listed": listed_rule(rules, F.col("host"), F.col("path")), "__tokens": tokens(F.col(url), F.col("host"), F.col("path"))})
    model = (miner or UrlRuleMiner()).fit(read, "__tokens", "__listed.verdict")
    out = read.withColumn("__mined", F.when(F.col("__listed").isNull(), mined_rule(model, F.col("__tokens"))))
    return out.withColumns(
        {
            "rule": F.col("__listed.name"),
            "verdict": F.coalesce("__listed.verdict", "__mined.verdict", F.lit(default)),
            "mined_rule": F.col("__mined.name"),
            "confidence": F.col("__mined.confidence"),
        }
    ).drop("__listed", "__tokens", "__mined")
