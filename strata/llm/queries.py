"""Registered queries of the operators: thin callers that run an
operator over its whole table and derive the contract's columns from its
real output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat_format, decontaminate, hard_negatives, lang_ecoc, license_scan, main_text, mix_sources, ngram_join, pii_anchors, quality_ledger, toxicity_ftrl, url_rules, whiten
from strata.llm.common import held_out, load

#: The listed rules of the URL query.
URL_RULES = [
    url_rules.Rule("allow", "com", "/"),
    url_rules.Rule("block", "example.com", "/en/"),
    url_rules.Rule("allow", "www.example.com", "/en/"),
    url_rules.Rule("block", "net", "/es/"),
    url_rules.Rule("block", "net", "/fr/"),
]
#: Production parameters of the mixing query.
MIX = mix_sources.Mix(block_tokens=250_000)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats every conversation and reads the result back."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = turns.unionByName(probe).withColumn("parts", chat_format.text_parts(F.col("text")))
    chat = chat_format.ChatFormatter()
    out = chat.format(turns).withColumns({"read": chat.turns(F.col("formatted")), "learned": chat.learned(F.col("formatted"), F.col("loss_spans"))})
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores every document; learns from labelled rows outside the fold."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity_ftrl.fit(docs, labels.where(~held_out()))
    score = toxicity_ftrl.score(docs, model)
    return score.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judges every page by listed and mined rules."""
    judged = url_rules.judge(load(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_rule")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals all documents out to blocks by tempered source weights."""
    out = mix_sources.plan(load(spark, sf_dir, "documents"), MIX)
    return out.select(F.col("doc").alias("doc_id"), "source", "epoch", "block", "tokens", "slot")


def op5_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures every document and applies the second policy."""
    book = quality_ledger.ledger(quality_ledger.measure(load(spark, sf_dir, "documents")))
    out = quality_ledger.apply_policy(book, 2)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", quality_ledger.rejected(quality_ledger.BASE).alias("base_failed"), "kept", "failed")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the second policy rejects, alone and with others."""
    return quality_ledger.ablation(quality_ledger.ledger(quality_ledger.measure(load(spark, sf_dir, "documents"))), 2)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of licence notices in every document, by the best licence
    at each place."""
    out = license_scan.scan(load(spark, sf_dir, "documents").select("doc_id", "text"))
    out = out.select("doc_id", license_scan.best_places(F.col("matches")).alias("best"))
    return out.select(
        "doc_id",
        F.size("best").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("best", lambda x: x["license"]))), ",").alias("licenses"),
        F.round(F.array_max(F.transform("best", lambda x: x["dice"])), 6).alias("best_dice"),
    )


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at a similarity of 0.9 over 3 words."""
    out = ngram_join.join(load(spark, sf_dir, "documents").select("doc_id", "text"), params=ngram_join.Join(90, 100, 3))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learns from rows outside the fold."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lang_ecoc.fit(docs.where(~held_out()))
    out = lang_ecoc.predict(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.find_items(docs, load(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        F.size("hits").cast("long").alias("n_items"),
        F.transform("hits", lambda h: h["item_id"]).alias("item_ids"),
        F.array_min(F.transform("hits", lambda h: h["distance"])).alias("least_distance"),
    )


def op10_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    out = pii_anchors.find_pii(load(spark, sf_dir, "documents").select("doc_id", "text"))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii_anchors.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in pii_anchors.BASE], F.sha2(line(base), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op11_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding projected on the leading components, whitened."""
    rows = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whiten.fit(rows)
    explained, error = (model.explained(), model.identity_error) if model else ([], None)
    out = whiten.whiten(rows, model).select("vec_id", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), F.posexplode("whitened").alias("k", "whitened"))
    share = F.get(F.array(*[F.lit(e).cast("double") for e in explained]), F.col("k"))
    return out.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", F.col("whitened"), share.cast("double").alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row, against all rows."""
    rows = load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract(pages, main_text.fit(pages))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_toxicity, op3_url_filter, op4_mix_sources, op5_quality_ledger, op6_license_scan, op7_ngram_jaccard_join, op8_language_id, op9_decontaminate, op10_pii_anchors, op11_whiten_embeddings, op12_hard_negatives, op13_main_text, quality_ablation)}
