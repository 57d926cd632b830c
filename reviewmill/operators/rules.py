"""Keyword-rule aggregates: aspects of all reviews, reasons of negative ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.numbers import safe_rate
from reviewmill.functions.once import literal_rows
from reviewmill.operators.aggregates import label_counts, with_rates
from reviewmill.settings import ASPECT_RULES, REASON_RULES, KeywordRule, RuleSet

_EVERY = "*"


def matched_codes(text: Column, rules: RuleSet) -> Column:
    """Codes of all rules that occur in the text.

    The text is cut into words once, and these are looked up in the table of all words that rules
    begin with or need. What is found, a handful at most, decides: single words at once, phrases and patterns
    by one search in those texts that hold a word of theirs. Only rules without any word are searched everywhere.
    """
    heads = sorted({w.split(" ")[0] for rule in rules.rules for w in (*rule.words, *rule.needs)})
    lowered = F.lower(text)
    found = F.array_intersect(F.split(lowered, rules.separator), F.array(*map(F.lit, heads))) if heads else F.array().cast("array<string>")

    def holds(hits: Column, words: tuple[str, ...]) -> Column:
        return F.arrays_overlap(hits, F.array(*map(F.lit, words))) if words else F.lit(False)

    def met(x: Column, rule: KeywordRule) -> Column:
        searched = x["text"].rlike(rule.pattern)
        if not rule.words:
            return holds(x["hits"], rule.needs) & searched if rule.needs else searched
        phrases = tuple(dict.fromkeys(w.split(" ")[0] for w in rule.words if " " in w))
        return holds(x["hits"], tuple(w for w in rule.words if " " not in w)) | (holds(x["hits"], phrases) & searched)

    def codes(x: Column) -> Column:
        return F.array_compact(F.array(*[F.when(met(x, rule), F.lit(rule.code)) for rule in rules.rules]))

    # One element, so that the words of a text are looked up once for all rules.
    return F.flatten(F.transform(F.array(F.struct(lowered.alias("text"), found.alias("hits"))), codes))


def _rule_table(counted: DataFrame, rules: RuleSet, prefix: str) -> DataFrame:
    names = literal_rows(counted, **{
        f"{prefix}_code": rules.codes, f"{prefix}_name": tuple(rule.name for rule in rules.rules),
    })
    return names.join(counted, f"{prefix}_code", "left").withColumns({
        "extraction_method": F.lit(rules.method),
        "rule_version": F.lit(rules.version),
    })


def aspect_summary(view: DataFrame, rules: RuleSet = ASPECT_RULES, text: str = "review_text_clean") -> DataFrame:
    """Mentions per aspect; a review counts once for every aspect it touches."""
    hits = view.select(
        F.explode(matched_codes(F.col(text), rules)).alias("aspect_code"),
        "parent_asin", "pred_label", "pred_score",
    )
    counted = hits.groupBy("aspect_code").agg(
        F.count(F.lit(1)).alias("mention_count"),
        *label_counts(),
        F.count_distinct("parent_asin").alias("product_count"),
        F.avg("pred_score").alias("average_prediction_score"),
    )
    counts = ["mention_count", "positive_count", "neutral_count", "negative_count", "product_count"]
    return with_rates(_rule_table(counted, rules, "aspect").fillna(0, subset=counts), "mention_count")


def negative_reasons(view: DataFrame, rules: RuleSet = REASON_RULES, text: str = "review_text_clean") -> DataFrame:
    """Mentions per reason among predicted-negative reviews, for the whole scope.

    The number of negative reviews travels through the same aggregation under
    its own code, so the text is read once.
    """
    negative = view.filter(F.col("pred_label") == "negative")
    codes = F.array_append(matched_codes(F.col(text), rules), F.lit(_EVERY))
    hits = negative.select(F.explode(codes).alias("reason_code"), "parent_asin", "pred_score")
    counted = hits.groupBy("reason_code").agg(
        F.count(F.lit(1)).alias("mention_count"),
        F.count_distinct("parent_asin").alias("product_count"),
        F.avg("pred_score").alias("average_prediction_score"),
    )
    # At most one row per rule plus one: a single-task window is bounded here.
    everyone = F.max(F.when(F.col("reason_code") == _EVERY, F.col("mention_count"))).over(Window.partitionBy(F.lit(1)))
    shared = counted.withColumn("share_of_negative_reviews", safe_rate(F.col("mention_count"), everyone))
    table = _rule_table(shared.filter(F.col("reason_code") != _EVERY), rules, "reason")
    return table.fillna(0, subset=["mention_count", "product_count", "share_of_negative_reviews"])
