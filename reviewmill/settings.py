"""Choices the contract leaves open. Every one is a parameter with a default."""

from __future__ import annotations

from dataclasses import dataclass, field

from reviewmill.schemas import ASPECT_RULE_VERSION, EXTRACTION_METHOD, REASON_RULE_VERSION


@dataclass(frozen=True)
class ConfidenceBucket:
    """Scores from ``low`` (included) to ``high`` (excluded; the last bucket includes it)."""

    code: str
    low: float
    high: float


CONFIDENCE_BUCKETS = (
    ConfidenceBucket("low", 0.0, 0.5),
    ConfidenceBucket("medium", 0.5, 0.7),
    ConfidenceBucket("high", 0.7, 0.9),
    ConfidenceBucket("very_high", 0.9, 1.0),
)


@dataclass(frozen=True)
class AlertPolicy:
    """Negative-rate thresholds from the most to the least severe level."""

    levels: tuple[tuple[str, float], ...] = (
        ("CRITICAL", 0.6), ("HIGH", 0.5), ("MEDIUM", 0.4), ("LOW", 0.3),
    )
    min_reviews: int = 20


@dataclass(frozen=True)
class KeywordRule:
    """A rule given by ``words`` (words or phrases that stand in the text), or else by ``pattern``.

    A pattern is searched only in texts that hold one of ``needs``, where these are given. For a rule
    of words the pattern says the same once more; it decides where a phrase of several words begins in a text.
    """

    code: str
    name: str
    pattern: str
    words: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class RuleSet:
    """Rules whose words are what ``separator`` cuts lower-cased text into; phrases have one blank between words."""

    rules: tuple[KeywordRule, ...]
    version: str
    method: str = EXTRACTION_METHOD
    separator: str = r"(?U)\W+"
    codes: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "codes", tuple(rule.code for rule in self.rules))


def _words(*stems: str) -> tuple[str, tuple[str, ...]]:
    """Whole words or phrases, matched against lower-cased text, as a pattern and as they are."""
    return r"(?U)\b(" + "|".join(stems) + r")\b", stems


# Keyword lists are ours: the contract fixes the codes and names only.
ASPECT_RULES = RuleSet(
    (
        KeywordRule("appearance", "Appearance", *_words("look", "looks", "color", "colour", "style", "pretty", "cute", "beautiful", "design")),
        KeywordRule("size_fit", "Size & Fit", *_words("size", "sizes", "fit", "fits", "small", "large", "tight", "loose")),
        KeywordRule("comfort", "Comfort", *_words("comfort", "comfortable", "comfy", "soft", "itchy", "uncomfortable")),
        KeywordRule("material", "Material", *_words("material", "fabric", "cotton", "leather", "polyester", "thin", "thick")),
        KeywordRule("price_value", "Price & Value", *_words("price", "value", "cheap", "expensive", "worth", "money")),
        KeywordRule("quality", "Quality", *_words("quality", "well made", "poorly made", "craftsmanship")),
        KeywordRule("shipping_packaging", "Shipping & Packaging", *_words("shipping", "shipped", "delivery", "package", "packaging", "arrived")),
        KeywordRule("durability", "Durability", *_words("durable", "broke", "broken", "ripped", "tore", "lasted", "fell apart")),
    ),
    ASPECT_RULE_VERSION,
)
REASON_RULES = RuleSet(
    (
        KeywordRule("return_issue", "Return issue", *_words("return", "returned", "returning", "refund")),
        KeywordRule("wrong_size", "Wrong size", *_words("too small", "too big", "too large", "too tight", "wrong size", "runs small", "runs large")),
        KeywordRule("poor_quality", "Poor quality", *_words("poor quality", "bad quality", "cheaply made", "poorly made", "low quality")),
        KeywordRule("overpriced", "Overpriced", *_words("overpriced", "too expensive", "not worth", "waste of money")),
        KeywordRule("damaged_item", "Damaged item", *_words("broke", "broken", "damaged", "ripped", "torn", "hole", "holes")),
        KeywordRule("uncomfortable", "Uncomfortable", *_words("uncomfortable", "itchy", "hurts", "scratchy")),
        KeywordRule("color_mismatch", "Color mismatch", *_words("wrong color", "different color", "color is off", "faded")),
        KeywordRule("not_as_described", "Not as described", *_words("not as described", "not as pictured", "not what", "misleading")),
        KeywordRule("delivery_issue", "Delivery issue", *_words("never arrived", "late", "delayed", "missing", "lost")),
    ),
    REASON_RULE_VERSION,
)

SAMPLES_PER_LABEL = 50
PREVIEW_CHARACTERS = 160
MONTH_FORMAT = "yyyy-MM"
UNKNOWN_NAME = "unknown"
PROBABILITY_TOLERANCE = 1e-6
