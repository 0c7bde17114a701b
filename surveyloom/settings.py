"""Everything a deployment may tune: code lists, thresholds, word lists.

Operators take these values as arguments; nothing below is read from inside an
operator. A deployment overrides any field from a JSON file (`Settings.load`).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
from dataclasses import dataclass, field

# --- fixed values: codes and labels that occur in the input and output tables ---

VALID_SCORES = ("0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10")
DETRACTOR_SCORES = ("0", "1", "2", "3", "4", "5", "6")
PASSIVE_SCORES = ("7", "8")
PROMOTER_SCORES = ("9", "10")

SURVEY_FAMILIES = (
    ("NPS", ("Optical", "Sun", "PICKUP_Optical")),
    ("Meta NPS", ("STELLA_Optical", "SNOVA_Optical", "STELLA_Sun", "SNOVA_Sun")),
    ("Nuance NPS", ("NUANCE_Optical",)),
    ("EXAM NPS", ("EXAM_Optical",)),
    ("CEPS", ("Product",)),
    ("Meta CEPS", ("STELLA_Product", "SNOVA_Product")),
    ("Nuance CEPS", ("NUANCE_Product",)),
)
OTHER_FAMILY = "OTHER"
EXAM_FAMILY = "EXAM NPS"

EXCLUDED_SURVEY_TYPES = ("CCEMAIL", "CCSMS", "PICKUP_Optical")
EXCLUDED_CHANNELS = ("H1", "H2", "H3", "H4", "Y1")

ONLINE_CHANNEL = "Internet"
ONLINE_LABEL = "E-commerce"
OFFLINE_LABEL = "Brick and Mortar"

NA_CODE = "NA"
NA_SUFFIXES = ("LO",)
NA_REGION = "North America"
NA_COUNTRIES = (("CA", "Canada"), ("US", "United States"))

EXAM_CUTOVER = dt.date(2026, 1, 1)

CATEGORY_LABELS = (
    "Aftersales",
    "Conventions/Insurance",
    "Product",
    "Staff Issues",
    "Store Appointment",
    "Subscribtions",
    "Customer Service",
    "Doctor Experience",
    "General Experience",
    "Logistic and Transportation",
    "Omnichnannel",
    "Pricing",
    "In-Store Experience",
    "Product Store Website",
    "Web-Store Delivery Time",
    "Associate",
    "Supply Chain",
    "Other",
)

TOKEN_SYMBOLS = ",.:;!()"
MIN_TOKEN_LENGTH = 4

# --- end of fixed values ---

# A short list of function words per language. Deployments pass their own.
DEFAULT_STOPWORDS = (
    # English
    "about", "after", "also", "because", "been", "before", "from", "have", "into",
    "more", "only", "other", "some", "than", "that", "their", "them", "then", "there",
    "these", "they", "this", "very", "were", "what", "when", "which", "will", "with",
    "would", "your",
    # Italian
    "alla", "anche", "avere", "come", "della", "dopo", "loro", "nella", "perché",
    "prima", "questo", "sono", "stato", "sulla",
    # French
    "alors", "avec", "cette", "comme", "dans", "elle", "leur", "mais", "même", "nous",
    "pour", "sans", "tout", "très", "vous",
    # Spanish
    "como", "cuando", "desde", "entre", "este", "muy", "pero", "porque", "siempre",
    "sobre", "también", "todo",
    # German
    "aber", "auch", "dass", "dieser", "eine", "haben", "nach", "nicht", "noch", "oder",
    "sein", "sind", "über", "wenn", "wird",
    # Portuguese
    "ainda", "então", "isso", "mais", "muito", "para", "pela", "pelo", "você",
)

CRITICAL_KEYWORDS = {
    "en": ("safety", "return", "damage", "fraud", "legal", "lawsuit"),
    "it": ("sicurezza", "reso", "danno", "frode", "legale"),
}

#: Words, phrases and stems (ending in *) that force a review, whatever the language of the survey was.
CRITICAL_SIGNALS = (
    "safety", "unsafe", "injur*", "return*", "refund*", "damag*", "fraud*", "legal", "lawsuit*", "legal act*",
    "sicurezza", "pericolos*", "reso", "rimbors*", "dann*", "frod*", "legale", "azione legal*",
)


@dataclass(frozen=True)
class ModelOptions:
    """Options handed to the model client with every prompt."""

    temperature: float = 0.2
    max_output_tokens: int = 1000


@dataclass(frozen=True)
class Routing:
    """Thresholds of the routing rules; `version` is written on every routed row."""

    version: str = "v1"
    min_confidence: float = 0.75
    min_volume: int = 2
    critical_severity: float = 0.8
    volume_reference: int = 50
    weights: tuple[float, float, float, float] = (0.4, 0.2, 0.3, 0.1)
    max_ticket_size: int = 500


@dataclass(frozen=True)
class Similarity:
    """Banding and threshold of the similarity links."""

    bands: int = 16
    rows_per_band: int = 4
    threshold: float = 0.6

    @property
    def n_hashes(self) -> int:
        return self.bands * self.rows_per_band


@dataclass(frozen=True)
class SlaRule:
    """Severity at or above `min_severity` must be handled within `hours`."""

    band: str
    min_severity: float
    hours: int
    second_owner: str


@dataclass(frozen=True)
class Settings:
    brand_prefixes: tuple[tuple[str, str], ...] = ()
    second_region_banners: tuple[str, ...] = ()
    first_region_excluded_banners: tuple[str, ...] = ()
    brand_names_without_blanks: tuple[str, ...] = ()
    survey_families: tuple[tuple[str, tuple[str, ...]], ...] = SURVEY_FAMILIES
    excluded_survey_types: tuple[str, ...] = EXCLUDED_SURVEY_TYPES
    excluded_channels: tuple[str, ...] = EXCLUDED_CHANNELS
    na_suffixes: tuple[str, ...] = NA_SUFFIXES
    category_labels: tuple[str, ...] = CATEGORY_LABELS
    exam_cutover: dt.date = EXAM_CUTOVER
    stopwords: tuple[str, ...] = DEFAULT_STOPWORDS
    translation_options: ModelOptions = ModelOptions(temperature=0.2)
    classification_options: ModelOptions = ModelOptions(temperature=0.1)
    category_options: ModelOptions = ModelOptions(temperature=0.1)
    reply_store: str | None = None  # shared folder that keeps model replies; none keeps none
    routing: Routing = Routing()
    similarity: Similarity = Similarity()
    sla: tuple[SlaRule, ...] = (
        SlaRule("high", 0.8, 4, "duty manager"),
        SlaRule("medium", 0.5, 24, "team lead"),
        SlaRule("low", 0.0, 72, "pipeline owner"),
    )
    critical_keywords: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: dict(CRITICAL_KEYWORDS)
    )
    critical_signals: tuple[str, ...] = CRITICAL_SIGNALS

    @property
    def translated_banners(self) -> tuple[str, ...]:
        """The labels of the prefix rules: these banners are translated, the rest kept."""
        return tuple(dict.fromkeys(label for _, label in self.brand_prefixes))

    @classmethod
    def load(cls, path: str) -> "Settings":
        """Read overrides from a JSON file; a field that is absent keeps its default."""
        with open(path, encoding="utf-8") as fh:
            raw = json.load(fh)
        known = {f.name for f in dataclasses.fields(cls)}
        unknown = sorted(set(raw) - known)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        nested = {
            "translation_options": lambda v: ModelOptions(**v),
            "classification_options": lambda v: ModelOptions(**v),
            "category_options": lambda v: ModelOptions(**v),
            "routing": lambda v: Routing(**{**v, **({"weights": tuple(v["weights"])} if "weights" in v else {})}),
            "similarity": lambda v: Similarity(**v),
            "sla": lambda v: tuple(SlaRule(**r) for r in v),
            "reply_store": lambda v: v,
            "exam_cutover": dt.date.fromisoformat,
            "critical_keywords": lambda v: {k: tuple(words) for k, words in v.items()},
            "survey_families": lambda v: tuple((name, tuple(types)) for name, types in v),
        }
        plain = lambda v: tuple(tuple(x) if isinstance(x, list) else x for x in v)
        return cls(**{k: nested.get(k, plain)(v) for k, v in raw.items()})
