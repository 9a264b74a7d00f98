"""Everything a user may want to change: word lists, rules, thresholds.

The defaults are fixed values of the report format; operators take a
``PipelineConfig`` so that another publisher's format needs no code change.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass, field
from pathlib import Path

DATA_DIR = Path(__file__).parent / "data"
CALENDAR_CSV = DATA_DIR / "academic_calendar.csv"
UNKNOWN = "UNKNOWN"

# ---- fixed values: zones -------------------------------------------------
# zone -> (label, residential, academic, on campus)
ZONE_ATTRIBUTES: dict[str, tuple[str, bool, bool, bool]] = {
    "ACADEMIC_CORE": ("Academic Core", False, True, True),
    "ENGINEERING_NORTH": ("Engineering (North)", False, True, True),
    "BUSINESS_SOUTH": ("Business (South)", False, True, True),
    "STUDENT_SERVICES": ("Student Services", False, False, True),
    "STADIUM_AREA": ("Stadium / Athletics", False, False, True),
    "DORMS_HELAMAN": ("Helaman Halls", True, False, True),
    "DORMS_HERITAGE": ("Heritage Halls", True, False, True),
    "WYVIEW_WYMOUNT": ("Wyview / Wymount", True, False, True),
    "MTC": ("Missionary Training Center", False, False, False),
    "SERVICE_SUPPORT": ("Service / Support", False, False, True),
    "OFF_CAMPUS": ("Off Campus", False, False, False),
    UNKNOWN: ("Unknown", False, False, False),
}

# ---- fixed values: numbered parking lots ---------------------------------
LOT_ZONES: dict[int, str] = {
    2: "STUDENT_SERVICES",
    4: "ENGINEERING_NORTH",
    20: "STADIUM_AREA",
    23: "STADIUM_AREA",
    25: "DORMS_HELAMAN",
    37: "STADIUM_AREA",
    38: "STADIUM_AREA",
    41: "DORMS_HELAMAN",
    45: "STADIUM_AREA",
    46: "OFF_CAMPUS",
    47: "STADIUM_AREA",
    50: "ACADEMIC_CORE",
    52: "WYVIEW_WYMOUNT",
}

# ---- fixed values: nouns that end a proper place name (case-sensitive) ----
PLACE_NOUNS = (
    "Building", "Hall", "Halls", "Center", "Centre", "Stadium", "Library",
    "Museum", "Tower", "Fieldhouse", r"Field\s?House", "Complex", "Terrace",
    "Pavilion", "Field", "Annex", "Court", "Apartments", "Park", "Commons",
    "Dorm",
)

# ---- fixed values: incident type -> category, first match wins ------------
CATEGORY_RULES = (
    ("alarm", "Alarm"),
    ("medical|seizure|chest|unconscious|faint|injur|overdose", "Medical"),
    ("traffic|accident|parking|vehicle|hit and run", "Traffic"),
    ("theft|burglar|robber|stolen|fraud|larceny|mischief", "Property"),
    ("welfare|assist|informa|found|lost|lockout|escort", "Service"),
    ("trespass|suspicious|disorder|drug|alcohol|assault|harass|disturbance", "Conduct/Crime"),
)

# ---- fixed values: deciding layer -> confidence ---------------------------
CONFIDENCE = {
    "landmark": "HIGH",
    "lot": "HIGH",
    "llm": "MEDIUM",
    "guardrail": "NONE",
    "none": "NONE",
}

# ---- fixed values: report page format -------------------------------------
TITLE_PREFIX = "police beat"
TITLE_PATTERN = r"Police\s+Beat\s*(?:•|[-:])\s*(.+)$"
DATE_PATTERN = r"[0-9]{2}/[0-9]{2}/[0-9]{4}"
DATE_FORMAT = "MM/dd/yyyy"
MARKER_PATTERN = r"Follow\s+us\s+on\s+Facebook"
LINK_TEXT_PATTERN = r"Police\s+Beat"
NEXT_TEXT_PATTERN = r"\bNext\b"

NOISE_PREFIXES = (
    "overrideBackgroundColorOrImage=",
    "overrideTextColor=",
    "promoTextAlignment=",
    "overrideCardHideSection=",
    "overrideCardHideByline=",
    "overrideCardHideDescription=",
    "overridebuttonBgColor=",
    "overrideButtonText=",
    "data-content-type=",
)

NARRATIVE_START_WORDS = (
    "a", "an", "after", "as", "at", "authorities", "based", "byu", "campus",
    "dispatch", "during", "employees", "firefighters", "officer", "officers",
    "police", "provo", "security", "staff", "the", "they", "upon", "while",
)

# ``.class``, ``tag`` or ``tag.class``, in order of preference
CONTAINER_SELECTORS = (
    ".RichTextArticleBody-body",
    ".RichTextArticleBody",
    ".ArticlePage-body",
    ".ArticlePage-articleBody",
    ".ContentPage-body",
    ".CreativeWorkPage-body",
    ".RichTextModule",
    ".RichTextFullWidth-content",
    ".RichTextFullWidth-items",
    ".RichTextFullWidth",
    ".PromoImageSmall-description",
    "article",
    "main.Page-main",
    "main",
)
MARKED_CONTAINER_TAGS = ("div", "section")
DROPPED_SELECTORS = (
    "script", "style", "svg", "noscript", "form", "nav", "header", "footer",
    ".RawHtmlModule",
)
BLOCK_TAGS = ("p", "div", "section", "article", "li", "h1", "h2", "h3")

LIST_ITEM_SELECTOR = "div.ListImageSmall-items-item"
LIST_TITLE_SELECTOR = "h3.PromoImageSmall-title"
LIST_DATE_BOX_SELECTOR = ".PromoImageSmall-nameAndDate"
LIST_DATE_SELECTORS = (".date", "span.date")
LIST_NEXT_BUTTON_SELECTOR = ".List-paginationButton"

# ---- fixed values: flat export, calendar, serving -------------------------
CSV_COLUMNS = (
    "beat_url", "beat_title", "beat_published_at", "date_range_raw",
    "incident_dates", "is_multi_date_beat", "incident_type", "incident_text",
    "raw_text_hash", "scraped_at",
)
PERIOD_TYPES = ("SEMESTER", "FINALS", "BREAK", "GAME_DAY")
DAY_TYPES = ("Regular", "Finals", "Break", "Game day")
WEEKDAYS = (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
)


def load_rules(path: str | Path) -> tuple[tuple[str, str], ...]:
    """Read an ordered ``pattern,zone`` rule table (``#`` lines are comments)."""
    with open(path, encoding="utf-8", newline="") as handle:
        lines = (line for line in handle if not line.startswith("#"))
        return tuple((row["pattern"], row["zone"]) for row in csv.DictReader(lines))


@dataclass(frozen=True)
class PipelineConfig:
    zones: tuple[str, ...] = tuple(ZONE_ATTRIBUTES)
    place_rules: tuple[tuple[str, str], ...] = field(
        default_factory=lambda: load_rules(DATA_DIR / "place_rules.csv")
    )
    lot_zones: dict[int, str] = field(default_factory=lambda: dict(LOT_ZONES))
    place_nouns: tuple[str, ...] = PLACE_NOUNS
    category_rules: tuple[tuple[str, str], ...] = CATEGORY_RULES
    confidence: dict[str, str] = field(default_factory=lambda: dict(CONFIDENCE))
    title_prefix: str = TITLE_PREFIX
    title_pattern: str = TITLE_PATTERN
    marker_pattern: str = MARKER_PATTERN
    noise_prefixes: tuple[str, ...] = NOISE_PREFIXES
    narrative_start_words: tuple[str, ...] = NARRATIVE_START_WORDS
    max_type_chars: int = 100
    max_type_words: int = 10
    # a wider span than this comes from a mistyped year in the title
    max_span_days: int = 31
    # a busier day than this is a backlog logged on one date
    outlier_day_threshold: int = 30
    rolling_days: int = 7


DEFAULT = PipelineConfig()
