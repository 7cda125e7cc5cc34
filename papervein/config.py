"""Run parameters, and the default values an existing user of the domain expects."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TokenTest:
    """One token's condition; exactly one of the four fields is set."""

    text: str | None = None
    regex: str | None = None
    one_of: tuple[str, ...] | None = None
    lower_in: tuple[str, ...] | None = None


@dataclass(frozen=True)
class TokenPattern:
    """A label and the conditions its consecutive tokens must meet."""

    label: str
    tests: tuple[TokenTest, ...]

    @property
    def n_tokens(self) -> int:
        return len(self.tests)


def _text(value: str) -> TokenTest:
    return TokenTest(text=value)


def _regex(value: str) -> TokenTest:
    return TokenTest(regex=value)


# ---- fixed values -----------------------------------------------------------
# Results are only right with exactly these words, patterns and numbers.

SOURCE_TYPE, TEXT_SOURCE, ORIGIN = "paper", "fulltext", "local_pdf_zotero"

DOMAIN_TERMS = (
    "non-oriented", "non-grain-oriented", "NGO", "NOES", "electrical steel",
    "silicon steel", "FeSi", "Fe-Si", "lamination steel", "soft magnetic",
    "core loss", "iron loss", "magnetic flux density", "permeability",
    "coercivity", "hysteresis", "eddy current", "magnetostriction",
    "grain", "texture", "annealing", "crystalline", "alloy",
    "motor", "transformer", "rotor", "stator", "traction",
)
RELEVANCE_THRESHOLD = 8

GRADE_PATTERNS = (
    TokenPattern("GRADE", (_regex(r"^\d{2}A\d{3,4}$"),)),
    TokenPattern("GRADE", (_regex(r"^M\d{3}$"), _text("-"), _regex(r"^\d{2}A\d?$"))),
    TokenPattern("GRADE", (_regex(r"^\d{2}H[A-Z]{0,2}\d{3,4}[A-Z]?$"),)),
    TokenPattern("GRADE", (_regex(r"^\d{2}JNE\d{3}$"),)),
    TokenPattern("GRADE", (_regex(r"^NO\d{2}$"),)),
    TokenPattern("GRADE", (_regex(r"^NO\d{2}$"), _text("-"), _regex(r"^\d{3,4}$"))),
)
MEASUREMENT_PATTERNS = (
    TokenPattern("CORE_LOSS", (_regex(r"^W\d+(\.\d+)?/\d+k?$"),)),
    TokenPattern("CORE_LOSS", (_regex(r"^\d+(\.\d+)?$"), _text("W"), _text("/"), _text("kg"))),
    TokenPattern("SI_CONTENT", (
        _regex(r"^[0-6](\.\d+)?$"),
        TokenTest(one_of=("%", "mass%", "wt%")),
        TokenTest(lower_in=("si", "silicon")),
    )),
    TokenPattern("MPA_VALUE", (_regex(r"^\d+(\.\d+)?$"), _text("MPa"))),
    TokenPattern("FLUX_DENSITY", (_regex(r"^B(8|10|25|50|80)$"),)),
    TokenPattern("FLUX_DENSITY", (_regex(r"^[0-2](\.\d+)?$"), _text("T"))),
)

LEXICON_FILES = {
    "applications.txt": "APPLICATION",
    "competing_materials.txt": "COMPETING_MATERIAL",
    "producers.txt": "PRODUCER",
    "processing_terms.txt": "PROCESSING",
    "brand_grades.txt": "GRADE_BRAND",
    "standards.txt": "STANDARD",
    "test_methods.txt": "TEST_METHOD",
    "out_of_scope_grades.txt": "OOS_GRADE",
}
DOMAIN_LABELS = (
    "GRADE", "CORE_LOSS", "SI_CONTENT", "MPA_VALUE", "FLUX_DENSITY",
    "APPLICATION", "COMPETING_MATERIAL", "PRODUCER", "PROCESSING",
    "GRADE_BRAND", "STANDARD", "TEST_METHOD", "OOS_GRADE",
)
TARGET_LABELS = ("GRADE", "CORE_LOSS", "SI_CONTENT", "MPA_VALUE", "FLUX_DENSITY")
COMPETITOR_LABELS = ("COMPETING_MATERIAL", "OOS_GRADE")
SCOPE_TRIGGERS = (r"\bnon-oriented\b", r"\bnon-grain-oriented\b", r"\bngo\b")

UNIT_BY_LABEL = {
    "CORE_LOSS": "W/kg",
    "SI_CONTENT": "%",
    "MPA_VALUE": "MPa",
    "FLUX_DENSITY": "T",
}
PROPERTY_BOUNDS = {
    "yield_strength": (180, 900),
    "tensile_strength": (300, 950),
    "applied_stress": (0, 400),
}
COMPETITOR_ALIASES = {
    "amorphous metal": "amorphous",
    "amorphous metals": "amorphous",
    "amorphous alloy": "amorphous",
    "amorphous steel": "amorphous",
    "amorphous ribbon": "amorphous",
    "goes": "grain-oriented electric steel",
    "go steel": "grain-oriented electric steel",
    "grain oriented electric steel": "grain-oriented electric steel",
    "grain-oriented electric steel": "grain-oriented electric steel",
    "grain oriented steel": "grain-oriented electric steel",
    "grain-oriented electrical steel": "grain-oriented electric steel",
    "grain oriented electrical steel": "grain-oriented electric steel",
    "high permeability grain-oriented": "grain-oriented electric steel",
    "grain-oriented material": "grain-oriented electric steel",
    "grain-oriented silicon steel": "grain-oriented electric steel",
    "grain-oriented steel": "grain-oriented electric steel",
    "hgo": "grain-oriented electric steel",
    "rgo": "grain-oriented electric steel",
    "nd-fe-b": "Hard Magnetic Material",
    "ndfeb": "Hard Magnetic Material",
    "neodymium iron boron": "Hard Magnetic Material",
    "alnico": "Hard Magnetic Material",
    "smco": "Hard Magnetic Material",
    "dysprosium": "Hard Magnetic Material",
    "ferrite magnet": "Hard Magnetic Material",
    "smc": "SMC",
    "soft magnetic composite": "SMC",
    "soft magnetic composites": "SMC",
    "fe-based amorphous": "amorphous",
    "fe-based amorphous alloy": "amorphous",
    "metglas": "amorphous",
    "permalloy": "permalloy",
    "ni-fe alloy": "permalloy",
}
APPLICATION_ALIASES = {
    "hybrid electric vehicle": "hybrid electric vehicle",
    "hev": "hybrid electric vehicle",
    "ev": "electric vehicle",
    "electric vehicle": "electric vehicle",
    "stator": "stator",
    "stator core": "stator",
    "bridge": "bridge component",
    "ipm": "rotor",
}
COMPONENT_TERMS = (
    "rotor", "stator", "stator core", "bridge component",
    "tooth", "yoke", "back iron", "slot", "lamination",
)
COST_ROLES = {
    "GRADE": "material_cost_input",
    "GRADE_BRAND": "material_cost_input",
    "CORE_LOSS": "loss_cost_input",
    "SI_CONTENT": "material_property",
    "PROCESSING": "manufacturing_cost_input",
    "APPLICATION": "model_selector",
    "FLUX_DENSITY": "loss_parameter",
}
PRICED_LABELS = ("GRADE", "GRADE_BRAND")
PRICE_CONSTANT = 0.35

START_YEAR, END_YEAR, PERIOD_YEARS = 1990, 2025, 5
CHUNK_CHARS, CHUNK_MIN_CHARS = 500, 100
MIN_TOPIC_SIZE, REDUCED_DIMS, SEED = 10, 5, 42
# ---- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Everything a run can be tuned with; tables (lexicon, aliases) are passed apart."""

    domain_terms: tuple[str, ...] = DOMAIN_TERMS
    relevance_threshold: int = RELEVANCE_THRESHOLD
    patterns: tuple[TokenPattern, ...] = GRADE_PATTERNS + MEASUREMENT_PATTERNS
    domain_labels: tuple[str, ...] = DOMAIN_LABELS
    target_labels: tuple[str, ...] = TARGET_LABELS
    competitor_labels: tuple[str, ...] = COMPETITOR_LABELS
    scope_triggers: tuple[str, ...] = SCOPE_TRIGGERS
    units: dict[str, str] = field(default_factory=lambda: dict(UNIT_BY_LABEL))
    component_terms: tuple[str, ...] = COMPONENT_TERMS
    priced_labels: tuple[str, ...] = PRICED_LABELS
    price_constant: float = PRICE_CONSTANT
    start_year: int = START_YEAR
    end_year: int = END_YEAR
    period_years: int = PERIOD_YEARS
    chunk_chars: int = CHUNK_CHARS
    chunk_min_chars: int = CHUNK_MIN_CHARS
    cluster_unit: str = "chunk"
    min_topic_size: int = MIN_TOPIC_SIZE
    min_points: int = MIN_TOPIC_SIZE       # points around a core point of a topic, itself included
    radius: float = 0.5                    # of what is around a point, in standard deviations
    reduced_dims: int = REDUCED_DIMS
    reduction: str = "pca"                 # of 256 dimensions; "svd": of 2^18, texts are shuffled once
    seed: int = SEED

    @property
    def period_starts(self) -> list[int]:
        return list(range(self.start_year, self.end_year + 1, self.period_years))

    @property
    def period_labels(self) -> list[str]:
        return [f"{start}-{start + self.period_years - 1}" for start in self.period_starts]
