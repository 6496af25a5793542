"""Business constants.

Everything under "Fixed values" must equal the behaviour being reproduced
(thresholds, closed domains, alert texts, segment names); change them only
through a new ``CatalogConfig``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Alert-rule thresholds.
POPULARITY_HIGH = 80
PLAYS_LOW = 3000
PLAYS_HIGH = 7000
VOTES_LOW = 5.0

# Closed domains of the restrictions file.
VALID_CLASSES = ("TE", "TE+7", "14", "18")
VALID_BLOCK_FLAGS = ("SI", "NO")
BLOCKED = "SI"

# Server token that means "no server".
NULL_SERVER = "null_server"

# The seven alert texts, in rule-priority order.
ALERT_CHECK_PLAYS = "Revisar dato de reproducciones"
ALERT_NIGHT_BANNER_AND_BLOCK = "Mover a banner principal nocturno y bloquear de portada infantil"
ALERT_BLOCK_KIDS = "Bloquear de portada infantil"
ALERT_BOOST = "Potenciar en portada principal"
ALERT_KEEP_FEATURED = "Mantener contenido destacado"
ALERT_CHECK_QUALITY = "Revisar calidad antes de promocionar"
ALERT_MONITOR = "Monitorear sin acción inmediata"

ALERTS = (
    ALERT_CHECK_PLAYS,
    ALERT_NIGHT_BANNER_AND_BLOCK,
    ALERT_BLOCK_KIDS,
    ALERT_BOOST,
    ALERT_KEEP_FEATURED,
    ALERT_CHECK_QUALITY,
    ALERT_MONITOR,
)

# Classifier target: alerts that count as "priority action".
PRIORITY_ACTIONS = (
    ALERT_CHECK_PLAYS,
    ALERT_NIGHT_BANNER_AND_BLOCK,
    ALERT_BLOCK_KIDS,
    ALERT_BOOST,
    ALERT_CHECK_QUALITY,
)

# Classifier: label given to a missing age class before one-hot encoding.
UNKNOWN_CLASS = "desconocido"

# Dashboard: critical-alert KPI pattern and the two row-highlight substrings.
CRITICAL_ALERT_PATTERN = "Control Parental|Alerta"
HIGHLIGHT_CRITICAL = "Control Parental"
HIGHLIGHT_OPPORTUNITY = "Oportunidad de Marketing"

# Curated table: maximum text lengths.
MAX_TITLE_LEN = 255
MAX_CLASS_LEN = 20
MAX_ALERT_LEN = 255

# Date formats tried in order (ISO, then day/month/year).
DATE_FORMATS = ("yyyy-M-d", "d/M/yyyy")

# Cluster segment names and the thresholds on cluster means, in priority order:
# votes < 5; popularity >= 100 and plays >= 5000; plays >= 6000 and votes >= 6;
# plays < 5000 and votes >= 6; otherwise.
SEGMENT_LOW_RATING = "Contenido con baja valoración crítica"
SEGMENT_GLOBAL_POPULAR = "Contenido globalmente popular y de alto rendimiento"
SEGMENT_LOCAL_CONSOLIDATED = "Contenido consolidado de alto consumo local"
SEGMENT_MODERATE = "Contenido de consumo moderado / oportunidad de impulso"
SEGMENT_STABLE = "Contenido estable / monitoreo"
SEGMENT_VOTES_LOW = 5
SEGMENT_POPULARITY_HIGH = 100
SEGMENT_PLAYS_HIGH = 5000
SEGMENT_PLAYS_LOCAL = 6000
SEGMENT_VOTES_GOOD = 6

# Model settings: forest size, test share, seed; KMeans k range and restarts.
RF_TREES = 200
TEST_SHARE = 0.20
SEED = 42
K_RANGE = (2, 3, 4, 5, 6)
KMEANS_RESTARTS = 10

# Write batch size used by the JDBC sink.
JDBC_BATCH_SIZE = 500

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CatalogConfig:
    """Tunable parameters; defaults are the fixed values above."""

    popularity_high: float = POPULARITY_HIGH
    plays_low: int = PLAYS_LOW
    plays_high: int = PLAYS_HIGH
    votes_low: float = VOTES_LOW
    valid_classes: tuple[str, ...] = VALID_CLASSES
    valid_block_flags: tuple[str, ...] = VALID_BLOCK_FLAGS
    priority_actions: tuple[str, ...] = PRIORITY_ACTIONS
    critical_alert_pattern: str = CRITICAL_ALERT_PATTERN
    # Opt-in: treat this character as a thousands separator when reading plays
    # ("1.500 visitas" -> 1500). Off by default: the first digit run wins.
    thousands_sep: str | None = None
    date_formats: tuple[str, ...] = field(default=DATE_FORMATS)
    # Models. Iterations of one KMeans fit (it stops earlier once converged);
    # depth of the forest's trees (30 is the most Spark allows; a tree of depth
    # 30 needs memory for its nodes, at most two per training row); most levels
    # of the age class, whose list is held on the driver.
    kmeans_iterations: int = 300
    forest_depth: int = 30
    max_class_levels: int = 1000


DEFAULT_CONFIG = CatalogConfig()
