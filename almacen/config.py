"""Parameters and business rules.

Every rule is a plain parameter so callers can override it; the defaults are
the values the reference pipeline uses.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------
# gender standardisation: (source values, output); anything else, nulls too
GENDER_RULES = ((("M", "Masculino"), "M"), (("F", "Femenino"), "F"))
GENDER_DEFAULT = "No informado"
# age range used when a member and its whole channel have none
AGE_RANGE_DEFAULT = "30-45"
# estimated margin rate by level-1 category; the default rate otherwise
MARGIN_RULES = ((("CAT_1", "ELECTRONICA", "TEC"), 0.25), (("CAT_2", "ROPA", "TEXTIL"), 0.45))
MARGIN_DEFAULT = 0.35
# store country from a city substring (checked on the upper-cased city, in order)
GEO_RULES = (("SANTIAGO", "Chile"), ("CDMX", "Mexico"), ("BOGOTA", "Colombia"), ("QUITO", "Ecuador"), ("LIMA", "Peru"))
GEO_DEFAULT_COUNTRY = "Colombia"
NULL_CITY = "CIUDAD_PRINCIPAL"
ZONE_PREFIX = "ZONA_DIST_"
# customer key of a sale without a known member
ANONYMOUS_CUSTOMER = "CLIENTE_ANONIMO"
# stock coverage when there is no positive consumption, and the alert threshold in days
COVERAGE_NO_CONSUMPTION = 999.0
STOCKOUT_DAYS = 7
# return motive text: (source codes, description); anything else is the default
MOTIVE_RULES = (
    (("DEF", "DEFECTUOSO"), "Producto Defectuoso"),
    (("TAL", "TALLA"), "Talla / Tamaño Incorrecto"),
    (("ERR", "ERROR"), "Envío Erróneo"),
)
MOTIVE_DEFAULT = "Otro Motivo"
# RFM: look-back window in days (inclusive of both ends), number of tiles
RFM_WINDOW_DAYS = 90
RFM_TILES = 5
# RFM segments, first match wins: (name, min R, max R, min F, max F, min M)
SEGMENT_RULES = (
    ("Champions / Pro", 4, 5, 4, 5, 4),
    ("Clientes Fieles", 3, 5, 3, 5, 1),
    ("En Riesgo", 1, 2, 3, 5, 1),
    ("Abandono", 1, 1, 1, 2, 1),
)
SEGMENT_DEFAULT = "En Desarrollo / Ocasionales"
CHURN_SEGMENTS = ("En Riesgo", "Abandono")
# referential-integrity reject reason for sales
RI_REJECT_REASON = "ERROR_INTEGRIDAD_REFERENCIAL_ART_O_TIENDA"
NULL_KEY_REJECT_REASON = "ERROR_LLAVE_NULA"
# bronze lineage constants
SOURCE_SYSTEM = "SQL_ORIGEN"
INGEST_TS = "FechaIngesta"
# counts that travel with a row: source rows behind it, values that did not convert
ROWS, FAILURES = "_rows", "_failures"
# key of an unknown store or original sale in the sources
UNKNOWN_KEY = -1
# run id formats of the silver and gold stages
SILVER_RUN_FORMAT = "EXEC_%Y%m%d_%H%M%S"
GOLD_RUN_FORMAT = "EXEC_GOLD_%Y%m%d_%H%M%S"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RunContext:
    """Run id and run time, made once per run and passed down (no clock below)."""

    run_id: str
    run_ts: _dt.datetime

    @staticmethod
    def now(fmt: str = SILVER_RUN_FORMAT) -> "RunContext":
        ts = _dt.datetime.now()
        return RunContext(ts.strftime(fmt), ts)


@dataclass(frozen=True)
class SilverConfig:
    gender_rules: tuple = GENDER_RULES
    gender_default: str = GENDER_DEFAULT
    age_default: str = AGE_RANGE_DEFAULT
    pii_salt: str | None = None
    reject_reason: str = RI_REJECT_REASON
    null_key_reason: str = NULL_KEY_REJECT_REASON
    reject_detail: bool = False


@dataclass(frozen=True)
class GoldConfig:
    margin_rules: tuple = MARGIN_RULES
    margin_default: float = MARGIN_DEFAULT
    geo_rules: tuple = GEO_RULES
    geo_default: str = GEO_DEFAULT_COUNTRY
    motive_rules: tuple = MOTIVE_RULES
    motive_default: str = MOTIVE_DEFAULT
    stockout_days: int = STOCKOUT_DAYS
    consumption_mode: str = "all"  # "all" (reference) or "trailing"
    consumption_days: int = 14
    consumption_calendar_days: bool = False  # divide by the days of the window instead of its sale days
    rfm_days: int = RFM_WINDOW_DAYS
    rfm_tiles: int = RFM_TILES
    rfm_include_anonymous: bool = True
    segment_rules: tuple = SEGMENT_RULES
    segment_default: str = SEGMENT_DEFAULT
    keep_raw_member_id: bool = True
    as_of: _dt.date | None = None


@dataclass(frozen=True)
class JoinConfig:
    """Salts of a hot join key, at least (more where the session shuffles to more partitions)."""

    null_key_salts: int = 64


DEFAULT_SILVER = SilverConfig()
DEFAULT_GOLD = GoldConfig()
DEFAULT_JOIN = JoinConfig()
