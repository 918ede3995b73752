"""Fixed values that results depend on, and the expressions that apply them.

All constants of the domain are listed here so that they can be reviewed in one place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: movements -------------------------------------------------------------------
CREDIT_TYPE = 180
CHARGE_TYPE = 181
MOVEMENT_ORIGIN = "M"
CURRENT_ORIGIN, LEGACY_ORIGIN = "MIT", "INTEGRITY"
BALANCE_KIND = "F"
RECODED_MOVEMENT = 117
RECODE_FROM = 114
RECODE_EMPLOYER_TAGS = ("INT. RET08", "INT. CYVTRA")
FUND_RECODES = {98: 14, 99: 15}
ASSIGNED_ACCOUNT_START = 7_000_000_000
AFFILIATED_ACCOUNT = 1
ASSIGNED_ACCOUNT = 2
LEGACY_CODES = (
    106, 109, 129, 210, 260, 405, 406, 410, 412, 413, 414, 416, 420, 421, 423, 424, 426, 430, 433, 436, 440, 441,
    442, 443, 444, 446, 450, 452, 453, 454, 456, 470, 472, 474, 476, 610, 630, 710, 760, 805, 806, 841,
)

# --- fixed values: clients ---------------------------------------------------------------------
CLIENT_ROLE = 787
BUSINESS_LINE = 763
HOME_TYPE = 818
RFC_ID, CURP_ID, NSS_ID = 1, 2, 3
INDICATOR_ORIGIN, INDICATOR_VALIDITY, INDICATOR_PENSION, INDICATOR_CLIENT_TYPE = 1, 2, 11, 12
ORIGIN_LABELS = {"66": "IMSS", "67": "ISSSTE", "68": "INDEPENDIENTE", "69": "MIXTO"}
CLIENT_TYPE_LABELS = {"713": "Asignado", "714": "Afiliado"}
VALIDITY_LABELS = {"1": "V", "0": "N"}
PENSION_LABELS = {"1": "TRUE", "0": "FALSE"}
GENERATION_MARKS = ("SAR", "92")
AFORE, TRANSITION, MIXED = "AFORE", "TRANSICION", "MIXTO"
BOND_FUND = 81
PENSION_PROCESSES = (4050, 4051)
PENSION_SUBPROCESSES = (309, 310)
NON_PENSION_SUBACCOUNTS = (15, 16, 17, 18)

# --- fixed values: statements ------------------------------------------------------------------
GENERATION_IDS = {"AFORE": 2, "TRANSICION": 3}
ORIGIN_CODES = {"ISSSTE": 67, "IMSS": 66, "MIXTO": 69, "INDEPENDIENTE": 68}
CLIENT_TYPE_CODES = {"Afiliado": 714, "Asignado": 713}
PENSIONER_CODE = 1
STATEMENT_LOCK = "CANDADO"
UNKNOWN_REFERENCE = "Desconocido"
SAVINGS_SECTION = "AHO"
SAMPLE_STATUS = "Pendiente"
MANUAL_SAMPLE_PROCEDURE, MANUAL_SAMPLE_AREA = "MM", 1

# --- fixed values: withdrawals -----------------------------------------------------------------
SETTLED_STATUS = 6649
SETTLED_GROUP = "1"
SETTLED_PROCESSES = (4045, 4046, 4047, 4048, 4049, 4050, 4051)
SAVINGS_TYPES = {14: 0, 15: 2, 16: 2}
DEFAULT_SAVINGS_TYPE = 1
WITHDRAWAL_PROCEDURES = (
    "T97", "TRU", "TED", "TNP", "TPP", "T73", "TPR", "TGF", "TPI", "TPG", "TRJ", "TJU", "TIV", "TIX", "TEI", "RJP",
    "TAI", "TNI", "TRE", "PPI", "RCI", "TJI",
)

# --- fixed values: run log ---------------------------------------------------------------------
GREEN, YELLOW, RED, FAILED = "Verde", "Amarillo", "Rojo", "Error"
UNKNOWN_PHASE = "Sin fase"
NOTICE_MENU = 7
MANUAL_FLAGS = 1

# --- fixed values: quality checks --------------------------------------------------------------
NO_DATA = "TABLE_NO_DATA"
MISSED_VALUES = "TABLE_MISSED_VALUES"
UNEXPECTED_VALUES = "TABLE_UNEXPECTED_VALUES"
DUPLICATED_VALUES = "TABLE_DUPLICATED_VALUES"
INVALID_FOREIGN_VALUES = "TABLE_INVALID_FOREIGN_VALUES"
NULL_METRICS = "CONTROL_METRICS_NULL_VALUES"
MISSED_TABLE = "TABLE_MISSED"


def decode(value: Column, table: dict) -> Column:
    """Look a value up in a small fixed table; anything else becomes NULL."""
    branches = list(table.items())
    chain = F.when(value == F.lit(branches[0][0]), F.lit(branches[0][1]))
    for key, label in branches[1:]:
        chain = chain.when(value == F.lit(key), F.lit(label))
    return chain


def digits_key(text: Column) -> Column:
    """Account number from a contract number: its digits, or NULL when there are none."""
    return F.regexp_replace(text.cast("string"), "[^0-9]", "").try_cast("bigint")


def pack_flags(available: Column, printed: Column, sent: Column, generated: Column) -> Column:
    """Four booleans as one integer, the first one in the highest bit."""
    bits = [available, printed, sent, generated]
    return sum(
        (F.shiftleft(bit.cast("int"), 3 - position) for position, bit in enumerate(bits)),
        F.lit(0),
    )


def savings_type(subaccount: Column) -> Column:
    """Savings type of a withdrawal by sub-account."""
    return F.coalesce(decode(subaccount, SAVINGS_TYPES), F.lit(DEFAULT_SAVINGS_TYPE))


def money(value: Column, scale: int = 2) -> Column:
    """Exact money: sums of decimals do not depend on the order in which tasks finish."""
    return value.cast(f"decimal(18,{scale})")
