"""Run parameters and business rules of the customer P&L job.

Everything the job needs to know about codes lives here: the seven run
parameters and the rule tables that turn codes into labels.  Operators
receive a ``JobParams`` and never hard-code a business key.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

# --------------------------------------------------------------------------
# Fixed values.  These must equal the original job's values for its results
# to be reproduced; they are listed as plain text in their natural order.
# --------------------------------------------------------------------------

# company code -> local currency of the ledger
COMPANY_CURRENCY = {
    "AR02": "ARS",
    "BO03": "BOB_ME",
    "BR02": "BRL",
    "BR04": "BRL",
    "CL02": "CLP",
    "CO05": "COP_ME",
    "CR02": "CRC",
    "DO03": "DOP",
    "EC02": "ECS",
    "GT02": "GTQ",
    "HN02": "HNL",
    "MX02": "MXN",
    "NI02": "NIO",
    "PA02": "PAB",
    "PE02": "PEN",
    "PR04": "USD",
    "SV02": "SVC",
    "UY02": "UYU",
}
# companies whose amounts are booked in hundredths (multiplied by 100)
SCALED_COMPANIES = ("CL02",)
# companies where an indicator decides gross sales / allowance
INDICATOR_COMPANIES = ("BR02", "BR04")
INDICATOR_KEEP_GROSS = "GS"
INDICATOR_GROSS_AS_ALLOWANCE = "UD"
# companies that must book in USD; all others must not
USD_COMPANIES = ("EC02", "PR04", "PA02", "SV02")
USD = "USD"
# ledger line filters
EXCLUDED_INDICATOR_A = ("IC",)
ALLOWED_INDICATOR_B = "ES"
EXCLUDED_CUSTOMER = "PL1048"
# customers booked to the second country; everything else is the first
COUNTRY_CUSTOMERS = ("100067548", "156049958", "156049959", "156191760", "156191761")
COUNTRY_IN_SET = "PARAGUAY"
COUNTRY_DEFAULT = "URUGUAY"
# default-customer rows of these SKUs are re-keyed to one customer
REKEY_SKUS = ("76222105759801", "76222106144000", "76222017596000")
REKEY_CUSTOMER = "156191761"
SKU_PREFIX = "SK"
# customer hierarchy: level-2 description -> channel
CHANNEL_BY_LEVEL2 = {
    "MODERN TRADE": "MT_UY",
    "TRADITIONAL TRADE": "TD_UY",
    "TT Export": "TD_PARAGUAY",
    "EXP-EXPORTS-1": "TD_PARAGUAY",
}
CUSTOMER_HIERARCHY_TYPE = "A"
# reporting-system account code -> measure name
ACCOUNT_MEASURE = {
    "PL211005": "COGS_MANUFACTURING",
    "PL212099": "COGS_LOGISTIC",
    "PL201010": "GROSS_SALES",
    "PL202000": "G2N",
    "PLV959999": "VOLUME",
}
PLANNING_ACCOUNT_MEASURE = {
    "PL211005": "COGS_MANUFACTURING",
    "PL212099": "COGS_LOGISTIC",
    "PL201010": "GROSS_SALES",
    "PL202000": "G2N",
    "PL213999": "GROSS_PROFIT",
    "PLV959999": "VOLUME",
}
# which hierarchy level carries which account codes
REPORTING_LEVEL_08 = ("PL211005", "PL212099")
REPORTING_LEVEL_07 = ("PL202000", "PL201010")
REPORTING_LEAF = ("PLV959999",)
PLANNING_LEVEL_05 = ("PLV959999", "PL213999")
PLANNING_LEVEL_08 = ("PL211005", "PL212099")
PLANNING_LEVEL_07 = ("PL202000", "PL201010")
REPORTING_CURRENCY = "LCL"
REPORTING_SKU_PREFIX = "SKU_SK"
# reporting entity -> country
ENTITY_COUNTRY = {
    "CDBOLFS": "BOLIVIA",
    "BOALLOC": "BOLIVIA",
    "BOLFS": "BOLIVIA",
    "ARUFS_Local": "ARGENTINA",
    "BRLFS": "BRAZIL",
    "SVLFS": "EL SALVADOR",
    "GTLFS": "GUATEMALA",
    "HNLFS": "HONDURAS",
    "MXLFS": "MEXICO",
    "NILFS": "NICARAGUA",
    "PALFS": "PANAMA",
    "DOLFS": "REPUBLICA DOMINICANA",
    "UYLFS": "URUGUAY",
    "CLLFS": "CHILE",
    "COALLOC": "COLOMBIA",
    "CDCOLCOM": "COLOMBIA",
    "CDCOLOM2_ELIM": "COLOMBIA",
    "CDCOLSC": "COLOMBIA",
    "COLFS": "COLOMBIA",
    "COLFSLAN": "COLOMBIA",
    "COT2_ELIM": "COLOMBIA",
    "ECLFS": "ECUADOR",
    "PELFS": "PERU",
    "BRLFSKFX": "AMEX",
    "CAMFSUSX": "AMEX",
    "CDWIUFS": "AMEX",
    "CRBUSDEXP": "AMEX",
    "LAEX2_ELIM": "AMEX",
    "LAEXALLOC": "AMEX",
    "PRUFSKFT": "PUERTO RICO",
    "CRLFS": "COSTA RICA",
    "MBSCRLFS": "COSTA RICA",
}
# planning only knows one entity -> country pair
PLANNING_ENTITY_COUNTRY = {"UYLFS": "URUGUAY"}
PLANNING_SCENARIO = "AC"
PLANNING_EXCLUDED_ACCOUNTS = ("PLC203000_50",)
# exchange rates
FX_ACCOUNT = "Avg_Rate"
FX_SCENARIO_ALT = "AC"
FX_SCENARIO_ACT = "Act"
FX_VERSION = "Final"
MONTH_ABBREVIATIONS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# output labels
ACTUAL_SCENARIO = "ACT"
DUMMY_KEY = "-1"
ACCOUNT_LABELS = {
    # account: (level 1, level 2, level 3)
    "COGS_MANUFACTURING": ("COGS", "COGS_MANUFACTURING", "COGS_MANUFACTURING"),
    "COGS_LOGISTIC": ("COGS", "COGS_LOGISTIC", "COGS_LOGISTIC"),
    "GROSS_PROFIT": ("Gross Profit", "Gross Profit", "Gross Profit"),
    "G2N": ("Gross to Net", "Gross to Net", "Gross to Net"),
    "GROSS_SALES": ("Gross Sales", "Gross Sales", "Gross Sales"),
    "NET_REVENUE": ("Net Revenue", "Net Revenue", "Net Revenue"),
    "VOLUME": ("Volume", "VOLUME", "Volume"),
}
# derived accounts: what they are made of, in the signs of the source systems
DERIVED_ACCOUNTS = {
    "NET_REVENUE": ("GROSS_SALES", "G2N"),
    "GROSS_PROFIT": ("NET_REVENUE", "COGS_MANUFACTURING", "COGS_LOGISTIC"),
}
# accounts that the result shows with the opposite sign
SHOWN_NEGATED = ("G2N", "COGS_MANUFACTURING", "COGS_LOGISTIC")
# order of the long-form measures (unpivot order)
ACTUAL_MEASURES = ("GROSS_SALES", "G2N", "VOLUME", "COGS_LOGISTIC", "COGS_MANUFACTURING", "GROSS_PROFIT", "NET_REVENUE")
# output schema, in order
OUTPUT_COLUMNS = (
    "SKU", "CUSTOMER", "CUSTOMER_NAME", "BRAND", "SUBBRAND", "CATEGORY", "FORMAT_FLAVOR", "PERIOD_YEAR", "DATE",
    "CHANNEL", "SUBCHANNEL", "Area", "Cluster", "Market", "SCENARIO", "ACCOUNT_LVL_1", "ACCOUNT_LVL_2",
    "ACCOUNT_LVL_3", "Value_AC_Rate", "Value_PY_Rate", "Value_USD", "Value_LCL",
)
# default run parameters of the original job
DEFAULT_PERIOD_START = dt.date(2023, 1, 1)
DEFAULT_PERIOD_END = dt.date(2024, 9, 30)
DEFAULT_REPORTING_START = dt.date(2023, 1, 1)
DEFAULT_COMPANY = "UY02"
DEFAULT_ENTITY = "UYLFS"
DEFAULT_CUSTOMER = "#"
DEFAULT_SKU = "001"
# --------------------------------------------------------------------------


@dataclasses.dataclass(frozen=True)
class JobParams:
    """The seven run parameters plus the rule sets that address specific keys."""

    period_start: dt.date = DEFAULT_PERIOD_START
    period_end: dt.date = DEFAULT_PERIOD_END
    reporting_start: dt.date = DEFAULT_REPORTING_START
    company: str = DEFAULT_COMPANY
    entity: str = DEFAULT_ENTITY
    default_customer: str = DEFAULT_CUSTOMER
    default_sku: str = DEFAULT_SKU
    excluded_customer: str = EXCLUDED_CUSTOMER
    country_customers: tuple[str, ...] = COUNTRY_CUSTOMERS
    rekey_skus: tuple[str, ...] = REKEY_SKUS
    rekey_customer: str = REKEY_CUSTOMER

    @property
    def company_currency(self) -> str | None:
        return COMPANY_CURRENCY.get(self.company)


def synthetic_params() -> JobParams:
    """Parameters for the derived views over the TPC-H-like test tables.

    The views translate the test tables into the original code space
    (companies, entities, accounts), so only the date window and the rules
    that name individual customers / SKUs differ from the defaults.
    """
    return JobParams(
        period_start=dt.date(1997, 1, 1),
        period_end=dt.date(1998, 9, 30),
        reporting_start=dt.date(1997, 1, 1),
        # customers 3, 10, 17, ... (every 7th key below 300) form the second country
        country_customers=tuple(str(k) for k in range(3, 300, 7)),
        rekey_skus=("12", "34", "56"),
        rekey_customer="3",
    )
