"""Reference values: currencies, industries, companies, feed schemas, rule codes."""

from __future__ import annotations

import uuid

# ---------------------------------------------------------------------------
# Fixed values. Ids, names, codes and bounds below must stay as they are: ids
# stored in existing tables are derived from them.
# ---------------------------------------------------------------------------

COMPANY_NAMESPACE = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"
INDUSTRY_NAMESPACE = "b2c3d4e5-f6a7-8901-bcde-f12345678901"
CATEGORY_NAMESPACE = "c3d4e5f6-a7b8-9012-cdef-123456789012"
QUARANTINE_NAMESPACE = "a7c3d4e5-f6a7-4b8c-9d0e-1f2a3b4c5d6e"
# Ours: surrogate keys that replace database-generated random ids.
SURROGATE_NAMESPACE = "5e0f7a52-3a38-4d0e-9d57-6a1c0c7be001"

# Currency code -> name.
CURRENCIES = {
    "USD": "US Dollar",
    "EUR": "Euro",
    "GBP": "British Pound",
    "JPY": "Japanese Yen",
    "AUD": "Australian Dollar",
    "CAD": "Canadian Dollar",
    "CHF": "Swiss Franc",
    "SEK": "Swedish Krona",
    "NOK": "Norwegian Krone",
    "MXN": "Mexican Peso",
    "BRL": "Brazilian Real",
    "SGD": "Singapore Dollar",
    "HKD": "Hong Kong Dollar",
    "AED": "UAE Dirham",
}

# Spellings accepted for each currency, besides any casing of the code itself.
CURRENCY_SPELLINGS = {
    "USD": ["us dollars", "us dollar", "$", "u.s.d.", "dollar"],
    "EUR": ["euro", "euros", "€"],
    "GBP": ["pound", "pounds", "£", "sterling"],
    "JPY": ["yen", "¥"],
    "AUD": ["a$", "australian"],
    "CAD": ["c$", "canadian"],
    "CHF": ["franc", "francs"],
    "SEK": ["krona"],
    "NOK": ["krone"],
    "MXN": ["peso"],
    "BRL": ["real", "reais", "r$"],
    "SGD": ["s$"],
    "HKD": ["hk$"],
    "AED": ["dirham", "dirhams"],
}

# Industry name -> display currency.
INDUSTRIES = {
    "Technology": "USD",
    "Retail": "EUR",
    "Fintech": "USD",
    "Logistics": "USD",
}

EXPENSE_CATEGORIES = ["Payroll", "Materials", "Utilities", "Rent", "Travel", "Software"]

# Company key, name, industry, headquarters country, default currency.
COMPANIES = [
    ("COMP001", "Orion Systems", "Technology", "United States", "USD"),
    ("COMP002", "BluePeak Analytics", "Technology", "United States", "USD"),
    ("COMP003", "NexaData Corp", "Technology", "United States", "USD"),
    ("COMP004", "AlpenMart GmbH", "Retail", "Germany", "EUR"),
    ("COMP005", "Nordic Trade AB", "Retail", "Sweden", "SEK"),
    ("COMP006", "Louvre Commerce SARL", "Retail", "France", "EUR"),
    ("COMP007", "ZenPay Ltd", "Fintech", "Singapore", "SGD"),
    ("COMP008", "Kumo Holdings", "Fintech", "Japan", "JPY"),
    ("COMP009", "Pacific Ledger Co", "Fintech", "Hong Kong", "HKD"),
    ("COMP010", "Andes Logistics", "Logistics", "Mexico", "MXN"),
    ("COMP011", "RioSoft Tecnologia", "Technology", "Brazil", "BRL"),
    ("COMP012", "Patagonia Digital", "Logistics", "Argentina", "USD"),
]

# Short names accepted for a company, besides any casing of its full name.
COMPANY_SHORT_NAMES = [
    ("ORION SYSTEMS INC", "COMP001"),
    ("BLUEPEAK", "COMP002"),
    ("NEXADATA", "COMP003"),
    ("ALPENMART", "COMP004"),
    ("ZENPAY", "COMP007"),
]

# Column names used by feeds -> canonical column name.
FEED_COLUMNS = {
    "tx_time": "tx_timestamp",
    "company": "company_id",
    "currency": "base_cncy",
    "fee": "fee_amount",
    "timestamp": "tx_timestamp",
    "firm_id": "company_id",
    "base_amount": "amount",
    "service_fee": "fee_amount",
    "date": "tx_timestamp",
    "seller": "company_id",
    "curr": "base_cncy",
    "gross_value": "amount",
    "charges": "fee_amount",
    "transaction_date": "tx_timestamp",
    "client_id": "company_id",
    "payment_currency": "base_cncy",
    "transaction_amount": "amount",
    "processing_fee": "fee_amount",
    "data_hora": "tx_timestamp",
    "empresa_id": "company_id",
    "moeda": "base_cncy",
    "valor": "amount",
    "taxa": "fee_amount",
}

# Spreadsheet day 0 as days before 1970-01-01 (day 0 is 1899-12-30).
SPREADSHEET_EPOCH_DAYS = 25569

# Failure codes written to the quarantine and the column each one is about.
DIRTY_COLUMN = {
    "NULL_COMPANY_ID": "c_id",
    "UNKNOWN_COMPANY": "c_id",
    "INVALID_AMOUNT": "amount",
    "INVALID_BASE_CURRENCY": "base_cncy",
    "NULL_TIMESTAMP": "tx_timestamp",
}

# Plausible USD rate per currency, inclusive.
RATE_BOUNDS = {
    "EUR": (0.5, 2.0),
    "GBP": (0.5, 2.5),
    "JPY": (50.0, 200.0),
    "AUD": (0.5, 2.0),
    "CAD": (0.5, 2.0),
    "CHF": (0.5, 2.0),
    "SEK": (5.0, 15.0),
    "NOK": (5.0, 15.0),
    "MXN": (10.0, 25.0),
    "BRL": (2.0, 10.0),
    "SGD": (0.8, 2.0),
    "HKD": (5.0, 10.0),
    "AED": (2.0, 5.0),
}

NOISE_LEVELS = {"low": 0, "medium": 1, "high": 2}
FX_SOURCES = ("live", "synthetic")
RESOLUTION_ACTIONS = ("deleted", "requeued")
COMPANY_WEIGHT_RANGE = (0.01, 1.0)

# --- end of fixed values ---------------------------------------------------


def _uuid5(namespace: str, name: str) -> str:
    return str(uuid.uuid5(uuid.UUID(namespace), name))


def currency_aliases() -> dict[str, str]:
    """Lower-case spelling -> code, codes included."""
    aliases = {code.lower(): code for code in CURRENCIES}
    for code, spellings in CURRENCY_SPELLINGS.items():
        aliases.update(dict.fromkeys(spellings, code))
    return aliases


def company_id(key: str) -> str:
    return _uuid5(COMPANY_NAMESPACE, key)


def industry_id(name: str) -> str:
    return _uuid5(INDUSTRY_NAMESPACE, name)


def category_id(name: str) -> str:
    return _uuid5(CATEGORY_NAMESPACE, name)
