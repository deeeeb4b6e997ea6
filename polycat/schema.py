"""Tables of a catalog dataset: columns, keys, code domains, locales."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Locales in order of precedence, and the codes that may be stored.
LOCALES = ["gb", "us", "au", "jp", "cn", "tw", "hk", "kr", "fr", "it", "de", "es", "pt", "bp", "nl", "pl", "tr", "ru", "gr", "ms", "th"]
#: What rows of a dataset without locales count as.
DEFAULT_LOCALE = "us"
ASPIRATION_CODES = ["NA", "TC", "SC", "EV", "HV", "TC+SC"]
DRIVETRAIN_CODES = ["FR", "FF", "MR", "RR", "4WD", "AWD"]

TABLES = {
    "manufacturers": "id string, name string, logo_path string, country_id string",
    "manufacturer_i18n": "id string, locale string, name string",
    "cars": "id string, name string, manufacturer_id string, aspiration_code string, drivetrain_code string, intro string, detail string, car_class string, pp string, year string, raw_json string",
    "aspiration_codes": "code string, default_name string",
    "aspiration_i18n": "code string, locale string, label string",
    "drivetrain_codes": "code string, default_name string",
    "drivetrain_i18n": "code string, locale string, label string",
    "car_specs": "id long, car_id string, locale string, spec_key string, spec_value string, spec_unit string, spec_raw string, sort_order int",
    "spec_code_i18n": "code string, locale string, label string",
    "car_texts": "car_id string, locale string, name string, intro string, detail string",
    "fetch_log": "id long, car_id string, locale string, status string, message string, updated_at string",
    "meta": "key string, value string",
    "country_iso_map": "country_id string, iso3 string",
    "country_i18n": "iso3 string, locale string, name string",
    "car_images": "id long, car_id string, image_path string, sort_order int, image_type string",
}
#: Tables that a dataset may lack.
OPTIONAL = {"car_images"}
KEYS = {
    "manufacturers": ["id"],
    "manufacturer_i18n": ["id", "locale"],
    "cars": ["id"],
    "aspiration_codes": ["code"],
    "aspiration_i18n": ["code", "locale"],
    "drivetrain_codes": ["code"],
    "drivetrain_i18n": ["code", "locale"],
    "spec_code_i18n": ["code", "locale"],
    "car_texts": ["car_id", "locale"],
    "meta": ["key"],
    "country_iso_map": ["country_id"],
    "country_i18n": ["iso3", "locale"],
}
NOT_NULL = {
    "manufacturers": ["id", "name"],
    "manufacturer_i18n": ["id", "locale", "name"],
    "cars": ["id", "name"],
    "car_specs": ["car_id", "locale", "spec_key"],
    "spec_code_i18n": ["code", "locale", "label"],
    "car_texts": ["car_id", "locale"],
    "fetch_log": ["car_id", "locale", "status", "updated_at"],
    "country_iso_map": ["country_id", "iso3"],
    "country_i18n": ["iso3", "locale", "name"],
    "car_images": ["car_id", "image_path"],
}
#: (table, column) -> (table, column) that it refers to.
REFERENCES = {
    ("manufacturer_i18n", "id"): ("manufacturers", "id"),
    ("cars", "manufacturer_id"): ("manufacturers", "id"),
    ("aspiration_i18n", "code"): ("aspiration_codes", "code"),
    ("drivetrain_i18n", "code"): ("drivetrain_codes", "code"),
    ("car_specs", "car_id"): ("cars", "id"),
    ("car_texts", "car_id"): ("cars", "id"),
    ("car_images", "car_id"): ("cars", "id"),
}
#: Tables that are laid out by locale.
BY_LOCALE = [t for t, c in TABLES.items() if "locale string" in c]


def struct(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])
