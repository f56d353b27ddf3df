"""Fixed values. They must not change: results depend on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEM_TYPES = ["movie", "series"]
CATALOG_STATUSES = ["active", "coming_soon", "archived"]
SUBSCRIPTION_PLANS = ["basic", "standard", "premium", "premium_plus"]
ACCOUNT_STATUSES = ["active", "suspended", "cancelled"]
GENDERS = ["male", "female", "other", "unknown"]

# Country code to the language assumed for titles and users from there.
COUNTRY_LANGUAGE = {
    "US": "en", "GB": "en", "CA": "en", "AU": "en", "IE": "en",
    "ES": "es", "MX": "es", "AR": "es", "CO": "es",
    "DE": "de", "AT": "de",
    "FR": "fr",
    "KR": "ko",
    "JP": "ja",
    "IN": "hi",
    "BR": "pt", "PT": "pt",
    "IT": "it",
}

COUNTRY_CODES = {
    "usa": "US", "uk": "GB", "canada": "CA", "south korea": "KR",
    "japan": "JP", "germany": "DE", "france": "FR", "india": "IN",
}

LANGUAGE_CODES = {
    "english": "en", "spanish": "es", "french": "fr", "hindi": "hi",
    "japanese": "ja", "italian": "it", "korean": "ko", "german": "de",
}

GENDER_NAMES = {
    "male": "male", "female": "female", "other": "other", "prefer not to say": "unknown",
}

GENDER_LETTERS = {"M": "male", "F": "female"}

# MovieLens 1M occupation codes.
OCCUPATIONS = {
    "0": "other", "1": "academic/educator", "2": "artist", "3": "clerical/admin",
    "4": "college/grad student", "5": "customer service", "6": "doctor/health care",
    "7": "executive/managerial", "8": "farmer", "9": "homemaker", "10": "K-12 student",
    "11": "lawyer", "12": "programmer", "13": "retired", "14": "sales/marketing",
    "15": "scientist", "16": "self-employed", "17": "technician/engineer",
    "18": "tradesman/craftsman", "19": "unemployed", "20": "writer",
}


def look_up(values: dict[str, str], key: Column) -> Column:
    """The value for ``key``, NULL when there is none."""
    pairs = [F.lit(text) for pair in values.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), key)
