"""Text predicates, URL parts and label maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from screenmart.functions.steps import lookup

# Tenant slugs that may open a URL path.
STATE_SLUGS = ["co", "nc", "tx", "wa", "il", "ma", "cesn"]

# Referral sources that mark a test screen.
TEST_SOURCE_PATTERN = "(?i)^(testOrProspect|stagingTest|test)$"

# Language names by request code.
LANGUAGES = {
    "af": "Afrikaans", "ar": "Arabic", "ar-dz": "Algerian Arabic", "ast": "Asturian",
    "az": "Azerbaijani", "bg": "Bulgarian", "be": "Belarusian", "bn": "Bengali",
    "br": "Breton", "bs": "Bosnian", "ca": "Catalan", "ckb": "Central Kurdish (Sorani)",
    "cs": "Czech", "cy": "Welsh", "da": "Danish", "de": "German", "dsb": "Lower Sorbian",
    "el": "Greek", "en": "English", "en-us": "English", "en-au": "Australian English",
    "en-gb": "British English", "eo": "Esperanto", "es": "Spanish",
    "es-ar": "Argentinian Spanish", "es-co": "Colombian Spanish", "es-mx": "Mexican Spanish",
    "es-ni": "Nicaraguan Spanish", "es-ve": "Venezuelan Spanish", "et": "Estonian",
    "eu": "Basque", "fa": "Persian", "fi": "Finnish", "fr": "French", "fy": "Frisian",
    "ga": "Irish", "gd": "Scottish Gaelic", "gl": "Galician", "he": "Hebrew", "hi": "Hindi",
    "hr": "Croatian", "hsb": "Upper Sorbian", "hu": "Hungarian", "hy": "Armenian",
    "ia": "Interlingua", "id": "Indonesian", "ig": "Igbo", "io": "Ido", "is": "Icelandic",
    "it": "Italian", "ja": "Japanese", "ka": "Georgian", "kab": "Kabyle", "kk": "Kazakh",
    "km": "Khmer", "kn": "Kannada", "ko": "Korean", "ky": "Kyrgyz", "lb": "Luxembourgish",
    "lt": "Lithuanian", "lv": "Latvian", "mk": "Macedonian", "ml": "Malayalam",
    "mn": "Mongolian", "mr": "Marathi", "ms": "Malay", "my": "Burmese",
    "nb": "Norwegian Bokmål", "ne": "Nepali", "nl": "Dutch", "nn": "Norwegian Nynorsk",
    "os": "Ossetic", "pa": "Punjabi", "pl": "Polish", "pt": "Portuguese",
    "pt-br": "Brazilian Portuguese", "ro": "Romanian", "ru": "Russian", "sk": "Slovak",
    "sl": "Slovenian", "sq": "Albanian", "sr": "Serbian", "sr-latn": "Serbian Latin",
    "sv": "Swedish", "sw": "Swahili", "ta": "Tamil", "te": "Telugu", "tg": "Tajik",
    "th": "Thai", "tk": "Turkmen", "tr": "Turkish", "tt": "Tatar", "udm": "Udmurt",
    "ug": "Uyghur", "uk": "Ukrainian", "ur": "Urdu", "uz": "Uzbek", "vi": "Vietnamese",
    "zh-hans": "Simplified Chinese", "zh-hant": "Traditional Chinese",
}

# Immediate-need flags and their display names.
NEEDS = {
    "needs_baby_supplies": "Baby Supplies",
    "needs_child_dev_help": "Child Development",
    "needs_food": "Food",
    "needs_funeral_help": "Funeral",
    "needs_housing_help": "Housing",
    "needs_mental_health_help": "Mental Health",
    "needs_family_planning_help": "Family Planning",
    "needs_dental_care": "Dental Care",
    "needs_job_resources": "Job Resources",
    "needs_legal_services": "Legal Services",
    "needs_college_savings": "College Savings",
    "needs_veteran_services": "Veteran Services",
}


def filled(c: Column) -> Column:
    """Not NULL and not blank."""
    return F.coalesce(F.trim(c) != "", F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def extract(c: Column, pattern: str) -> Column:
    """First capture group, NULL where the pattern misses."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def url_state(page_location: Column, slugs: list[str] = STATE_SLUGS) -> Column:
    """Tenant slug that is the whole first path segment of a URL."""
    segment = extract(page_location, "https?://[^/]+/([^/?#]+)")
    return F.when(segment.isin(slugs), segment)


def page_path(url: Column) -> Column:
    return extract(url, "[^/]+://[^/]+(/[^?]*)")


def host_name(url: Column) -> Column:
    return extract(url, "[^/]+://([^/]+)")


def path_state_code(url: Column) -> Column:
    return extract(url, "^[^/]+://[^/]+/([a-z][a-z0-9_]+)/")


def language_name(code: Column) -> Column:
    return lookup(LANGUAGES, code, F.lit("(blank)"))


def word_caps(c: Column) -> Column:
    """First letter of each word in upper case, the rest in lower case.

    A word ends at white space or at any of the listed marks, not only at a space.
    """
    parts = F.split(F.lower(c), r"(?<=[\s\[\](){}/|\\<>!?@\"^#$&~_,.:;*%+-])")
    return F.array_join(
        F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""
    )
