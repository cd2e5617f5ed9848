"""These must be exactly as given for results to be right."""

from __future__ import annotations

# Two-letter language codes and their English names.
LANGUAGES = {
    "aa": "Afar",
    "ab": "Abkhazian",
    "ae": "Avestan",
    "af": "Afrikaans",
    "ak": "Akan",
    "am": "Amharic",
    "an": "Aragonese",
    "ar": "Arabic",
    "as": "Assamese",
    "av": "Avaric",
    "ay": "Aymara",
    "az": "Azerbaijani",
    "ba": "Bashkir",
    "be": "Belarusian",
    "bg": "Bulgarian",
    "bh": "Bihari",
    "bi": "Bislama",
    "bm": "Bambara",
    "bn": "Bengali",
    "bo": "Tibetan",
    "br": "Breton",
    "bs": "Bosnian",
    "ca": "Catalan",
    "ce": "Chechen",
    "ch": "Chamorro",
    "co": "Corsican",
    "cr": "Cree",
    "cs": "Czech",
    "cu": "Church Slavic",
    "cv": "Chuvash",
    "cy": "Welsh",
    "da": "Danish",
    "de": "German",
    "dv": "Divehi",
    "dz": "Dzongkha",
    "ee": "Ewe",
    "el": "Greek",
    "en": "English",
    "eo": "Esperanto",
    "es": "Spanish",
    "et": "Estonian",
    "eu": "Basque",
    "fa": "Persian",
    "ff": "Fulah",
    "fi": "Finnish",
    "fj": "Fijian",
    "fo": "Faroese",
    "fr": "French",
    "fy": "Western Frisian",
    "ga": "Irish",
    "gd": "Scottish Gaelic",
    "gl": "Galician",
    "gn": "Guarani",
    "gu": "Gujarati",
    "gv": "Manx",
    "ha": "Hausa",
    "he": "Hebrew",
    "hi": "Hindi",
    "ho": "Hiri Motu",
    "hr": "Croatian",
    "ht": "Haitian",
    "hu": "Hungarian",
    "hy": "Armenian",
    "hz": "Herero",
    "ia": "Interlingua",
    "id": "Indonesian",
    "ie": "Interlingue",
    "ig": "Igbo",
    "ii": "Sichuan Yi",
    "ik": "Inupiaq",
    "io": "Ido",
    "is": "Icelandic",
    "it": "Italian",
    "iu": "Inuktitut",
    "ja": "Japanese",
    "jv": "Javanese",
    "ka": "Georgian",
    "kg": "Kongo",
    "ki": "Kikuyu",
    "kj": "Kuanyama",
    "kk": "Kazakh",
    "kl": "Kalaallisut",
    "km": "Khmer",
    "kn": "Kannada",
    "ko": "Korean",
    "kr": "Kanuri",
    "ks": "Kashmiri",
    "ku": "Kurdish",
    "kv": "Komi",
    "kw": "Cornish",
    "ky": "Kirghiz",
    "la": "Latin",
    "lb": "Luxembourgish",
    "lg": "Ganda",
    "li": "Limburgan",
    "ln": "Lingala",
    "lo": "Lao",
    "lt": "Lithuanian",
    "lu": "Luba-Katanga",
    "lv": "Latvian",
    "mg": "Malagasy",
    "mh": "Marshallese",
    "mi": "Maori",
    "mk": "Macedonian",
    "ml": "Malayalam",
    "mn": "Mongolian",
    "mr": "Marathi",
    "ms": "Malay",
    "mt": "Maltese",
    "my": "Burmese",
    "na": "Nauru",
    "nb": "Norwegian Bokmål",
    "nd": "North Ndebele",
    "ne": "Nepali",
    "ng": "Ndonga",
    "nl": "Dutch",
    "nn": "Norwegian Nynorsk",
    "no": "Norwegian",
    "nr": "South Ndebele",
    "nv": "Navajo",
    "ny": "Chichewa",
    "oc": "Occitan",
    "oj": "Ojibwa",
    "om": "Oromo",
    "or": "Oriya",
    "os": "Ossetian",
    "pa": "Punjabi",
    "pi": "Pali",
    "pl": "Polish",
    "ps": "Pashto",
    "pt": "Portuguese",
    "qu": "Quechua",
    "rm": "Romansh",
    "rn": "Rundi",
    "ro": "Romanian",
    "ru": "Russian",
    "rw": "Kinyarwanda",
    "sa": "Sanskrit",
    "sc": "Sardinian",
    "sd": "Sindhi",
    "se": "Northern Sami",
    "sg": "Sango",
    "si": "Sinhala",
    "sk": "Slovak",
    "sl": "Slovenian",
    "sm": "Samoan",
    "sn": "Shona",
    "so": "Somali",
    "sq": "Albanian",
    "sr": "Serbian",
    "ss": "Swati",
    "st": "Southern Sotho",
    "su": "Sundanese",
    "sv": "Swedish",
    "sw": "Swahili",
    "ta": "Tamil",
    "te": "Telugu",
    "tg": "Tajik",
    "th": "Thai",
    "ti": "Tigrinya",
    "tk": "Turkmen",
    "tl": "Tagalog",
    "tn": "Tswana",
    "to": "Tonga",
    "tr": "Turkish",
    "ts": "Tsonga",
    "tt": "Tatar",
    "tw": "Twi",
    "ty": "Tahitian",
    "ug": "Uighur",
    "uk": "Ukrainian",
    "ur": "Urdu",
    "uz": "Uzbek",
    "ve": "Venda",
    "vi": "Vietnamese",
    "vo": "Volapük",
    "wa": "Walloon",
    "wo": "Wolof",
    "xh": "Xhosa",
    "yi": "Yiddish",
    "yo": "Yoruba",
    "za": "Zhuang",
    "zh": "Chinese",
    "zu": "Zulu",
}

# Page namespaces that are kept.
NAMESPACES = [
    "Article",
    "User",
    "Wikipedia",
    "WP",
    "Project",
    "File",
    "Image",
    "MediaWiki",
    "Template",
    "TM",
    "Help",
    "Category",
    "Portal",
    "Draft",
    "TimedText",
    "Module",
    "MOS",
    "Event",
    "User talk",
    "Talk",
    "WT",
    "Special",
    "Transwiki",
    "Media",
    "Wikipedia talk",
    "File talk",
    "MediaWiki talk",
    "Template talk",
    "Help talk",
    "Category talk",
    "Portal talk",
    "Draft talk",
    "MOS talk",
    "TimedText talk",
    "Module talk",
    "Event talk",
]
DEFAULT_NAMESPACE = "Article"

# First parts of domain codes that belong to no language.
SPECIAL_DOMAINS = [
    "commons",
    "meta",
    "incubator",
    "species",
    "strategy",
    "outreach",
    "usability",
    "quality",
]

# Domain code parts and the project they stand for; the first match in this order wins.
PROJECT_SUFFIXES = {
    "voy": "wikivoyage",
    "b": "wikibooks",
    "q": "wikiquote",
    "n": "wikinews",
    "s": "wikisource",
    "v": "wikiversity",
    "d": "wiktionary",
    "w": "mediawikiwiki",
    "wd": "wikidatawiki",
    "f": "foundationwiki",
}
DEFAULT_PROJECT = "wikipedia.org"
MOBILE_SUFFIX = "m"

# Raw log files: names, schema, and the bounds of a plausible hourly count.
RAW_FILE_PATTERN = r"^pageviews-\d{8}-\d{6}"
RAW_FILE_GLOB = "pageviews-*"
RAW_SCHEMA = "domain_code string, page_title string, count_views bigint, total_response_size bigint"
MIN_VIEWS, MAX_VIEWS = 0, 1_000_000_000
PLACEHOLDER_TITLE = "-"

# An entity is a page of one project edition.
ENTITY_KEYS = ["language", "database_name", "is_mobile", "namespace", "page_title"]

# Upper bounds of active days per sparsity class, in order; beyond them an entity is "frequent".
SPARSITY_LEVELS = {"very_sparse": 2, "sparse": 5, "medium": 8}
DENSEST_LEVEL = "frequent"

# Table layout and sampling defaults.
MAX_RECORDS_PER_FILE = 2_000_000
SCAN_SPLIT_BYTES = "256MB"
SEED = 42
SEARCH_ROWS, TEST_SHARE = 10_000, 0.2
IMPORTANCE_REPEATS = 10

# Search space of the boosted trees; the largest depth stands in for trees without a limit.
SEARCH_SPACE = {
    "max_depth": [3, 5, 7, 10],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "max_iter": [100, 200, 500],
    "min_samples_leaf": [10, 20, 50],
}
SEARCH_DRAWS, SEARCH_FOLDS = 2, 3

# Features whose distribution is compared between churned and surviving entities.
BOX_FEATURES = [
    "views_last_day",
    "sum_3d",
    "sum_7d",
    "views_total",
    "trend_slope",
    "views_mean",
    "views_median",
    "views_max",
    "views_std",
    "unique_weekdays",
    "first_dow",
    "views_std_dow",
]
