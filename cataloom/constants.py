"""Fixed values. Results depend on these exact entries and, where noted, on their order."""

# Cell texts that mean "no value" in raw files.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# Fragments removed from a language entry, one after the other in this order.
LABEL_REMOVALS = ("strong", "amp", "*", "&", "lt;", "gt;", ";", "\\/", "/", "br", "[b]")

# Canonical languages; the first one contained in an entry wins.
CANONICAL_LANGUAGES = (
    "English", "Spanish", "Portuguese", "French", "German", "Arabic", "Bulgarian",
    "Chinese", "Czech", "Danish", "Dutch", "Finnish", "Greek", "Hungarian", "Italian",
    "Japanese", "Korean", "Norwegian", "Polish", "Romanian", "Russian", "Swedish",
    "Thai", "Turkish", "Ukrainian", "Vietnamese",
)

# Repairs that turn a dict literal into JSON, in this order.
WEIGHTED_REPAIRS = (
    ("0'", "0"),
    ("'Em Up", " Em Up"),
    ("'em up", " Em Up"),
    ("{'", '{"'),
    ("':", '":'),
    (", '", ', "'),
)

# Names shown for result columns; any other name is capitalised.
DISPLAY_LABELS = {
    "peak_ccu_yesterday": "Peak CCU yesterday",
    "average_forever_hs": "Avg hs played forever",
    "average_2weeks_hs": "Avg hs played last 2 weeks",
    "median_forever_hs": "Median hs played forever",
    "median_2weeks_hs": "Median hs played last 2 weeks",
    "owners_min": "Minimum Owners",
    "owners_max": "Owners (max)",
    "price_usd": "Current US Price",
    "initial_price_usd": "Initial US Price",
    "apps_count": "Number of Apps",
    "avg_peak_ccu_yesterday": "Average peak CCU yesterday",
    "avg_2weeks_hs": "Average hours played last 2 weeks",
    "avg_owners_max": "Average Owners (Max)",
    "avg_price_usd": "Average Current Price in USD",
    "avg_discount": "Average Discount (%)",
}

# Every character that counts as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: how the line on freshness begins.
UPDATE_TEXT = "Last database update: "

# Limits.
PRICE_CEILING = 1500.0
BATCH_SIZE = 2500
PREVIEW_ROWS = 100
SEARCH_ROWS = 2500
RANKING_ROWS = 10
CATEGORICAL_BELOW = 10
