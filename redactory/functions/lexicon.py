"""The sensitive vocabulary: terms, categories, ranks, labels and the words that are never matched fuzzily."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The vocabulary that results are defined by.
DAYS = (
    "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "mon", "tue", "tues", "wed", "thu", "thur", "thurs", "fri", "sat", "sun",
)
MONTHS = (
    "january", "february", "march", "april", "june", "july", "august", "september", "october", "november", "december", "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sep",
    "sept", "oct", "nov", "dec",
)
COLORS = (
    "red", "orange", "yellow", "green", "blue", "purple", "pink", "black", "white", "gray", "grey", "brown", "gold", "silver", "violet", "indigo", "teal", "cyan", "magenta",
    "maroon", "navy", "beige", "tan", "coral", "turquoise", "lavender", "crimson", "amber", "aqua", "bronze", "burgundy", "charcoal", "chartreuse", "chocolate", "copper",
    "cream", "fuchsia", "ivory", "jade", "khaki", "lilac", "lime", "mauve", "olive", "peach", "periwinkle", "plum", "rose", "ruby", "salmon", "sapphire", "scarlet", "sienna",
    "slate", "taupe", "topaz", "vermillion",
)
STATES = (
    "alabama", "alaska", "arizona", "arkansas", "california", "colorado", "connecticut", "delaware", "florida", "georgia", "hawaii", "idaho", "illinois", "indiana", "iowa",
    "kansas", "kentucky", "louisiana", "maine", "maryland", "massachusetts", "michigan", "minnesota", "mississippi", "missouri", "montana", "nebraska", "nevada",
    "new hampshire", "new jersey", "new mexico", "new york", "north carolina", "north dakota", "ohio", "oklahoma", "oregon", "pennsylvania", "rhode island", "south carolina",
    "south dakota", "tennessee", "texas", "utah", "vermont", "virginia", "washington", "west virginia", "wisconsin", "wyoming", "district of columbia",
)
CITIES_OF_WORDS = (
    "salt lake city", "new york city", "oklahoma city", "kansas city", "virginia beach", "new york", "los angeles", "san francisco", "san diego", "san antonio", "san jose",
    "las vegas", "fort worth", "el paso", "new orleans", "long beach", "colorado springs", "st louis", "st paul", "st petersburg", "santa fe", "santa ana", "santa monica",
    "baton rouge", "little rock", "grand rapids", "des moines", "ann arbor", "corpus christi", "round rock", "college station",
)
CITIES = (
    "houston", "phoenix", "philadelphia", "dallas", "austin", "jacksonville", "charlotte", "seattle", "denver", "boston", "detroit", "portland", "memphis", "baltimore",
    "milwaukee", "albuquerque", "tucson", "fresno", "sacramento", "atlanta", "miami", "oakland", "minneapolis", "cleveland", "tulsa", "pittsburgh", "cincinnati",
    "indianapolis", "nashville", "chicago", "omaha", "raleigh", "richmond", "buffalo", "orlando", "tampa", "honolulu", "anchorage", "arlington", "irving", "garland",
    "mesquite", "plano", "waco", "lubbock", "amarillo", "laredo", "midland", "odessa", "brownsville", "mcallen", "killeen", "pasadena", "beaumont", "abilene", "carrollton",
    "frisco", "lewisville", "denton", "richardson", "tyler", "pearland", "conroe", "edinburg", "burkburnett", "hilton", "lincoln", "savannah", "mobile", "greenville",
    "greensboro", "brownwood", "blacksburg", "whitehall", "goldsboro", "silverdale", "bluefield", "redmond", "redding", "orangeburg", "pinkville",
)
NEVER_FUZZY = (
    "like", "back", "lack", "lick", "lock", "luck", "read", "lead", "bead", "dead", "head", "plan", "clan", "scan", "lime", "time", "dime", "mime", "goal", "coal", "foal",
    "pin", "tin", "bin", "fin", "win", "sin", "pint", "pine", "ping", "tank", "sank", "rank", "bank", "beat", "heat", "meat", "neat", "seat", "tale", "tall", "remember",
    "november", "september", "december", "member", "ember", "around", "round", "sound", "found", "bound", "texture", "mixture", "fixture", "salon", "gallon", "talon",
)
LABELS = {"day": "[DAY]", "month": "[MONTH]", "color": "[COLOR]", "state": "[STATE]", "city": "[CITY]"}
# End of fixed values.

BY_PRIORITY = (("city", CITIES_OF_WORDS), ("city", CITIES), ("state", STATES), ("day", DAYS), ("month", MONTHS), ("color", COLORS))
#: What a plural may be reduced to.
SINGULARS = sorted({*DAYS, *MONTHS, *COLORS, *STATES, *CITIES})
SCHEMA = "term string, category string, label string, n_words int, n_chars int, rank int"


def rows(extra: dict[str, str] | None = None) -> list[tuple]:
    """All entries in rank order: longest first, then by letter, then by priority. extra: term -> category, last."""
    found = [(t, c, p) for p, (c, terms) in enumerate(BY_PRIORITY) for t in terms] + [(t, c, len(BY_PRIORITY)) for t, c in (extra or {}).items()]
    found.sort(key=lambda x: (-len(x[0]), x[0], x[2]))
    return [(t, c, LABELS.get(c, f"[{c.upper()}]"), len(t.split()), len(t), i) for i, (t, c, _) in enumerate(found)]


def lexicon(spark: SparkSession, extra: dict[str, str] | None = None) -> DataFrame:
    """The vocabulary as a relation of fixed size; safe to broadcast."""
    return spark.createDataFrame(rows(extra), SCHEMA)


def first_by_rank(spark: SparkSession, extra: dict[str, str] | None = None) -> DataFrame:
    """One row a term, the one of least rank ("new york" is a city)."""
    seen: dict[str, tuple] = {}
    for r in rows(extra):
        seen.setdefault(r[0], r)
    return spark.createDataFrame(list(seen.values()), SCHEMA)


def by_category(spark: SparkSession) -> DataFrame:
    """category, terms (sorted set)."""
    return lexicon(spark).groupBy("category").agg({"term": "collect_set"}).selectExpr("category", "sort_array(`collect_set(term)`) AS terms")
