"""Small literal dimensions used by the registered queries, plus their SQL form.

Literal dimensions have a size fixed here in the source, so broadcasting them is
always safe; every data-sized input comes from the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The standard release category list (code, title), two levels:
# a thousand code is a parent, the codes below it up to the next thousand its children.
CATEGORIES = [
    (1000, "Console"), (1010, "Console/NDS"), (1020, "Console/PSP"), (1030, "Console/Wii"),
    (1040, "Console/XBox"), (1050, "Console/XBox 360"), (1060, "Console/Wiiware"),
    (1070, "Console/XBox 360 DLC"), (1080, "Console/PS3"), (1090, "Console/Other"),
    (1110, "Console/3DS"), (1120, "Console/PS Vita"), (1130, "Console/WiiU"),
    (1140, "Console/XBox One"), (1180, "Console/PS4"),
    (2000, "Movies"), (2010, "Movies/Foreign"), (2020, "Movies/Other"), (2030, "Movies/SD"),
    (2040, "Movies/HD"), (2045, "Movies/UHD"), (2050, "Movies/BluRay"), (2060, "Movies/3D"),
    (2070, "Movies/DVD"), (2080, "Movies/WEB-DL"),
    (3000, "Audio"), (3010, "Audio/MP3"), (3020, "Audio/Video"), (3030, "Audio/Audiobook"),
    (3040, "Audio/Lossless"), (3050, "Audio/Other"), (3060, "Audio/Foreign"),
    (4000, "PC"), (4010, "PC/0day"), (4020, "PC/ISO"), (4030, "PC/Mac"), (4040, "PC/Mobile-Other"),
    (4050, "PC/Games"), (4060, "PC/Mobile-iOS"), (4070, "PC/Mobile-Android"),
    (5000, "TV"), (5010, "TV/WEB-DL"), (5020, "TV/Foreign"), (5030, "TV/SD"), (5040, "TV/HD"),
    (5045, "TV/UHD"), (5050, "TV/Other"), (5060, "TV/Sport"), (5070, "TV/Anime"),
    (5080, "TV/Documentary"),
    (6000, "XXX"), (6010, "XXX/DVD"), (6020, "XXX/WMV"), (6030, "XXX/XviD"), (6040, "XXX/x264"),
    (6045, "XXX/UHD"), (6050, "XXX/Pack"), (6060, "XXX/ImageSet"), (6070, "XXX/Other"),
    (6080, "XXX/SD"), (6090, "XXX/WEB-DL"),
    (7000, "Books"), (7010, "Books/Mags"), (7020, "Books/EBook"), (7030, "Books/Comics"),
    (7040, "Books/Technical"), (7050, "Books/Other"), (7060, "Books/Foreign"),
    (8000, "Other"), (8010, "Other/Misc"), (8020, "Other/Hashed"),
]
# Codes from here up are site-specific custom categories.
CUSTOM_CATEGORY_BASE = 100000

# Our fixture: the language section of a captured page's path -> site category id,
# as a source would declare it; en pages are e-books, the others foreign books.
PAGE_SECTION_MAP = [("pages", "en", 7020, "EBook"), ("pages", "fr", 7060, "Foreign"),
                    ("pages", "de", 7060, "Foreign"), ("pages", "es", 7060, "Foreign")]

# Our fixture: part types as one source's site ids. MEDIUM maps to two categories
# (a duplicate id, as some sources declare), PROMO is deliberately unmapped.
PART_TYPE_MAP = [
    ("parts", "STANDARD", 5040, "standard", True), ("parts", "ECONOMY", 5030, "economy", False),
    ("parts", "MEDIUM", 5040, "medium hd", False), ("parts", "MEDIUM", 2040, "medium movies", False),
    ("parts", "SMALL", 5070, "small", False), ("parts", "LARGE", 2045, "large", False),
]

# Our fixture: capability modes per source and the parameters each accepts.
CAPABILITIES = [
    ("view", "search", ["q"]), ("view", "tv-search", ["q", "season", "ep", "imdbid"]),
    ("click", "search", ["q"]), ("click", "movie-search", ["q", "imdbid", "tmdbid"]),
    ("signup", "search", ["q"]), ("signup", "music-search", ["q", "artist", "album"]),
    ("purchase", "search", ["q"]), ("purchase", "book-search", ["q", "title", "author"]),
    ("purchase", "tv-search", ["q", "season", "ep"]),
    ("error", "search", ["q"]),
]

# The block list of keys that must never be added (entries as listed).
BLOCKLIST = ["uniongang", "uniongangcookie", "ygg-api", "yggtorrent", "yggcookie",
             "yggtorrent-turbo", "yggcookie-turbo", "u2p", "sharewood", "anirena",
             "torrentgalaxy", "scenelinks", "therarbg", "ildragonero", "rutracker-ru",
             "magnetz", "tvchaosuk", "torrent-heaven", "torrentgalaxyclone"]


def values_sql(rows, cols) -> str:
    """Rows -> ``(VALUES ...) AS t(cols)`` for the oracle."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, int):
            return f"CAST({v} AS BIGINT)"  # the Spark side holds these as bigint
        if isinstance(v, float):
            return repr(v)
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(lit(x) for x in v) + "]"
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def category_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("cat_code", T.LongType()),
                           T.StructField("cat_name", T.StringType())])
    return spark.createDataFrame(CATEGORIES, schema)


CATEGORY_SQL = values_sql(CATEGORIES, ["cat_code", "cat_name"])


def page_section_map_df(spark: SparkSession) -> DataFrame:
    schema = "source string, site_id string, cat_code bigint, descr string"
    return spark.createDataFrame(PAGE_SECTION_MAP, schema)


PAGE_SECTION_MAP_SQL = values_sql(PAGE_SECTION_MAP, ["source", "site_id", "cat_code", "descr"])


def part_type_map_df(spark: SparkSession) -> DataFrame:
    schema = "source string, site_id string, cat_code bigint, descr string, is_default boolean"
    return spark.createDataFrame(PART_TYPE_MAP, schema)


PART_TYPE_MAP_SQL = values_sql(PART_TYPE_MAP, ["source", "site_id", "cat_code", "descr", "is_default"])


def capabilities_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CAPABILITIES, "source string, mode string, params array<string>")


CAPABILITIES_SQL = values_sql(CAPABILITIES, ["source", "mode", "params"])


def blocklist_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k,) for k in BLOCKLIST], "key string")


BLOCKLIST_SQL = values_sql([(k,) for k in BLOCKLIST], ["key"])
