"""Column-level extraction of API answer fields.

The raw JSON text is parsed once into a VARIANT. A field counts only when it holds a JSON
*string*: numbers, booleans, null and missing keys all give null (``{"Rated": 5}`` has no
rating). Typed conversions then follow the JVM number parsers the format was defined with.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import parse_comma_list

# The top-level answer fields read from each API response.
RATED, DIRECTOR, WRITER, ACTORS = "Rated", "Director", "Writer", "Actors"
LANGUAGE, COUNTRY, BOX_OFFICE = "Language", "Country", "BoxOffice"
METASCORE, IMDB_RATING, IMDB_VOTES, RESPONSE = "Metascore", "imdbRating", "imdbVotes", "Response"

# Fixed value: characters removed from money and vote counts before conversion.
NON_NUMERIC = r"[^\d.]+"

# Special float spellings a JVM float parser accepts (exact case, optional sign) ...
_JVM_SPECIAL = r"\A[\x00-\x20]*[+-]?(?:NaN|Infinity)[\x00-\x20]*\z"
# ... and the wider set Spark's cast also accepts, which must become null here.
_ANY_SPECIAL = r"(?i)\A[\x00-\x20]*[+-]?(?:nan|inf|infinity)[\x00-\x20]*\z"


def parse_json(col: Column | str) -> Column:
    """Raw JSON text -> VARIANT; malformed text -> null."""
    return F.try_parse_json(F.col(col) if isinstance(col, str) else col)


def _path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def json_field(doc: Column, key: str) -> Column:
    """A top-level field as a VARIANT (SQL null when the key is absent)."""
    return F.try_variant_get(doc, _path(key), "variant")


def string_value(field: Column) -> Column:
    """A VARIANT holding a JSON string -> that string; any other JSON type -> null."""
    return F.when(F.schema_of_variant(field) == "STRING", F.try_variant_get(field, "$", "string"))


def json_string(doc: Column, key: str) -> Column:
    """The field's value if it is a JSON string, else null."""
    return string_value(json_field(doc, key))


def json_list(doc: Column, key: str) -> Column:
    """A string field split on commas and trimmed (``"N/A"`` -> ``["N/A"]``)."""
    return parse_comma_list(json_string(doc, key))


def jvm_float(col: Column) -> Column:
    """Text -> float as a JVM float parser reads it; any failure -> null."""
    special_only_in_spark = col.rlike(_ANY_SPECIAL) & ~col.rlike(_JVM_SPECIAL)
    return F.when(~special_only_in_spark, col.try_cast("float"))


def money(col: Column) -> Column:
    """``"$1,234,567"`` -> 1234567.0; ``"N/A"`` or nothing numeric -> null."""
    return F.regexp_replace(col, NON_NUMERIC, "").try_cast("float")


def count(col: Column) -> Column:
    """P7e: ``"860,790"`` -> 860790; a decimal point left over (``"1.5"``) -> null."""
    digits = F.regexp_replace(col, NON_NUMERIC, "")
    return F.when(digits.rlike(r"\A[0-9]+\z"), digits.try_cast("bigint"))


# Record field <- (answer key, conversion of the string value).
ANSWER_FIELDS = {
    "rated": (RATED, lambda s: s),
    "directors": (DIRECTOR, parse_comma_list),
    "writers": (WRITER, parse_comma_list),
    "actors": (ACTORS, parse_comma_list),
    "languages": (LANGUAGE, parse_comma_list),
    "countries": (COUNTRY, parse_comma_list),
    "boxOffice": (BOX_OFFICE, money),
    "metascore": (METASCORE, jvm_float),
    "imdbScore": (IMDB_RATING, jvm_float),
    "imdbVotes": (IMDB_VOTES, count),
}


def answer_fields(doc: Column) -> dict[str, Column]:
    """The parsed record's fields from one parsed answer."""
    return {name: convert(json_string(doc, key)) for name, (key, convert) in ANSWER_FIELDS.items()}


def is_failure(doc: Column) -> Column:
    """``"Response": "False"`` as a JSON string (a boolean ``false`` does not count)."""
    return json_string(doc, RESPONSE) == "False"


def has_response_key(doc: Column) -> Column:
    """The answer object has a ``Response`` key (a JSON null value counts as present)."""
    return F.try_variant_get(doc, _path(RESPONSE), "variant").isNotNull()
