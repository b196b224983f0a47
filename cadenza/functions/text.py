"""Text keys and list-as-text parsing.

Only the Unicode compatibility decomposition (NFKD) has no built-in Spark function; it is one ``arrow_udf``.
Everything else (case folding, character classes, splitting) is JVM-side.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


#: Texts are decomposed so many at a time, so that a Python worker holds few of a batch beside its Arrow columns.
PIECE = 256


@F.arrow_udf(StringType())
def decompose(s: pa.Array) -> pa.Array:
    """NFKD; NULL becomes the empty string. The marks go with the other signs that a key drops."""
    pieces = [pa.array([unicodedata.normalize("NFKD", x or "") for x in s.slice(a, PIECE).to_pylist()], pa.string()) for a in range(0, len(s), PIECE)]
    return pa.concat_arrays(pieces) if pieces else pa.array([], pa.string())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _folded(c) -> Column:
    """``decompose`` applied to a column; ships the package to the executors first."""
    from cadenza.session import ship_package
    ship_package()
    return decompose(_col(c).cast("string"))


#: The white space that text is trimmed of, as a character class for either engine.
BLANKS = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def normalize_alnum(c) -> Column:
    """NFKD, drop marks, lower, keep Unicode letters and digits."""
    return F.regexp_replace(F.lower(_folded(c)), r"[^\p{L}\p{N}]", "")


def key_exact(c) -> Column:
    """The text as is (NULL stays NULL, never the text 'nan')."""
    return _col(c).cast("string")


def key_basic(c) -> Column:
    """Lower case, trim every kind of surrounding whitespace."""
    return F.regexp_replace(F.lower(_col(c).cast("string")), f"^{BLANKS}+|{BLANKS}+$", "")


def key_loose(c) -> Column:
    """NFKD, drop marks, lower, keep only [a-z0-9]."""
    return F.regexp_replace(F.lower(_folded(c)), "[^a-z0-9]+", "")


def key_word(c) -> Column:
    """NFKD, lower, drop marks, drop whitespace/hyphen/underscore and non-word chars."""
    t = F.regexp_replace(F.lower(_folded(c)), r"[\s\-_]+", "")
    return F.regexp_replace(t, r"[^\p{L}\p{N}_]", "")


def join_key(c, mode: str = "basic") -> Column:
    """Key by mode name; empty keys never match (NULL)."""
    fn = {"exact": key_exact, "basic": key_basic, "loose": key_loose,
          "alnum": normalize_alnum, "word": key_word}[mode]
    return F.nullif(fn(c), F.lit(""))


_LIST_JSON_OPTS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}


def _literal(s: Column) -> Column:
    """The items of a list or tuple literal, without None; NULL if the text is none."""
    listed = F.regexp_replace(F.regexp_replace(F.trim(s), r"^\((.*)\)$", "[$1]"), r",\s*\]$", "]")
    bare = F.regexp_replace(listed, r"(?<=[\[,]|[\[,]\s)None(?=\s*[,\]])", "null")
    items = F.coalesce(F.from_json(listed, "array<string>", _LIST_JSON_OPTS), F.from_json(bare, "array<string>", _LIST_JSON_OPTS))
    return F.filter(items, lambda x: x.isNotNull())


def parse_list(c) -> Column:
    """list-as-text → array<string>.

    A Python/JSON-like list or tuple is parsed by ``from_json`` (single quotes allowed, bare
    ``None`` items dropped); anything else falls back to: strip brackets, split on commas, strip
    quotes and blanks, drop empty items and the literal ``None``.
    """
    s = _col(c).cast("string")
    body = F.regexp_replace(F.trim(s), r"^\[|\]$", "")
    items = F.transform(F.split(body, ","), lambda x: F.regexp_replace(x, "^[ '\"]+|[ '\"]+$", ""))
    fallback = F.filter(items, lambda x: (F.length(F.trim(x)) > 0) & (x != F.lit("None")))
    return F.when(s.isNull(), F.lit(None)).otherwise(F.coalesce(_literal(s), fallback))


def primary_item(c) -> Column:
    """first element of the list, only when the text starts with '['."""
    s = _col(c).cast("string")
    return F.when(s.startswith("["), F.get(parse_list(s), 0))


def genre_tokens(c) -> Column:
    """bracketed literal → its items (trimmed); else bars become commas,
    split, trim, drop empties. NULL gives an empty list."""
    s = F.coalesce(_col(c).cast("string"), F.lit(""))
    bracketed = s.startswith("[") & s.endswith("]")
    lit_items = F.transform(_literal(s), lambda x: F.trim(x))
    plain = F.filter(F.transform(F.split(F.translate(s, "|", ","), ","), lambda x: F.trim(x)),
                     lambda x: F.length(x) > 0)
    parsed = F.when(bracketed, lit_items)
    return F.when(F.coalesce(F.size(parsed), F.lit(0)) > 0, parsed).otherwise(plain)


def join_top(names: Column, n: int = 3, sep: str = ",") -> Column:
    """F8: comma-join of the first ``n`` names of an ordered array."""
    return F.array_join(F.slice(names, 1, n), sep)
