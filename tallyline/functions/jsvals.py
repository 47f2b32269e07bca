"""Loosely typed JSON values as native column expressions.

Feed records carry values of any JSON type, and the rules are defined on the
conversions of the feed's scripting language: which values count as "empty",
how a value reads as text or as a number, where optional access stops. Every
function takes and returns columns; inputs named ``v`` are VARIANT, inputs named
``s`` are STRING. An absent key is SQL NULL, a JSON null is a VARIANT null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters stripped by trimming (white space, line ends, BOM).
WHITESPACE = (
    "\t\n\u000b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
# The same set as a regular-expression class.
WS_CLASS = r"[\s\x0B\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"

_DECIMAL = r"(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)"


def js_get(v: Column, path: str) -> Column:
    """Optional access: NULL as soon as a step is missing. ``path`` is a JSON path."""
    return F.try_variant_get(v, path, "variant")


def js_nullish(*vs: Column) -> Column:
    """First value that is neither absent nor JSON null (an empty string counts)."""
    return F.coalesce(*[F.when(~F.is_variant_null(v), v) for v in vs])


def plain_text(v: Column, path: str = "$") -> Column:
    """Text of a scalar as stored, JSON text of an object or array. The functions
    below use it several times: give them a column (this, or the string a typed
    JSON parse yields) where speed counts."""
    return F.try_variant_get(v, path, "string")


def seldom(v: Column, fn) -> Column:
    """``fn(v)`` for a branch few rows take: as a lambda it stays out of the
    generated code, which keeps the common path small enough to be compiled."""
    return F.get(F.transform(F.array(v), fn), F.lit(0))


def _joined(v: Column) -> Column:
    return F.array_join(F.try_variant_get(v, "$", "array<string>"), ",", "")


def _bind(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _double_text(d: Column) -> Column:
    """The shortest digits that read back as ``d``: plain from 1e-6 to below 1e21, else with an exponent."""
    zero = F.lit("0")

    def placed(x):
        digits, point, n = x["digits"], x["point"], x["n"]
        scaled = F.concat(F.substring(digits, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(""),
                          F.when(point > 0, "e+").otherwise("e-"), F.abs(point - 1).cast("string"))
        return (
            F.when(n == 0, zero).when((point > 21) | (point < -5), scaled)
            .when(point <= 0, F.concat(F.lit("0."), F.repeat(zero, -point), digits))
            .when(n <= point, F.concat(digits, F.repeat(zero, point - n)))
            .otherwise(F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1))))

    def counted(x):
        # Places before the point, counted from the first digit that is not zero.
        kept = F.ltrim(F.concat(x["whole"], x["fraction"]), zero)
        digits = F.rtrim(kept, zero)
        point = F.length(kept) - F.length(x["fraction"]) + x["exponent"]
        return F.struct(digits.alias("digits"), point.alias("point"), F.length(digits).alias("n"))

    def parted(shown):
        mantissa = F.substring_index(shown, "E", 1)
        return F.struct(F.substring_index(mantissa, ".", 1).alias("whole"), F.substring_index(mantissa, ".", -1).alias("fraction"),
                        F.when(F.contains(shown, F.lit("E")), F.substring_index(shown, "E", -1).try_cast("int")).otherwise(0).alias("exponent"))

    text = _bind(_bind(_bind(F.abs(d).cast("string"), parted), counted), placed)
    return F.concat(F.when(d < 0, "-").otherwise(""), text)


def _printed(v: Column) -> Column:
    """A scalar prints as the only element of an array would."""
    def element(e):
        return _bind(F.schema_of_variant(e), lambda kind: (
            F.when(kind.startswith("OBJECT"), F.lit("[object Object]")).when(kind.startswith("ARRAY"), _joined(e))
            .when(kind.rlike("^(DOUBLE|FLOAT|DECIMAL)"), _bind(F.try_variant_get(e, "$", "double"), _double_text))
            .otherwise(F.coalesce(plain_text(e), F.lit("")))))

    listed = F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v))
    return F.array_join(F.transform(listed, element), ",")


def js_text(v: Column, path: str = "$", plain: Column | None = None) -> Column:
    """Text good enough for emptiness and pattern tests: arrays read as their
    joined elements, objects as some non-blank text, numbers in any form."""
    t = plain_text(v, path) if plain is None else plain
    at = v if path == "$" else js_get(v, path)
    return F.when(t.startswith("["), seldom(at, lambda x: F.coalesce(_joined(x), plain_text(x)))).otherwise(t)


_OTHERWISE = r"^(\[|\{|-?\d+[.eE]|-?\d{20})"


def reads_otherwise(t: Column) -> Column:
    """Whether a plain text may stand for a value that prints in another form: a list, an object, a number with a point or
    exponent, or an integer of 20 digits. The pattern decides; tests without it leave out most texts."""
    numeric = F.ascii(t).between(45, 57) & (
        (F.octet_length(t) >= 20) | F.contains(t, F.lit(".")) | F.contains(t, F.lit("e")) | F.contains(t, F.lit("E")))
    return (F.ascii(t).isin(91, 123) | numeric) & t.rlike(_OTHERWISE)


def js_string(v: Column, path: str = "$", plain: Column | None = None) -> Column:
    """Text of the value at ``path``, NULL for absent and null.

    Numbers print without ``.0`` and with an exponent only from 1e21 up and
    below 1e-6; other numbers print the shortest digits of their double, integers
    of up to 19 digits all of them. Arrays print as comma-joined
    elements, objects as ``[object Object]``.
    """
    t = plain_text(v, path) if plain is None else plain
    at = v if path == "$" else js_get(v, path)
    # The cheap tests name the text often: only for a text at hand, not for one that is cast from a VARIANT each time.
    special = t.rlike(_OTHERWISE) if plain is None else reads_otherwise(t)
    return F.when(special, seldom(at, _printed)).otherwise(t)


def js_truthy(v: Column, path: str = "$", plain: Column | None = None) -> Column:
    """False for absent, null, false, zero and the empty string; ``"0"``, ``[]``
    and ``{}`` are true. The type is looked at only where the text is ambiguous."""
    t = plain_text(v, path) if plain is None else plain
    at = v if path == "$" else js_get(v, path)
    maybe = F.lit(True) if plain is None else F.ascii(t).isin(45, 48, 102)
    return (
        F.when(t.isNull() | (t == ""), F.lit(False))
        .when(maybe & t.rlike(r"^(false|-?0(\.0*)?([eE].*)?)\z"), seldom(at, lambda x: F.schema_of_variant(x) == "STRING"))
        .otherwise(F.lit(True))
    )


def js_trim(s: Column) -> Column:
    return F.btrim(s, F.lit(WHITESPACE))


def js_trim_column(s: Column) -> Column:
    """The same; a text that begins and ends with visible ASCII is not searched. ``s`` is named five times: a column."""
    edges = F.ascii(s).between(33, 126) & F.ascii(F.substring(s, -1, 1)).between(33, 126)
    return F.when(edges, s).otherwise(js_trim(s))


def js_number(s: Column) -> Column:
    """Text as a number, NULL where it is not one. Blank text is 0; hexadecimal,
    octal and binary prefixes and ``Infinity`` are numbers."""
    return trimmed_number(js_trim(s))


def trimmed_number(t: Column) -> Column:
    """``js_number`` of a text that is trimmed already."""
    prefix = F.lower(F.substring(t, 1, 2))
    digits = F.substr(t, F.lit(3))

    def based(pattern: str, base: int, places: int) -> Column:
        # 60 bits of the number, all a double can hold, times the power of the digits behind them.
        figures = F.regexp_replace(digits, "^0+(?=.)", "")
        behind = F.greatest(F.length(figures) - places, F.lit(0))
        head = F.conv(F.substring(figures, 1, places), base, 10).try_cast("double")
        return F.when(digits.rlike(pattern), head * F.pow(F.lit(float(base)), behind))

    return (
        F.when(t == "", F.lit(0.0))
        .when(t.rlike(rf"^[+-]?{_DECIMAL}\z"), t.try_cast("double"))
        .when(prefix == "0x", based(r"^[0-9a-fA-F]+\z", 16, 15))
        .when(prefix == "0o", based(r"^[0-7]+\z", 8, 20))
        .when(prefix == "0b", based(r"^[01]+\z", 2, 60))
        .when(t.rlike(r"^[+-]?Infinity\z"), t.try_cast("double"))
    )


def is_js_number(s: Column) -> Column:
    """Whether ``js_number`` yields a value, without computing it."""
    return is_trimmed_number(js_trim(s))


def is_trimmed_number(t: Column) -> Column:
    return t.rlike(
        rf"^([+-]?{_DECIMAL}|0[xX][0-9a-fA-F]+|0[oO][0-7]+|0[bB][01]+|[+-]?Infinity)?\z")


def js_parse_float(s: Column) -> Column:
    """The longest leading number, NULL when there is none or it overflows."""
    d = F.regexp_extract(s, rf"^{WS_CLASS}*([+-]?{_DECIMAL})", 1).try_cast("double")
    return F.when(F.abs(d) < float("inf"), d)


def has_value(v: Column, path: str = "$") -> Column:
    """Not blank once read as text; 0 and false have a value, ``[]`` does not."""
    return has_text(js_text(v, path))


def has_text(s: Column) -> Column:
    """Not NULL and not blank; a visible ASCII first character settles it."""
    return F.coalesce(F.ascii(s).between(33, 126) | (js_trim(s) != ""), F.lit(False))


def is_iso_date(s: Column) -> Column:
    """Shape only: four, two and two digits."""
    return F.coalesce(s.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.lit(False))


def is_object(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "map<string,variant>").isNotNull()


def key_count(v: Column) -> Column:
    """Number of top-level keys; 0 for anything but an object."""
    keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    return F.coalesce(F.size(keys), F.lit(0))
