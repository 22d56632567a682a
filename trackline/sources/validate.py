"""Record validation of landed JSON lines (V1-V4).

Each line is parsed once into a VARIANT, which keeps whether JSON held a
number, a text, a boolean or a null, so every field is coerced by what it is
and not by how its text looks.  The rules are those of the validation classes
that land the feeds (lax mode):

* int    - a whole number (``1.0`` too), a boolean, or the text of a whole
           number (white space around it, ``1_000`` and ``12.0`` pass; ``12d``,
           ``1e3`` and ``1.5`` fail); beyond 64 bits it is invalid;
* float  - any number, a boolean, or the text of a number, inf or nan;
* bool   - true/false, 1/0, or the texts true/false, 1/0, yes/no, on/off, t/f,
           y/n in any case, without white space;
* ts     - an ISO date-time or date with an optional offset (normalised to
           UTC; fractions beyond microseconds are cut), or a number or its text:
           seconds since 1970, milliseconds above 2e10.  A time alone is
           invalid, so no result depends on the day it is computed;
* str    - a text; numbers and booleans are not;
* text   - anything, kept as its text (``0`` -> ``"0"``);
* float_list - an array of floats; NULL entries removed, NULL -> ``[]``.

A field that is absent is an error when required, a null one when its kind
takes no null.  With ``strict`` the fields outside the spec are listed in the
same pass, each an error.  Errors are collected into an array column; ``split``
separates good and bad rows; ``require_valid`` implements the all-or-nothing
rule (one count of bad rows before anything is written).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

# texts of booleans (fixed values)
_TRUE = ("true", "1", "yes", "on", "t", "y")
_FALSE = ("false", "0", "no", "off", "f", "n")

# numbers above this are milliseconds since 1970, the others seconds (fixed value)
MILLISECONDS_ABOVE = 20_000_000_000
# years 1 to 9999
_FIRST_US, _LAST_US = -62_135_596_800_000_000, 253_402_300_799_999_999

_DIGITS = "[0-9]+(?:_[0-9]+)*"
_INT_TEXT = f"^\\s*([+-]?{_DIGITS})(?:\\.0+)?\\s*$"
_FLOAT_TEXT = f"^\\s*([+-]?(?:(?:{_DIGITS}(?:\\.(?:{_DIGITS})?)?|\\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan)))\\s*$"
_EPOCH_TEXT = "^([+-]?(?:[0-9]+(?:\\.[0-9]*)?|\\.[0-9]+))$"
# how the feeds write times; the longer rule below takes the other forms
_USUAL_TS = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\\.[0-9]{1,6})?(?:Z|[+-][0-9]{2}:[0-9]{2})?$"
_TS_TEXT = "^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[Tt _]([0-9]{2}:[0-9]{2})(:[0-9]{2})?(?:[.,]([0-9]{1,6})[0-9]{0,3})?([Zz]|[+-][0-9]{2}:?[0-9]{2})?)?$"


def _get(variant: Column | str, kind: str, path: str = "$") -> Column:
    return F.try_variant_get(F.col(variant) if isinstance(variant, str) else variant, path, kind)


def _matched(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of a match, NULL where the text does not match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _number(text: Column, pattern: str, kind: str) -> Column:
    return F.replace(_matched(text, pattern), F.lit("_"), F.lit("")).try_cast(kind)


def _float(v: Column, kind: Column, text: Column) -> Column:
    return (F.when(_numeric(kind), _get(v, "double"))
            .when(kind == "BOOLEAN", _get(v, "boolean").cast("double"))
            .when(kind == "STRING", _number(text, _FLOAT_TEXT, "double")))


def _numeric(kind: Column) -> Column:
    return kind.startswith("BIGINT") | kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")


def _epoch(x: Column) -> Column:
    """A timestamp of a number of seconds or milliseconds (decimal)."""
    us = F.when(F.abs(x) > MILLISECONDS_ABOVE, x * 1000).otherwise(x * 1_000_000)
    us = F.floor(us + F.lit(0.5).cast("decimal(2,1)"))
    return F.when((us >= _FIRST_US) & (us <= _LAST_US), F.timestamp_micros(us.cast("bigint")).cast("timestamp_ntz"))


def _iso(text: Column) -> Column:
    part = lambda i: F.regexp_extract(text, _TS_TEXT, i)
    or_ = lambda c, other: F.when(c == "", F.lit(other)).otherwise(c)
    zone = F.regexp_replace(F.upper(part(5)), "^([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    # a fraction belongs to seconds
    ok = text.rlike(_TS_TEXT) & ((part(4) == "") | (part(3) != ""))
    whole = F.concat(part(1), F.lit("T"), or_(part(2), "00:00"), or_(part(3), ":00"), F.lit("."), or_(part(4), "0"), or_(zone, "Z"))
    return F.when(ok, F.try_to_timestamp(whole).cast("timestamp_ntz"))


def _coerce(kind: str, v: Column, held: Column, text: Column) -> Column:
    """The typed value of a field that is neither absent nor null; NULL where
    it is invalid.  ``held`` is the JSON type, ``text`` the value as text."""
    if kind == "int":
        d = _get(v, "double")
        return (F.when(held == "BIGINT", _get(v, "bigint"))
                .when(held == "BOOLEAN", _get(v, "boolean").cast("bigint"))
                .when(held == "STRING", _number(text, _INT_TEXT, "bigint"))
                .when(held == "DOUBLE", F.when(F.floor(d) == d, d.try_cast("bigint")))
                .when(held.startswith("DECIMAL") & held.endswith(",0)"), text.try_cast("bigint")))
    if kind == "float":
        return _float(v, held, text)
    if kind == "bool":
        low, d = F.lower(text), _get(v, "double")
        return (F.when(held == "BOOLEAN", _get(v, "boolean"))
                .when((held == "STRING") & low.isin(*_TRUE, *_FALSE), low.isin(*_TRUE))
                .when(_numeric(held) & d.isin(0.0, 1.0), d == 1.0))
    if kind == "ts":
        number = "decimal(38,6)"
        # a number of more than 32 digits is no time, as are nan and inf
        usual = F.when(text.rlike(_USUAL_TS), F.try_to_timestamp(text).cast("timestamp_ntz"))
        return (F.when(held == "STRING", F.coalesce(usual, F.when(text.rlike(_EPOCH_TEXT), _epoch(text.try_cast(number))).otherwise(_iso(text))))
                .when(_numeric(held), _epoch(_get(v, number))))
    if kind == "str":
        return F.when(held == "STRING", text)
    if kind == "text":
        return (F.when(held == "BOOLEAN", F.initcap(text)).when(held.isin("DOUBLE", "FLOAT") | held.startswith("DECIMAL"), _get(v, "double").cast("string"))
                .when((held == "STRING") | (held == "BIGINT"), text).when(held != "VOID", F.to_json(v)))
    if kind == "float_list":
        got = F.transform(F.filter(_get(v, "array<variant>"), lambda x: ~F.is_variant_null(x)),
                          lambda x: _float(x, F.schema_of_variant(x), _get(x, "string")))
        return F.when(held.startswith("ARRAY") & ~F.exists(got, lambda x: x.isNull()), got)
    raise ValueError(f"unknown kind {kind!r}")


def validate(lines: DataFrame, spec: Mapping[str, tuple[str, bool]], text_col: str = "value",
             keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """Typed columns of ``spec`` plus ``_errors`` (array<string>, empty when
    the record is valid) and the raw ``_line``.  ``keep`` carries extra
    columns of ``lines``.  A line that is not one JSON object (cut off, two in
    a line, a key given twice) has that as its only error."""
    names = list(spec)
    # the mark after the record shows that the parser saw the whole line
    whole = F.try_parse_json(F.concat(F.lit("["), F.col(text_col), F.lit(',"end"]')))
    # generators keep the parse and the checks from being inlined into every
    # reference (a filter on the errors would be pushed down through them)
    parsed = lines.select(*keep, F.col(text_col).alias("_line"), F.explode(F.array(whole)).alias("_v"))
    record = (_get("_v", "string", "$[1]") == "end") & _get("_v", "variant", "$[2]").isNull() & F.schema_of_variant(_get("_v", "variant", "$[0]")).startswith("OBJECT")
    fields = parsed.select(*keep, "_line", F.coalesce(record, F.lit(False)).alias("_is"), *[_get("_v", "variant", f"$[0].{n}").alias(f"_raw_{i}") for i, n in enumerate(names)],
                           *([F.map_keys(_get("_v", "map<string,variant>", "$[0]")).alias("_keys")] if strict else []))
    # numbers rarely come as texts: their text is taken only in that branch
    worded = [spec[n][0] in ("str", "text", "ts", "bool") for n in names]
    seen = fields.select("*", *[F.schema_of_variant(F.col(f"_raw_{i}")).alias(f"_held_{i}") for i in range(len(names))],
                         *[_get(f"_raw_{i}", "string").alias(f"_text_{i}") for i in range(len(names)) if worded[i]])
    values = seen.select("*", *[_coerce(spec[n][0], F.col(f"_raw_{i}"), F.col(f"_held_{i}"), F.col(f"_text_{i}") if worded[i] else _get(f"_raw_{i}", "string"))
                                .alias(f"_val_{i}") for i, n in enumerate(names)])
    typed, errs, wrong = [], [], F.lit(False)
    for i, name in enumerate(names):
        kind, required = spec[name]
        raw, held, value = F.col(f"_raw_{i}"), F.col(f"_held_{i}"), F.col(f"_val_{i}")
        empty = (held == "VOID") if not required or kind == "float_list" else F.lit(False)
        errs.append(F.when(raw.isNull(), F.lit(f"{name}: field required") if required else F.lit(None))
                    .when(~empty & value.isNull(), F.lit(f"{name}: invalid {kind}")))
        wrong = wrong | (value.isNull() & ~(F.coalesce(empty, F.lit(False)) if required else raw.isNull() | empty))
        typed.append((F.coalesce(value, F.array().cast(ArrayType(DoubleType()))) if kind == "float_list" else value).alias(name))
    none = F.array().cast("array<string>")
    # the list is made for the few rows that need one
    errors = F.when(wrong, F.filter(F.array(*errs), lambda e: e.isNotNull())).otherwise(none)
    if strict:
        known = F.array(*[F.lit(n) for n in names])
        errors = F.concat(errors, F.transform(F.array_sort(F.array_except(F.coalesce("_keys", none), known)),
                                              lambda k: F.concat(k, F.lit(": unexpected field"))))
    errors = F.when(F.col("_is"), errors).otherwise(F.array(F.lit("line: not a JSON object")))
    return values.select(*keep, F.inline(F.array(F.struct(*typed, errors.alias("_errors"), F.col("_line")))))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without bookkeeping columns, bad rows with line + errors)."""
    good = validated.where(F.size("_errors") == 0).drop("_errors", "_line")
    bad = validated.where(F.size("_errors") > 0)
    return good, bad


class InvalidBatch(ValueError):
    """Raised when a batch holds at least one invalid record."""


def require_valid(validated: DataFrame, mode: str = "fail") -> tuple[DataFrame, DataFrame]:
    """All-or-nothing (``mode='fail'``): count bad records first and raise
    before any write; ``mode='quarantine'`` returns (good, bad)."""
    good, bad = split(validated)
    if mode == "fail":
        n = bad.count()
        if n:
            first = bad.select("_errors").first()
            raise InvalidBatch(f"{n} invalid record(s), e.g. {list(first[0]) if first else []}")
    elif mode != "quarantine":
        raise ValueError("mode must be 'fail' or 'quarantine'")
    return good, bad


def strip_nulls(arr: Column) -> Column:
    """V3 on an array column: NULL entries removed, NULL array -> []."""
    return F.coalesce(F.filter(arr, lambda x: x.isNotNull()), F.array().cast(ArrayType(DoubleType())))
