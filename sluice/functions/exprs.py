"""Column expressions.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

# ── fixed values ─────────────────────────────────────────────────────────
# Characters that Python's str.strip() removes (str.isspace): the reference
# strips every identifier, flag and value this way.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Canonical 8-4-4-4-12 hex UUID, searched anywhere in a file name.
UUID_PATTERN = r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"
# Statuses and error label of the split validation.
STATUS_COMPLETED = "COMPLETED"
STATUS_ERRORED = ("FAILED", "ERROR")
SCHEMA_VALIDATION_ERROR = "schema-validation-error"
# Labels for missing values in reports.
MISSING_SUB_PROCESS = "unknown"
MISSING_STATUS = "(null)"
MISSING_ERROR_TYPE = "unknown"
EMPTY_ERROR_REASON = "(error field is empty)"
# Full case folding where it differs from lower-casing (the common cases).
CASEFOLD_EXTRA = (("ß", "ss"), ("ẞ", "ss"), ("ς", "σ"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬅ", "st"), ("ﬆ", "st"))
# Rule-id spellings accepted when a payload or log echoes a rule.
RULE_ALIAS_FORMATS = ("{}", "rule-{}", "rule_{}", "prac-{}", "practice-{}", "facility-{}")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_norm(c, data_type=None) -> Column:
    """EXP-1: null, numeric 0 and False become ''; else the string, stripped.

    ``data_type`` lets numeric/boolean columns get the falsy-zero rule; string
    columns only need the null default and the Unicode-whitespace strip.
    """
    c = _col(c)
    if isinstance(data_type, BooleanType):
        s = F.when(c, F.lit("True")).otherwise(F.lit(""))
    elif isinstance(data_type, NumericType):
        s = F.when(c == 0, F.lit("")).otherwise(c.cast("string"))
    else:
        s = c.cast("string")
    return F.btrim(F.coalesce(s, F.lit("")), F.lit(WHITESPACE))


def text_of(df, name: str) -> Column:
    """``text_norm`` of a named column using its declared type."""
    return text_norm(F.col(name), df.schema[name].dataType)


def ci_equal(a, b) -> Column:
    """EXP-2: equality after strip + upper case."""
    return F.upper(text_norm(a)) == F.upper(text_norm(b))


def casefold(c) -> Column:
    """EXP-3: case folding: lower case plus the multi-character foldings
    (ß → ss, ...) that lower-casing alone misses."""
    v = F.lower(text_norm(c))
    for src, dst in CASEFOLD_EXTRA:
        v = F.replace(v, F.lit(src), F.lit(dst))
    return v


def canon_id(c) -> Column:
    """EXP-4: canonical identifier; all-digit values lose leading zeros.

    Two values are "the same identifier" exactly when their canon_id is equal,
    so identifier matching becomes a plain hash equi-join.
    """
    t = c if isinstance(c, Column) else text_norm(c)
    stripped = F.ltrim(t, F.lit("0"))
    return F.when(t.rlike("^[0-9]+$"), F.when(stripped == "", F.lit("0")).otherwise(stripped)).otherwise(t)


def normalise_prefix(c) -> Column:
    """EXP-5: strip, drop leading '/', force one trailing '/' unless empty."""
    v = F.ltrim(text_norm(c), F.lit("/"))
    return F.when((v == "") | v.endswith("/"), v).otherwise(F.concat(v, F.lit("/")))


def file_name(key) -> Column:
    """EXP-6: object name after the last '/'."""
    return F.substring_index(_col(key), "/", -1)


def null_to_blank(c) -> Column:
    """EXP-7."""
    return F.coalesce(_col(c), F.lit(""))


def active_on(date_from, date_to, as_of) -> Column:
    """FLT-4 with EXP-8: closed date interval; a null start excludes the row."""
    as_of_c = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return (F.to_date(_col(date_from)) <= as_of_c) & (
        _col(date_to).isNull() | (F.to_date(_col(date_to)) >= as_of_c)
    )


def process_uuid(name) -> Column:
    """EXP-9: first UUID in a file name, null when there is none."""
    return F.nullif(F.regexp_extract(_col(name), UUID_PATTERN, 0), F.lit(""))


def json_normalise(c) -> Column:
    """EXP-11: JSON text becomes canonical compact JSON; other text unchanged.

    Valid JSON objects/arrays (text starting with '{' or '[') are re-rendered;
    invalid JSON and plain text are returned as they are.
    """
    c = _col(c)
    lead = F.btrim(c, F.lit(WHITESPACE))
    looks_json = lead.startswith("{") | lead.startswith("[")
    return F.when(looks_json, F.coalesce(F.to_json(F.try_parse_json(c)), c)).otherwise(c)


def first_lines(c, n: int = 20) -> Column:
    """EXP-12: the first ``n`` lines of a text."""
    return F.array_join(F.slice(F.split(_col(c), r"\r?\n"), 1, n), "\n")


def rule_aliases(rule_id) -> Column:
    """EXP-13: every accepted spelling of a rule id, as an array of strings."""
    rid = _col(rule_id).cast("string")
    return F.array(*[F.format_string(fmt.replace("{}", "%s"), rid) for fmt in RULE_ALIAS_FORMATS])


def or_default(df, name: str, default: str) -> Column:
    """EXP-14: null, blank and numeric zero take a default; other values stay
    as they are (not stripped)."""
    c, kind = F.col(name), df.schema[name].dataType
    empty = c.isNull() | ((c == 0) if isinstance(kind, NumericType) else (c.cast("string") == ""))
    return F.when(empty, F.lit(default)).otherwise(c.cast("string"))


def pct_tenths(num, den) -> Column:
    """Percentage in tenths, rounded half up with integer arithmetic."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, F.floor((num * 2000 + den) / (den * 2)).cast("long"))


def pct_text(tenths) -> Column:
    """EXP-15: ``12.3%`` from a tenths value (exact, no float formatting)."""
    t = _col(tenths)
    return F.concat(F.floor(t / 10).cast("string"), F.lit("."), (t % 10).cast("string"), F.lit("%"))


def flag(c) -> Column:
    """EXP-16: Y/N flag normalisation."""
    return F.upper(text_norm(c))


def in_values(c, values: Iterable[str]) -> Column:
    """FLT-2 for one rule: exact IN list; an empty list is an error."""
    values = list(values)
    if not values:
        raise ValueError("an IN list needs at least one value")
    return _col(c).isin(values)
