"""Normalisers that turn source text into typed values, as Spark SQL text.

Each function takes a SQL expression and returns one, for ``selectExpr`` or ``F.expr``.  Building
text keeps wide normalisations cheap to plan.  Bad input becomes NULL (the caller decides whether
that rejects the row); nothing raises under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from mastlight.fixed_values import BOOLEAN_WORDS, NETWORK_SYNONYMS

_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_RADIX = (("^0[xX][0-9a-fA-F]+$", 16), ("^0[oO][0-7]+$", 8), ("^0[bB][01]+$", 2))
_LEADING_INT = "^[ \t]*([+-]?[0-9]+)"
_LEADING_FLOAT = "^[ \t]*([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)"
#: Blank characters that are stripped from both ends of a text.
BLANKS = (
    "\t\n\v\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f"
    "\u3000\ufeff"
)
SLASH_DATES = ("yyyy/M/d", "M/d/yyyy")
NAMED_DATES = ("d MMM yyyy", "MMM d yyyy")
MONTHS = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\b"
WEEKDAY = r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+"
ZONE = r"(?i)\s*\b(gmt|utc|z)([+]0000)?$"
_MAX_DOUBLE = "1.7976931348623157E308D"
_MAX_MILLIS = "8.64E15D"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(words: Sequence[str]) -> str:
    """A SQL list of string literals."""
    return ", ".join(quoted(w) for w in words)


def first_present(available: Sequence[str], names: Sequence[str]) -> str:
    """First of ``names`` that the source has and that is not the empty string, else NULL."""
    found = [f"nullif(`{n}`, '')" for n in names if n in available]
    return f"coalesce({', '.join(found)})" if found else "cast(NULL AS string)"


def stripped(text: str) -> str:
    """The text without blank characters (tabs, line breaks and wide blanks too) at either end."""
    return f"trim(BOTH {quoted(BLANKS)} FROM {text})"


def _finite(value: str) -> str:
    return f"CASE WHEN abs({value}) <= {_MAX_DOUBLE} THEN {value} END"


def number(text: str) -> str:
    """Strict number: the whole trimmed text must be a finite literal.  Empty or NULL gives NULL."""
    trimmed = stripped(text)
    radixes = " ".join(
        f"WHEN {trimmed} RLIKE {quoted(pattern)} THEN try_cast(conv(substring({trimmed}, 3), {radix}, 10) AS double)"
        for pattern, radix in _RADIX
    )
    # A non-empty text of blanks reads as zero.
    return (
        f"CASE WHEN {trimmed} RLIKE {quoted(_DECIMAL)} THEN {_finite(f'try_cast({trimmed} AS double)')} "
        f"{radixes} WHEN {trimmed} = '' AND {text} <> '' THEN 0D END"
    )


def leading_float(text: str) -> str:
    """Longest numeric prefix as a double (``'6.5N'`` -> 6.5), else NULL."""
    digits = f"nullif(regexp_extract({text}, {quoted(_LEADING_FLOAT)}, 1), '')"
    return _finite(f"try_cast({digits} AS double)")


def leading_int(text: str, to: str = "int") -> str:
    """Integer prefix (``'42.7ms'`` -> 42), else NULL; out of the target's range gives NULL."""
    digits = f"nullif(regexp_extract({text}, {quoted(_LEADING_INT)}, 1), '')"
    return f"try_cast(try_cast({digits} AS decimal(38,0)) AS {to})"


def clamp(value: str, low: float, high: float) -> str:
    """Limit to [low, high], keeping NULL (``least``/``greatest`` alone would drop it)."""
    return f"CASE WHEN ({value}) IS NOT NULL THEN least({high}, greatest({low}, {value})) END"


def clean_text(text: str, fallback: str, length: int) -> str:
    """Trimmed text, ``fallback`` when empty, cut to ``length`` characters."""
    return f"substring(coalesce(nullif({stripped(text)}, ''), {quoted(fallback)}), 1, {length})"


def network_generation(text: str, unknown: str | None = None) -> str:
    """Canonical 2G..5G.  Other names become ``unknown``, or stay upper-cased when it is None."""
    raw = f"upper({clean_text(text, '4G', 10)})"
    cases = " ".join(f"WHEN {raw} IN ({listed(n)}) THEN {quoted(g)}" for g, n in NETWORK_SYNONYMS.items())
    return f"CASE {cases} ELSE {raw if unknown is None else quoted(unknown)} END"


def network_parameter(value: str) -> str:
    """The generation a list filter asks for; names it does not know mean 4G.  (A plain value.)"""
    name = ((value or "").strip() or "4G")[:10].upper()
    return next((g for g, names in NETWORK_SYNONYMS.items() if name in names), "4G")


def boolean(text: str, words: str = "plain") -> str:
    """Three-valued boolean from a word list of ``BOOLEAN_WORDS``."""
    yes, no = BOOLEAN_WORDS[words]
    raw = f"lower({stripped(text)})"
    return f"CASE WHEN {raw} IN ({listed(yes)}) THEN true WHEN {raw} IN ({listed(no)}) THEN false END"


def timestamp(text: str) -> str:
    """UTC wall time of a date/time text, to the millisecond.

    Reads ISO forms, slash dates year- or month-first (24 or 12 hours), and dates with an English month name, with or
    without weekday and a final GMT, UTC or Z.
    """
    raw = stripped(text)

    def tried(value: str, forms: Sequence[str], clocks: Sequence[str]) -> str:
        return ", ".join(f"try_to_timestamp({value}, {quoted(form + clock)})" for form in forms for clock in clocks)

    slashed = tried(f"upper({raw})", SLASH_DATES, ("[ H:mm[:ss]]", " h:mm[:ss] a"))
    # Weekday, commas and the zone go; the month is cut to three letters.
    bare = f"regexp_replace({raw}, {quoted(WEEKDAY)}, '')"
    bare = f"regexp_replace(regexp_replace({bare}, {quoted(ZONE)}, ''), '[, ]+', ' ')"
    bare = f"regexp_replace(initcap({bare}), '([A-Z][a-z]{{2}})[a-z]*', '$1')"
    named = tried(bare, NAMED_DATES, ("[ H:mm[:ss]]",))
    parsed = (
        f"CASE WHEN {raw} RLIKE '^[0-9]{{4}}(-|$)' THEN try_cast({raw} AS timestamp) "
        f"WHEN contains({raw}, '/') THEN coalesce({slashed}) "
        f"WHEN {raw} RLIKE {quoted(MONTHS)} THEN coalesce({named}) END"
    )
    return f"cast(date_trunc('millisecond', {parsed}) AS timestamp_ntz)"


def date(text: str) -> str:
    """UTC date of a date/time text."""
    return f"cast({timestamp(text)} AS date)"


def month_start(text: str) -> str:
    """``YYYY-MM`` means the first of that month; longer texts are read as dates."""
    raw = clean_text(text, "", 20)
    return date(f"CASE WHEN length({raw}) = 7 THEN concat({raw}, '-01') ELSE {raw} END")


def epoch_millis(value: str) -> str:
    """UTC wall time of epoch milliseconds; out of range gives NULL."""
    safe = f"CASE WHEN abs({value}) <= {_MAX_MILLIS} THEN {value} END"
    return f"cast(timestamp_millis(cast({safe} AS bigint)) AS timestamp_ntz)"


def epoch_or_text_timestamp(text: str, parsed: str) -> str:
    """Timestamp from date text, or from ``parsed`` (its number): seconds, or milliseconds above 1e12."""
    millis = f"(CASE WHEN {parsed} > 1E12D THEN {parsed} ELSE {parsed} * 1000 END)"
    return (
        f"CASE WHEN {parsed} IS NOT NULL THEN {epoch_millis(millis)} "
        f"WHEN length({text}) > 0 THEN {timestamp(text)} END"
    )


def minutes_between(start: str, end: str) -> str:
    """Whole minutes, rounded half up, never negative; NULL while either end is missing."""
    micros = f"unix_micros(cast({end} AS timestamp)) - unix_micros(cast({start} AS timestamp))"
    return (
        f"CASE WHEN {start} IS NOT NULL AND {end} IS NOT NULL THEN "
        f"cast(floor(floor(greatest(0L, {micros}) / 1000) / 60000 + 0.5D) AS int) END"
    )
