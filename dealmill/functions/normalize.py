"""Cleaning of text cells as native SQL expressions; no Python runs per row.

``clean`` normalises the named columns of a table.  It works in five projections (strip, fold case, take
apart, convert, describe), each a code-generated expression over the one before, so that no
step is repeated within a row.  Parsing uses ``try_cast``: a cell that cannot be read becomes
NULL and never stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from dealmill.schemas import DATA_TIME_ZONE, DEFAULT_CURRENCY, MONEY, SOURCE_ALIASES, SOURCE_SEED

# Every character that counts as white space at the ends of a cell (Unicode, not only U+0020).
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
_WHITESPACE_SQL = "'" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "'"

PARSED_NUMBER = "decimal(38,10)"


def text_or_null(column: str) -> str:
    """The cell without white space at either end; NULL when nothing is left.

    Most cells begin and end with a visible ASCII character: two comparisons tell, and nothing is searched or copied.
    """
    first, last = f"`{column}`", f"substring(`{column}`, -1, 1)"
    visible = f"{first} >= '!' and {first} < '\\u007f' and {last} >= '!' and {last} < '\\u007f'"
    return f"if({visible}, `{column}`, nullif(btrim(`{column}`, {_WHITESPACE_SQL}), ''))"


def is_blank(column: str) -> str:
    """True for NULL and for cells of white space only."""
    return f"({text_or_null(column)} is null)"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ---------------------------------------------------------------- kinds of cells

TIMESTAMP, DATE, AMOUNT, DISCOUNT, INTEGER, FLAG, TEXT, CURRENCY, CHANNEL, PHONE = (
    "timestamp", "date", "amount", "discount", "integer", "flag", "text", "currency", "channel", "phone"
)
Kind = str | list[str]  # one of the names above, or the allowed codes of a coded column

# Patterns of the five accepted date spellings; only the first two are standard.
_YEAR, _MONTH, _DAY = r"(?!0000)\d{4}", r"(?:1[0-2]|0?[1-9])", r"(?:3[01]|[12]\d|0?[1-9])"
_HOUR, _MINUTE, _SECOND = r"(?:2[0-3]|[01]?\d)", r"[0-5]?\d", r"[0-5]?\d"
_ISO_INSTANT = rf"^{_YEAR}-{_MONTH}-{_DAY}[Tt]{_HOUR}:{_MINUTE}:{_SECOND}(?:Z|[+-]\d\d:?[0-5]\d)$"
_ISO_DATE = rf"^{_YEAR}-{_MONTH}-{_DAY}$"
_SLASH_DATE = rf"^{_YEAR}/{_MONTH}/{_DAY}$"
_DOT_TIME = rf"^({_DAY})\.({_MONTH})\.({_YEAR})\s+({_HOUR}):({_MINUTE})$"
_DOT_DATE = rf"^({_DAY})\.({_MONTH})\.({_YEAR})$"

# What ``\s`` matches in a pattern.
_PATTERN_BLANKS = r"' \u0009\u000a\u000b\u000c\u000d'"

# Patterns of whole numbers and of national phone numbers (digits only).
_INTEGER = r"^[+-]?\d+(?:_\d+)*$"
_NATIONAL_PHONE = r"^[78]\d{10}$"


def _as_iso(text: str, zone: str) -> str:
    """(standard spelling?, ISO text) of a date cell; cells without an offset are read in ``zone``.

    A character that all spellings of a kind have, and no others, tells first which patterns can match at all.
    """
    midnight = f"'T00:00:00{zone}'"
    day, month, rest = f"substring_index({text}, '.', 1)", f"substring_index(substring_index({text}, '.', 2), '.', -1)", f"substring_index({text}, '.', -1)"
    dotted = f"concat(substring({rest}, 1, 4), '-', {month}, '-', {day}, 'T'"

    def found(pattern: str, standard: bool, iso: str) -> str:
        return f"when {text} rlike r'{pattern}' then named_struct('standard', {str(standard).lower()}, 'iso', {iso})"

    return f"""case
        when contains({text}, '.') then case
            {found(_DOT_TIME, False, f"{dotted}, btrim(substring({rest}, 5), {_PATTERN_BLANKS}), ':00{zone}')")}
            {found(_DOT_DATE, False, f"{dotted}, '00:00:00{zone}')")} end
        when contains({text}, ':') then case
            {found(_ISO_INSTANT, True, f"if(contains({text}, 't'), translate({text}, 't', 'T'), {text})")} end
        when contains({text}, '/') then case
            {found(_SLASH_DATE, False, f"concat(translate({text}, '/', '-'), {midnight})")} end
        else case {found(_ISO_DATE, True, f"concat({text}, {midnight})")} end
        end"""


def _take_apart(kind: Kind, text: str, folded: str, zone: str) -> str:
    if kind in (TIMESTAMP, DATE):
        return _as_iso(text, zone)
    if kind == PHONE:
        return f"regexp_replace({text}, r'\\D', '')"
    if kind == CHANNEL:
        aliases = " ".join(f"when '{spelling}' then '{code}'" for spelling, code in SOURCE_ALIASES.items())
        return f"case {folded} {aliases} else {folded} end"
    if kind in (AMOUNT, DISCOUNT):
        # Few cells have separators; ``translate`` looks every character up.
        return f"try_cast(if(contains({text}, '_'), translate({text}, '_', ''), {text}) as {PARSED_NUMBER})"
    if kind == FLAG:
        return folded
    return text


def _convert(kind: Kind, text: str, part: str) -> str:
    if kind == TIMESTAMP:
        return f"try_cast({part}.iso as timestamp)"
    if kind == DATE:
        # The date as written, whatever its offset, of a cell that is valid as a whole.
        written = f"try_cast(substring_index({part}.iso, 'T', 1) as date)"
        return f"case when try_cast({part}.iso as timestamp) is not null then {written} end"
    if kind == PHONE:
        return f"case when {part} rlike r'{_NATIONAL_PHONE}' then concat('+7', substring({part}, 2)) else {text} end"
    if kind == DISCOUNT:
        return f"coalesce({part}, cast(0 as {PARSED_NUMBER}))"
    if kind == CURRENCY:
        return f"coalesce({text}, '{DEFAULT_CURRENCY}')"
    if kind == INTEGER:
        return f"case when {text} rlike r'{_INTEGER}' then try_cast(translate({text}, '_', '') as int) end"
    if kind == FLAG:
        # Accepted spellings; anything else is unknown, not false.
        return (
            f"case when {part} in ('true', '1', 'yes', 't') then true "
            f"when {part} in ('false', '0', 'no', 'f') then false end"
        )
    if isinstance(kind, list):
        return f"case when {text} in ({quoted(kind)}) then {text} end"
    return part


def _describe(kind: Kind, text: str, part: str, value: str) -> dict[str, str]:
    """What was found out about a cell besides its value."""
    out = {"blank": f"{text} is null"}
    if kind in (TIMESTAMP, DATE):
        out["nonstandard"] = (
            f"{text} is not null and not (coalesce({part}.standard, false) and {value} is not null)"
        )
    elif kind == PHONE:
        out["status"] = (
            f"case when {text} is null then cast(null as string) "
            f"when not {part} rlike r'{_NATIONAL_PHONE}' then 'unrecognized' "
            f"when not startswith({text}, '+7') then 'fixed' end"
        )
    elif kind == CHANNEL:
        codes = [code for code, _ in SOURCE_SEED]
        ids = " ".join(f"when '{code}' then {i}" for i, code in enumerate(codes, start=1))
        out["id"] = f"case {part} {ids} end"
        out["unknown"] = f"coalesce({part} not in ({quoted(codes)}), false)"
        out["rewritten"] = f"coalesce({part} in ({quoted(codes)}) and {part} <> {text}, false)"
    elif isinstance(kind, list):
        out["invalid"] = f"{text} is not null and {value} is null"
    return out


def clean(df: DataFrame, kinds: dict[str, Kind], zone: str = DATA_TIME_ZONE) -> DataFrame:
    """``df`` with ``<column>__v`` (value), ``<column>__blank`` and statuses per named column.

    ==========  =====================================  =============================================
    kind        value                                  statuses
    ==========  =====================================  =============================================
    timestamp   instant, ``zone`` where none is given  ``__nonstandard``: other spelling, unreadable
    date        calendar date as written               the same
    amount      decimal before rounding                -
    discount    the same, 0 when absent                -
    integer     whole number                           -
    flag        true, false or NULL                    -
    text        stripped text                          -
    currency    stripped text, RUB when absent         -
    channel     code in one spelling                   ``__id``, ``__unknown``, ``__rewritten``
    phone       +7XXXXXXXXXX where possible            ``__status``: NULL, fixed or unrecognized
    codes       the code when it is allowed            ``__invalid``
    ==========  =====================================  =============================================
    """

    def step(table: DataFrame, columns: dict[str, str]) -> DataFrame:
        return table.selectExpr("*", *(f"{expression} as `{name}`" for name, expression in columns.items()))

    text = {c: f"`{c}__text`" for c in kinds}
    # A column of its own, since a CASE over an expression evaluates it once per branch.
    folded = {c: f"`{c}__folded`" for c, kind in kinds.items() if kind in (CHANNEL, FLAG)}
    part = {c: f"`{c}__part`" for c in kinds}
    value = {c: f"`{c}__v`" for c in kinds}
    out = step(df, {f"{c}__text": text_or_null(c) for c in kinds})
    out = step(out, {f"{c}__folded": f"lower({text[c]})" for c in folded}) if folded else out
    out = step(out, {f"{c}__part": _take_apart(kind, text[c], folded.get(c, ""), zone) for c, kind in kinds.items()})
    out = step(out, {f"{c}__v": _convert(kind, text[c], part[c]) for c, kind in kinds.items()})
    found = {
        f"{c}__{name}": expression
        for c, kind in kinds.items()
        for name, expression in _describe(kind, text[c], part[c], value[c]).items()
    }
    steps = [*(f"{c}__text" for c in kinds), *(f"{c}__folded" for c in folded), *(f"{c}__part" for c in kinds)]
    return step(out, found).drop(*steps)


def to_money(number: Column) -> Column:
    """Stored amount: two decimals, halves away from zero; too large a number is an error."""
    return number.cast(MONEY)
