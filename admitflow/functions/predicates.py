"""Conditions as SQL text, for rules that are counted by the dozen."""

from __future__ import annotations


def listed(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def outside(column: str, accepted: list[str]) -> str:
    """A filled value that is not accepted; an empty one is the business of the required-field check."""
    return f"{column} NOT IN {listed(accepted)}"


def within(column: str, values: list[str]) -> str:
    """Membership that is false, not unknown, for NULL."""
    return f"coalesce({column} IN {listed(values)}, false)"


def any_null(columns: list[str]) -> str:
    return " OR ".join(f"{c} IS NULL" for c in columns)


# A reader of strict JSON whose limits on depth and length are lifted. It skips over what the schema does not name, so it
# goes through a text once and keeps nothing of it.
_READER = ", ".join(
    f"'{name}', '{value}'"
    for name, value in {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "unreadable",
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false",
        "maxNestingDepth": 2**31 - 1,
        "maxNumLen": 2**31 - 1,
        "maxStringLen": 2**31 - 1,
    }.items()
)
# The one limit that cannot be lifted is on names; shorter texts cannot reach it.
_LONGEST_NAME = 50_000


def _reads(text: str) -> str:
    return f"from_json({text}, 'other INT, unreadable STRING', map({_READER})).unreadable IS NULL"


def _one_value(text: str) -> str:
    """Whether a text is one JSON value: the reader stops after the first one, so text that follows it would pass.
    Wrapping the text once as a member and once in a list below it leaves no tail that closes both."""
    as_member, in_list = f"""('{{"v":' || {text} || '}}')""", f"""('{{"v":[' || {text} || ']}}')"""
    return f"({_reads(as_member)} AND {_reads(in_list)})"


def _emptied_strings(text: str) -> str:
    """Every sound string without its content. A quote before a fault stays, and so does the fault inside it."""
    unescaped = rf"regexp_replace({text}, r'\\(?:[\x22\\/bfnrt]|u[0-9a-fA-F]{{4}})', '~')"
    return rf"""regexp_replace({unescaped}, r'\x22[^\x22\\\x00-\x1F]*+\x22', '""')"""


def is_json(column: str) -> str:
    """True when the whole text is one JSON value, however deep and long; NULL for NULL. Linear in the text."""
    long_names = f"length({column}) > {_LONGEST_NAME} AND {_one_value(_emptied_strings(column))}"
    return f"CASE WHEN {column} IS NULL THEN NULL WHEN {_one_value(column)} THEN true ELSE {long_names} END"
