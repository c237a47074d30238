"""String expressions over logged SQL, replies and keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The words that make a logged statement unsafe, and its allowed openings.
BLOCKED_WORDS = [
    "DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "TRUNCATE",
    "CREATE", "REPLACE", "MERGE", "GRANT", "REVOKE", "CALL",
]
ALLOWED_OPENINGS = ["SELECT", "WITH"]

TABLE_NAME = r"(?i)(?:FROM|JOIN)\s+`?([a-zA-Z0-9_.-]+)`?"


def strip(col: Column) -> Column:
    """Remove every kind of white space at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def without_fence(col: Column, languages: tuple[str, ...]) -> Column:
    """Drop an opening code fence (with an optional language tag) and a closing one."""
    opening = "^(?:" + "|".join(f"```{tag}" for tag in languages) + ")?(?:```)?"
    return strip(F.regexp_replace(F.regexp_replace(strip(col), opening, ""), "```$", ""))


def clean_sql(col: Column) -> Column:
    """Generated SQL without fence and trailing semicolons."""
    return F.regexp_replace(without_fence(col, ("sql", "SQL")), ";+$", "")


def sql_error(col: Column) -> Column:
    """First reason a statement is refused, or an empty string.

    Order: opening word, blocked words (alphabetical), more than one statement.
    """
    upper = strip(F.upper(col))
    openings = upper.startswith(ALLOWED_OPENINGS[0])
    for word in ALLOWED_OPENINGS[1:]:
        openings = openings | upper.startswith(word)
    reason = F.when(
        ~openings, F.concat(F.lit("Only SELECT queries allowed. Got: "), F.left(upper, F.lit(20)), F.lit("..."))
    )
    for word in sorted(BLOCKED_WORDS):
        reason = reason.when(upper.rlike(rf"\b{word}\b"), F.lit(f"Blocked keyword detected: {word}"))
    return reason.when(statement_count(col) > 1, F.lit("Multiple SQL statements not allowed")).otherwise(F.lit(""))


def statement_count(col: Column) -> Column:
    return F.size(F.filter(F.split(col, ";"), lambda part: strip(part) != ""))


def referenced_tables(col: Column) -> Column:
    """Sorted distinct names after FROM and JOIN, cut to ``dataset.table``."""
    names = F.regexp_extract_all(col, F.lit(TABLE_NAME), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(names, last_two_parts)))


def last_two_parts(name: Column) -> Column:
    parts = F.split(name, r"\.")
    return F.when(F.size(parts) >= 3, F.concat_ws(".", F.element_at(parts, -2), F.element_at(parts, -1))).otherwise(name)


def text_key(col: Column) -> Column:
    """Store key of a text: the first 16 hex digits of its SHA-256."""
    return F.left(F.sha2(col, 256), F.lit(16))


def question_key(col: Column) -> Column:
    return text_key(strip(F.lower(col)))


def preview(col: Column, limit: int = 400) -> Column:
    return F.when(F.length(col) > limit, F.concat(F.left(col, F.lit(limit)), F.lit("..."))).otherwise(col)


def sorted_json(params: Column) -> Column:
    """JSON of a map with its keys in order, so equal maps give equal text."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(params))))


def action_key(tool: Column, params: Column) -> Column:
    return F.md5(F.concat(tool, sorted_json(params)))


def pseudonym(col: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), col.cast("string")), 256)
