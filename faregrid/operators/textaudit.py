"""Audit of query texts held in a table: clean, cap and check, one row per text.

Everything is a column expression, so a table of texts of any size is audited
in one narrow pass. ``(?U)`` makes the classes match all scripts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tables a text may read, words it may not contain, row caps.
GUARDED_TABLES = (
    "monthly_trips",
    "borough_summary",
    "zone_summary",
    "hourly_summary",
    "weather_summary",
    "fact_trips_yellow",
    "fact_trips_fhvhv",
    "dim_time",
    "dim_zone",
)
FORBIDDEN_WORDS = (
    "INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER",
    "TRUNCATE", "REPLACE", "MERGE", "UPSERT", "GRANT", "REVOKE",
    "EXEC", "EXECUTE", "CALL", "PRAGMA", "ATTACH", "DETACH",
)
FORBIDDEN_WORDS_REDUCED = (
    "INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE",
)
MAX_LIMIT = 1000
DEFAULT_LIMIT = 100

# How tables and limits are found in a text, and the reasons given.
TABLE_PATTERN = r"(?U)\b(?:FROM|JOIN)\s+([a-zA-Z_][a-zA-Z0-9_]*)"
LIMIT_PATTERN = r"(?U)\bLIMIT\s+(\d+)"
EMPTY = "Empty SQL query"
SELECT_ONLY = "Only SELECT statements are allowed"
FORBIDDEN = "Forbidden keyword detected: "
UNKNOWN_TABLES = "Unknown tables referenced: "
NO_LIMIT = "Query must include a LIMIT clause"
TOO_HIGH = ("LIMIT ", " exceeds maximum allowed ")
MULTIPLE = "Multiple statements not allowed"

# blanks of all scripts, and the four separators that are not white space by class
BLANKS = r"[\s\x1c-\x1f]+"


@dataclass(frozen=True)
class GuardProfile:
    """Which rules apply; ``tables=None`` leaves the table rule out."""

    forbidden: Sequence[str] = FORBIDDEN_WORDS
    tables: Sequence[str] | None = GUARDED_TABLES
    single_statement: bool = True
    max_limit: int = MAX_LIMIT


FULL_GUARD = GuardProfile()
REDUCED_GUARD = GuardProfile(FORBIDDEN_WORDS_REDUCED, tables=None, single_statement=False)


def strip_blanks(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{BLANKS}|{BLANKS}\z", "")


def strip_semicolons(text: Column) -> Column:
    return F.regexp_replace(text, r";+\z", "")


def sanitise(text: Column) -> Column:
    """Remove code fences, outer blanks, then trailing semicolons."""
    unfenced = F.regexp_replace(text, r"(?iU)```sql\s*", "")
    unfenced = F.regexp_replace(unfenced, r"(?U)```\s*", "")
    return strip_semicolons(strip_blanks(unfenced))


def with_limit(text: Column, default: int = DEFAULT_LIMIT) -> Column:
    """Append the default row cap unless the text mentions one anywhere."""
    capped = F.concat(strip_blanks(strip_semicolons(text)), F.lit(f" LIMIT {default}"))
    return F.when(F.upper(text).contains("LIMIT"), text).otherwise(capped)


def _exceeds(digits: Column, maximum: int) -> Column:
    """Compare a digit string of any length with ``maximum`` without overflow."""
    significant = F.regexp_replace(digits, "^0+", "")
    width = len(str(maximum))
    longer = F.length(significant) > width
    return longer | (
        (F.length(significant) == width) & (significant > F.lit(str(maximum)))
    )


def validate(texts: DataFrame, column: str, profile: GuardProfile = FULL_GUARD) -> DataFrame:
    """Add ``valid``, ``rule`` (NULL when accepted) and ``error`` to each text.

    The rules are tried in a fixed order and the first one that fails is named.
    The trimmed and upper-cased text are columns of their own, so they are
    computed once per row and not once per rule.
    """
    text, trimmed, upper = F.col(column), F.col("__trimmed"), F.col("__upper")
    words = r"(?U)\b(" + "|".join(profile.forbidden) + r")\b"
    word = F.regexp_extract(upper, words, 1)
    limit = F.regexp_extract(upper, LIMIT_PATTERN, 1)
    named = F.transform(F.regexp_extract_all(upper, F.lit(TABLE_PATTERN), F.lit(1)), F.lower)
    known = F.array(*[F.lit(t) for t in profile.tables or ()]).cast("array<string>")
    unknown = F.array_except(named, known)

    rules = [
        (text.isNull() | (trimmed == ""), "empty", F.lit(EMPTY)),
        (
            ~upper.startswith("SELECT"),
            "select_only",
            F.lit(SELECT_ONLY),
        ),
        (
            upper.rlike(words),
            "forbidden_word",
            F.concat(F.lit(FORBIDDEN), word),
        ),
    ]
    if profile.tables is not None:
        listed = F.array_join(F.array_sort(unknown), ", ")
        rules.append(
            (
                F.size(unknown) > 0,
                "unknown_table",
                F.concat(F.lit(UNKNOWN_TABLES), listed),
            )
        )
    rules.append(
        (
            ~upper.contains("LIMIT"),
            "no_limit",
            F.lit(NO_LIMIT),
        )
    )
    rules.append(
        (
            _exceeds(limit, profile.max_limit),
            "limit_too_high",
            F.concat(
                F.lit(TOO_HIGH[0]), limit, F.lit(f"{TOO_HIGH[1]}({profile.max_limit})")
            ),
        )
    )
    if profile.single_statement:
        rules.append(
            (
                strip_semicolons(trimmed).contains(";"),
                "multiple_statements",
                F.lit(MULTIPLE),
            )
        )

    first = None
    for test, name, message in rules:
        outcome = F.struct(F.lit(name).alias("rule"), message.alias("error"))
        first = F.when(test, outcome) if first is None else first.when(test, outcome)
    return (
        texts.withColumn("__trimmed", strip_blanks(text))
        .withColumn("__upper", F.upper(trimmed))
        .withColumn("__first", first)
        .select(
            *texts.columns,
            F.col("__first").isNull().alias("valid"),
            F.col("__first.rule").alias("rule"),
            F.coalesce(F.col("__first.error"), F.lit("")).alias("error"),
        )
    )


def audit(texts: DataFrame, column: str, profile: GuardProfile = FULL_GUARD) -> DataFrame:
    """Clean and cap each raw text, then check the result."""
    cleaned = texts.withColumn("sanitised", sanitise(F.col(column)))
    limited = cleaned.withColumn("limited", with_limit(F.col("sanitised")))
    return validate(limited, "limited", profile)
