"""Text and time expressions on columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a closing year or year span in brackets, years 1900 to 2099.
TITLE_YEAR = r"\s*\((?:19|20)\d{2}(?:-(?:19|20)\d{2})?\)\s*$"
# Fixed value: runs of letters, digits and underscore in any script.
WORD = r"[\p{L}\p{N}_]+"
# The flag columns of the piped item file, in file order.
GENRE_FLAGS = [
    "unknown", "Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
    "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "Musical", "Mystery",
    "Romance", "Sci-Fi", "Thriller", "War", "Western",
]


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_title(col: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(col), TITLE_YEAR, ""))


def content_text(title: Column | str, genres: Column | str) -> Column:
    empty = F.lit("")
    return F.concat(
        F.coalesce(clean_title(title), empty), F.lit(" "), F.coalesce(_col(genres), empty)
    )


def item_blob(title: Column | str, genres: Column | str, description: Column | str) -> Column:
    """One sentence per item for a text encoder; nulls are empty."""
    parts = [F.coalesce(_col(c), F.lit("")) for c in (title, genres, description)]
    return F.concat(parts[0], F.lit(". "), parts[1], F.lit(". "), parts[2])


def split_genres(col: Column | str) -> Column:
    return F.coalesce(F.split(_col(col), r"\|"), F.array().cast("array<string>"))


def genre_flags_to_array(df: DataFrame, flags: list[str] = GENRE_FLAGS) -> DataFrame:
    """Replace the 0/1 flag columns by one ``genres`` array."""
    names = F.array(*[F.when(F.col(f"`{f}`") == 1, F.lit(f)) for f in flags])
    return df.withColumn("genres", F.filter(names, lambda g: g.isNotNull())).drop(*flags)


def words(col: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(col)), F.lit(WORD), F.lit(0))


def starts_with(col: Column | str, prefix: str) -> Column:
    return _col(col).startswith(prefix)


def has_word(col: Column | str, word: str) -> Column:
    """Whole-word match, ignoring case; the word is taken literally."""
    return _col(col).rlike(rf"(?i)\b\Q{word}\E\b")


def title_starts_with(df: DataFrame, prefix: str, col: str = "title") -> DataFrame:
    return df.where(starts_with(col, prefix))


def title_has_word(df: DataFrame, word: str, col: str = "title") -> DataFrame:
    return df.where(has_word(col, word))


def with_title(df: DataFrame, col: str = "title") -> DataFrame:
    return df.where(F.col(col).isNotNull())


def daypart(ts: Column | str) -> Column:
    """Hours 6-11 morning, 12-17 afternoon, 18-21 evening, the rest night."""
    hour = F.hour(_col(ts))
    return (
        F.when(hour.between(6, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .when(hour.between(18, 21), "evening")
        .otherwise("night")
    )


def parse_event_time(df: DataFrame, col: str = "timestamp", unit: str = "s") -> DataFrame:
    """Epoch numbers (or text, with ``unit=None``) to ``ts``; unparsable rows are dropped."""
    if unit is None:
        parsed = F.try_to_timestamp(F.col(col))
    else:
        per_second = {"s": 1, "ms": 1_000, "us": 1_000_000}[unit]
        seconds = F.expr(f"try_cast(`{col}` AS BIGINT)")
        parsed = F.timestamp_micros(seconds * F.lit(1_000_000 // per_second))
    return df.withColumn("ts", parsed).where(F.col("ts").isNotNull())


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp read in the session zone (UTC here)."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def sid_token(semantic_id: Column | str) -> Column:
    """The first two levels of a semantic id as one vocabulary token."""
    sid = _col(semantic_id)
    return F.concat_ws("_", F.lit("SID"), sid[0].cast("string"), sid[1].cast("string"))
