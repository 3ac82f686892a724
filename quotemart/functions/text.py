"""Text functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and formats shared with the feeds and file names.
CLOCK_PATTERN = r"(\d{2}:\d{2}:\d{2})"
DATE_TOKEN_PATTERN = r"(\d{4}_\d{2}_\d{2})"
DATE_TOKEN_FORMAT = "yyyy_MM_dd"
ISO_DATE_FORMAT = "yyyy-MM-dd"
LIST_SEPARATOR = ","


def normal_ticker(ticker: Column) -> Column:
    """Join key of a ticker: lower case, outer spaces removed."""
    return F.trim(F.lower(ticker))


def normal_name(name: Column) -> Column:
    """Join key of an exchange or industry name: outer spaces removed, case kept."""
    return F.trim(name)


def strip(text: Column) -> Column:
    """Remove outer white space of any kind; ``trim`` would leave tabs and line ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def split_names(text: Column) -> Column:
    """Comma list to array: elements stripped, blank elements dropped."""
    parts = F.transform(F.split(text, LIST_SEPARATOR), strip)
    return F.filter(parts, lambda part: part != "")


def text_id(text: Column) -> Column:
    """Stable business id: md5 hex of the UTF-8 text."""
    return F.md5(text.cast("binary"))


# Fixed value: how a null reads in a key text.
NULL_TEXT = "None"


def industry_text(sector: Column, industry: Column) -> Column:
    """Key text of an industry: sector and name joined by an underscore; a null sector is not an empty one."""
    return F.concat(F.coalesce(sector, F.lit(NULL_TEXT)), F.lit("_"), industry)


def clock_text(text: Column) -> Column:
    """First HH:MM:SS found in a text, NULL if there is none."""
    return F.nullif(F.regexp_extract(text, CLOCK_PATTERN, 1), F.lit(""))


def date_token(file_name: Column) -> Column:
    """Date token of a file name, NULL if it carries none."""
    return F.nullif(F.regexp_extract(file_name, DATE_TOKEN_PATTERN, 1), F.lit(""))


def token_date(token: Column) -> Column:
    """Date of a date token."""
    return F.to_date(token, DATE_TOKEN_FORMAT)


def token_of(day: Column) -> Column:
    """Date token of a date."""
    return F.date_format(day, DATE_TOKEN_FORMAT)
