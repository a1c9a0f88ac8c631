"""Text rules: usage in charge descriptions, notes, fixed-width cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed_usage(group: Column, text: Column) -> Column:
    """Struct(description, usage) from a charge description.

    Storage charges read ``<name>: <usage>``, metered services ``<name> - $<rate> <unit>``. Text without the
    mark, or without a number after it, has no usage.
    """
    colon, dollar = F.instr(text, ":"), F.instr(text, "- $")
    after_colon = F.substr(text, colon)
    # The number patterns and marks of charge descriptions.
    whole_number = F.regexp_extract(after_colon, r"\d+", 0).try_cast("double")
    fraction = F.replace(
        F.regexp_extract(after_colon, r"\d+([\.,]\d+)", 0), F.lit(","), F.lit(".")
    ).try_cast("double")
    storage_usage = (
        F.when(colon == 0, F.lit(None).cast("double"))
        .when(F.contains(text, F.lit("API Requests")) | F.contains(text, F.lit("Snapshot Space")), whole_number)
        .when(F.contains(text, F.lit("Replication for tier")), F.lit(0.0))
        .otherwise(fraction)
    )
    after_dollar = F.substr(text, dollar)
    metered_usage = F.when(
        dollar > 0, F.regexp_extract(after_dollar, r"([\d.]+)\s+(\S+)", 1).try_cast("double")
    )
    storage = F.coalesce(group == "StorageLayer", F.lit(False))
    mark = F.when(storage, colon).otherwise(dollar)
    return F.struct(
        F.when(mark > 0, F.substr(text, F.lit(1), mark - 1)).otherwise(text).alias("description"),
        F.when(storage, storage_usage).otherwise(metered_usage).alias("usage"),
    )


def decoded_notes(text: Column) -> Column:
    """Percent-decoding that keeps ``+`` and stray percent signs; '' when there are no notes."""
    safe = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(safe, F.lit("+"), F.lit("%2B"))), F.lit(""))


# Common markup, stripped in this order: (pattern, replacement).
MARKUP = [
    (r"(?m)^```.*$", ""),
    (r"!\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"(?m)^ {0,3}#{1,6} +", ""),
    (r"(?m)^ {0,3}> ?", ""),
    (r"(?m)^ *[-*+] +", ""),
    (r"(?m)^ *[0-9]+\. +", ""),
    (r"\*\*([^\s*](?:.*?[^\s*])?)\*\*", "$1"),
    (r"__([^\s_](?:.*?[^\s_])?)__", "$1"),
    (r"\*([^\s*](?:.*?[^\s*])?)\*", "$1"),
    (r"(^|[ (])_([^\s_](?:.*?[^\s_])?)_($|[ ).,;:!?])", "$1$2$3"),
    (r"`([^`]*)`", "$1"),
]


def plain_notes(text: Column) -> Column:
    """Markdown notes as plain text."""
    for pattern, replacement in MARKUP:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def first_csv_column(line: Column) -> Column:
    return F.trim(F.split_part(F.trim(line), F.lit(","), F.lit(1)))


def fixed_width(value: Column, width: int) -> Column:
    """A cell cut or padded to its width; missing values are blank."""
    return F.rpad(F.substring(F.coalesce(value.cast("string"), F.lit("")), 1, width), width, " ")


def fixed_width_row(cells: list[tuple[str, int]], separator: str = " ") -> Column:
    return F.concat_ws(separator, *[fixed_width(F.col(name), width) for name, width in cells])


def name_before(text: Column, mark: str) -> Column:
    """Text before the first mark; the whole text if there is none."""
    return F.substring_index(text, mark, 1)


def name_after(text: Column, mark: str) -> Column:
    """Text after the first mark; the whole text if there is none."""
    return F.substr(text, F.instr(text, mark) + 1)


def region_of_zone(zone: Column) -> Column:
    return F.regexp_replace(zone, "-[^-]*$", "")
