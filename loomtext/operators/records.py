"""The record: one text with its provenance; all other columns of a source are kept beside the core ones."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

HUMAN_LABELS = ("human_translation",)
MACHINE_LABELS = ("machine_translation", "machine_assisted")
OPTIONAL = ("publication_date", "text_version_date", "source_text", "source_language", "engine", "version_evidence")


def records(rows: DataFrame, dataset: str, key: Column, text: Column, label: Column | str, group: Column, **extra: Column) -> DataFrame:
    """Rows as records; an empty text fails the job, since gates come before."""
    label = F.lit(label) if isinstance(label, str) else label
    body = F.when(t.is_blank(text), F.raise_error(F.concat(F.lit(f"Empty text: {dataset}/"), key.cast("string"))).cast("string")).otherwise(text)
    columns = {
        "id": F.concat(F.lit(f"{dataset}/"), key.cast("string")),
        "dataset": F.lit(dataset),
        "authorship": label,
        "document_group": F.concat(F.lit(f"{dataset}/"), group.cast("string")),
        "language": F.lit("en"),
        **{name: F.lit(None).cast("string") for name in OPTIONAL},
        **extra,
    }
    made = rows.select(body.alias("text"), *[c.alias(n) for n, c in columns.items()])
    return made.withColumns({"text_sha256": t.text_hash(F.col("text")), "whitespace_words": t.word_count(F.col("text"))})


def binary_label(authorship: Column) -> Column:
    """0 human, 1 machine, null for what isn't documented."""
    return F.when(authorship.isin(*HUMAN_LABELS), 0).when(authorship.isin(*MACHINE_LABELS), 1)


def plain_name(name: str) -> str:
    if name in ("", ".", "..") or "/" in name or "\\" in name:
        raise ValueError(f"not a plain file name: {name!r}")
    return name


def parse_mapping(items: list[str], allowed: set[str]) -> dict[str, str]:
    """name=value pairs, each name allowed and once."""
    found: dict[str, str] = {}
    for item in items:
        name, sign, value = item.partition("=")
        if not sign or name not in allowed or name in found:
            raise ValueError(f"unknown or repeated name: {item!r}")
        found[name] = value
    return found


def iso_date(value: str) -> str:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        raise ValueError(f"not an ISO date: {value!r}")
    return value
