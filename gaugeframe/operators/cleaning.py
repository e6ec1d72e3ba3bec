"""Cleaning of raw tables into typed staging tables (CL9-CL13).

A table is described by one row per output column: its name and how it is cleaned. The
description becomes a single `select`, so Catalyst prunes the columns a later step does not
read, together with the work of cleaning them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.config import Vocabulary
from gaugeframe.functions.text import canonicalise, clean_lower, clean_text, strip_spaces
from gaugeframe.functions.timestamps import parse_timestamp

Cleaner = Callable[[Column, Vocabulary], Column]


def _text(c: Column, _: Vocabulary) -> Column:
    return clean_text(c)


def _lower(c: Column, _: Vocabulary) -> Column:
    return clean_lower(c)


def _timestamp(c: Column, _: Vocabulary) -> Column:
    return parse_timestamp(c)


def _state(c: Column, words: Vocabulary) -> Column:
    """CL4: unknown states are upper-cased."""
    return canonicalise(c, words.states, F.upper(strip_spaces(c)))


def _grade(c: Column, words: Vocabulary) -> Column:
    """CL5"""
    return canonicalise(c, words.grades, strip_spaces(c))


def _district(c: Column, words: Vocabulary) -> Column:
    """CL6"""
    return canonicalise(c, words.districts, strip_spaces(c))


TABLES: Mapping[str, Mapping[str, Cleaner]] = {
    "districts": {"district_id": _text, "district_name": _district, "state": _state},
    "users": {
        "user_id": _text, "email": _lower, "org_id": _text, "role": _lower,
        "state": _state, "district_id": _text,
    },
    "resources": {
        "resource_id": _text, "type": _lower, "subject": _text, "grade_band": _grade,
    },
    "events": {
        "event_id": _text, "user_id": _text, "resource_id": _text, "event_type": _lower,
        "event_ts": _timestamp,
    },
    "newsletter": {
        "email": _lower, "subscribed_at": _timestamp, "opened_at": _timestamp,
        "clicked_at": _timestamp,
    },
}


def clean_table(
    raw: DataFrame,
    name: str,
    words: Vocabulary,
    tables: Mapping[str, Mapping[str, Cleaner]] = TABLES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One cleaned table; columns in `keep` pass through unchanged."""
    cleaned = [
        cleaner(F.col(column), words).alias(column) for column, cleaner in tables[name].items()
    ]
    return raw.select(*keep, *cleaned)


def clean_all(
    raw: Mapping[str, DataFrame],
    words: Vocabulary,
    tables: Mapping[str, Mapping[str, Cleaner]] = TABLES,
) -> dict[str, DataFrame]:
    return {name: clean_table(raw[name], name, words, tables) for name in tables if name in raw}
