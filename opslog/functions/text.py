"""Field helpers for log lines: all built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a port label looks like.
PORT_WORD = "Port"
GIGABIT_PREFIX = "GigabitEthernet1"


def unwrap(text: Column, opener: str) -> Column:
    """Drop the first and last character where the text starts with ``opener``."""
    return F.when(
        text.startswith(opener), F.substring(text, F.lit(2), F.length(text) - 2)
    ).otherwise(text)


def drop_lead(text: Column, lead: str) -> Column:
    return F.when(text.startswith(lead), F.substring(text, F.lit(2), F.length(text))).otherwise(text)


def client_mark(text: Column) -> Column:
    """A client id without its ``#`` mark and braces."""
    return unwrap(drop_lead(text, "#"), "{")


def part(text: Column, sep: str, index: int) -> Column:
    """Trimmed ``index``-th part, null where there are fewer (``sep`` is a pattern)."""
    return F.trim(F.get(F.split(text, sep), F.lit(index)))


def after_colon(text: Column) -> Column:
    """``name:8080`` -> ``8080``; a text without a colon after its first character stays."""
    return F.when(F.instr(text, ":") > 1, part(text, ":", 1)).otherwise(text)


def looks_like_mac(text: Column) -> Column:
    return (F.instr(text, ":") > 1) & (F.length(text) == 17)


def port_number(label: Column) -> Column:
    """Port number of an interface label, -1 where the label names no port."""
    by_word = F.get(F.split(F.get(F.split(label, PORT_WORD), F.lit(1)), " "), F.lit(1))
    by_slot = F.get(F.split(label, "_"), F.lit(2))
    return (
        F.when(label.contains(PORT_WORD), by_word.try_cast("int"))
        .when(label.contains(GIGABIT_PREFIX), by_slot.try_cast("int"))
        .otherwise(F.lit(-1))
    )


def pair_value(values: Column, index: int) -> Column:
    """One number of an ``rx,tx`` text."""
    return F.get(F.split(values, ","), F.lit(index)).try_cast("bigint")
