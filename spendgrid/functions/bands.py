"""Threshold tables as columns."""

from pyspark.sql import functions as F


def at_least(x, table):
    """Label of the first entry whose limit is <= x; a NULL x gets the last label."""
    label = F.lit(table[-1][1])
    for limit, name in reversed(table[:-1]):
        label = F.when(x >= limit, name).otherwise(label)
    return label


def above(x, table):
    """Label of the first entry whose limit is < x; a NULL x gets the last label."""
    label = F.lit(table[-1][1])
    for limit, name in reversed(table[:-1]):
        label = F.when(x > limit, name).otherwise(label)
    return label


def lookup_text(key, texts, default=None):
    """Value for a key out of a short dict."""
    value = F.lit(default)
    for name, text in texts.items():
        value = F.when(key == name, text).otherwise(value)
    return value


def position_in(key, names):
    """1-based position of a name in a list, one past the end for any other value."""
    position = F.lit(len(names) + 1)
    for i, name in enumerate(names):
        position = F.when(key == name, F.lit(i + 1)).otherwise(position)
    return position
