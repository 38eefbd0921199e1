"""Checks on caller-supplied arguments."""

from __future__ import annotations

# Rows that a response-shaped report may be asked for.
API_ROWS = 1000


class _Every:
    """Instead of a limit: all rows, with their ``position`` in the order that the limit would cut."""


EVERY = _Every()


def check_limit(limit: int | _Every, most: int | None = None) -> int | _Every:
    """A row limit must be a whole number from 1, to ``most`` if that is given."""
    if limit is EVERY:
        return limit
    if not isinstance(limit, int) or limit < 1:
        raise ValueError(f"limit must be a whole number from 1, got {limit!r}")
    if most is not None and limit > most:
        raise ValueError(f"limit must be between 1 and {most}, got {limit!r}")
    return limit
