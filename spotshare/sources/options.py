"""Checks of reader and writer options."""

from __future__ import annotations

from collections.abc import Mapping


def exactly_one(options: Mapping[str, str], first: str, second: str) -> str:
    """Name of the one option that is given."""
    given = [name for name in (first, second) if options.get(name) is not None]
    if len(given) == 2:
        raise ValueError(f"only one of '{first}' and '{second}' may be specified")
    if not given:
        raise ValueError(f"either '{first}' or '{second}' has to be specified")
    return given[0]


def flag(options: Mapping[str, str], name: str, default: str = "false") -> bool:
    value = options.get(name, default)
    if value not in ("true", "false"):
        raise ValueError(f"'{name}' flag can only be true or false")
    return value == "true"


def integer(options: Mapping[str, str], name: str, default: int | None = None) -> int | None:
    value = options.get(name)
    if value is None:
        return default
    try:
        return int(value)
    except ValueError:
        raise ValueError(f"{name} must be a valid integer") from None


def required(options: Mapping[str, str], name: str, purpose: str) -> str:
    value = options.get(name)
    if not value:
        raise ValueError(f"{name} must not be empty {purpose}")
    return value


def names(options: Mapping[str, str], name: str) -> list[str]:
    return [part.strip() for part in options.get(name, "").split(",") if part.strip()]
