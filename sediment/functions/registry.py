"""``name -> function returning a Column``: how specs refer to transforms, and how users add theirs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column

from sediment.config import SpecError

_TRANSFORMS: dict[str, Callable[..., Column]] = {}


def register(name: str) -> Callable[[Callable[..., Column]], Callable[..., Column]]:
    def add(function: Callable[..., Column]) -> Callable[..., Column]:
        _TRANSFORMS[name] = function
        return function

    return add


def lookup(name: str) -> Callable[..., Column]:
    try:
        return _TRANSFORMS[name]
    except KeyError:
        raise SpecError(f"unknown transform {name!r}; known: {', '.join(registered())}") from None


def registered() -> list[str]:
    return sorted(_TRANSFORMS)
