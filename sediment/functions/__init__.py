"""Named column transforms. Everything here is a built-in expression; nothing is a Python UDF."""

from sediment.functions.registry import lookup, register, registered
from sediment.functions import protect, text  # noqa: F401  (fills the registry)

__all__ = ["lookup", "register", "registered"]
