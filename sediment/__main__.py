"""``python -m sediment <layer.table> <sql> <format> <path>``: process one table."""

from __future__ import annotations

import sys

from sediment.plans.layers import process_table
from sediment.session import build_session


def main(arguments: list[str]) -> int:
    if len(arguments) != 4:
        print("usage: python -m sediment <layer.table> <sql> <format> <path>", file=sys.stderr)
        return 1
    table, transformation, fmt, path = arguments
    process_table(build_session(f"sediment {table}"), table, transformation or None, path, fmt)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
