"""Pipeline queries next to their SQL. Usage: python tests/llm/oracle.py [sf] [name-prefix ...]"""

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from dataclasses import dataclass  # noqa: E402
from collections.abc import Callable  # noqa: E402

import oracle as base  # noqa: E402


@dataclass
class Query:
    run: Callable
    sql: str | None


def main() -> None:
    from candor.llm.queries import QUERIES
    from candor.session import local_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    spark = local_session(8)
    connection = base.connect(folder)
    for name, (run, sql) in QUERIES.items():
        if name.startswith(tuple(sys.argv[2:]) or ("",)):
            message, spent, other, rows = base.compare(spark, connection, name, Query(run, sql), folder)
            print(f"{'ok  ' if message is None else 'FAIL'} {name} rows={rows} spark={spent:.2f}s sql={other:.2f}s {message or ''}", flush=True)


if __name__ == "__main__":
    main()
