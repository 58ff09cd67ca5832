"""Compare every registered query with its check: ``check_all.py SF_DIR [name …]``."""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tests.oracle import connect, differences  # noqa: E402
from tidyspark.queries import QUERIES  # noqa: E402
from tidyspark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="10g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in chosen or QUERIES:
        start = time.time()
        try:
            found = differences(spark, sf_dir, name, connection)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        for line in found:
            print("     ", line[:1800], flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
