"""Run every registered query against its oracle: python tests/check_all.py <folder> [names]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from listmill.session import local_session  # noqa: E402
from tests.compare import mismatch  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    failed = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            sql = oracle_sql().get(name)
            if sql is None:
                found = None if query(spark, sf_dir).count() else "no rows"
            else:
                found = mismatch(query(spark, sf_dir), sql, sf_dir)
        except Exception as error:  # report all queries, also after a failure
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{name:24} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    sys.exit(failed > 0)
