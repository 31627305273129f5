"""Compare registered queries with their SQL: python tests/check_oracles.py [sf_dir] [names...]"""

import sys
import time
import traceback

sys.path[:0] = ["/root/repo", "/root/repo/tests"]

import __spark_entry__ as entry_points  # noqa: E402
from oracle import compare, connect  # noqa: E402
from tidemark.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, sqls = entry_points.queries(), entry_points.oracle_sql()
    names = [n for n in queries if not sys.argv[2:] or any(n.startswith(a) for a in sys.argv[2:])]
    spark, con = local_session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
            else:
                n = df.count()
                problem = None if n else "no rows"
                name += f" (rows only: {n})"
        except Exception as error:
            problem = "".join(traceback.format_exception(error))[-1500:]
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} fine")
