"""Run registered queries against their SQL twins: python tests/check_queries.py [sf_dir] [name ...]"""

import sys

sys.path[:0] = ["/root/repo", "/root/repo/tests"]

from compare import compare, connect
from conftest import make_session

import __spark_entry__ as entry


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    spark, con, failed = make_session(), connect(sf_dir), []
    for n in names:
        try:
            ok, msg = compare(queries[n], oracles.get(n), spark, sf_dir, con)
        except Exception as e:  # report and go on with the next query
            ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
        print("ok  " if ok else "FAIL", n, msg, flush=True)
        if not ok:
            failed.append(n)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")


if __name__ == "__main__":
    main()
