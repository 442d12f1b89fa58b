"""Check queries by hand: python tests/run_checks.py [folder] [name prefix ...]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, connect  # noqa: E402

from marketlake.session import get_session  # noqa: E402
from marketlake.verification import QUERIES  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    prefixes = tuple(sys.argv[2:])
    spark = get_session("checks", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            r = compare(spark, con, name, sf_dir)
        except Exception as e:  # a broken query must not end the run
            r = {"name": name, "ok": False, "rows": 0, "seconds": 0, "note": str(e)[:1500] if os.environ.get("SHORT") is None else str(e)[:300]}
        print(("ok  " if r["ok"] else "FAIL"), r["name"], r["rows"], r["seconds"], r["note"], flush=True)
        if not r["ok"]:
            failed.append(r["name"])
    print(len(failed), "failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
