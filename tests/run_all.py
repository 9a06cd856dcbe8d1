"""Runs every registered query: python tests/run_all.py <sf dir> [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from candlewick.session import build_session  # noqa: E402
from compare import connect, difference  # noqa: E402


def main() -> None:
    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles, bad = entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = run(spark, sf)
            if name in oracles:
                outcome = difference(df, con, oracles[name]) or "ok"
            else:
                outcome = f"ok, {len(df.collect())} rows without SQL"
        except Exception as e:  # noqa: BLE001
            outcome = f"{type(e).__name__}: {str(e)[:600]}"
        if not outcome.startswith("ok"):
            bad.append(name)
        print(f"{name:28s} {time.time() - started:6.1f}s  {outcome}", flush=True)
    print(f"{len(bad)} bad: {' '.join(bad)}")
    spark.stop()


main()
