"""Times ``section_balance`` on copies of the given orders and lines, plain and with a hot order.

python bench_growth.py [COPIES ...]    copies of the tables in BENCH_SF_DIR (default 1 20)

Every copy shifts the order keys, so journal lines and entries both grow. "Hot" moves a third
of all lines to one live order. Prints one JSON line for each run: lines, layout, the large join
of the final plan, and the best of three times. BENCH_CPUS as in bench.py; the copies are
written to a new temporary folder.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from tallybook.operators import build_section_balance
from tallybook.session import cluster_settings, local_session
from tallybook.sources import ledger_from_orders


def _copy(spark, source: str, path: str, copies: int, hot: bool) -> int:
    orders = spark.read.parquet(f"{source}/orders.parquet")
    lines = spark.read.parquet(f"{source}/lineitem.parquet")
    step = orders.selectExpr("max(o_orderkey) + 1").first()[0]
    live = orders.where("o_orderpriority <> '5-LOW'").selectExpr("min(o_orderkey)").first()[0]
    turns = spark.range(copies).withColumnRenamed("id", "turn")
    for name, df, key in (("orders", orders, "o_orderkey"), ("lineitem", lines, "l_orderkey")):
        shifted = f"{key} + turn * {step}"
        if hot and name == "lineitem":
            shifted = f"IF((l_partkey + l_linenumber) % 3 = 0, {live}, {shifted})"
        kept = [column for column in df.columns if column != key]
        (
            df.hint("broadcast").join(turns, how="cross").repartition(8 * max(1, copies // 4))
            .selectExpr(f"{shifted} AS {key}", *kept)
            .write.parquet(f"{path}/{name}.parquet")
        )
    spark.read.parquet(f"{source}/supplier.parquet").write.parquet(f"{path}/supplier.parquet")
    return spark.read.parquet(f"{path}/lineitem.parquet").count()


def _timed(spark, path: str) -> tuple[float, str]:
    start = time.perf_counter()
    df = build_section_balance(ledger_from_orders(spark, path))
    df.collect()
    seconds = time.perf_counter() - start
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joins = re.findall(r"(\w+Join)(\(skew=true\))? \[journal_entry_id", plan)
    return seconds, "".join(joins[0]) if joins else "?"


def main(copies: list[int]) -> None:
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    for name, value in cluster_settings(0).items():
        spark.conf.set(name, value)
    root = tempfile.mkdtemp(prefix="growth-")
    for n in copies:
        spark.conf.set("spark.sql.shuffle.partitions", str(min(8 * max(1, n // 10), 64)))
        for hot in (False, True):
            path = f"{root}/{n}-{hot}"
            lines = _copy(spark, source, path, n, hot)
            runs = [_timed(spark, path) for _ in range(3)]
            print(
                json.dumps(
                    {
                        "lines": lines,
                        "layout": "hot" if hot else "plain",
                        "join": runs[-1][1],
                        "seconds": round(min(seconds for seconds, _ in runs), 2),
                    }
                ),
                flush=True,
            )
    spark.stop()


if __name__ == "__main__":
    main([int(x) for x in sys.argv[1:]] or [1, 20])
