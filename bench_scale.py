"""Write a larger copy of the given tables, for bench.py and bench_pandas.py: ``python bench_scale.py FROM TO COPIES``.

Events, orders and line items are repeated with shifted ids and users, so that series, trips and counts grow in number; the other
tables are copied. Every month keeps its share of the rows.
"""

from __future__ import annotations

import os
import shutil
import sys

from demandgrid import build_session
from pyspark.sql import functions as F

SHIFTED = {"events": ("event_id", "user_id"), "orders": ("o_orderkey",), "lineitem": ("l_orderkey",)}
TABLES = ("region", "nation", "customer", "supplier", "part")


def main(source: str, target: str, copies: int) -> None:
    spark = build_session("scale", "local[8]", spark__ui__enabled="false", spark__driver__memory="16g")
    os.makedirs(target)
    for name, ids in SHIFTED.items():
        df = spark.read.parquet(f"{source}/{name}.parquet")
        key = "o_orderkey" if name != "events" else None
        steps = {c: spark.read.parquet(f"{source}/orders.parquet").agg(F.max(key)).first()[0] if key else df.agg(F.max(c)).first()[0] for c in ids}
        many = df.crossJoin(F.broadcast(spark.range(copies).select(F.col("id").alias("copy"))))
        shifted = {c: (F.col(c) + F.col("copy") * (step + 1)).cast(dict(df.dtypes)[c]) for c, step in steps.items()}
        many.withColumns(shifted).drop("copy").write.parquet(f"{target}/{name}.parquet")
    for name in TABLES:
        shutil.copy(f"{source}/{name}.parquet", f"{target}/{name}.parquet")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]))
