"""Sessions of a log in which one user holds a third of the rows, against one global window.

Writes ``HOT_ROWS`` rows (default 10 million) to a scratch folder, runs the sessions as they are
and as SQL whose windows hold a whole user, or in compat the whole log, and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from pyspark.sql import functions as F

from studytrail.operators import sessions as S
from studytrail.runtime import build_session

SQL = {
    "clean": """with s as (select *, sum(case when at=1 then 1 else 0 end)
  over (partition by uid, cid order by ct, id rows unbounded preceding) as sid from rows)
 select uid, cid, sid, min(ct) as minct, max(ct) as maxct from s where sid>0 group by uid, cid, sid""",
    "compat": """with n as (select *, row_number() over (order by uid, cid, ct, id) as n,
  lead(at) over (order by uid, cid, ct, id) as nxt from rows),
 t as (select *, case when at=1 then n else lag(n) over (order by n) end as tag from n where at=1 or nxt=1)
 select uid, cid, tag, min(ct) as minct, max(ct) as maxct from t group by uid, cid, tag""",
}


def main() -> None:
    rows = int(os.environ.get("HOT_ROWS", "10000000"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "studytrail-hot",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(4 * int(cpus)),
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    i = F.col("id")
    log = spark.range(rows).select(
        "id",
        F.when(i % 3 == 0, 1).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("uid"),
        (i % 3).alias("cid"),
        F.lit(1).cast("bigint").alias("appid"),
        (i % 19).alias("sn"),
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) == 0, 1).otherwise(0).alias("at"),
        F.timestamp_seconds(i).cast("timestamp_ntz").alias("ct"),
    )
    with tempfile.TemporaryDirectory(prefix="studytrail-hot-") as folder:
        log.write.parquet(f"{folder}/log")
        log = spark.read.parquet(f"{folder}/log")
        beats = log.select("uid", "cid", "ct").limit(0)
        log.createOrReplaceTempView("rows")
        seconds = {}
        for mode, sql in SQL.items():
            for name, make in ((f"{mode}_sliced", lambda m=mode: S.sessionize(log, beats, S.COURSE, m)),
                               (f"{mode}_window", lambda q=sql: spark.sql(q))):
                start = time.perf_counter()
                make().write.format("noop").mode("overwrite").save()
                seconds[name] = round(time.perf_counter() - start, 1)
    spark.stop()
    print(json.dumps({"metric": "hot_user_sessions", "rows": rows, "unit": "sec", "queries": seconds}))


if __name__ == "__main__":
    main()
