"""Time the headline queries and print one JSON line.

Each query writes its whole result to the no-op sink, so every row and column is
computed. One untimed pass of a tiny query warms the session up.
"""

from __future__ import annotations

import json
import os
import time

from cohortloom.queries import QUERIES
from cohortloom.session import local_session

HEADLINE = [
    "q_v1", "q_v2", "q_v3", "q_v3b", "q_v4", "q_v5", "q_c2", "q_c6", "q_c8", "q_e1", "q_e2", "q_e5",
    "q_s1", "q_d_reject", "q_k1", "q_k4", "q_h1", "q_h9", "q_h14", "q_h15", "q_g1", "q_g2", "q_g3", "q_g4",
    "q_i4", "q_i5", "q_p1", "q_p4", "q_p6",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    QUERIES["q_d1"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        if name in QUERIES:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
