"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import re
import sys
import time

from rowtide.plans import registry
from rowtide.session import session

HEADLINES = [
    "feed_changes", "tx_chunks", "rule_fanout", "json_payload", "kv_commands",
    "kv_string_state", "kv_string_moved_keys", "kv_hash_state", "kv_set_state", "kv_zset_state",
    "kv_shared_hash", "kv_member_table", "kv_snapshot_hash",
    "messages_json_event", "messages_json_rows", "messages_row_split", "messages_topic", "messages_xml",
    "rule_violations", "message_routes", "translate_position", "sink_kv",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = session("rowtide-bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries = registry.queries()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before the clock
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf.group(1)) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
