"""Timing of the headline jobs: one JSON line on the last line of standard output.

Inputs that belong to a job's premise (a stored table, prepared vectors) are written
before the clock starts; each job is then run once to warm the JVM and twice for the
clock, with every result column computed. The better of the two counts.
"""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace

from pyspark.sql import functions as F

from recollect.operators import protect
from recollect.operators.approximate import with_signature
from recollect.operators.ingest import apply_delta, ingest_sessions, insert_memories
from recollect.operators.retention import live
from recollect.operators.search import search, top_k
from recollect.operators.transcript import segments, transcripts
from recollect.plans import inputs as i
from recollect.plans.protect import POLICY
from recollect.session import build_session, scratch_path

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def main() -> None:
    spark = build_session("bench", cores=CPUS, partitions=CPUS)
    spark.sparkContext.setLogLevel("ERROR")

    def stored(name: str, df):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    # small tables: as many embedding tasks as cores, where Spark would make one of all
    config = replace(i.CONFIG, embed_partitions=CPUS)
    events = stored("events", i.events(spark, SF_DIR))
    first = stored("first", ingest_sessions(events.filter("seq < 4"), i.CONFIG, i.at(i.FIRST)))
    table = i.new_table(spark, "bench")
    table.add_sessions(events, i.CONFIG, i.at(i.SECOND))
    sessions = table.read()
    questions = stored("questions", i.user_questions(spark, SF_DIR))
    memories = stored(
        "memories", with_signature(i.vector_memories(spark, SF_DIR).drop("signature"), i.CONFIG)
    )
    queries = stored("queries", with_signature(i.vector_queries(spark, SF_DIR), i.CONFIG))
    people = stored("people", i.customer_memories(spark, SF_DIR))
    key = i.session_key(spark)
    entries = i.entries(spark, SF_DIR)
    midway = F.lit("2024-03-01").cast("timestamp")

    jobs = {
        "transcripts": lambda: transcripts(segments(events)),
        "ingest_sessions": lambda: ingest_sessions(events, config, i.at(i.FIRST)),
        "apply_delta": lambda: apply_delta(events, config, i.at(i.SECOND), first),
        "insert_memories": lambda: insert_memories(
            entries, config, i.at(i.FIRST), entry_id=F.col("entry_id")
        ),
        "search_sessions": lambda: search(questions, sessions, config),
        "top_k_exact": lambda: top_k(queries, memories, config),
        "top_k_approximate": lambda: top_k(queries, memories, config, "approximate"),
        "purge": lambda: live(memories, 15 * 86_400, midway),
        "encrypt_fields": lambda: protect.encrypt_fields(people, POLICY, key),
    }

    times: dict[str, float] = {}
    for name, job in jobs.items():
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            job().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs[1:]), 3)

    def write_table() -> float:
        start = time.perf_counter()
        target = i.new_table(spark, "write")
        target.add_sessions(events.filter("seq < 4"), config, i.at(i.FIRST))
        target.add_events(events, config, i.at(i.SECOND))
        return time.perf_counter() - start

    times["table_ingest_and_delta"] = round(min(write_table() for _ in range(2)), 3)

    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
