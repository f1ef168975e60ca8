"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS].  Each query is fully executed through the ``noop``
sink (no collect).  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textloom.plans import QUERIES  # noqa: E402
from textloom.session import get_spark  # noqa: E402

HEADLINE = ["dedup_status", "dedup_report", "paragraph_dedup", "clean_wikitext_injected",
            "pretoken_counts", "token_audit", "pack_blocks", "seeded_shuffle_split",
            "stanzas", "poem_html_clean", "prompt_assembly", "bpe_merges",
            # the same jobs over the published vocabulary
            "token_audit_bpe", "pack_blocks_bpe"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      spark__textloom__scanPartitions=cpus)  # each table is one row group
    n_docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    # warm-up: JVM, Python workers, file listing
    QUERIES["nfc_doc_hash"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus),
                      "documents": n_docs,
                      "dedup_docs_per_sec": round(n_docs / times["dedup_status"], 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
