"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from clonarium.session import clear_scratch, local_session
from testdata_queries import QUERIES

HEADLINE = [
    "tree_label_mutations",
    "tree_cumulative",
    "tree_cumulative_chain",
    "point_in_segment",
    "segment_gene_overlap",
    "band_list_per_gene",
    "liftover_positions",
    "variant_dedup",
    "mutation_score_join",
    "mutation_rollups",
    "melt_matrix",
    "expression_pair",
    "id_apply_convention",
    "scan_delimited",
    "scan_per_entity_union",
    "ragged_melt",
    "contract_report_scores",
    "named_filters",
]


def run(name: str, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="clonarium-bench-")  # one machine: driver and executors share it
    spark = local_session(scratch, cpus, "clonarium-bench")
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    run("scan_parquet", spark, sf_dir)  # starts the JVM side
    names = sys.argv[1:] or HEADLINE
    seconds = {name: round(run(name, spark, sf_dir), 3) for name in names}
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
