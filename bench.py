"""Times the headline queries and prints one JSON line. Reads BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from agorascope.plans.queries import REGISTRY  # noqa: E402
from agorascope.session import build_session  # noqa: E402

HEADLINE = [
    "json_roundtrip_parse",
    "clean_text",
    "window_volume_score",
    "window_volume_topic",
    "corpus_export",
    "contract_violations",
    "incremental_watermark",
    "interaction_edges",
    "weighted_degree",
    "modularity_of_partition",
    "top_degree_subgraph_nodes",
    "lexicon_sentiment",
    "mean_polarity",
    "classification_report",
    "stratified_split",
    "tfidf_top_terms",
    "stream_window_update",
    "stream_dedupe",
    "nmf_topics",
    "train_eval_classifier",
    "betweenness_sampled",
    "louvain_communities",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["clean_text"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds: dict[str, float] = {}
    for name in names:
        started = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
