"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.  Every result
is computed in full and sent to Spark's no-op sink.  The derived input tables
and the model fits are timed as entries of their own, not hidden in the first
query that needs them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from qirtas.plans.queries import QUERIES, prepare
from qirtas.session import local_session

HEADLINE = [
    "unpivot_sources",
    "null_profile",
    "length_stats",
    "source_counts",
    "clean_text",
    "remove_stopwords",
    "stem_vocab",
    "clean_text_stemmed",
    "stream_clean",
    "ttr_by_label",
    "clean_stats",
    "avg_words",
    "word_count_top",
    "bigram_top",
    "features",
    "feature_means",
    "tfidf_terms",
    "hashed_tf",
    "label_index",
    "split_counts",
    "rule_classify",
    "class_metrics",
    "auc",
    "confusion",
    "encode_all_messages",
    "decode_messages",
    "stream_score",
    "tfidf_vectors",
    "assemble",
    "lr_predictions",
    "rf_predictions",
    "svm_predictions",
    "mlp_predictions",
    "model_comparison",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4)), "bench")
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}

    def timed(name: str, work) -> None:
        """A step that fails is named with its error; the others keep their figures."""
        start = time.perf_counter()
        try:
            work()
        except Exception as error:  # noqa: BLE001
            failed[name] = f"{type(error).__name__}: {error}"[:300]
        else:
            seconds[name] = round(time.perf_counter() - start, 3)

    timed("prepare_inputs", lambda: prepare(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": f"total seconds of {len(seconds)} steps, four model fits included",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "failed": failed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
