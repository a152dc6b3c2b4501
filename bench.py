"""Benchmark the headline queries.

Runs each query end to end (plan construction, the checkpoints it takes,
and a full execution into the no-op sink) on ``local[$BENCH_CPUS]`` over
``$BENCH_SF_DIR`` and prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["records", "clean", "features", "feature_matrix", "rule_risk", "eval_metrics", "auc_ap",
            "roc_points", "bootstrap_f1", "stratified_split", "extract_join", "model_scores",
            "request_scores"]


def main() -> None:
    from upkeep.plans.catalog import QUERIES
    from upkeep.session import get_spark

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = get_spark(f"local[{cpus}]", int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2)), app_name="upkeep-bench",
                      extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM class loading and the parquet footer cache, not timed
    QUERIES["records"](spark, sf_dir).limit(1).collect()
    timings, rows, errors = {}, {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            df = QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
            if name in ("records", "model_scores", "request_scores"):
                rows[name] = df.count()
        except Exception as e:  # noqa: BLE001 - report and keep timing the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    out = {"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": _sf(sf_dir), "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    if "model_scores" in timings and rows.get("model_scores"):
        out["scored_rows"] = rows["model_scores"]
    if "request_scores" in timings and rows.get("request_scores"):
        # batch scoring with a fitted model: latest history join + encode + predict
        out["scoring_rows_per_sec"] = round(rows["request_scores"] / max(timings["request_scores"], 1e-9), 1)
    if "records" in timings and rows.get("records"):
        out["records_rows_per_sec"] = round(rows["records"] / max(timings["records"], 1e-9), 1)
    print(json.dumps(out))
    spark.stop()


def _sf(path: str):
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else None


if __name__ == "__main__":
    main()
