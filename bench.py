"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {key: sec}, "sf", ...}.
Each query is fully computed into the no-op sink (nothing is collected to the driver):
one warm-up run, then the median of ``--runs`` timed runs.
"""

from __future__ import annotations

import argparse
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "nav_search", "A2_html_rows", "A3_json_rows", "A4_xml_rows", "A5_nested_rows", "A8_merge_following_rows",
    "A9_carry_header", "A15_flatten_documents", "A17_scan_keyvalue",
    "F1_re_replace", "F15_diacritics", "F16_validate", "F18_dateparse", "F22_fuzzytime",
    "N1_to_bytes", "N5_localised_months", "B8_remove_elements", "B10_field_chain",
    "Q9_keyword_rewrite", "Q10_filter_category", "Q14_andmatch", "O2_limit_top", "O4_top_per_group",
    "U2_dedupe_records", "W3_first_per_group",
    "C2_map_category_multi", "C10_caps_convert", "G6_source_profile",
    "L14_report_all", "L16_best_version", "G1_validation_summary",
    "M1_snapshot_diff", "M2_rename_detect", "M4_apply_changes", "M14_change_report", "M10_relocate_version",
]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default=os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    ap.add_argument("--runs", type=int, default=int(os.environ.get("BENCH_RUNS", "3")))
    ap.add_argument("--all", action="store_true", help="every registered query, not only the headline set")
    ap.add_argument("--event-log", default=os.environ.get("BENCH_EVENT_LOG"),
                    help="write Spark's event log here (scratch folder); jobs are tagged with the query key")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()

    from feedloom.plans import queries
    from feedloom.session import build_session

    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    extra = {"spark.feedloom.spreadPartitions": cpus, "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if a.event_log:  # task metrics per query: python tools/stage_times.py <dir>
        os.makedirs(a.event_log, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": a.event_log})
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(int(cpus) * 2)))
    spark = build_session(f"local[{cpus}]", app="feedloom-bench", shuffle_partitions=parts, extra=extra)
    qs = queries()
    keys = a.keys or (list(qs) if a.all else [k for k in HEADLINE if k in qs])
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for k in keys:
        spark.sparkContext.setJobDescription(k)
        try:
            qs[k](spark, a.sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            runs = []
            for _ in range(a.runs):
                t0 = time.perf_counter()
                qs[k](spark, a.sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[k] = round(statistics.median(runs), 4)
        except Exception as e:  # noqa: BLE001 - report, keep going
            errors[k] = str(e)[:300]
    m = re.search(r"sf([0-9.]+)", a.sf_dir)
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 4), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else a.sf_dir, "cpus": int(cpus),
           "runs": a.runs, "n_queries": len(times)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
