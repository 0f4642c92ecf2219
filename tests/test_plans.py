"""Plan guard: no registered query evaluates Python per row or per batch."""

import re

from depot import registry

SF = "/root/testdata/sf0.001"
# these run a stream or write files when called; their plans read written output
SKIP = {"stream_order_pipeline", "stream_dense_ids", "reload_streamed", "stream_milestones",
        "stream_progress_counts", "scan_catalog_csv", "scan_postal_tsv", "sink_csv", "sink_parquet",
        "append_parts", "compact_parts", "bulk_load_tables", "preview_tables"}


def test_no_python_in_plans(spark):
    bad = []
    for key, fn in registry.queries().items():
        if key in SKIP:
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        if re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF", plan):
            bad.append(key)
    assert bad == []
