"""Plan checks: Spark-native plans, no hot key moved whole.

* No Python node but in the named queries (user hooks, vocabulary lookup, ``%e`` text).
* An exchange keyed by ``run_id`` alone (one run -> one task) only ever moves
  pre-aggregated rows: a partial aggregate, a per-chunk summary or a partial
  top-N (``WindowGroupLimit``).
* A single-partition exchange only moves bounded tables (aggregates or a
  bounded top-k).

The run-plan queries (hardware lookup, plan, names, paths, hand-off) join
per-run dimension tables - one row per run and phase, at most N kept
checkpoints per run - so a run key cannot be hot there; they are checked
for Python nodes and single-partition exchanges only.
"""

import re

import pytest

from tessera.queries import QUERIES
from tests.conftest import SF_SMALL

# user hooks; the map-only vocabulary lookup; exact %e text
ARROW = {"map_batches_format", "encode_with_hook", "encode_truncate", "add_special_tokens", "attention_mask", "causal_labels",
         "write_corpus", "write_corpus_sft", "drop_source_columns", "format_lr", "run_name", "checkpoint_path", "phase_handoff"}
NATIVE = [n for n in QUERIES if not n.startswith("stream_") and n not in ARROW]
# the log joins a table of one row per run: AQE broadcasts it or splits a hot run's partition
ADAPTIVE_JOINS = {"events_until_stop", "generalization_gap_planned", "best_n_by_gap_planned", "early_stop_planned"}
PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF",
                "FlatMapGroupsInPandasWithState")
PER_RUN_TABLES = {"hardware_lookup", "run_plan", "run_name", "checkpoint_path", "phase_handoff", "phase_orphans"}
PRE_AGGREGATED = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit",
                  "TakeOrderedAndProject")


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_native_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not any(p in plan for p in PYTHON_NODES), name
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        hot = re.search(r"Exchange hashpartitioning\(run_id#\d+L?, \d+\)", line) and name not in PER_RUN_TABLES
        single = "Exchange SinglePartition" in line
        if (hot or single) and "ReusedExchange" not in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            if hot and name in ADAPTIVE_JOINS and "ENSURE_REQUIREMENTS" in line:
                continue
            assert any(k in child for k in PRE_AGGREGATED), f"{name}: {line.strip()} <- {child.strip()}"
