"""Every registered query against its DuckDB SQL, and the entry module's contract."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = {k: v for k, v in entry.oracle_sql().items() if not k.startswith("op") and k != "pipeline"}


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


def cell(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return ""
    return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(cell(v[k]) for k in order) for v in values)


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    found = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(found.columns, found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_python_in_relational_plans(spark, data):
    for name in ("dnsmos_filter_quantile", "vad_gap_merge", "norm_text", "parse_spk_id", "merge_asr_shards"):
        plan = entry.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "MapIn" not in plan, name


def test_no_wide_rows_are_sorted_or_fetched(spark, data):
    for name in ("merge_scores_in_order", "merge_asr_shards", "resume_union", "lid_probe_longest", "lid_gate_first_segment", "char_vocab", "seeded_split"):
        plan = entry.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "TakeOrdered" not in plan, name


def one_pass(spark, data, name):
    """Whether the tables to merge are read once each, lie together by recording and are neither shuffled again by segment nor joined."""
    plan = entry.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan") == plan.count("Exchange hashpartitioning(audio_id") == 2 and "Join" not in plan and "seg_id#" not in "".join(x for x in plan.split("\n") if "ENSURE_REQ" in x)


def test_scores_are_merged_in_one_pass(spark, data):
    assert one_pass(spark, data, "merge_scores_in_order")


def test_scores_are_counted_in_one_pass(spark, data):
    assert one_pass(spark, data, "merge_score_counts")


def test_transcripts_are_merged_in_one_pass(spark, data):
    assert one_pass(spark, data, "merge_asr_shards")


def test_pushdown(spark, data):
    plan = entry.queries()["lid_probe_longest"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.split("ReadSchema")[1].split("\n")[0]
