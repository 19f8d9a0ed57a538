"""Queries whose tables had been cut: they see all rows."""

import duckdb
from check import compare

import __spark_entry__ as e


def _checked(spark, tmp_path, name, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert compare(name, e.queries()[name](spark, str(tmp_path)), con, e.oracle_sql()[name]) is None
    return e.queries()[name](spark, str(tmp_path)).collect()


def test_line_files_run_through_the_whole_table(spark, tmp_path):
    # the same user text in conversations that lie far apart
    rows = spark.range(0, 4000, 4).selectExpr("id AS conv_id", "1 AS turn", "'user' AS role", "'the very same request' AS text")
    rows.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = _checked(spark, tmp_path, "duplicate_users", "conversations")
    assert {r.file for r in got} == {"part-0"} and len({r.first_line for r in got}) <= 2
    assert len(got) > 500  # in files of twenty conversations: a few in each
    errors = _checked(spark, tmp_path, "validation_errors", "conversations")
    assert sum(r.code == "duplicate_user" for r in errors) == len(got)
    numbered = _checked(spark, tmp_path, "numbered_lines", "conversations")
    assert {r.file for r in numbered} == {"part-0"} and max(r.line_no for r in numbered) > 900


def test_active_learning_asks_every_request(spark, tmp_path):
    events = spark.range(5, 43 * 400, 43).selectExpr(
        "id AS event_id", "timestamp'2024-01-01 00:00:00' AS ts", "id % 50 AS user_id", "'other' AS event_type", "1.0D AS value", "concat('{\"k\": ', id % 33 * 3, '}') AS props"
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = _checked(spark, tmp_path, "active_learning", "events")
    assert got and {r.request_id % 43 for r in got} == {5}
