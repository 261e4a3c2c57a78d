"""Every registered query of the market library against its SQL."""

import pytest

from tickspark import plans

SLOW = {"symbol_drift_auc"}


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_equals_sql(name, same):
    same(plans.QUERIES[name], plans.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES) - SLOW))
def test_query_without_sql_runs(name, spark, sf):
    assert plans.QUERIES[name](spark, sf).count() > 0


CALENDAR = ["sessions", "session_grid", "holiday_flags", "session_state", "tick_coverage", "trade_gaps", "missing_bars", "interior_gaps", "session_qualification", "recovery_coverage"]


@pytest.fixture(scope="module", params=[("2024-03-01", 60), ("2024-07-01", 175), ("2024-11-20", 320)], ids=lambda x: x[0])
def moved(request, tmp_path_factory):
    """The events moved by some days: over a change of clocks, Independence Day and its early eve, Thanksgiving and the day after."""
    import duckdb

    from tests.conftest import SF

    folder, con = str(tmp_path_factory.mktemp("moved")), duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"COPY (SELECT * REPLACE (ts + INTERVAL {request.param[1]} DAY AS ts) FROM read_parquet('{SF}/events.parquet')) TO '{folder}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    return folder, con


@pytest.mark.parametrize("name", CALENDAR)
def test_calendar_queries_in_other_months(name, moved, spark):
    from tests.conftest import compare

    folder, con = moved
    compare(spark, con, plans.QUERIES[name], plans.ORACLES[name], folder)


def stored(folder, rows: str):
    """Events as ``rows`` gives them from the sample's, as a folder and a connection that has them."""
    import duckdb

    from tests.conftest import SF

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"COPY ({rows.format(events=f"read_parquet('{SF}/events.parquet')")}) TO '{folder}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    return str(folder), con


#: A session's half hours of one symbol with three trades each, the middle one or a volume faulty; two trades of one instant; a time that is null.
FAULTS = """SELECT * FROM {events} WHERE ts >= TIMESTAMP '2024-01-18' UNION ALL BY NAME
SELECT 10000000 + 3 * b + k AS event_id, TIMESTAMP '2024-01-17 14:30:00' + b * INTERVAL 30 MINUTE + k * INTERVAL 5 MINUTE AS ts, 1 AS user_id, 'view' AS event_type,
  CASE WHEN k <> 1 THEN 5.0 WHEN b = 1 THEN 0.0 WHEN b = 2 THEN -1.0 WHEN b = 3 THEN 'inf'::DOUBLE WHEN b = 4 THEN '-inf'::DOUBLE WHEN b = 5 THEN 'nan'::DOUBLE WHEN b = 6 THEN NULL ELSE 5.0 END AS value,
  CASE WHEN b = 7 THEN '{{"k": 0}}' WHEN b = 8 THEN NULL ELSE '{{"k": 3}}' END AS props FROM range(13) r(b), range(3) s(k) UNION ALL BY NAME
SELECT 20000002 + 3 * b - k AS event_id, TIMESTAMP '2024-01-17 14:30:00' + b * INTERVAL 30 MINUTE AS ts, 1 AS user_id, 'click' AS event_type, CASE WHEN k <> b % 3 THEN 5.0 END AS value, '{{"k": 3}}' AS props FROM range(13) r(b), range(3) s(k) UNION ALL BY NAME
SELECT 30000000 AS event_id, NULL::TIMESTAMP AS ts, 1 AS user_id, 'view' AS event_type, 5.0 AS value, '{{"k": 3}}' AS props"""


def test_session_qualification_judges_every_number_of_a_bar(spark, tmp_path):
    from tests.conftest import compare

    folder, con = stored(tmp_path, FAULTS)
    query, sql = plans.QUERIES["session_qualification"], plans.ORACLES["session_qualification"]
    compare(spark, con, query, sql, folder)
    seen = con.execute(f"SELECT symbol, observed, invalid, passed FROM ({sql}) WHERE session_date = DATE '2024-01-17' AND symbol IN ('click', 'view') ORDER BY symbol").fetchall()
    assert seen == [("click", 13, 9, False), ("view", 13, 7, False)]  # a null price between two others is neither open nor close


#: Two sessions: click's are whole, signup has invalid bars, purchase missing ones, view some after the close, error no trade at all.
HISTORY = """SELECT row_number() OVER () AS event_id, d + b * INTERVAL 30 MINUTE + k * INTERVAL 5 MINUTE AS ts, 1 AS user_id, s AS event_type,
  CASE WHEN s = 'signup' AND b = 4 AND k = 1 THEN 0.0 ELSE 5.0 END AS value, '{{"k": 3}}' AS props
  FROM (VALUES (TIMESTAMP '2024-01-17 14:30:00'), (TIMESTAMP '2024-01-18 14:30:00')) r(d), range(14) u(b), range(3) v(k), (VALUES ('click'), ('purchase'), ('signup'), ('view')) w(s)
  WHERE (b < 13 OR s = 'view') AND NOT (s = 'purchase' AND b = 5)"""


def test_historical_qualification_of_whole_and_faulty_histories(spark, tmp_path):
    from tests.conftest import compare

    folder, con = stored(tmp_path, HISTORY)
    query, sql = plans.QUERIES["historical_qualification"], plans.ORACLES["historical_qualification"]
    compare(spark, con, query, sql, folder)
    seen = con.execute(f"SELECT symbol, sessions, qualified, missing, off_session, duplicates, passed FROM ({sql}) ORDER BY symbol").fetchall()
    assert seen == [("click", 2, 2, 0, 0, 0, True), ("error", 2, 0, 26, 0, 0, False), ("purchase", 2, 0, 2, 0, 0, False), ("signup", 2, 0, 0, 0, 0, False), ("view", 2, 2, 0, 2, 0, False)]


def test_historical_qualification_of_faulty_numbers(spark, tmp_path):
    from tests.conftest import compare

    folder, con = stored(tmp_path, FAULTS)
    compare(spark, con, plans.QUERIES["historical_qualification"], plans.ORACLES["historical_qualification"], folder)


@pytest.mark.parametrize("days", [-8750, 888, 1096, 2922])
def test_session_qualification_in_other_years(spark, tmp_path, days):
    from tests.conftest import compare

    folder, con = stored(tmp_path, f"SELECT * REPLACE (ts + INTERVAL ({days}) DAY AS ts) FROM {{events}}")
    assert compare(spark, con, plans.QUERIES["session_qualification"], plans.ORACLES["session_qualification"], folder) > 0


@pytest.mark.parametrize("name", ["tick_coverage", "trade_gaps", "session_qualification", "recovery_coverage", "interior_gaps"])
def test_no_calendar_rule_reaches_the_ticks(name, spark, sf):
    """Each trade's New York date is found once or twice, not once a rule."""
    plan = plans.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert max(line.count("convert_timezone") for line in plan.splitlines()) <= 2 and "make_date" not in plan


def test_every_oracle_has_a_query():
    assert set(plans.ORACLES) <= set(plans.QUERIES)


def test_sequence_examples_of_every_origin(spark, sf):
    windows, blocks = plans.QUERIES["sequence_examples_all"](spark, sf), plans.QUERIES["sequence_examples"](spark, sf)
    assert windows.where("time_idx % 4 <> 0").count() > 0 and windows.count() == blocks.count()
    same = ["symbol", "time_idx", "encoder_length", "decoder_length", "encoder_first", "decoder_last"]
    assert windows.select(same).exceptAll(blocks.select(same)).isEmpty()


def test_the_flagship_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_queries_can_be_listed_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)
