"""The derived tables make every branch of the queries fire (checked with the SQL oracle)."""

import pytest

from tussock.plans import oracle as O
from tussock.plans.catalog import ORACLE

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def ask():
    import duckdb
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events pages".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return lambda sql, needs=(): con.execute(O.build(sql, list(needs))).fetchall()


def test_every_customer_is_loaded_and_every_filter_drops_rows(ask):
    counts = [r[2] for r in sorted(ask(ORACLE["census_ingest_funnel"]))]
    assert counts[0] == ask("SELECT count(*) FROM customer")[0][0]
    assert counts[0] > counts[1] and counts[2] > counts[3] > counts[4] > counts[5]


def test_probe_finds_some_names_and_misses_others(ask):
    found = {r[1] == "NOT FOUND" for r in ask(ORACLE["keyword_probe"])}
    assert found == {True, False}


def test_base_rows_lie_past_the_patch(ask):
    n, past = ask("SELECT count(*), count(*) FILTER (WHERE date >= (SELECT min(date) FROM rate_patch)) FROM rates_positional",
                  ["rates_positional", "rate_patch"])[0]
    assert 0 < past < n


def test_schools_lie_outside_the_box(ask):
    n, out = ask("SELECT count(*), count(*) FILTER (WHERE lat < -37.5 OR lon > 175.5) FROM stg_schools", ["stg_schools"])[0]
    assert 0 < out < n


def test_more_suburbs_than_the_limit(ask):
    n = ask("SELECT count(*) FROM mart_aff WHERE report_date = (SELECT max(report_date) FROM mart_aff) "
            "AND avg_eqi_index IS NOT NULL", ["mart_aff"])[0][0]
    assert n > 30 == len(ask(ORACLE["report_top_schools"]))


def test_scores_are_missing_and_differ(ask):
    null, kinds, n = ask("SELECT count(*) FILTER (WHERE amenity_score IS NULL), count(DISTINCT liveability_score), count(*) "
                         "FROM mart_live", ["mart_live"])[0]
    assert 0 < null < n and kinds > n // 2


def test_yields_differ_and_the_peak_has_a_trough(ask):
    assert ask(f"SELECT max(yield_gap) FROM ({ORACLE['gross_yield_check']})")[0][0] > 1
    peak = ask(ORACLE["report_peak_to_trough"])[0]
    assert peak[2] > peak[0] and peak[4] < 0


def test_coverage_is_partial_for_every_source(ask):
    assert all(0 < r[4] < 1 for r in ask(ORACLE["coverage_rate"]))


def test_scores_below_and_at_their_caps(ask):
    for q in ("amenity_scores_by_size", "transit_scores_dense"):
        scores = [r[2] for r in ask(ORACLE[q])]
        assert max(scores) == 10 and any(0 < s < 10 for s in scores), q
    assert min(r[2] for r in ask(ORACLE["transit_scores_dense"])) == 0


def test_repeated_rows_are_found_and_kept_once(ask):
    assert all(r[2] == 2 for r in ask(ORACLE["dq_mart_repeated_rows"])) and ask(ORACLE["dq_mart_repeated_rows"])
    n, kept = ask("SELECT count(*), count(DISTINCT suburb) FROM stg_prices", ["stg_prices"])[0]
    assert n > 10 * kept == 10 * len(ask(ORACLE["latest_price_by_suburb"]))


def test_lines_are_short_long_and_without_numbers(ask):
    assert {r[1] for r in ask(ORACLE["stop_file_rejects"])} == {"short_line", "long_line", "bad_value"}


def test_a_price_is_carried_and_some_months_have_none_before(ask):
    rows = ask(ORACLE["price_carried_forward"])
    assert any(r[2] is None and r[3] is not None for r in rows) and any(r[3] is None for r in rows)
