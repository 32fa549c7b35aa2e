"""A sample of the registered queries against their SQL, on the smallest tables."""

from pathlib import Path

import pytest

from check_queries import compare
from logloom.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = """
hourly_totals access_log_parse page_sequence_parts previous_page events_in_time_order sensor_csv
word_count whitespace_cleaning tokenize_lemmas tfidf_limited fit_vocabulary encode_sequences
tfidf_embedding fuzzy_join geo_ip path_enumeration extract_links largest_box leaderboard
item_similarity recommend author_posts stream_referrals stream_windowed_views file_inventory
""".split()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, FOLDER, name) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert not [name for name, sql in ORACLES.items() if not sql.strip()]


def test_entry_points(spark):
    import __spark_entry__ as entry_points

    df = entry_points.entry(spark)
    assert df.columns == ["date", "hour", "id", "total"] and df.count() > 0
    # the training-data package adds its own where it is present
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLES.items() <= entry_points.oracle_sql().items()
