"""Sources, sinks and small operators as whole queries, against SQL."""

import pytest

from against_sql import compare


@pytest.mark.parametrize("name", [
    "csv_round_trip", "split_round_trip", "jsonl_round_trip", "error_report", "truncate_tokens", "fill_null",
    "accepted_texts", "exclusive_ends"])
def test_against_sql(spark, name):
    compare(spark, name)
