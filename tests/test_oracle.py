"""Every registered query against its DuckDB oracle (sf0.001); queries without
an oracle must at least run and keep a stable schema."""

import pytest

from __spark_entry__ import entry, oracle_sql
from conftest import SF_SMALL
from gridwave.plans.catalog import REGISTRY
from oracle_compare import compare, duck

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, name, SF_SMALL, con, verbose=False), name


def test_every_query_without_oracle_is_a_model_fit():
    missing = set(REGISTRY) - set(oracle_sql())
    assert missing <= {"train_classifier", "kernel_classifier", "model_selection", "refit_classifier", "eval_metrics",
                       "model_metrics", "score_waveforms", "score_plugin", "stream_score"}


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["filename", "frame", "n_samples", "length_ok", "sample_times", "waveform"]
