"""Session helpers: the checkpoint folder comes from the session."""

from __future__ import annotations

from keystat.session import SESSION_DEFAULTS, checkpoint_dir


def test_checkpoint_dir_is_the_sessions(spark):
    # the test session set one (local mode, none configured): it is reused
    first = checkpoint_dir(spark)
    assert first and checkpoint_dir(spark) == first
    assert spark.sparkContext.getCheckpointDir() == first


def test_defaults_keep_ui_off_and_aqe_on():
    assert SESSION_DEFAULTS["spark.ui.enabled"] == "false"
    assert SESSION_DEFAULTS["spark.sql.adaptive.enabled"] == "true"
    assert SESSION_DEFAULTS["spark.sql.adaptive.skewJoin.enabled"] == "true"
