"""Scratch location rules."""

from __future__ import annotations

from tickhouse.session import SESSION_DEFAULTS, new_scratch_dir, scratch_root


def test_scratch_root_is_the_checkpoint_dir(spark):
    root = scratch_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = new_scratch_dir(spark, "x"), new_scratch_dir(spark, "x")
    assert a != b and a.startswith(root + "/tickhouse/x-")


def test_session_defaults_applied(spark):
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
                "spark.sql.adaptive.enabled"):
        assert spark.conf.get(key) == SESSION_DEFAULTS[key]
