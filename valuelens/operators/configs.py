"""Experiment configs: which tests are sampled, and under which name and component type."""

from __future__ import annotations

from pyspark.sql import DataFrame

from valuelens.functions.hours import Hours
from valuelens.functions.text import case_of, one_of, quoted
from valuelens.schemas import COMPONENT_TYPES, SAMPLED_METHODOLOGIES


def sampled_tests(tests: DataFrame) -> DataFrame:
    """Tests with at least one sampled methodology, all their methodologies kept."""
    return tests.where(
        f"exists(methodologies, m -> {one_of('m.name', SAMPLED_METHODOLOGIES)})"
    ).select("name", "channel", "methodologies")


def component_type_of(channel: str) -> str:
    """Component type of a channel; NULL for the landing page and for unknown channels."""
    return case_of(channel, {name: quoted(value) for name, value in COMPONENT_TYPES.items()})


def test_configs(tests: DataFrame) -> DataFrame:
    """One row per sampled methodology of a test, named as the methodology or else as the test.

    Two methodologies without a name of their own give two equal rows. Both count in the run metrics.
    """
    return (
        tests.selectExpr("channel", "name", "explode(methodologies) as methodology")
        .where(one_of("methodology.name", SAMPLED_METHODOLOGIES))
        .selectExpr(
            "channel",
            "coalesce(methodology.testName, name) as name",
            f"{component_type_of('channel')} as component_type",
        )
    )


def distinct_configs(configs: DataFrame) -> DataFrame:
    """Configs as a join key: (channel, test_name, component_type), each once."""
    return configs.selectExpr(
        "channel", "name as test_name", f"{component_type_of('channel')} as component_type"
    ).distinct()


def config_hours(configs: DataFrame, hours: Hours) -> DataFrame:
    """One row per config and hour, with the number of equal configs as ``copies``."""
    copies = configs.groupBy("channel", "name").count()
    return copies.selectExpr(
        "channel", "name as test_name", "count as copies", f"explode({hours.each()}) as window_start"
    )
