"""Classes of user agents, found once for every different agent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import agents
from tidemark.operators import joins
from tidemark.sinks.versions import Change, Versions

CLASSES = ["OS", "Device", "Browser", "Is_Mobile"]
# What the rules say of no agent.
OF_NO_AGENT = ["", "", "", False]


def classified(distinct: DataFrame) -> DataFrame:
    """``UserAgent`` with its classes. The rules run once for each row, so rows should be different agents."""
    agent = F.col("UserAgent")
    return distinct.withColumns(
        {
            "OS": agents.agent_os(agent),
            "Device": agents.agent_device(agent),
            "Browser": agents.agent_browser(agent),
            "Is_Mobile": agents.agent_is_mobile(agent),
        }
    )


class AgentDictionary:
    """A kept table of all agents seen so far, with their classes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.table = Versions(spark, path)

    def read(self) -> DataFrame | None:
        return self.table.read("agents")

    def extend(self, logs: DataFrame) -> bool:
        """Classifies the agents of ``logs`` that are not known yet; False if there were none."""
        seen = logs.where("UserAgent IS NOT NULL").select("UserAgent").distinct()
        known = self.read()
        new = seen if known is None else seen.join(known, "UserAgent", "left_anti")
        if known is not None and new.isEmpty():
            return False
        return self.table.publish({"agents": Change(classified(new))})


def with_agent(logs: DataFrame, spread_by: list[str], known: DataFrame | None = None) -> DataFrame:
    """``logs`` with the classes of their agents, looked up and not computed for each row.

    ``known`` has agents with their classes, as :class:`AgentDictionary` keeps; without it the different agents are
    classified in the same plan. Agents that ``known`` lacks have no classes, rows without an agent those of none.
    """

    def classes(distinct: DataFrame) -> DataFrame:
        return classified(distinct) if known is None else distinct.join(known.select("UserAgent", *CLASSES), "UserAgent", "left")

    looked_up = joins.lookup_distinct(logs, "UserAgent", classes, spread_by)
    named = F.col("UserAgent").isNotNull()
    return looked_up.withColumns({c: F.when(named, F.col(c)).otherwise(F.lit(v)) for c, v in zip(CLASSES, OF_NO_AGENT)})
