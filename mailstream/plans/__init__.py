"""The three reports, from raw lines to counts."""

from mailstream.plans.actions import actions_rollup
from mailstream.plans.logs import logs_rollup
from mailstream.plans.user_agents import user_agent_rollup

__all__ = ["actions_rollup", "logs_rollup", "user_agent_rollup"]
