"""Configured data pipelines on Spark: cleanse, deduplicate, check, write and record tables."""

from millrace.operators import *  # noqa: F401,F403
from millrace.plans import *  # noqa: F401,F403
from millrace.sources import *  # noqa: F401,F403
from millrace.streaming import *  # noqa: F401,F403
