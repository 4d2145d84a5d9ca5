"""Named queries over the given tables, each with the SQL it is checked against where SQL can say it."""

from postlens.plans import activity, combining, evaluation, models, storage, streams, words  # noqa: F401
from postlens.plans.registry import ORACLES, QUERIES  # noqa: F401
