"""Named queries over the given tables, each with the SQL it must agree with where there is one."""

from sheafmill.catalog import corpus, files, runs, tokens  # noqa: F401
from sheafmill.catalog.base import ORACLES, QUERIES  # noqa: F401
