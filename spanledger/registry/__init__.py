"""Named queries over the supplied tables, each with a plain-SQL counterpart where SQL can say it."""

from spanledger.registry.base import CASES  # noqa: F401
from spanledger.registry import basic, history, intervals, phone, quality, reports, tables  # noqa: F401,E402
