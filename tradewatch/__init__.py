"""tradewatch: trade-surveillance analytics expressed as Spark DataFrame/SQL plans.

Every public function takes and returns DataFrames; nothing is collected to
the driver outside of tests.  See README.md for the operator map.
"""

from tradewatch.profiles import LATEST_PAIR, POST_TRADE, Profile

__all__ = ["Profile", "POST_TRADE", "LATEST_PAIR"]
