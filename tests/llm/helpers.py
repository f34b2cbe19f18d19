from __future__ import annotations

import checks.compare
from skylog.llm import queries


def compare_with_sql(spark, connection, name, sf_dir):
    """What differs between a query of this package and its SQL, or None."""
    checks.compare.QUERIES.setdefault(name, queries.QUERIES[name])
    checks.compare.ORACLES.setdefault(name, queries.ORACLES[name])
    try:
        return checks.compare.compare(spark, connection, name, sf_dir)
    finally:
        del checks.compare.QUERIES[name], checks.compare.ORACLES[name]
