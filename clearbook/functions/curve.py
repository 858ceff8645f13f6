"""Order curve and settlement price expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: levels of a curve the merge looks at, although tables hold ten.
LADDER_LEVELS = 5


def ladder_size(levels: int = LADDER_LEVELS) -> Column:
    """Quantity of the first level that has one."""
    return F.coalesce(*[F.col(f"mw{level}") for level in range(1, levels + 1)])


def ladder_price(levels: int = LADDER_LEVELS) -> Column:
    """Price at the first level that has a quantity.

    That price may be missing, and then the result is missing: the ladder is decided by quantities alone.
    """
    branch = F
    for level in range(1, levels + 1):
        branch = branch.when(F.col(f"mw{level}").isNotNull(), F.col(f"price{level}"))
    return branch


def settlement_price(market: Column, award: Column) -> Column:
    """Market price where there is one, else the price the award itself carries."""
    return F.coalesce(market, award)


def first_present(*candidates: Column) -> Column:
    """First candidate that is not NULL."""
    return reduce(lambda a, b: F.coalesce(a, b), candidates)
