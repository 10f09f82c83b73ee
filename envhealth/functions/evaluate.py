from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(**columns: Column) -> Column:
    """Columns that later filters can use without computing them again.

    Spark copies the expression of a projected column into every condition on it that it
    pushes down. For a text parse with several conditions that is most of the work of a
    scan. A one-row generator ends the copying; conditions on other columns still pass it.
    """
    return F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
