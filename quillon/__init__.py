"""Analytics over single-cell reads, and operators for training data, on Spark."""

from __future__ import annotations

import os


def ship(spark) -> None:
    """Lets Python workers find this package where it isn't installed and no --py-files names it."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, *paths]))
