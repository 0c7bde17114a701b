"""Survey analytics on Spark: DataFrame operators, jobs and streams."""

from surveyloom.settings import Settings

__all__ = ["Settings"]
