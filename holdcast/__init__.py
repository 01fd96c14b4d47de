"""holdcast: inventory holding and demand-bias metrics as Spark DataFrame plans.

Every metric is a pure function ``(Tables, as_of) -> DataFrame``. Nothing here
collects rows to the driver; the caller decides the action (write, count, show).
"""

from holdcast.schemas import Tables

__all__ = ["Tables"]
