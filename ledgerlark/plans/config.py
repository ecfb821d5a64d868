"""Names and dates a run is given."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import resolve_period


@dataclass(frozen=True)
class AuditConfig:
    """network and insurer are the names printed in reports and messages.

    period  processing date as ISO text; empty means yesterday in Lima
    today   the run's current date
    """

    network: str = "RED"
    insurer: str = "Aseguradora"
    period: str = ""
    today: dt.date = field(default_factory=dt.date.today)

    @property
    def processed_date(self) -> str:
        return resolve_period(self.period)

    def today_column(self) -> Column:
        return F.lit(self.today.isoformat()).cast("date")

    def month_column(self) -> Column:
        return F.lit(self.today.replace(day=1).isoformat()).cast("date")
