"""Run parameters with the source system's bounds."""
from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from decimal import Decimal

from . import schemas as S


@dataclass(frozen=True)
class BenefitParams:
    """Parameters of one benefit run.

    ``as_of`` replaces every ``now()``: the trailing window, the future-date
    checks and the audit timestamps use it, so a run is reproducible.
    """

    prime_rate: Decimal = Decimal(S.DEFAULT_PRIME_RATE)
    wellbeing_threshold: int = S.DEFAULT_WELLBEING_THRESHOLD
    walking_max_km: float = S.DEFAULT_WALKING_MAX_KM
    cycling_max_km: float = S.DEFAULT_CYCLING_MAX_KM
    as_of: dt.datetime = dt.datetime(2001, 8, 1)
    window_days: int = S.WELLBEING_WINDOW_DAYS
    days_granted: int = S.WELLBEING_DAYS_GRANTED
    pii_salt: str = field(kw_only=True)  # secret of the deployment: no default
    run_id: str = field(default_factory=lambda: f"local-{uuid.uuid4().hex[:8]}")

    def __post_init__(self):
        rate = Decimal(str(self.prime_rate))
        object.__setattr__(self, "prime_rate", rate)
        if not (Decimal(0) <= rate <= Decimal(1)):
            raise ValueError(f"prime_rate must be within [0, 1], got {rate}")
        if rate != rate.quantize(Decimal("0.0001")):
            raise ValueError(f"prime_rate has more than 4 decimals: {rate}")
        if int(self.wellbeing_threshold) < 1:
            raise ValueError("wellbeing_threshold must be >= 1")
        if not (self.walking_max_km > 0 and self.cycling_max_km > 0):
            raise ValueError("distance limits must be > 0")
        if self.window_days < 1:
            raise ValueError("window_days must be >= 1")

    @property
    def window_start(self) -> dt.datetime:
        return self.as_of - dt.timedelta(days=self.window_days)

    def with_(self, **kw) -> "BenefitParams":
        data = {k: getattr(self, k) for k in self.__dataclass_fields__}
        data.update(kw)
        return BenefitParams(**data)
