"""Date windows that fit the driver tables."""

import datetime as dt
from dataclasses import replace

from ..config import DEFAULTS

SETTINGS = replace(
    DEFAULTS,
    claim_from=dt.date(1995, 1, 1),
    claim_to=dt.date(2001, 12, 31),
    effective_from=dt.date(1998, 1, 1),
    effective_to=dt.date(1999, 12, 31),
)
