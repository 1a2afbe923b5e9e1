"""Business thresholds, kept in one immutable object so every job shares them."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Rules:
    # The defaults must equal the published rule book.
    valid_from: str = "2025-05-01 00:00:00"
    valid_to: str = "2025-06-14 23:59:59"
    unknown_account: str = "ACC99999999"
    baseline_days: int = 30
    min_prior_days: int = 5
    spike_factor: int = 5
    burst_devices: int = 3
    risk_merchant_from: str = "MER0000"
    risk_merchant_to: str = "MER0039"
    off_hours: tuple[int, ...] = (23, 0, 1)


# The same rules, moved to the period and the merchant range of the test tables.
EVENT_RULES = replace(
    Rules(),
    valid_from="2024-01-01 00:00:00",
    valid_to="2024-01-28 23:59:59",
    risk_merchant_to="MER0009",
)
