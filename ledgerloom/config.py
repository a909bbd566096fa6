"""Settings of the wallet and cash-cycle plans."""

from __future__ import annotations

from dataclasses import dataclass, field


# Settings that results depend on.
@dataclass(frozen=True)
class WalletConfig:
    pillars: tuple[str, ...] = ("Transactional Banking", "Investment Banking", "Global Markets")
    book_pillar: dict[str, str] = field(default_factory=lambda: {"transactional_banking": "Transactional Banking", "trade_finance": "Transactional Banking", "cross_border_payments": "Global Markets"})
    rho: float = 0.30
    alpha: float = 0.10
    k0_no_data: float = 3.0
    default_log_var: float = 0.35
    floor: float = 1.0
    a0_min: float = 1.0
    unit_multiplier: float = 1e6
    reporting_months: int = 12
    default_observed_months: int = 12
    cashflow_min_year: int = 2023
    fx_to_zar: dict[str, float] = field(default_factory=lambda: {"ZAR": 1.0, "USD": 16.5, "GBP": 23.5, "EUR": 20.0})


LEGS = ("collections", "supplier_payments", "intercompany_sweeps", "payroll", "tax")
# End of fixed values.
CONFIG = WalletConfig()
