"""Unit-economics parameters of the marketplace P&L."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class EconomicsConfig:
    # The P&L rules (10 % sales fee, 80 BRL per seller-month,
    # reputation cost per review by stars, IT cost scaling parameters).
    sales_fee: float = 0.1
    monthly_fee: float = 80.0
    review_cost: dict[int, int] = field(default_factory=lambda: {1: 100, 2: 50, 3: 40, 4: 0, 5: 0})
    it_alpha: float = 3157.27
    it_beta: float = 978.23


DEFAULT = EconomicsConfig()
