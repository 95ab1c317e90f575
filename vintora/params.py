"""Methodology constants and run parameters (known on the driver, never data)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Ordered delinquency buckets of the roll-rate report.
BUCKETS = (
    "corrente",
    "f5_30",
    "f31_60",
    "f61_90",
    "f91_120",
    "f121_150",
    "f151_180",
    "f180p",
)

# Fixed values: (label, first day, last day); a last day of None is open-ended.
DELINQUENCY_BANDS = (
    ("Corrente (0 dias)", None, 0),
    ("1 a 30 dias", 1, 30),
    ("31 a 60 dias", 31, 60),
    ("61 a 90 dias", 61, 90),
    ("Acima de 90 dias", 91, None),
)

# Fixed values: (label, first term, last term); a last term of None is open-ended.
TERM_BANDS = (
    ("1-12 meses", 1, 12),
    ("13-24 meses", 13, 24),
    ("25-36 meses", 25, 36),
    ("37-48 meses", 37, 48),
    ("49-60 meses", 49, 60),
    ("61-72 meses", 61, 72),
    (">72 meses", 73, None),
)

# Roll name, numerator bucket this month, denominator bucket last month.
ROLLS = (
    ("r5_30", "f5_30", "corrente"),
    ("r31_60", "f31_60", "f5_30"),
    ("r61_90", "f61_90", "f31_60"),
    ("r91_120", "f91_120", "f61_90"),
    ("r121_150", "f121_150", "f91_120"),
    ("r151_180", "f151_180", "f121_150"),
)

# Names and labels of the reports.
RISK_GROUPS = ("alto", "medio", "baixo")
NOT_INFORMED = "N/I"
LTM_LABEL = "Média LTM"
NO_BAND = "Sem faixa"  # our own: loans between two bands


@dataclass(frozen=True)
class Params:
    """Snapshot date plus the methodology constants.

    The gate refuses terms above ``max_term``, which would otherwise size every curve, and a share of malformed
    lines above ``max_malformed``.
    """

    snapshot: date
    max_term: int = 600
    max_malformed: float = 0.0
    # The methodology's constants.
    mob_cut: int = 2
    mature_mob: int = 6
    scale_mob: int = 4
    loss_decay: float = 0.85
    revenue_decay_base: float = 0.92
    revenue_decay_power: float = 1.2
    shape_floor: float = 0.001
    revenue_floor: float = 0.0001
    scale_floor: float = 0.2
    group_quantiles: tuple[float, float] = (0.3333, 0.6666)
    ltm_rows: int = 12
    npv_rates: tuple[float, ...] = (0.01, 0.015)
    npv_stress: tuple[tuple[str, float], ...] = (
        ("otimista", 0.8),
        ("base", 1.0),
        ("pessimista", 1.2),
    )

    @classmethod
    def at(cls, year_month: str, **overrides) -> "Params":
        """Snapshot ``YYYY-MM`` means the first day of that month."""
        year, month = year_month[:7].split("-")
        return cls(snapshot=date(int(year), int(month), 1), **overrides)
