from .evaluate import measure, measure_all
from .strategies import (
    adaptive_cycle,
    batch_strategies,
    live_samples,
    live_strategies,
    start_live,
    start_symbol_strategies,
    symbol_strategies,
)

__all__ = [
    "adaptive_cycle",
    "batch_strategies",
    "live_samples",
    "live_strategies",
    "measure",
    "measure_all",
    "start_live",
    "start_symbol_strategies",
    "symbol_strategies",
]
