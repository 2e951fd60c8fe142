"""Column expressions by name, for use without the modules that define them."""

from ..core.numeric import divide, from_fixed, notional, to_fixed, whole_quotient
from ..core.timeutil import trading_date, zone_column
from ..operators.bars import vwap
from ..operators.dimension import market_type_of, symbol_id
from ..operators.phases import trading_phase
from ..operators.stats import p_value
from ..operators.windows import changed, diff, persistence, rolling_mean, rolling_median, rolling_std
from ..sources.cn import symbol_code, timestamp_us
from ..sources.files import member_symbol

__all__ = [
    "changed",
    "diff",
    "divide",
    "from_fixed",
    "market_type_of",
    "member_symbol",
    "notional",
    "p_value",
    "persistence",
    "rolling_mean",
    "rolling_median",
    "rolling_std",
    "symbol_code",
    "symbol_id",
    "timestamp_us",
    "to_fixed",
    "trading_date",
    "trading_phase",
    "vwap",
    "whole_quotient",
    "zone_column",
]
