"""Column functions: dates, keys, and rolling statistics."""

from .dates import detail_date, epoch_or_text_date, event_time, number
from .keys import record_key, redact
from .rolling import forward_fill, history_rank, rolling, rolling_median, rolling_z, streak_length

__all__ = [
    "detail_date", "epoch_or_text_date", "event_time", "forward_fill", "history_rank", "number", "record_key", "redact", "rolling",
    "rolling_median", "rolling_z", "streak_length",
]
