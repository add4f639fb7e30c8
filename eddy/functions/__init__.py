from .columns import (  # noqa: F401
    epoch_us, ntz_from_us, ltz_from_us, to_event_time, strictly_above,
    abs_diff_at_least, concat_pair, fold_block, alert_text, order_struct,
    split_like_java, duration_us,
)
