"""Plan shapes that keep hot groups spread over many tasks."""

from tallyfold.plans.topk import top_per_group
from tallyfold.plans.windows import ROWS_PER_SEGMENT, windowed

__all__ = ["ROWS_PER_SEGMENT", "top_per_group", "windowed"]
