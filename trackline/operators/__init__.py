from trackline.operators.asof import asof_fill, asof_fill_plain  # noqa: F401
from trackline.operators.bands import band_join  # noqa: F401
from trackline.operators.interval import interval_join, interval_join_plain, suggest_bucket_us  # noqa: F401
from trackline.operators.ranking import first_by, group_rank, with_group_min  # noqa: F401
from trackline.operators.segments import number_segments  # noqa: F401
