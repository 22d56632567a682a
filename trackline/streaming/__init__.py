from trackline.streaming.landing import land_feed, landed_lines  # noqa: F401
