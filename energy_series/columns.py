"""Column names shared by every operator."""

KEYS = ("site_id",)
MARKET = ("market_id",)
TS = "sample_time"
COUNTERS = ("exp", "imp", "gen", "gep", "evn", "evp")
