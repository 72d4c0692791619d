"""Fixed values.

Stores filled by existing jobs already hold these keys and formats, so they must not change.
"""

TIME_FIELD = "time"
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"

CACHE_PREFIX = "sfhd_origin_"
LEGACY_CACHE_PREFIX = "sfhd_origin"
CACHE_DB = 1
CACHE_TTL_SECONDS = 600

BATCH_SECONDS = 3

# Table columns hold three decimals and at most ten digits.
NUMBER_SCALE = 3
NUMBER_LIMIT = 9999999.999

# Body of the connectivity-check message; not JSON, so it ends up in quarantine.
CHECK_MESSAGE = "ping"
