"""Fixed values.

Values that must stay exactly as they are for results to match the
warehouse semantics (host prefix, default thresholds and windows).  Kept
together here, plainly, in natural order.
"""

# --- fixed values: log parsing -------------------------------------------
# The request log holds only the path and query of a request; a dummy
# scheme+host is prefixed so that URL parsing works.
URL_PREFIX = "http://www.example.com"
# Query keys carried by an ad request, in the order they appear.
QUERY_KEYS = ("t", "id", "ip", "ua", "os_type", "device_id")
# Path layout: /<x>/<platform>/<event_type>; element 0 is the empty string.
PATH_PLATFORM_INDEX = 2
PATH_EVENT_TYPE_INDEX = 3

# Valid event times, epoch milliseconds: 0 up to (not including) 2100-01-01.
MAX_EVENT_TIME_MS = 4102444800000

# --- fixed values: invalid-traffic rules ----------------------------------
# Trailing window of the high-frequency rules, milliseconds (5 minutes).
FREQUENCY_WINDOW_MS = 300000
# An IP or device is flagged when a trailing window holds more events than this.
FREQUENCY_THRESHOLD = 100
# Fixed-period rules: an island of equal gaps larger than this is flagged.
CYCLE_IP_THRESHOLD = 5
CYCLE_DEVICE_THRESHOLD = 100

# --- fixed values: text layout --------------------------------------------
ODS_FIELD_DELIMITER = "\t"
LOG_FIELD_DELIMITER = "\u0001"
EXPORT_NULL = "\\N"
