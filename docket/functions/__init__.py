from docket.functions.text import ci, null_unified, scrub_placeholders, ci_equals  # noqa: F401
from docket.functions.periods import period_year, canonical_period, normalise_period  # noqa: F401
from docket.functions.times import parse_event_time  # noqa: F401
from docket.functions.scan import KeyedScan, null_safe_join  # noqa: F401
