"""Small fixed value lists shared by the Spark code and the SQL oracles.

Larger dictionaries (region keywords, coordinates) live as text files in
``topicloom/data`` and are parsed by ``topicloom.sources.dims``.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES - must equal the reference for identical results; do not edit.
# ---------------------------------------------------------------------------

# Boilerplate phrases removed (each as a whole-word match, in this order)
# before topic tokens are built.
BOILERPLATE_PHRASES = [
    "continue reading",
    "read more",
    "click here",
    "subscribe now",
    "sign up",
    "follow live",
    "live updates",
    "this story has been updated",
    "advertisement",
    "skip advertisement",
    "full story",
    "for more information",
]

# Extra stop words dropped from topic text (tokens of length <= 2 are dropped too).
TOPIC_STOP_WORDS = [
    "continue", "reading", "read", "more", "click", "here", "subscribe", "sign",
    "watch", "video", "live", "updates", "breaking", "news", "article", "story",
    "said", "says", "say", "new", "year", "years", "like", "just", "people",
    "time", "day", "week", "month", "today", "latest", "report", "reports",
    "reported", "according", "online", "full", "advertisement", "skip",
]

# Letters kept by the headline/description cleaner besides ASCII letters and digits.
CLEAN_EXTRA_LETTERS = "äöüÄÖÜßéèàçÉÈÀÇ"

# Dashboard topic palette, indexed by topic_id % 7.
TOPIC_COLORS = ["#d5eef2", "#aebbd0", "#dedaff", "#ef64ad", "#eff55a", "#d9f5c5", "#ffd6a5"]

# Colour used when a row has no topic_id.
DEFAULT_RGB = [239, 245, 90]

# Month labels of the dashboard date banner (DD.MON.YYYY), January first.
BANNER_MONTHS = ["JAN", "FEB", "MAR", "APR", "MAI", "JUN", "JUL", "AUG", "SEP", "OKT", "NOV", "DEZ"]

# Map bubble styling: intensity = int(200 + 55 * count / max_count), fixed radius.
MAP_INTENSITY_BASE = 200
MAP_INTENSITY_SPAN = 55
MAP_RADIUS = 90000

# Default region and its coordinates when no keyword matches.
DEFAULT_REGION = "World"

# Region fallback when a predictions table has no region column.
FALLBACK_REGION = "World"

# Top headlines shown per topic.
TOP_HEADLINES_PER_TOPIC = 8
