"""Fixed values that results depend on."""

# Defaults used when a record does not carry a split.
UNKNOWN_SPLIT = "unknown"
INFERENCE_SPLIT = "inference"

# Fixed value. Markup: one tag, from "<" to the next ">".
HTML_TAG = r"<[^>]+>"

# White space as Python's str.split() sees it: the Unicode White_Space property and the four ASCII separators.
# The property is one predicate for the Java regex engine, several times faster than spelling out the ranges.
WHITE_SPACE = r"[\p{IsWhite_Space}\x1c\x1d\x1e\x1f]"

# Scoring.
SCORE_THRESHOLD = 0.5
DEFAULT_MODEL_VERSION = "logreg"

# Text encoding.
ENCODE_BATCH = 32
VECTOR_SIZE = 768

# Training.
SEED = 42
MAX_ITERATIONS = 2000

# Upper bounds of the latency histograms, in seconds.
REQUEST_BOUNDS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
PROCESSING_BOUNDS = (0.5, 1.0, 2.0, 5.0, 10.0, 30.0)
