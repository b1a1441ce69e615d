"""Word lists, patterns and numbers that results depend on."""

# Columns of a raw record.
RECORD_COLUMNS = ["movie_id", "movie_name", "description", "genre"]

# A record is dropped when its label string contains one of these.
EXCLUDED_LABELS = ["Reality-TV", "News", "Adult", "Talk-Show", "Game-Show", "Short"]

# The text that stands for "nothing was entered".
EMPTY_TEXT = "Add a Plot"

# Placeholder texts, tried in this order, case-insensitive.
PLACEHOLDER_PATTERNS = [
    r"Add a Plot",
    r"\bunder wrap",
    r"plot.*unknown",
    r"plot.*undisclosed",
    r"in development",
    r"^no plot",
    r"\bTBA\b",
    r"^coming soon",
    r"^(?:not available)|(?:(?:plot|outline|details|story).*not available)",
    r"^(?:not disclosed)|(?:(?:plot|outline|details|story).*not disclosed)",
    r"(?:plot|story|synopsis).*unavailable",
]

# A text that matches any placeholder pattern holds one of these, in any case.
PLACEHOLDER_MARKS = [
    "add a plot", "under wrap", "unknown", "undisclosed", "in development", "no plot", "tba",
    "coming soon", "not available", "not disclosed", "unavailable",
]

# Tail of a cut-off text, and the author's signature.
TRUNCATION_SUFFIX = r"\.{3,} *See full (?:summary|synopsis) »$"
SIGNATURE = r"—.*$"
OVERRIDE_MARKS = ["See full summary", "Add a Plot"]

# Phrases that speak about the film rather than its story.
META_PHRASES = ["directed by", "produced by", "starring", "stars as ", "filmed in ", "acted by "]

# Label names used when no vocabulary is given.
DEFAULT_LABELS = [
    "Action", "Adventure", "Animation", "Biography", "Comedy", "Crime", "Drama",
    "Family", "Fantasy", "Film-Noir", "History", "Horror", "Music", "Musical",
    "Mystery", "Romance", "Sci-Fi", "Sport", "Thriller", "War", "Western",
]

# Run parameters.
SEED = 42069
SMOTE_SEED = 42
MIN_WORDS = 10
MAX_WORDS = 200
PROBABILITY_THRESHOLD = 0.5
LOGIT_THRESHOLD = 0.425

# Our own short list of English function words, the default for stop_words="english".
ENGLISH_STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being "
    "below between both but by can did do does doing down during each few for from further had "
    "has have having he her here hers herself him himself his how i if in into is it its itself "
    "just me more most my myself no nor not now of off on once only or other our ours ourselves "
    "out over own same she should so some such than that the their theirs them themselves then "
    "there these they this those through to too under until up very was we were what when where "
    "which while who whom why will with you your yours yourself yourselves"
).split()
