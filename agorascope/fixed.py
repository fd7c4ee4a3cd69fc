"""Lists and patterns that results depend on."""

# Characters removed by strip (Unicode white space and the four ASCII separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ASCII punctuation stripped from both ends of a word before lexicon lookup.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Patterns.
URL_PATTERN = r"http\S+|www\S+"
NOT_ALNUM_PATTERN = r"[^a-z0-9\s]"
MENTION_PATTERN = r"(?i)(?:^|[(" + WHITESPACE + r"])(?:u/|/u/)([A-Za-z0-9_-]{3,20})"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
MARKDOWN_LINK_PATTERN = r"\[([^\]]+)\]\([^)]+\)"

# Account names that stand for "nobody" (compared in lower case).
NO_ACCOUNT = ["[deleted]", "deleted", "none", "null"]

# Label vocabularies, ordered negative, neutral, positive.
SHORT_LABELS = ("neg", "neu", "pos")
LONG_LABELS = ("negative", "neutral", "positive")

# Rule constants of the published compound score (Hutto & Gilbert 2014).
BOOST = 0.293
CAPS_BOOST = 0.733
NEGATION_FACTOR = -0.74
NEVER_FACTOR = 1.25
BOOST_DECAY = (1.0, 0.95, 0.9)
CONTRAST_BEFORE = 0.5
CONTRAST_AFTER = 1.5
EXCLAMATION_STEP = 0.292
QUESTION_STEP = 0.18
QUESTION_MAX = 0.96
NORMALISER = 15.0

# Degree words that strengthen the word after them (common ones; callers can pass their own lists).
STRENGTHENERS = [
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably",
    "decidedly", "deeply", "enormous", "enormously", "entirely", "especially", "exceptional",
    "exceptionally", "extreme", "extremely", "fabulously", "flipping", "flippin", "frackin",
    "fracking", "fricking", "frickin", "frigging", "friggin", "fully", "greatly", "hella",
    "highly", "hugely", "incredible", "incredibly", "intensely", "major", "majorly", "more",
    "most", "particularly", "purely", "quite", "really", "remarkably", "so", "substantially",
    "thoroughly", "total", "totally", "tremendous", "tremendously", "uber", "unbelievably",
    "unusually", "utter", "utterly", "very",
]

# Degree words that weaken the word after them.
WEAKENERS = [
    "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little", "marginal",
    "marginally", "occasional", "occasionally", "partly", "scarce", "scarcely", "slight",
    "slightly", "somewhat", "sorta", "sortof", "sort-of",
]

# Negating words; any word holding "n't" negates as well.
NEGATORS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "dont", "hadnt",
    "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither", "neednt", "never", "none", "nope",
    "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "without", "wont", "wouldnt", "rarely", "seldom", "despite",
]
