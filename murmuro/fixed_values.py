"""Word lists, patterns, constants and formats that results depend on."""

# Custom stop words, added to the English list.
CUSTOM_STOP_WORDS = [
    "game", "video", "trailer", "youtube", "comment", "like", "watch",
    "im", "dont", "thats", "got", "get", "go", "one", "also", "would",
    "really", "back", "us", "u", "ur", "lol", "yeah", "gonna", "wanna",
]

# English stop words (the common public list of function words).
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself
she she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain
aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't
mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Contractions the standard English tokeniser splits in two.
SPLIT_CONTRACTIONS = [("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na")]

# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Cleaning patterns.
TAG = r"<[^>]+>"
URL = r"https?://\S+|www\.\S+"
NON_PRINTABLE = r"[^\t\n\r\x20-\x7E\x{A0}-\x{FFFF}]"
TOKEN_URL = r"http\S+|www\.\S+"
TOKEN_TAG = r"(?d)<.*?>"
MIN_TEXT_LENGTH = 3

# CSV cells read as missing.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Entity labels kept by named-entity extraction.
KEPT_ENTITY_LABELS = ["PERSON", "ORG", "PRODUCT", "GPE", "LOC", "WORK_OF_ART", "EVENT", "NORP"]

# Default labels and score threshold of caller-labelled entity extraction.
DOMAIN_LABELS = ["game feature", "character name", "platform", "release date", "company/studio", "price"]
DOMAIN_THRESHOLD = 0.4

# The eight emotions, in report order.
EMOTIONS = ["joy", "trust", "anticipation", "surprise", "sadness", "fear", "anger", "disgust"]

# Suffix rules of the pattern tagger, first match wins; then numbers, then noun.
SUFFIX_TAGS = [("ing", "VBG"), ("ed", "VBD"), ("es", "VBZ"), ("ould", "MD"), ("'s", "NN$"), ("s", "NNS")]
NUMBER = r"^-?[0-9]+(.[0-9]+)?$"
NUMBER_TAG, OTHER_TAG = "CD", "NN"

# Closed-class words and their tags, looked up before the suffix rules.
CLOSED_CLASS = {
    "DT": ["a", "an", "the", "this", "that", "these", "those", "each", "every", "some", "any", "all", "no"],
    "IN": ["of", "in", "on", "at", "by", "for", "with", "from", "as", "into", "about", "than", "if", "because"],
    "TO": ["to"],
    "CC": ["and", "or", "but", "nor"],
    "PRP": ["i", "you", "he", "she", "it", "we", "they", "me", "him", "them", "us"],
    "PRP$": ["my", "your", "his", "her", "its", "our", "their"],
    "VBZ": ["is", "has", "does"],
    "VBP": ["am", "are", "have", "do"],
    "VBD": ["was", "were", "had", "did"],
    "VB": ["be"],
    "MD": ["can", "will", "may", "must", "might", "shall"],
    "RB": ["not", "never", "very", "too", "also", "just"],
}

# Punctuation kept as tokens of their own by the tagger.
SENTENCE_MARKS = ".,!?;:"

# Noun suffix detachment rules (ending -> replacement).
DETACHMENTS = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
    ("men", "man"), ("ies", "y"),
]

# Constants of the rule-based sentiment score (Hutto & Gilbert, 2014).
BOOST_UP, BOOST_DOWN = 0.293, -0.293
CAPS_BOOST, NEGATION = 0.733, -0.74
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, QUESTION, MANY_QUESTIONS = 0.292, 0.18, 0.96
NORMALISER = 15.0
SENTIMENT_CUT = 0.05
NEGATORS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't dont hadnt hasnt
havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none nope nor
not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont
wouldnt won't wouldn't rarely seldom despite
""".split()
BOOSTERS_UP = """
absolutely amazingly awfully completely considerable considerably decidedly deeply enormous enormously entirely
especially exceptional exceptionally extreme extremely fabulously flipping frackin fracking fully greatly hella highly
hugely incredible incredibly intensely major majorly more most particularly purely quite really remarkably so
substantially thoroughly total totally tremendous tremendously uber unbelievably unusually utter utterly very
""".split()
BOOSTERS_DOWN = """
almost barely hardly less little marginal marginally occasional occasionally partly scarce scarcely slight slightly
somewhat
""".split()

# Topic and retrieval defaults.
MIN_TOPIC_SIZE = 30
MIN_GROUP_SIZE = 50
TOP_K = 6
BM25_K1, BM25_B, BM25_EPSILON = 1.5, 0.75, 0.25
RANK_FUSION_CONSTANT = 60
QUERY_CATEGORIES = ["sentiment", "summary", "topics", "qa"]
SPECIALISTS = {
    "qa": "qa_agent",
    "summary": "summary_agent",
    "sentiment": "sentiment_agent",
    "topics": "topic_agent",
}

# Chunking defaults.
CHUNK_SIZE, CHUNK_OVERLAP = 250, 25
TOKEN_CHUNK_SIZE, TOKEN_CHUNK_OVERLAP = 100, 10
BREAK_PERCENTILE = 95

# Emoji code point ranges (single signs; modifiers and joiners extend them).
EMOJI = (
    r"[\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{21AA}\x{231A}-\x{23FF}\x{24C2}\x{25AA}-\x{25FE}"
    r"\x{2600}-\x{27BF}\x{2934}-\x{2935}\x{2B05}-\x{2B55}\x{3030}\x{303D}\x{3297}\x{3299}\x{1F000}-\x{1FAFF}]"
)
EMOJI_MODIFIERS = r"[\x{FE0F}\x{1F3FB}-\x{1F3FF}\x{20E3}]"
EMOJI_JOINER = r"\x{200D}"
