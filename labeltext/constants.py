"""Fixed values.

Everything here is data, not logic: results only match if these values are
exactly as stated.
"""

# --- Fixed values: the sixteen label codes -----------------------------------
TYPE_CODES = (
    "INTJ", "INTP", "ENTJ", "ENTP",
    "INFJ", "INFP", "ENFJ", "ENFP",
    "ISTJ", "ISFJ", "ESTJ", "ESFJ",
    "ISTP", "ISFP", "ESTP", "ESFP",
)

# --- Fixed values: the four letter axes (name, position, letters) ------------
LETTER_AXES = (
    ("E/I", 1, ("E", "I")),
    ("S/N", 2, ("S", "N")),
    ("T/F", 3, ("T", "F")),
    ("J/P", 4, ("J", "P")),
)

# --- Fixed values: the 127 English stop words --------------------------------
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he
    him his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few
    more most other some such no nor not only own same so than too very s t can
    will just don should now
    """.split()
)

# --- Fixed values: description per label code --------------------------------
TYPE_DESCRIPTIONS = {
    "INTJ": "Architect - Strategic thinkers with innovative ideas",
    "INTP": "Logician - Innovative inventors with an unquenchable thirst for knowledge",
    "ENTJ": "Commander - Bold, imaginative and strong-willed leaders",
    "ENTP": "Debater - Smart and curious thinkers who cannot resist an intellectual challenge",
    "INFJ": "Advocate - Quiet and mystical, yet inspiring and tireless idealists",
    "INFP": "Mediator - Poetic, kind and altruistic people, always eager to help a good cause",
    "ENFJ": "Protagonist - Charismatic and inspiring leaders, able to mesmerize their listeners",
    "ENFP": "Campaigner - Enthusiastic, creative and sociable free spirits",
    "ISTJ": "Logistician - Practical and fact-minded individuals, reliable and responsible",
    "ISFJ": "Defender - Very dedicated and warm protectors, always ready to defend their loved ones",
    "ESTJ": "Executive - Excellent administrators, unsurpassed at managing things or people",
    "ESFJ": "Consul - Extraordinarily caring, social and popular people",
    "ISTP": "Virtuoso - Bold and practical experimenters, masters of all kinds of tools",
    "ISFP": "Adventurer - Flexible and charming artists, ready to explore and experience the world",
    "ESTP": "Entrepreneur - Smart, energetic and perceptive people",
    "ESFP": "Entertainer - Spontaneous, energetic and enthusiastic entertainers",
}
NO_DESCRIPTION = "No description available"

# --- Fixed values: settings of the jobs --------------------------------------
MIN_WORDS, MAX_WORDS = 10, 1000          # kept text lengths, both ends included
VALIDATION_SHARE, SPLIT_SEED = 0.2, 42
TOP_WORDS_K, TOP_TFIDF_K, TOP_MI_K = 20, 10, 10
STATS_VOCABULARY = 10_000                # terms kept for class TF-IDF and MI
SEQUENCE_WORDS, SEQUENCE_LENGTH = 10_000, 500
OOV_INDEX, PAD_INDEX = 1, 0
SVD_COMPONENTS = 300
LOW_CONFIDENCE, ALTERNATIVES_K = 70.0, 3
LOG_LOSS_EPSILON = 1e-10

# --- Fixed values: every white-space character --------------------------------
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- Fixed values: characters replaced by a space by the sequence tokenizer --
SEQUENCE_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'

#: Classes of one label column: they are held on the driver and in one row.
MAX_CLASSES = 10_000
