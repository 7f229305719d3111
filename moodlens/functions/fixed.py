"""Fixed values that results depend on.

FIXED VALUES: the lists below must stay exactly as written (text and order), because cleaning
results are defined by them.  They are data, not logic.  Larger lexicons (the ~220-entry emoticon
table, the ~240-entry slang table, the emoji alias tables) are not shipped: callers pass them as a
lexicon DataFrame (see :mod:`moodlens.functions.lexicon`), and the small defaults at the end of this
file are our own.
"""

# --- FIXED VALUES: contraction rules of the social-text cleaner (regex, replacement), applied in
# this order.  Replacements use ``$1`` for the first group (Java syntax); none is word-bounded.
CONTRACTION_RULES = [
    (r"won't", "will not"),
    (r"can't", "cannot"),
    (r"i'm", "i am"),
    (r"ain't", "is not"),
    (r"(\w+)'ll", "$1 will"),
    (r"(\w+)n't", "$1 not"),
    (r"(\w+)'ve", "$1 have"),
    (r"(\w+)'s", "$1 is"),
    (r"(\w+)'re", "$1 are"),
    (r"(\w+)'d", "$1 would"),
    (r"&", "and"),
    (r"dammit", "damn it"),
    (r"dont", "do not"),
    (r"wont", "will not"),
]

# --- FIXED VALUES: emoji table of the classic (pandas-style) cleaner, in this order; each key is
# replaced by the value with one blank on both sides.  Case-sensitive.
CLASSIC_EMOJIS = [
    (":)", "smile"), (":-)", "smile"), (";d", "wink"), (":-E", "vampire"), (":(", "sad"),
    (":-(", "sad"), (":-<", "sad"), (":P", "raspberry"), (":O", "surprised"),
    (":-@", "shocked"), (":@", "shocked"), (":-$", "confused"), (":\\", "annoyed"),
    (":#", "mute"), (":X", "mute"), (":^)", "smile"), (":-&", "confused"), ("$_$", "greedy"),
    ("@@", "eyeroll"), (":-!", "confused"), (":-D", "smile"), (":-0", "yell"), ("O.o", "confused"),
    ("<(-_-)>", "robot"), ("d[-_-]b", "dj"), (":'-)", "sadsmile"), (";)", "wink"),
    (";-)", "wink"), ("O:-)", "angel"), ("O*-)", "angel"), ("(:-D", "gossip"), ("=^.^=", "cat"),
]

# --- FIXED VALUES: stop words of the classic cleaner (a set; order is irrelevant).
CLASSIC_STOPWORDS = [
    "a", "about", "above", "after", "again", "ain", "all", "am", "an",
    "and", "any", "are", "as", "at", "be", "because", "been", "before",
    "being", "below", "between", "both", "by", "can", "d", "did", "do",
    "does", "doing", "down", "during", "each", "few", "for", "from",
    "further", "had", "has", "have", "having", "he", "her", "here",
    "hers", "herself", "him", "himself", "his", "how", "i", "if", "in",
    "into", "is", "it", "its", "itself", "just", "ll", "m", "ma",
    "me", "more", "most", "my", "myself", "now", "o", "of", "on", "once",
    "only", "or", "other", "our", "ours", "ourselves", "out", "own", "re",
    "s", "same", "she", "shes", "should", "shouldve", "so", "some", "such",
    "t", "than", "that", "thatll", "the", "their", "theirs", "them",
    "themselves", "then", "there", "these", "they", "this", "those",
    "through", "to", "too", "under", "until", "up", "ve", "very", "was",
    "we", "were", "what", "when", "where", "which", "while", "who", "whom",
    "why", "will", "with", "won", "y", "you", "youd", "youll", "youre",
    "youve", "your", "yours", "yourself", "yourselves",
]

# --- FIXED VALUES: Spark ML's default English stop-word list (StopWordsRemover, Spark 4.1),
# stated here so SQL oracles can use the same list without a JVM.
SPARK_ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should",
    "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've",
    "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's",
    "where's", "who's", "why's", "would",
]

# --- FIXED VALUES: part-of-speech tag prefixes kept by the social cleaner
# (adjective, adverb, verb, noun).
ALLOWED_TAG_PREFIXES = ["J", "R", "V", "N"]

# --- FIXED VALUES: HTML entities decoded natively (the common subset), ``&amp;`` last so that an
# escaped entity such as ``&amp;lt;`` decodes once, to ``&lt;``.
COMMON_HTML_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"),
    ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"),
]

# --- Our own small default lexicons (not the reference's tables).  Pass the full tables as a
# lexicon DataFrame for real use.
DEFAULT_EMOTICONS = [
    (":)", "happy"), (":-)", "happy"), (":(", "sad"), (":-(", "sad"), (";)", "wink"),
    (";-)", "wink"), (":d", "laugh"), (":p", "playful"), (":o", "surprise"), (":/", "unsure"),
    (":'(", "crying"), ("<3", "love"), ("(^_^)", "joy"), ("(-_-)", "bored"),
]

DEFAULT_ABBREVIATIONS = [
    ("lol", "laughing out loud"), ("brb", "be right back"), ("btw", "by the way"),
    ("imo", "in my opinion"), ("idk", "i do not know"), ("omg", "oh my god"),
    ("thx", "thanks"), ("u", "you"), ("ur", "your"), ("w/", "with"), ("b4", "before"),
    ("gr8", "great"), ("tbh", "to be honest"), ("asap", "as soon as possible"),
    ("lol!", "laughing out loud"), ("tl;dr", "too long did not read"),
]

# Our own small default lexicons for the re-aimed tagger and lemmatizer (token -> tag / lemma).
DEFAULT_POS_TAGS = [
    ("good", "JJ"), ("bad", "JJ"), ("happy", "JJ"), ("sad", "JJ"), ("really", "RB"),
    ("very", "RB"), ("love", "VB"), ("hate", "VB"), ("say", "VB"), ("is", "VBZ"),
    ("the", "DT"), ("a", "DT"), ("an", "DT"), ("and", "CC"), ("or", "CC"), ("but", "CC"),
    ("of", "IN"), ("in", "IN"), ("on", "IN"), ("at", "IN"), ("to", "TO"), ("it", "PRP"),
    ("they", "PRP"), ("we", "PRP"), ("you", "PRP"), ("i", "PRP"),
]

DEFAULT_LEMMAS = [
    ("cats", "cat"), ("dogs", "dog"), ("days", "day"), ("words", "word"), ("geese", "goose"),
    ("feet", "foot"), ("mice", "mouse"), ("children", "child"), ("women", "woman"), ("men", "man"),
]

# Our own small alias → emoji table for ``emojize``/``demojize`` (the full alias tables are passed in
# as a lexicon DataFrame).  ``:+1:`` repeats an emoji, so the inverse keeps the later alias.
DEFAULT_EMOJI_ALIASES = [
    (":thumbs_up:", "\U0001F44D"), (":red_heart:", "❤️"), (":grinning_face:", "\U0001F600"),
    (":crying_face:", "\U0001F622"), (":fire:", "\U0001F525"), (":winking_face:", "\U0001F609"),
    (":+1:", "\U0001F44D"), (":party_popper:", "\U0001F389"),
]
