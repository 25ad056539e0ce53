"""Fixed word values used by the tokenizer."""

# Words that carry the opinion and therefore are never stop words.
NEGATIONS = ("no", "nor", "not", "never")

# Endings that become tokens of their own after an apostrophe.
CLITICS = ("ll", "re", "ve", "s", "m", "d")

# Default lemma dictionary: irregular English forms. A user table replaces it.
LEMMAS = {
    "n't": "not", "'m": "be", "'re": "be", "'ve": "have", "'ll": "will", "'d": "would",
    "am": "be", "are": "be", "is": "be", "was": "be", "were": "be", "been": "be", "being": "be",
    "has": "have", "had": "have", "having": "have",
    "does": "do", "did": "do", "done": "do", "doing": "do",
    "goes": "go", "went": "go", "gone": "go", "going": "go",
    "says": "say", "said": "say", "saying": "say",
    "gets": "get", "got": "get", "gotten": "get", "getting": "get",
    "makes": "make", "made": "make", "making": "make",
    "knows": "know", "knew": "know", "known": "know", "knowing": "know",
    "thinks": "think", "thought": "think", "thinking": "think",
    "takes": "take", "took": "take", "taken": "take", "taking": "take",
    "sees": "see", "saw": "see", "seen": "see", "seeing": "see",
    "comes": "come", "came": "come", "coming": "come",
    "gives": "give", "gave": "give", "given": "give", "giving": "give",
    "finds": "find", "found": "find", "finding": "find",
    "tells": "tell", "told": "tell", "telling": "tell",
    "feels": "feel", "felt": "feel", "feeling": "feel",
    "leaves": "leave", "left": "leave", "leaving": "leave",
    "keeps": "keep", "kept": "keep", "keeping": "keep",
    "begins": "begin", "began": "begin", "begun": "begin", "beginning": "begin",
    "writes": "write", "wrote": "write", "written": "write", "writing": "write",
    "films": "film", "movies": "movie", "actors": "actor", "scenes": "scene",
    "men": "man", "women": "woman", "children": "child", "people": "people",
    "lives": "life", "wives": "wife", "feet": "foot", "mice": "mouse",
    "better": "good", "best": "good", "worse": "bad", "worst": "bad",
}

# English inflections as (ending, what replaces it, whether a doubled consonant goes as well), in the
# order in which they are tried.
DETACHMENTS = (
    ("sses", "ss", False), ("ies", "y", False), ("ies", "ie", False), ("ves", "f", False), ("ves", "fe", False),
    ("s", "", False), ("es", "", False),
    ("ied", "y", False), ("ed", "", True), ("ed", "e", False), ("ed", "", False),
    ("ying", "ie", False), ("ing", "", True), ("ing", "e", False), ("ing", "", False),
    ("iest", "y", False), ("ier", "y", False),
)
