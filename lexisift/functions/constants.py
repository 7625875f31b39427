"""Results depend on them, so they are stated literally."""

# Delimiter characters of the tokenizers. The second set is the one
# that leaves the dollar sign inside a token.
DELIMITERS = r"""()[]{}.!?,;:+=-_"'`~#@&*%€$§\/"""
DELIMITERS_WITHOUT_DOLLAR = r"""()[]{}.!?,;:+=-_"'`~#@&*%€§\/"""

# Character classes (regular expression syntax of both Java and RE2).
ASCII_DIGITS = "0-9"
UNICODE_DIGITS = r"\p{Nd}"
JAVA_WHITESPACE = r"\t\n\x0B\f\r "
UNICODE_WHITESPACE = r"\t\n\x0B\f\r\x1c-\x1f\x85\p{Z}"
BLANK_AND_TAB = r"\t "
WORD_CHARACTERS = r"\p{L}\p{N}_"

# Fixed value: characters that stripping removes from both ends of a word.
STRIPPED = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
            "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# Defaults of the term ranking and of the feature stages.
TOP_K = 75
MIN_TERM_LENGTH = 2
VOCABULARY_SIZE = 50_000
MIN_DOCUMENT_FREQUENCY = 2
DEFAULT_VOCABULARY_SIZE = 1 << 18
DEFAULT_DOCUMENT_FREQUENCY = 1
SELECTED_FEATURES = 2_000
SELECTED_FEATURES_HEAVY = 500
SVM_MAX_ITER = 50
SVM_REG_PARAM = 0.1

# Parameter grids (regParam x standardization x maxIter).
GRID_REG_PARAM = (0.01, 0.1, 1.0)
GRID_STANDARDIZATION = (True, False)
GRID_MAX_ITER = (10, 50)
GRID_MAX_ITER_LONG = (50, 200)
GRID_NUM_FEATURES = (500, 2_000)
GRID_REG_PARAM_DRAFT = (0.001, 0.01, 0.1)
GRID_MAX_ITER_DRAFT = (10, 8)


def char_class(*parts: str) -> str:
    """One regex class out of ready-made ranges and plain delimiter characters."""
    return "[" + "".join(parts) + "]"


def escaped(characters: str) -> str:
    """Delimiter characters escaped for use inside a regex class."""
    return "".join("\\" + c if c in r"\[]-^&~" else c for c in characters)


TRANSLATE_PATTERN = char_class(UNICODE_WHITESPACE, ASCII_DIGITS, escaped(DELIMITERS)) + "+"
TRANSLATE_PATTERN_WITHOUT_DOLLAR = (
    char_class(UNICODE_WHITESPACE, ASCII_DIGITS, escaped(DELIMITERS_WITHOUT_DOLLAR)) + "+")
REGEX_PATTERN = char_class(UNICODE_WHITESPACE, UNICODE_DIGITS, escaped(DELIMITERS)) + "+"
REPLACE_PATTERN = char_class(ASCII_DIGITS, escaped(DELIMITERS_WITHOUT_DOLLAR)) + "+"
ML_PATTERN_LITERAL = char_class(BLANK_AND_TAB, ASCII_DIGITS, escaped(DELIMITERS)) + "+"
ML_PATTERN = char_class(JAVA_WHITESPACE, ASCII_DIGITS, escaped(DELIMITERS)) + "+"
# The characters of those two classes.
ML_DELIMITERS = {ML_PATTERN_LITERAL: "\t 0123456789" + DELIMITERS, ML_PATTERN: "\t\n\x0b\f\r 0123456789" + DELIMITERS}

# A run of word characters and apostrophes, optionally hyphenated. Possessive
# repetition keeps the matcher iterative, so a chain of any length is safe.
WORD_RUN_PATTERN = rf"[{WORD_CHARACTERS}']++(?:-[{WORD_CHARACTERS}']++)*+"
