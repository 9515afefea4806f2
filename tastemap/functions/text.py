"""Text cleaning as one native regular expression."""

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII punctuation, digits, and what counts as Unicode whitespace.
# Java's own \s is ASCII only, so the latter is written out.
PUNCTUATION = string.punctuation
DIGITS = string.digits
LOW_WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
HIGH_WHITESPACE = r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_BREAKS_AND_TABS = "\r\t\n"


def _listed(characters: str) -> str:
    # Java looks up single characters below 256 in a bit set; ranges it tries in turn.
    return "".join(f"\\x{ord(c):02x}" for c in characters)


# The outer range lets letters skip the test for the rarer blanks.
BLANK_RUN = (f"[{_listed(PUNCTUATION + DIGITS + LOW_WHITESPACE)}"
             rf"[\u1680-\u3000&&[{HIGH_WHITESPACE}]]]++")
BLANK = f"[{_listed(PUNCTUATION + DIGITS + LINE_BREAKS_AND_TABS)}]"


def clean_text(text, collapse: bool = True) -> Column:
    """Blank out punctuation, digits and whitespace; neither trim nor lower-case.

    A whole run of such characters becomes one space. With ``collapse=False``
    each punctuation mark, digit, tab or line break becomes its own space and
    other whitespace stays.
    """
    return F.regexp_replace(text, BLANK_RUN if collapse else BLANK, " ")
