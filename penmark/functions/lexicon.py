"""Fixed word lists and character tables.

FIXED VALUES: these must equal the published lists the reference relies on
for its results, so they are stated as plain text in their natural order.
"""

from __future__ import annotations

import string
import unicodedata

# FIXED VALUES: the 179-word English stop-word list of the NLTK corpus (public).
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so
than too very s t can will just don don't should should've now d ll m o re ve
y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn
wouldn't
""".split())

# FIXED VALUES: ASCII punctuation as Python's string.punctuation defines it.
ASCII_PUNCTUATION = string.punctuation

# FIXED VALUES: Latin letters whose ASCII spelling is not their base letter.
_SPECIAL_FOLDS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o",
    "Ð": "D", "ð": "d", "Þ": "TH", "þ": "th", "Ł": "L", "ł": "l", "Đ": "D",
    "đ": "d", "ı": "i", "Ħ": "H", "ħ": "h", "ŀ": "l", "Ŀ": "L",
}


def _build_ascii_folds() -> tuple[str, str, dict[str, str]]:
    """Single-letter folds derived by rule: NFKD-decompose Latin-1 and Latin
    Extended-A letters and keep the ASCII base letter. Returns the ``translate``
    source and target strings plus the multi-letter replacements."""
    src, dst = [], []
    for code in range(0x00C0, 0x0180):
        ch = chr(code)
        if ch in _SPECIAL_FOLDS:
            continue
        base = unicodedata.normalize("NFKD", ch)[:1]
        if base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    multi = {}
    for ch, rep in _SPECIAL_FOLDS.items():
        if len(rep) == 1:
            src.append(ch)
            dst.append(rep)
        else:
            multi[ch] = rep
    return "".join(src), "".join(dst), multi


FOLD_FROM, FOLD_TO, FOLD_MULTI = _build_ascii_folds()

# FIXED VALUES: characters the reference deletes from file names (backslash is
# not among them: its pattern escapes the colon instead).
FILE_NAME_RESERVED = "~#%&*{}:<>?/+|\"'"

# FIXED VALUES: the cleaning rules for article bodies, applied in this order.
# Kind "tail" cuts from the marker to the end of the text; kind "line" removes
# the marker text only.
CLEANING_MARKERS = (
    ("tail", "ABOUT BRIAN AND AHA!"),
    ("tail", "ABOUT THE AUTHOR"),
    ("tail", "Ian Bremmer is president of"),
    ("line", "If you liked this article and want more content to help you transform into a better leader, join the Radiate community by clicking here."),
    ("line", "For more, read my book, Driver in the Driverless Car, follow me on Twitter: @wadhwa, and visit my website: www.wadhwa.com"),
    ("tail", "“Better Off” is sponsored by Betterment."),
    ("line", "For more, go to JillonMoney.com"),
    ("line", "For more, go to Jill on Money"),
    ("tail", "Image by Flickr User"),
    ("tail", "Dustin McKissen is the founder"),
)

# FIXED VALUES: Penn Treebank tag initial -> lexicon word class; anything else is a noun.
TAG_CLASS = (("N", "n"), ("V", "v"), ("R", "r"), ("J", "a"))
DEFAULT_WORD_CLASS = "n"


# FIXED VALUES: lines that quote or announce a quoted message, as in the loader of the
# public 20-newsgroups collection of scikit-learn (BSD licence).
QUOTE_LINE = r"(writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\||^>)"
