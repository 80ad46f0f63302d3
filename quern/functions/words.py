"""Word lists and character tables for text cleaning."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

# Common English stop words, as in public natural-language toolkits.
ENGLISH = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've now
d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't
wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Further words left out of cleaned text.
EXTRA = [
    "from", "subject", "re", "edu", "use", "like", "im", "know", "just", "dont", "thats", "right",
    "people", "youre", "got", "gonna", "time", "think", "yeah", "said", "say", "\\s", "mr", "Mr",
    "said", "says", "saying", "today", "be", "one", "two", "three", "four", "five", "six", "seven",
    "eight", "nine", "ten", "however", "i", "ii", "iii", "iv", "v", "vii", "viii", "ix", "x", "xi",
    "xii", "xiii", "xiv", "often", "called", "new", "date", "fully", "thus", "new", "include", "http",
    "www", "doi", "preprint", "copyright", "peer", "reviewed", "org", "https", "et", "al", "author",
    "figure", "rights", "reserved", "permission", "used", "using",
]

# Words left out of frequency clouds on top of the stop words.
CLOUD_EXTRA = ["t", "co", "https", "amp", "U"]

STOP_WORDS = sorted({*ENGLISH, *EXTRA})


@cache
def accent_table() -> tuple[str, str]:
    """Letters that are one base letter plus marks, and their base letters, for ``translate``."""
    accented, plain = [], []
    for code in range(0xC0, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        parts = unicodedata.normalize("NFD", chr(code))
        base = "".join(c for c in parts if unicodedata.category(c) != "Mn")
        if len(parts) > 1 and len(base) == 1 and base != chr(code):
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)
