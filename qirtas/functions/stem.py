"""Root stemming of Arabic words after Taghva, Elkhoury and Coombs (ITCC 2005).

The published algorithm strips affixes by length and then reduces words of four
to seven letters to a root by letter patterns.  A pattern is "fixed letters at
some positions, root letters at the others", which is exactly a regular
expression with one group per root letter run.  The first matching pattern
wins, as the first matching alternative of a regular expression does.  So each
stage is one ``regexp_replace`` over the *whole cleaned text*: no token array,
no vocabulary join, no shuffle, and whole-stage code generation stays on.

Patterns are written as words: a dot is a root letter and is kept, any other
letter or [set] must be present and is dropped; "(.)" followed by "=" asks for
the same root letter twice and keeps it once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm ------------------------------------
# A prefix goes only when three letters stay, a suffix likewise.
LONG_PREFIXES = "كال بال ولل وال ال لل".split()
LONG_SUFFIXES = (
    "تمل همل تان تين كمل "
    "ون ات ان ين تن كم هن نا يا ها تم كن ني وا ما هم"
).split()
SHORT_PREFIX = "[لبفسويتنا]"
SHORT_SUFFIX = "[ةهيكتان]"

SEVEN = f"......{SHORT_SUFFIX} {SHORT_PREFIX}......".split()
SIX = (
    "است... مست... م..ا.ة ا.ت.ا. ا.(.)و=. ت.ا.ي. "
    f".....{SHORT_SUFFIX} {SHORT_PREFIX}....."
).split()
FIVE = (
    "ا.[ات].. م..[ايو]. [اتم]...ة [ميت].ت.. [مت].ا.. ..[او].ة [ام]ن... "
    "ا..ا. ...ان ت..ي. .ا.و. .وا.. ..ائ. .ا..ة ..ا.ي "
    f"....{SHORT_SUFFIX} {SHORT_PREFIX}...."
).split()
FOUR = f"م... .ا.. ..[اوي]. ...ة ...{SHORT_SUFFIX} {SHORT_PREFIX}...".split()
FIVE_TO_FOUR = "[اتم].... ....ة ..ا..".split()
SIX_TO_FOUR = "ا...ا. مت....".split()

# Words the algorithm leaves alone.
KEPT_WORDS = (
    "يكون وليس وكان كذلك التي وبين عليها مساء الذي وكانت ولكن والتي تكون اليوم "
    "اللذين عليه كانت لذلك أمام هناك منها مازال لازال لايزال مايزال اصبح أصبح "
    "أمسى امسى أضحى اضحى مابرح مافتئ ماانفك لاسيما ولايزال الحالي اليها الذين "
    "فانه والذي وهذا لهذا فكان ستكون اليه يمكن بهذا الذى"
).split()
# -----------------------------------------------------------------------------

# Words are anchored on the one blank before them, so a scan jumps from blank to
# blank.  A kept word gets a mark in place of that blank and is never entered.
_MARK = "\u0001"
_LETTER = "[^ \u0001]"
_END = "(?![^ \u0001])"


def _trie(words: list[str]) -> str:
    """Words as a regex that shares common beginnings."""
    tails: dict[str, list[str]] = {}
    for word in words:
        tails.setdefault(word[:1], []).append(word[1:])
    optional = tails.pop("", None) is not None
    branches = [head + (_trie(rest) if any(rest) else "") for head, rest in tails.items()]
    return "(?:" + "|".join(branches) + ")" + ("?" if optional else "")


def _stage(*lengths: list[str]) -> tuple[str, str]:
    """Ordered patterns as (regex, replacement); each list holds one word length."""
    groups = 0
    by_length = []
    for patterns in lengths:
        size = 0
        alternatives = []
        for pattern in patterns:
            regex, size = "", 0
            for part in re.findall(r"\(\.\)|\.+|\[[^]]*\]|.", pattern):
                letters = part.count(".") or 1
                size += letters
                if "." in part:
                    groups += 1
                    regex += "(" + _LETTER * letters + ")"
                elif part == "=":
                    regex += f"\\{groups}"
                else:
                    regex += part
            alternatives.append(regex)
        body = "|".join(alternatives)
        by_length.append(f"(?={_LETTER}{{{size}}}{_END})(?:{body})")
    kept = "".join(f"${g}" for g in range(1, groups + 1))
    return f" (?:{'|'.join(by_length)})", f" {kept}"


_HAMZA = (" [آأإ]", " ا")

# Order matters.  Each stage matches words of its own lengths only, so a word
# that an earlier stage shortened meets exactly the stages meant for its new
# length.  The last stage ends the work on a word, whatever its length, so its
# three lists share one scan.
_AFFIXES: list[tuple[str, str]] = [
    (f" ({_trie(KEPT_WORDS)}{_END})", f"{_MARK}$1"),
    (f" {_trie(LONG_PREFIXES)}(?={_LETTER}{{3}})", " "),
    (f" ({_LETTER}{{3,}}?){_trie(LONG_SUFFIXES)}{_END}", " $1"),
    (f" و(?=و{_LETTER}{{2}})", " "),
]
_PATTERNS: list[tuple[str, str]] = [
    _stage(SEVEN),
    _stage(SIX),
    _stage(FIVE),
    _stage(FOUR, FIVE_TO_FOUR, SIX_TO_FOUR),
]


def stem_text(cleaned: Column, folded: bool = True) -> Column:
    """Stem every word of a cleaned, space-separated text (or a single word).

    ``folded=False`` also turns a leading alef with hamza or madda into a bare
    alef, which the cleaner has done already.
    """
    text = F.concat(F.lit(" "), cleaned)
    for regex, replacement in [*_AFFIXES, *([] if folded else [_HAMZA]), *_PATTERNS]:
        text = F.regexp_replace(text, regex, replacement)
    return F.trim(F.translate(text, _MARK, " "))
