"""Token ids of whole texts, put together from the ids of their words.

The vocabulary's rules drop white space and never let a token or a special
string reach across it, and no character composes with a space before it.  So a
text's ids are the ids of its words (runs without ASCII white space) in order,
and each distinct word has to be encoded once.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
from functools import lru_cache

from tokenizers import Tokenizer

# A Python worker remembers the latest words, at most twice so many (about 120 MB).
MEMO_WORDS = 300_000


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """The file's tokenizer without truncation and padding; refuses unsuitable rules."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    for token in found.get_added_tokens_decoder().values():
        if token.lstrip or token.rstrip or token.content.split() != [token.content]:
            raise ValueError(f"special string {token.content!r} can reach across white space")
    return found


@lru_cache(maxsize=2)
def drops_white_space(path: str) -> bool:
    """Does white space end every token and vanish, and does case not matter?"""
    t = tokenizer(path)
    ids = lambda s: t.encode(s, add_special_tokens=False).ids
    spaced = all(ids(f"ab{c}cd") == ids("ab") + ids("cd") for c in " \t\n\r\x0b\x0c")
    return spaced and ids("aB") == ids("ab") and not ids(" \n")


# A capital that may compose with what follows, and then into a letter that is
# lower-cased (or not, as J with U+030C) as a whole.
COMPOSING = re.compile(rb"[A-Z](?=[\x80-\xff])")


def split_words(text: str | None, marks: tuple[bytes, ...]) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased unless a special string may occur.

    The vocabulary composes first and lower-cases last, so a capital before
    anything but ASCII stays for it to do.
    """
    raw = (text or "").encode()
    if not any(m in raw for m in marks):
        if raw.isascii():
            return raw.lower().split()
        lower = bytearray(raw.lower())
        for m in COMPOSING.finditer(raw):
            lower[m.start()] = raw[m.start()]
        raw = bytes(lower)
    return raw.split()


@lru_cache(maxsize=2)
def special_marks(path: str) -> tuple[bytes, ...]:
    """What a text must contain to hold a special string, whatever its case."""
    added = tokenizer(path).get_added_tokens_decoder().values()
    return tuple({t.content.encode()[:2] for t in added})


# Lower-case letters (ASCII and Latin-1), then ASCII punctuation: the vocabulary's
# rules leave both runs as they are and always cut between them.
LETTERS_TAIL = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")
KNOWN_RULES = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
LETTER_RUNS = r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@lru_cache(maxsize=2)
def bare_tokenizer(path: str) -> Tokenizer | None:
    """The tokenizer without the rules that leave a run of letters as it is.

    None, if the file has other rules than those that are known to do so, or a
    special string that letters and punctuation could hold.
    """
    rules = json.loads(tokenizer(path).to_str())
    cut, *others = (rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    known = (rules["normalizer"] or {}).get("normalizers") == KNOWN_RULES
    known = known and cut.get("type") == "Split" and cut["pattern"].get("Regex", "").endswith(LETTER_RUNS)
    special = [t.content.encode() for t in tokenizer(path).get_added_tokens_decoder().values()]
    if not known or any(LETTERS_TAIL.fullmatch(b"a" + s.lower()) for s in special):
        return None
    rules["normalizer"], rules["added_tokens"] = None, []
    rules["pre_tokenizer"]["pretokenizers"] = others
    return Tokenizer.from_str(json.dumps(rules))


def packed_ids(encoder: Tokenizer, words: list[bytes]) -> list[bytes]:
    found = encoder.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
    return [struct.pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in found)]


def encode_words(path: str, words: list[bytes], memo: dict[bytes, bytes] | None = None) -> list[bytes]:
    """Ids of each word as little-endian unsigned 32-bit integers.

    Letters and the punctuation behind them are encoded apart, so words that
    differ in punctuation share the work; ``memo`` remembers such parts.
    """
    memo = {} if memo is None else memo
    bare = bare_tokenizer(path)
    matches = [LETTERS_TAIL.fullmatch(w) if bare else None for w in words]
    pairs = [m.groups() if m else (w, b"") for w, m in zip(words, matches, strict=True)]
    letters = list({m[1] for m in matches if m}.difference(memo))
    if letters:
        memo.update(zip(letters, packed_ids(bare, letters), strict=True))
    rest = list({part for pair in pairs for part in pair}.difference(memo))
    memo.update(zip(rest, packed_ids(tokenizer(path), rest), strict=True))
    return [memo[run] + memo[tail] for run, tail in pairs]


class WordIds:
    """Encodes texts; remembers a bounded number of words.

    When ``memo_words`` have come together they are set aside for those before
    them; a word that is met again while it lies there comes back, so frequent
    words are never encoded anew.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        if not drops_white_space(path):
            raise ValueError(f"{path}: tokens of this vocabulary reach across white space")
        self.path, self.limit = path, memo_words
        self.marks = special_marks(path)
        self.memo: dict[bytes, bytes] = {}
        self.aside: dict[bytes, bytes] = {}

    def blobs(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        split = [split_words(t, self.marks) for t in texts]
        if len(self.memo) > self.limit:
            self.aside, self.memo = self.memo, {}
        unmet = set().union(*split).difference(self.memo)
        back = {w: self.aside[w] for w in unmet if w in self.aside}
        self.memo.update(back)
        new = list(unmet.difference(back))
        self.memo.update(zip(new, encode_words(self.path, new, self.memo), strict=True))
        get = self.memo.__getitem__
        return [b"".join(map(get, words)) for words in split]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per Python worker and vocabulary, so that tasks share what it remembers.

    Words make no reference cycles, so the worker's collector may look seldom.
    """
    gc.set_threshold(500_000, 50)
    return WordIds(path)

