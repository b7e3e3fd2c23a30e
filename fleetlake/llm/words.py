"""Pre-splitting of texts into words, and a bounded memo of what a word becomes.

Byte-pair merges never cross a word, so a text's ids are the ids of its words.
Most words of a corpus repeat; a worker keeps what it made of the latest ones.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import regex
from tokenizers import Tokenizer

# The split patterns of the two public vocabularies.
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOWER_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_NARROW_END = 0x250  # Latin letters with and without marks
_WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0"  # all of the property below that end


def _ranges(initial: str) -> str:
    """The characters below the end whose category begins so, as the inside of a class."""
    codes = [c for c in range(_NARROW_END) if unicodedata.category(chr(c))[0] == initial]
    starts = [c for c in codes if c - 1 not in codes]
    ends = [c for c in codes if c + 1 not in codes]
    return "".join(
        f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(starts, ends, strict=True)
    )


def _narrow(pattern: str) -> re.Pattern:
    """The same pattern for texts below the end; the standard engine runs twice as fast."""
    letters, numbers, white = _ranges("L"), _ranges("N"), re.escape(_WHITE_SPACE)
    outside = re.sub(r"\[[^]]*\]", lambda m: m[0].replace(r"\s", white), pattern)
    outside = outside.replace(r"\S", f"[^{white}]").replace(r"\s", f"[{white}]")
    inside = re.sub(
        r"\[[^]]*\]",
        lambda m: m[0].replace(r"\p{L}", letters).replace(r"\p{N}", numbers),
        outside,
    )
    return re.compile(inside.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]"))


_wide = re.compile(f"[^\x00-{chr(_NARROW_END - 1)}]").search


def is_wide(text: str) -> bool:
    """Whether a text has characters beyond the Latin ones."""
    return not text.isascii() and bool(_wide(text))


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function from a text to its words."""
    general = regex.compile(pattern).findall
    narrow = _narrow(pattern).findall
    return lambda text: general(text) if is_wide(text) else narrow(text)


class Agreement:
    """Whether two functions of texts agree on all characters of a text.

    Libraries know different versions of Unicode, and so may disagree on what is
    a letter. Each character is tried once, next to a letter, a sign and a digit.
    """

    def __init__(self, own: Callable, library: Callable):
        self.own, self.library = own, library
        self.known: dict[str, bool] = {}

    def __call__(self, text: str) -> bool:
        if not is_wide(text):
            return True
        return all([self._try(c) for c in set(text)])

    def _try(self, character: str) -> bool:
        found = self.known.get(character)
        if found is None:
            tries = [f"{x}{character}{x}" for x in ("a", "!", "1", " ", "")]
            found = all(self.own(t) == self.library(t) for t in tries)
            self.known[character] = found
        return found


def lower_words(path: str) -> Callable[[str], list[str]]:
    """A function from a text to its lower-cased words, as the file's own library splits it."""
    split, library = splitter(LOWER_WORDS), Tokenizer.from_file(path)
    byte_of = {c: b for b, c in enumerate(byte_characters())}

    def own(text: str) -> list[str]:
        return split(lower_normal(text))

    def by_library(text: str) -> list[str]:
        normal = library.normalizer.normalize_str(text)
        pieces = library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(map(byte_of.__getitem__, piece)).decode() for piece, _ in pieces]

    agree = Agreement(own, by_library)
    return lambda text: own(text) if agree(text) else by_library(text)


def lower_normal(text: str) -> str:
    """Composed (NFC) and lower-cased character by character, without context rules."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


class Memo(dict):
    """Words and what ``make`` gives for them; holds at most ``limit`` short words.

    When it is full, the older half of the entries goes. Long words are made anew.
    """

    def __init__(self, make: Callable, limit: int = 400_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                newer = list(self.items())[self.limit // 2 :]
                self.clear()
                self.update(newer)
            self[word] = value
        return value


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def rows_in_pieces(batches: Iterator, rows: int = 256) -> Iterator:
    """Arrow batches cut into short ones, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
