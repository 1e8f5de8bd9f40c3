"""Token ids of texts by a public byte-level BPE, remembered per word."""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import chain, islice

import regex
from tokenizers import Tokenizer

# How this vocabulary's byte-level pre-tokenizer cuts a text. Merges never cross a cut,
# so a text's ids are the ids of its cuts in order. The second pattern says the same of texts that
# hold nothing beyond U+024F, with plain character ranges, which are faster.
_SPACE = "\t-\r \x85\xa0  -     　"
ANY_TEXT = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{L}}\p{{N}}{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_BLANK = "\t-\r \x85\xa0"
LATIN_TEXT = re.compile(
    rf" ?[{_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{_NUMBER}]+| ?[^{_LETTER}{_NUMBER}{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
_BEYOND_LATIN = re.compile("[^\\0-ɏ]")

# How byte-level vocabularies spell bytes: printable Latin-1 as it is, the others as U+0100 onwards. No UTF-8 holds the byte 0xFF.
_SPELLED_AS_IS = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELLING = dict(zip((b for b in range(256) if b not in _SPELLED_AS_IS), map(chr, range(0x100, 0x200))))


def _spelled(cuts: list[str]) -> list[str]:
    """The cuts in the characters of the vocabulary, as its byte-level pre-tokenizer hands them to the merges."""
    return "\udcff".join(cuts).encode("utf-8", "surrogateescape").decode("latin-1").translate(_SPELLING).split("\xff")


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizers library's merges encode each distinct cut once and its ids are remembered in two generations:
    when the younger one is full it becomes the older, whose cuts move back as they occur again. So the
    memory is bounded by about twice ``remembered`` entries and frequent cuts stay. A text that spells a
    special token goes to the library whole, since the library takes such tokens out before it cuts.
    """

    def __init__(self, path: str, remembered: int = 250_000, cuts_at_once: int = 500_000) -> None:
        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._remembered, self._cuts_at_once = remembered, cuts_at_once

    def __call__(self, texts: list[str]) -> list[bytes]:
        found, waiting, held = [b""] * len(texts), [], 0
        for i, text in enumerate(texts):
            if any(s in text for s in self._special):
                found[i] = array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
                continue
            pattern = ANY_TEXT if _BEYOND_LATIN.search(text) else LATIN_TEXT
            if len(text) > self._cuts_at_once:
                cuts, parts = (m.group() for m in pattern.finditer(text)), []
                while some := list(islice(cuts, self._cuts_at_once)):
                    parts += self._of_cuts([some])
                found[i] = b"".join(parts)
                continue
            waiting.append((i, pattern.findall(text)))
            held += len(waiting[-1][1])
            if held > self._cuts_at_once:
                self._fill(found, waiting)
                waiting, held = [], 0
        self._fill(found, waiting)
        return found

    def _fill(self, found: list[bytes], waiting: list[tuple[int, list[str]]]) -> None:
        for (i, _), ids in zip(waiting, self._of_cuts([cuts for _, cuts in waiting])):
            found[i] = ids

    def _of_cuts(self, lists: list[list[str]]) -> list[bytes]:
        if len(self._known) > self._remembered:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        missing = set(chain.from_iterable(lists)).difference(known)
        again = missing.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        if new := list(missing.difference(again)):
            tokenize = self._tokenizer.model.tokenize
            for cut, spelled in zip(new, _spelled(new)):
                known[cut] = array("I", [token.id for token in tokenize(spelled)]).tobytes()
        return [b"".join(map(known.__getitem__, cuts)) for cuts in lists]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The process's encoder, so that a worker's next task starts with what it remembers."""
    return Encoder(path)
