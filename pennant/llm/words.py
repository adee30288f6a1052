"""Words and their tokens, learned once per Python worker."""

from __future__ import annotations

import numpy as np


class Generations:
    """A mapping of bounded size: when the young generation holds ``most`` entries or keys of ``most_chars`` characters
    in all, the old one goes; entries in use are carried over, so what is common stays.  In scripts without spaces a
    whole line is one word: the characters bound what such words take."""

    def __init__(self, most: int = 500_000, most_chars: int = 16_000_000):
        self.young: dict = {}
        self.old: dict = {}
        self.most, self.most_chars, self.chars = most, most_chars, 0

    def missing(self, keys: set) -> list:
        """What must be learned before all ``keys`` are in ``young``."""
        if len(self.young) > self.most or self.chars > self.most_chars:
            self.old, self.young, self.chars = self.young, {}, 0
        keys = keys.difference(self.young)
        self.chars += sum(map(len, keys))
        kept = keys & self.old.keys()
        self.young.update((k, self.old[k]) for k in kept)
        return list(keys - kept)


def encode_words(tokenizer, words: list[str], separator: str, lead: int, size: int = 500):
    """Encodes many words as few texts, joined by ``separator`` of one character; per text its words' numbers (low,
    high), its ids, and the first and the end token of each word.  ``lead`` 1: a separator stands before each word
    and belongs to it; 0: separators stand between words and belong to none.

    Right where the tokeniser never merges over the separator's place.
    """
    groups = [words[low:low + size] for low in range(0, len(words), size)]
    texts = [separator * lead + separator.join(g) for g in groups]
    at = 0
    for own, e in zip(groups, tokenizer.encode_batch(texts, add_special_tokens=False)):
        starts = np.zeros(len(own) + 1, np.int64)
        np.cumsum([len(w) + 1 for w in own], out=starts[1:])
        ends = starts[1:] if lead else starts[1:] - 1
        places = np.fromiter((o[0] for o in e.offsets), np.int64, len(e))
        yield at, at + len(own), e.ids, np.searchsorted(places, starts[:-1]), np.searchsorted(places, ends)
        at += len(own)
