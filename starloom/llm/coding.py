"""Token ids of single words, kept per Python worker, since texts repeat their words."""

from __future__ import annotations

import os
import re
from functools import cache

#: Separators that Python takes for white space and the tokenizers do not.
UNUSUAL = re.compile("[\x1c-\x1f]")


@cache
def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker; its own threads would take the cores of
    other tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordCache:
    """What ``make`` gives for each word. The first ``limit`` / 2 words are kept as they come, others
    from their second time on while there are less than ``limit``; the rest is made anew. First
    times are noted in a table of fixed size, in which a collision only keeps a word too early."""

    def __init__(self, make, limit: int = 600_000):
        self.make, self.limit, self.known = make, limit, {}
        self.seen = bytearray(1 << 22)

    def stays(self, word: str, size: int) -> bool:
        """Whether a word is kept when there are ``size`` others."""
        if size < self.limit // 2:
            return True
        place = hash(word) & 0x3FFFFF
        again, self.seen[place] = self.seen[place], 1
        return bool(again) and size < self.limit

    def of(self, lists: list[list[str]]) -> list[list]:
        """The values of the words of each list."""
        known = self.known
        missing = list({word for words in lists for word in words if word not in known})
        made = self.make(missing) if missing else ()
        size = len(known)
        known.update(zip(missing, made))
        found = [list(map(known.__getitem__, words)) for words in lists]
        for word in missing:
            if self.stays(word, size):
                size += 1
            else:
                del known[word]
        return found
