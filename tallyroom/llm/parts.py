"""Encoding whole texts, and cutting a text into parts that a byte-level tokenizer encodes independently.

The tokenizers' pattern never lets a match start with anything but white space where
the character before is not white space, so a text may be cut in front of every run
of white space. Parts repeat a lot, so a worker keeps what it worked out for them.
"""

import json
import os
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Unicode's White_Space, which is what the pattern means by white space.
WHITE = "\t-\r \x85\xa0  -     　"
_DOUBLE = re.compile(f"[{WHITE}][{WHITE}]")
_PART = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Marks, which can be cut off the end of a part if a letter stands before.
_MARKS = frozenset(".,;:!?")


#: Characters of text whose unknown parts are encoded together.
GROUP_CHARS = 4_000_000
#: Latin letters, digits, signs and spaces.
LATIN = re.compile("[\t\n\r -~\u00a1-\u00ac\u00ae-\u024f\u2010-\u2027\u2030-\u205e\u20ac]*")


class Remembered(dict):
    """What was worked out for parts: about `limit` of them, `young` of which were met in one batch only.

    Half of all distinct parts never come back. They make room for each other, so that they
    do not push out what does come back.
    """

    def __init__(self, limit: int, young: int = 300_000):
        super().__init__()
        self.limit, self.young = limit, young
        self.once: set[str] = set()

    def missing(self, parts: set[str]) -> set[str]:
        """Those of `parts` that have to be worked out and added; all others are there."""
        self.once -= parts
        new = parts.difference(self)
        if len(self.once) + len(new) > self.young:
            for part in self.once:
                del self[part]
            self.once.clear()
        if len(self) + len(new) > self.limit:
            # The first learned are mostly the most frequent: those stay.
            stay = list(islice(self.items(), self.limit // 2))
            self.clear()
            self.update(stay)
            self.once &= self.keys()
            new = parts.difference(self)
        self.once |= new
        return new


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others, in order, are the characters from 256 on.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevel:
    """A byte-level vocabulary file of the `tokenizers` library, encoding whole texts.

    Where merges are numbered as their tokens are, the `tiktoken` library gives the same ids from the
    same merges in a quarter of the time. It is used for texts of Latin letters, digits, signs and
    spaces, whose classes no Unicode version has changed; all other texts go to the `tokenizers`
    library. With `added`, so do texts with the string of an added token, which is then one id, as in
    the library's default call; otherwise such a string is ordinary text.
    """

    def __init__(self, path: str, pattern: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = not added
        self.added = [t.content for t in self.own.get_added_tokens_decoder().values()] if added else []
        with open(path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        vocabulary, alphabet = self.own.get_vocab(with_added_tokens=False), byte_alphabet()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(map(alphabet.__getitem__, token))
        made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        self.fast = None
        if made == list(range(256, 256 + len(merges))) and all(len(b) == 1 for b in self.bytes[:256]):
            import tiktoken

            ranks = {self.bytes[i]: i for i in (*range(256), *made)}
            self.fast = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def of_texts(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The 32-bit ids of each text in order; NULL and empty texts have none."""
        for text in texts:
            if not text:
                yield b""
            elif self.fast is not None and LATIN.fullmatch(text) and not any(a in text for a in self.added):
                yield np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
            else:
                yield np.array(self.own.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()


class Parts:
    """Encodings of parts as bytes, of which about `limit` are remembered.

    `encode` maps a list of texts to a list of encodings; the encoding of two parts in a
    row is the concatenation of theirs.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 600_000):
        self.encode = encode
        self.spaced = Remembered(limit)  # by the part without its leading space
        self.plain = Remembered(limit)
        self.marks: dict[str, bytes] = {}

    def _learn(self, known: Remembered, parts: set[str], lead: str) -> None:
        stems = {p: p[:-1] for p in parts.difference(known) if len(p) > 1 and p[-1] in _MARKS and p[-2].isalpha()}
        new = known.missing(parts.union(stems.values()))
        made = new & stems.keys()
        marks = {p[-1] for p in made}.difference(self.marks)
        self.marks.update(zip(marks, self.encode(list(marks)), strict=True))
        texts = list(new - made)
        known.update(zip(texts, self.encode([t if t[:1] == "\n" else lead + t for t in texts]), strict=True))
        # A stem may end in a mark itself only behind a letter, so shorter ones come first.
        for p in sorted(made, key=len):
            known[p] = known[stems[p]] + self.marks[p[-1]]

    def of_texts(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The encoding of each text in order; NULL and empty texts have none."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP_CHARS:
                yield from self._of_segments(group)
                group, size = [], 0
        yield from self._of_segments(group)

    def _of_segments(self, group: list[str]) -> Iterator[bytes]:
        # A text with single white space only is cut at spaces and in front of line ends.
        single = [_DOUBLE.search(t) is None for t in group]
        cut = [t.replace("\n", " \n").split(" ") if s else _PART.findall(t) for t, s in zip(group, single, strict=True)]
        self._learn(self.spaced, set(chain.from_iterable(c[1:] for c, s in zip(cut, single, strict=True) if s)), " ")
        self._learn(self.plain, set(chain.from_iterable(c[:1] if s else c for c, s in zip(cut, single, strict=True))) - {""}, "")
        for parts, s in zip(cut, single, strict=True):
            if s:
                yield self.plain.get(parts[0], b"") + b"".join(map(self.spaced.__getitem__, parts[1:]))
            else:
                yield b"".join(map(self.plain.__getitem__, parts))
