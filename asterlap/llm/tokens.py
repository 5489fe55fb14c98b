"""Token IDs of whole texts by the tokenizers library, with the pieces of text that recur encoded once.

A text is cut only where the tokenizer's own splitting always ends a piece, so IDs joined piece by piece are those of
the whole text; pieces seen before come from a bounded memory. A text that may hold an added token is encoded whole. ``words`` is for tokenizers that drop white space and
case, ``spaced_words`` for byte-level ones.
"""

import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np

# Where texts are cut. White space is ASCII white space; marks are ASCII punctuation.
_SPACE, _MARK = r" \t-\r", r"!-/:-@\[-`{-~"
#: Words without white space, for a tokenizer that drops white space; a cut at ASCII white space is always safe.
WORD = re.compile(f"[^{_SPACE}]+")
#: ASCII white space and the word behind it, for a byte-level tokenizer; safe where the text has no other white space.
SPACED = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
OTHER_SPACE = re.compile("[%s]" % "".join(map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])))
#: Texts of ASCII and Latin letters alone are also cut between a letter or digit and the marks behind it, where both
#: tokenizers' patterns always end a piece; what follows the marks stays with them, for the sake of contractions.
UNUSUAL = re.compile("[^\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
PLAIN_WORD = re.compile(f"[^{_SPACE}{_MARK}]+|[{_MARK}]+[^{_SPACE}{_MARK}]*")
PLAIN_SPACED = re.compile(f"[{_SPACE}]*(?:[^{_SPACE}{_MARK}]+|[{_MARK}]+[^{_SPACE}{_MARK}]*)|[{_SPACE}]+")
LETTERS = re.compile(" ?[a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: Longer pieces aren't remembered.
LONG_PIECE = 400


class Tokens(dict):
    """IDs of texts as bytes, little-endian, four to an ID."""

    def __init__(self, path: str, pieces: Callable[[str], list[str]], limit: int = 1_000_000, added_as_text: bool = True):
        """``added_as_text``: the marks of special tokens are ordinary text; the library's default is that they aren't."""
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.bare = (Tokenizer.from_file(path) for _ in range(2))
        self.tokenizer.encode_special_tokens = self.bare.encode_special_tokens = added_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.lower() for t in added if not (added_as_text and t.special)]
        # A word of lower-case letters, with a blank before it or not, needs neither normalising nor splitting.
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces, self.limit, self.new = pieces, limit, []

    def __missing__(self, piece: str) -> bytearray:
        """Room for the IDs of a piece not seen before, which ``encode`` fills."""
        self.new.append(piece)
        self[piece] = room = bytearray()
        return room

    def encode(self, texts: list[str]) -> list[bytes]:
        """Every piece is looked up once; new ones give room that is filled before the IDs of a text are joined."""
        if len(self) > self.limit:
            self.clear()
        self.new = []
        try:
            found = [list(map(self.__getitem__, [t] if self.has_added(t) else self.pieces(t))) for t in texts]
            plain = [p for p in self.new if LETTERS.fullmatch(p)]
            for tokenizer, some in ((self.bare, plain), (self.tokenizer, list(set(self.new).difference(plain)))):
                for i in range(0, len(some), 10_000):
                    self._fill(tokenizer, some[i : i + 10_000])
        except BaseException:
            self.clear()  # some rooms may be empty
            raise
        for piece in self.new:
            if len(piece) > LONG_PIECE:
                del self[piece]
        return [b"".join(ids) for ids in found]

    def _fill(self, tokenizer, pieces: list[str]) -> None:
        found = [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
        ends = [4 * n for n in accumulate(map(len, found))]
        for piece, i, j in zip(pieces, [0, *ends], ends):
            own = ids[i:j]
            self[piece] += own
            self[piece] = own  # takes less memory

    def has_added(self, text: str) -> bool:
        """Whether an added token may be in the text, in whatever case."""
        return bool(self.added) and any(t in text or t in text.lower() for t in self.added)


def words(text: str) -> list[str]:
    return WORD.findall(text) if UNUSUAL.search(text) else PLAIN_WORD.findall(text.lower())


def spaced_words(text: str) -> list[str]:
    if not UNUSUAL.search(text):
        return PLAIN_SPACED.findall(text)
    return [text] if OTHER_SPACE.search(text) else SPACED.findall(text)


@lru_cache(maxsize=2)
def worker_tokens(path: str, pieces: Callable[[str], list[str]]) -> Tokens:
    """One for all tasks of a Python worker, with the library's defaults."""
    return Tokens(path, pieces, added_as_text=False)
