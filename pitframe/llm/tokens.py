"""Pre-tokens of the lower-case BPE tokenizer file, cached, for ids and for counts.

White space never lies inside a token of this tokenizer, so a text's tokens are its words' tokens.
A text of plain letters, digits and signs (ASCII, and composed Latin-1 letters) is lower-cased and
cut into pre-tokens here; each distinct one then goes to a model once. Texts with anything else are
taken word by word, and a word that isn't plain (other scripts, combining marks, apostrophes,
special strings) goes to the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

# Byte letters: printable bytes stand for themselves, the others follow from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTER = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(_PLAIN))}
LETTERS = "a-zßà-öø-ÿ"
SAFE = re.compile(r"[\t-\r !-&(-;=-~A-Za-z0-9À-ÖØ-öø-ÿ]*")  # no apostrophe, no '<'
PIECE = re.compile(rf"[{LETTERS}]+|[0-9]|[^\t-\r {LETTERS}0-9]+")


@lru_cache(maxsize=4)
def library(name: str):
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(name))


def byte_letters(piece: str) -> str:
    return piece if piece.isascii() else "".join(BYTE_LETTER[b] for b in piece.encode())


class PieceCache:
    """A value for every pre-token: ``of_piece`` takes one in byte letters, ``of_word`` any other word.

    The cache holds at most ``most`` values and starts anew when it is full.
    """

    def __init__(self, of_piece: Callable[[str], object], of_word: Callable[[str], object], most: int = 400_000):
        self.of_piece, self.of_word, self.most = of_piece, of_word, most
        self.known: dict[str, object] = {}

    def values(self, text: str | None) -> list:
        text = text or ""
        if SAFE.fullmatch(text):
            return self._plain(PIECE.findall(text.lower()))
        out: list = []
        for word in text.encode().split():
            w = word.decode()
            if SAFE.fullmatch(w):
                out += self._plain(PIECE.findall(w.lower()))
            else:
                out.append(self.of_word(w))
        return out

    def _plain(self, pieces: list[str]) -> list:
        if len(self.known) >= self.most:
            self.known.clear()
        known = self.known
        out = list(map(known.get, pieces))
        if None in out:
            for i, v in enumerate(out):
                if v is None:
                    p = pieces[i]
                    v = known.get(p)
                    if v is None:
                        v = self.of_piece(byte_letters(p))
                        if len(p) <= 64:
                            known[p] = v
                    out[i] = v
        return out
