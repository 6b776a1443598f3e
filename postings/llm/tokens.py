"""Token ids of whole texts, piece by piece.

A text is cut where no token can cross, and each distinct piece is encoded once per generation of a
bounded memory; all else is lookups and joins of bytes.
"""

import functools
import os
import re
import sys
from array import array
from collections.abc import Callable

from postings.llm.workers import Pieces

#: Files of the public tokenizers, by the path that their package gives.
BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

# White space other than the space and the line feed, as ``str.isspace`` sees it: a few control
# characters more than Unicode's White_Space, which only makes pieces longer.
_OTHER_SPACE = re.compile(
    "[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")

# Latin letters that are whole (NFC) and have one lower-case letter each, among these. Texts of them,
# printable ASCII and line feeds are cut into words by patterns of the standard library, which are the
# vocabularies' own patterns for these characters; all others go to the tokenizers library whole.
LETTERS = "a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u017f"
CAPITALS = "A-Z\u00c0-\u00d6\u00d8-\u00de"
plain = re.compile("[\n !-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*").fullmatch
PLAIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s{LETTERS}0-9]+")
PLAIN_SPACED = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}{CAPITALS}]+| ?[0-9]+| ?[^\\s{LETTERS}{CAPITALS}0-9]+"
    r"|\s+(?!\S)|\s+"
)


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file; a path is taken as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_at_lone_spaces(text: str) -> list[str]:
    """The text cut before every single space that stands between two characters that are no space.

    The space is left out; it belongs to the piece after it. A byte-level pre-tokenizer begins a new
    word at such a space whatever stands around it.
    """
    if (
        "  " in text
        or "\n " in text
        or " \n" in text
        or text[:1] == " "
        or text[-1:] == " "
        or _OTHER_SPACE.search(text)
    ):
        return _LONE_SPACE.split(text)
    return text.split(" ")


class PieceIds:
    """Ids of a text as bytes, little-endian unsigned 32-bit, from a function that encodes a piece.

    ``keeps_spaces`` is true of byte-level vocabularies, where the space before a word is part of
    its first token; otherwise white space only separates. ``words`` cuts a whole text into words of which
    ``of_word`` has the ids, or gives None where it cannot; then words with other marks around them are
    remembered once, and pieces are not remembered at all.
    """

    def __init__(
        self,
        encode: Callable[[str], bytes],
        keeps_spaces: bool,
        words: Callable[[str], list[str] | None] = lambda text: None,
        of_word: Callable[[str], bytes] | None = None,
    ):
        self.keeps_spaces, self.first, self.words, self.of_word = keeps_spaces, encode, words, of_word
        self.pieces = Pieces((lambda piece: encode(" " + piece)) if keeps_spaces else encode)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        words = self.words(text)
        if words is not None:
            return b"".join(map(self.of_word, words))
        if not self.keeps_spaces:
            return b"".join(map(self.pieces.__getitem__, text.split(" ")))
        first, *rest = cut_at_lone_spaces(text)
        return self.first(first) + b"".join(map(self.pieces.__getitem__, rest))


def packed(ids: list[int]) -> bytes:
    """The ids as little-endian unsigned 32-bit integers."""
    values = array("I", ids)
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    table = dict(zip(shown, map(chr, shown), strict=True))
    table |= {byte: chr(256 + i) for i, byte in enumerate(hidden)}
    return [table[byte] for byte in range(256)]


@functools.lru_cache(maxsize=4)
def library_ids(path: str) -> PieceIds:
    """Ids as the tokenizers library gives them with ``add_special_tokens=False``.

    Pieces of plain Latin text are cut into words here and each word goes to the library's model;
    the library does all the rest itself.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    keeps_spaces = tokenizer.normalizer is None
    model, shown = tokenizer.model, dict(enumerate(byte_characters()))
    added = [re.escape(token.content) for token in tokenizer.get_added_tokens_decoder().values()]
    special = re.compile("|".join(added) or r"(?!)").search

    def of_word(word: str) -> bytes:
        if not word.isascii() or not word.isprintable() or word[0] == " ":
            word = word.encode().decode("latin-1").translate(shown)
        return packed([token.id for token in model.tokenize(word)])

    of_known_word = Pieces(of_word).__getitem__

    def words(text: str) -> list[str] | None:
        if plain(text) is None or special(text):
            return None
        return PLAIN_SPACED.findall(text) if keeps_spaces else PLAIN_WORDS.findall(text.lower())

    def encode(piece: str) -> bytes:
        found = words(piece)
        if found is None:
            return packed(tokenizer.encode(piece, add_special_tokens=False).ids)
        # A piece of one word is remembered as a piece.
        return of_word(found[0]) if len(found) == 1 else b"".join(map(of_known_word, found))

    return PieceIds(encode, keeps_spaces, words, of_known_word)
