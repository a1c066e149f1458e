"""Where tokenizer libraries and Python may see a character differently."""

from __future__ import annotations

import regex

#: Outside these blocks the class of a character may depend on the version of Unicode, so that the
#: tokenizer library itself has to split the text.
UNSETTLED = regex.compile(
    "[^\\x00-ɏͰ-ϿЀ-ԯ -⁩₠-₵　-〯ぁ-ゖァ-ヺ一-龥]"
)


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


ALPHABET = byte_alphabet()
BYTES = {c: b for b, c in ALPHABET.items()}


def spell(word: str) -> str:
    return "".join(map(ALPHABET.__getitem__, word.encode()))


def unspell(spelled: str) -> str:
    return bytes(map(BYTES.__getitem__, spelled)).decode()
