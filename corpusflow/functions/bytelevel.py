"""Byte-level alphabet and word split of the GPT-2 style tokenizer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.sequences import SPECIAL_TOKENS

# Fixed value: the word split. `(?U)` gives the classes their Unicode meaning.
WORD_PATTERN = (
    r"(?U)('s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+)"
)
# Bytes shown as themselves; the others take the characters from U+0100 on.
VISIBLE_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_characters() -> list[str]:
    """The character standing for each of the 256 bytes."""
    visible = set(VISIBLE_BYTES)
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


def alphabet() -> list[str]:
    return sorted(byte_characters())


def base_ids() -> list[int]:
    """Token id of each byte: the alphabet follows the special tokens in code point order."""
    ids = {c: i for i, c in enumerate(alphabet(), start=len(SPECIAL_TOKENS))}
    return [ids[c] for c in byte_characters()]


def constant_array(values: list[str]) -> Column:
    """Array literal built by one expression; entries must hold no space. Lookup by position is O(1)."""
    return F.split(F.lit(" ".join(values)), " ")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), 1)


def pieces_of(text: Column) -> Column:
    """Words for encoding: special tokens written in the text stay whole."""
    special = "|".join(t.replace("[", r"\[").replace("]", r"\]") for t in SPECIAL_TOKENS)
    parts = F.split(text, f"(?={special})|(?<={special})")
    split = F.flatten(
        F.transform(parts, lambda p: F.when(p.isin(*SPECIAL_TOKENS), F.array(p)).otherwise(words_of(p)))
    )
    return F.when(F.regexp_like(text, F.lit(special)), split).otherwise(words_of(text))


def byte_ids(text: Column) -> Column:
    """Base token ids of the UTF-8 bytes of `text`."""
    codes = constant_array([str(i) for i in base_ids()]).cast("array<int>")
    # Read as Latin-1, every byte is the character of that code.
    characters = F.split(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), "")
    return F.transform(F.filter(characters, lambda c: c != ""), lambda c: F.element_at(codes, F.ascii(c) + 1))


def text_of(ids: Column, tokens: list[str], skip: set[int]) -> Column:
    """Text of token ids through their bytes; malformed UTF-8 becomes U+FFFD.

    The vocabulary travels as one array literal: it is bounded by the vocabulary
    size, and the lookup needs no join and no shuffle.
    """
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    digits = []
    for i, token in enumerate(tokens):
        if i in skip:
            digits.append("-")
        elif all(c in byte_of for c in token):
            digits.append(bytes(byte_of[c] for c in token).hex())
        else:
            digits.append(token.encode().hex())
    table = constant_array(digits)
    known = F.filter(F.transform(ids, lambda x: F.try_element_at(table, x + 1)), lambda h: h.isNotNull() & (h != "-"))
    return F.make_valid_utf8(F.unhex(F.array_join(known, "")).cast("string"))
