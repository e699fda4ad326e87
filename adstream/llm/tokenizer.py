"""Token ids of whole texts, with the public tokenizer libraries, inside tasks.

Byte-level BPE never merges across the pieces that its pattern cuts a text into, so ids
of a piece are the same wherever it occurs. A worker keeps a bounded memory of pieces it
has met; only new ones are merged. Texts with characters beyond Latin-1 or with the
special strings go to the library whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The letters, numbers and white space up to U+00FF, and the alternatives of
# the byte-level pattern over them, in its order.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBER = "0-9²³¹¼½¾"
SPACE = "\t-\r \x85\xa0"
PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# A piece never holds white space after something else: a text may be cut there.
CUT = re.compile(r"[^\t-\r \x85\xa0](?=[\t-\r \x85\xa0])")
SEGMENT = 1 << 20
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64


def byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes: printable ones for themselves, others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


def segments(text: str) -> Iterator[str]:
    """Cut a very long text where no piece can cross, about every ``SEGMENT`` characters."""
    start = 0
    while len(text) - start > SEGMENT:
        found = CUT.search(text, start + SEGMENT)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:] if start else text


class _Pieces(dict):
    """Little-endian 32-bit ids by piece."""

    def __init__(self, model):
        self.model, self.alphabet = model, byte_alphabet()

    def __missing__(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.alphabet)
        ids = array("I", [token.id for token in self.model.tokenize(mapped)]).tobytes()
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


class JsonTokenizer:
    """A ``tokenizers`` file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cutter, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.specials = [token["content"] for token in spec.get("added_tokens", [])]
        plain = (
            cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space")
            and spec.get("normalizer") is None
            and model.get("type") == "BPE"
            and not model.get("dropout")
            and not model.get("ignore_merges")
        )
        self.pieces = _Pieces(self.whole.model) if plain else None

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.pieces is not None and not any(s in text for s in self.specials):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                get = self.pieces.__getitem__
                return b"".join(b"".join(map(get, PIECES.findall(s))) for s in segments(text))
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()


class ModelTokenizer:
    """A ``sentencepiece`` file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def ids(self, text: str) -> bytes:
        return array("I", self.model.encode(text, add_bos=False, add_eos=False)).tobytes()


@lru_cache(maxsize=2)
def load(path: str) -> JsonTokenizer | ModelTokenizer:
    """One tokenizer a worker and file; every machine has the file at the same path."""
    return ModelTokenizer(path) if path.endswith(".model") else JsonTokenizer(path)


def version(path: str) -> str:
    """Digest of a tokenizer's version: its file and the library that reads it."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read())
    content.update(f"{library.__name__} {library.__version__}".encode())
    return content.hexdigest()
