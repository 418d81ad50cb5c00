"""Fast, exact encoding with a byte-level BPE file of the ``tokenizers`` library.

The vocabulary and merges are read from the tokenizer's own JSON file; the merging itself is done by
``tiktoken`` (the same algorithm over byte ranks, several times faster a core).  Two kinds of file:

* ``byte``: byte-level BPE with the pre-tokenizer's usual pattern; token ids are merge ranks.
* ``word``: lower case, white space dropped, last byte of each word marked as a word end.  The mark
  becomes a space behind the word, and the pairs (byte, space) get the lowest ranks, so that they are
  joined before any other merge, as the file's word-end symbols demand.

Text that the fast preparation does not cover (characters beyond Latin-1 or apostrophes for ``word``)
goes to the ``tokenizers`` library whole; results are the same either way (tests compare them).
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_BLANKS = " \t\n\x0b\x0c\r\x85\xa0"
_NOT_LETTERS = re.compile(f"[^{_LETTERS} ]+")
_PIECES = re.compile(f"[{_DIGITS}]|[^{_BLANKS}{_DIGITS}]+")
#: How byte-level pre-tokenizers split a text (fixed value, part of the file format).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict[tuple[str, str], "BpeEncoder"] = {}


def _byte_of_symbol() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others follow from code point 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class BpeEncoder:
    """Encodes texts to numpy arrays of unsigned 16-bit ids (vocabularies up to 65,536)."""

    def __init__(self, path: str, kind: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.kind = kind
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer do not fit in 16 bits")
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte = _byte_of_symbol()
        raw = lambda s: bytes(byte[c] for c in s)
        vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        end = model.get("end_of_word_suffix") or ""
        if kind == "byte":
            ranks = {raw(c): n for n, c in enumerate(byte)}
            ids = [vocab[c] for c in byte]
            pattern = BYTE_PATTERN
            name = raw
        elif kind == "word" and end:
            ranks = {raw(c): n for n, c in enumerate(byte)}
            ids = [vocab[c] for c in byte]
            for c in byte:
                ranks[raw(c) + b" "] = len(ids)
                ids.append(vocab[c + end])
            pattern = "[^ ]+ "
            name = lambda s: raw(s[: -len(end)]) + b" " if s.endswith(end) else raw(s)
        else:
            raise ValueError(f"unknown kind of tokenizer: {kind}")
        for a, b in merges:
            ranks[name(a + b)] = len(ids)
            ids.append(vocab[a + b])
        self.ids = np.array(ids, "<u2")
        self.fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _prepared(self, text: str) -> str | None:
        """``word``: the text with one space behind each word, or None if only the library may do it."""
        if "'" in text:
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return _NOT_LETTERS.sub(lambda m: f" {' '.join(_PIECES.findall(m[0]))} ", text.lower()) + " "

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, special-token strings taken as ordinary text."""
        try:
            ready = self._prepared(text) if self.kind == "word" else text
            if ready is not None:
                return self.ids[self.fast.encode_to_numpy(ready, disallowed_special=())]
        except UnicodeEncodeError:
            text = text.encode("utf-8", "replace").decode("utf-8")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u2")


def encoder(path: str, kind: str) -> BpeEncoder:
    """The worker's encoder for a tokenizer file, loaded once per process."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = BpeEncoder(path, kind)
    return _ENCODERS[path, kind]
