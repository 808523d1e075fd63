"""Encoding of whole texts with a fixed tokenizer file, in tasks.

Byte-pair encoding works inside pre-tokens, so a text may be cut wherever a pre-token surely begins, the
parts encoded alone and their ids joined.  Each worker keeps the ids of the parts it has met (bounded, see
``CACHE_PARTS``); only new parts go to the tokenizers library.  ``tests/llm`` hold this against encoding
whole texts.  Special-token strings inside a text are ordinary text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterable

from lapline.llm._common import give_back

CACHE_PARTS = 450_000  # parts a worker keeps (about 200 bytes each) before it starts anew
KEPT_PART = 200  # longer parts are encoded each time

# The characters that \s means in the tokenizers' patterns (Unicode White_Space).
WHITE = "\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
MARKS = r"!-&(-/:-@\[-`{-~"  # ASCII punctuation but the apostrophe, which starts patterns of its own

#: First two: one pre-token (a run of letters, or of marks, that ends where the pattern's own run must end).
#: Otherwise the rest of a run, or white space as the byte-level pattern deals it.
BYTE_PARTS = re.compile(rf" ?[{LETTERS}]++(?=[{WHITE}{MARKS}]|\Z)|[{MARKS}]++(?=[{WHITE}]|\Z)| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
WORD_PARTS = re.compile(rf"[{LETTERS}]++(?=[{WHITE}{MARKS}]|\Z)|[{MARKS}]++(?=[{WHITE}]|\Z)|[^{WHITE}]+")
#: White space but the space and the line feed.
OTHER_WHITE = re.compile("[\x09\x0b-\x0d\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Marks that compose with ASCII letters (NFC) all lie in this block.
COMPOSING = re.compile("[\u0300-\u036f]")
ONE_BYTE = re.compile(rf" ?(?:[{LETTERS}]+|[{MARKS}]+)")
ONE_WORD = re.compile(rf"[{LETTERS}]+|[{MARKS}]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves and the others, in order, from code point 256 on."""
    out, more = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[b] = chr(b)
        else:
            out[b], more = chr(more), more + 1
    return out


BYTE_LETTERS = _byte_letters()


class _Parts(dict):
    """Ids of a part (see the patterns above) as little-endian uint32 bytes, found when first asked for."""

    def __init__(self, tokenizer, single, lower):
        super().__init__()
        self.tokenizer, self.model, self.single, self.lower = tokenizer, tokenizer.model, single, lower

    def __missing__(self, part: str) -> bytes:
        if self.single is not None and self.single.fullmatch(part):
            spelt = (part.lower() if self.lower else part).encode().decode("latin-1").translate(BYTE_LETTERS)
            ids = [t.id for t in self.model.tokenize(spelt)]
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        found = array("I", ids).tobytes()
        if len(part) <= KEPT_PART:
            self[part] = found
        return found


class _Runs(dict):
    """Ids of a run between white space, joined from its parts; ``lead`` stands before each run."""

    def __init__(self, parts: _Parts, cut, lead: str):
        super().__init__()
        self.parts, self.cut, self.lead = parts, cut, lead

    def __missing__(self, run) -> bytes:
        found = b"".join(map(self.parts.__getitem__, self.cut(self.lead + (run if isinstance(run, str) else run.decode()))))
        if len(run) <= KEPT_PART:
            self[run] = found
        return found


class Encoder:
    """``ids(texts)``: the ids of each text as little-endian uint32 bytes, without end ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        assert array("I").itemsize == 4 and sys.byteorder == "little"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        before, norm = conf.get("pre_tokenizer") or {}, conf.get("normalizer") or {}
        steps = [s["type"] for s in norm.get("normalizers", [])]
        kinds = [s["type"] for s in before.get("pretokenizers", [])]
        self.kind = "whole"  # a file of another make: whole texts
        if before.get("type") == "ByteLevel" and not norm and before.get("use_regex") and not before.get("add_prefix_space"):
            self.kind = "byte"
        elif steps == ["NFC", "Replace", "Lowercase"] and kinds == ["Split", "ByteLevel"] \
                and before["pretokenizers"][0]["behavior"] == "Removed":
            self.kind = "word"
        word = self.kind == "word"
        self.cut = (WORD_PARTS if word else BYTE_PARTS).findall
        self.parts = _Parts(self.tokenizer, ONE_WORD if word else ONE_BYTE, word)
        self.runs = _Runs(self.parts, self.cut, "" if word else " ")

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _text(self, text: str) -> bytes:
        if self.kind == "word":  # the six ASCII separators
            # ASCII letters may be lowered first unless a mark may compose with the small letter only
            spelt = text.encode()
            return b"".join(map(self.runs.__getitem__, (spelt if COMPOSING.search(text) else spelt.lower()).split()))
        if self.kind == "byte":
            if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or OTHER_WHITE.search(text):
                # a space that is not alone between two runs
                return b"".join(map(self.parts.__getitem__, self.cut(text)))
            first, *rest = text.split(" ")
            return b"".join(map(self.parts.__getitem__, self.cut(first))) + b"".join(map(self.runs.__getitem__, rest))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text; null and empty texts have none."""
        out = []
        for text in texts:
            for kept in (self.parts, self.runs):
                if len(kept) > CACHE_PARTS:
                    kept.clear()
            out.append(self._text(text) if text else b"")
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; loaded once a worker."""
    give_back()
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Give the worker's kept parts back: called where another operator's tasks begin in the same worker."""
    for one in _ENCODERS.values():
        one.parts.clear()
        one.runs.clear()
    give_back()
