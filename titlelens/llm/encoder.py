"""Token ids of whole texts by a vocabulary file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import re
import sys
import types
from array import array

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# Fixed value: the split rule of word-level BPE vocabularies that drop white space.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Latin letters that are their own NFC form and lower-case one to one.
_LETTERS = "À-ÖØ-öø-įı-ž"
_LATIN_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^a-z{_LETTERS}0-9]+")
_LATIN = re.compile(rf"[!-~{_LETTERS}]+").fullmatch


class _Words(dict):
    """Ids of a white-space delimited word, as little-endian bytes.

    Up to ``most`` young entries, and the generation before them: when the young are
    full they become the old ones, and an old entry that is met again is young once
    more.  So frequent words stay, and no more than twice ``most`` are held.  A word of several
    pieces has the ids of these, each of which is a word as well.
    """

    def __init__(self, tok: Tokenizer, code: str, most: int):
        super().__init__()
        self.tok, self.model, self.code, self.most, self.old = tok, tok.model, code, most, {}
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        # The library's own spelling of bytes, letter by letter.
        self.spell = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x17F)}

    def age(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: bytes) -> bytes:
        out = self.old.pop(word, None)
        if out is None:
            text = word.decode()
            if b"<|" in word or not _LATIN(text):  # added tokens and other scripts: the library's whole path
                out = array(self.code, self.tok.encode(text, add_special_tokens=False).ids).tobytes()
            else:
                low = text.lower()
                pieces = (low,) if low.isalpha() else _LATIN_SPLIT.findall(low)
                if pieces[0] == text:
                    spelled = text if text.isascii() else text.translate(self.spell)
                    out = array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()
                else:
                    out = b"".join([self[p.encode()] for p in pieces])
        self[word] = out
        return out


class Encoder:
    """``encode(text)`` equals ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    A vocabulary whose split rule drops white space gives a text the ids of its
    words one after another, so ids are kept by word, ``max_words`` met lately and
    as many met before; other vocabularies encode the text as it is.
    """

    def __init__(self, path: str, max_words: int = 300_000):
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.dtype = "<u2" if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        little = sys.byteorder == "little"
        self.words = _Words(self.tok, "H" if self.dtype == "<u2" else "I", max_words) if little and self._drops_space(conf) else None

    @staticmethod
    def _drops_space(conf: dict) -> bool:
        steps = (conf.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [n.get("type") for n in (conf.get("normalizer") or {}).get("normalizers", [])]
        return (steps[0].get("type") == "Split" and steps[0].get("pattern") == {"Regex": _SPLIT}
                and steps[0].get("behavior") == "Removed" and bool(steps[0].get("invert"))
                and kinds == ["NFC", "Replace", "Lowercase"] and conf.get("post_processor") is None
                and conf["model"].get("dropout") is None)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, self.dtype)
        if self.words is None:
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype)
        self.words.age()
        # bytes.split() splits at ASCII white space only; the rest stays inside a word.
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.encode().split())), self.dtype)


def encoder(path: str) -> Encoder:
    """The encoder of this Python process: tasks that follow each other in one
    worker share it and the words it has met."""
    kept = sys.modules.setdefault("_titlelens_worker", types.ModuleType("_titlelens_worker"))
    found = getattr(kept, "encoders", None)
    if found is None:
        found = kept.encoders = {}
    if path not in found:
        found[path] = Encoder(path)
    return found[path]
