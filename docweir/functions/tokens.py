"""Token ids of texts, and where tokens end, by a public byte-level BPE vocabulary file."""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np


_SEPARATORS = re.compile("[\x1c-\x1f]")


def _byte_symbols() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable character: its own where that is printable, else one from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts, the same as tokenizers' encode(text, add_special_tokens=False).

    Where the file is a plain byte-level BPE whose ids rank its merges, tiktoken's engine runs the
    same vocabulary (several times faster); a probe checks that both agree. Else tokenizers runs it,
    and so it does for a text with a run of white space that is longer than the engine's pattern can
    go back over.
    """

    #: White space in a row that the engine is given; it fails from about 700,000 on.
    _LONGEST = 100_000

    _PROBE = "It's  a probe:\n\n\t naïve façade, 12345 €9 — don't!   日本語   x"

    def __init__(self, path: str) -> None:
        import tokenizers

        self._path = path
        self._slow = tokenizers.Tokenizer.from_file(path)
        self._slow.no_truncation()
        self._fast = self._bytes = None
        self.size = max(self._slow.get_vocab(with_added_tokens=True).values()) + 1
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        level = model.get("pre_tokenizer") or {}
        self._special = [t["content"] for t in model.get("added_tokens", [])]
        if model["model"]["type"] == "BPE" and not model.get("normalizer") and level.get("type") == "ByteLevel" and level.get("use_regex", True) and not level.get("add_prefix_space"):
            self._fast, self._bytes = self._engine(model)
            if self._fast is not None and list(self._fast(self._PROBE)) != self._slow.encode(self._PROBE, add_special_tokens=False).ids:
                self._fast = None
        if self._fast is not None:
            self._slow = None  # a worker needs the memory

    @staticmethod
    def _engine(model: dict):
        import public_tokenizers
        import tiktoken

        symbols = _byte_symbols()
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        ranks = {bytes(symbols[c] for c in piece): i for piece, i in model["model"]["vocab"].items() if piece not in special}
        encoding = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        sizes = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for piece, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            sizes[i] = len(piece)
        return lambda text: encoding.encode_to_numpy(text, allowed_special="all"), sizes

    def _blank_run(self, text: str) -> bool:
        """Whether a run of white space may be too long: one spans at least one of the places looked at."""
        step = self._LONGEST
        for at in range(step - 1, len(text), step):
            if text[at].isspace():
                lo, hi = at, at
                while lo > max(0, at - step) and text[lo - 1].isspace():
                    lo -= 1
                while hi < min(len(text), at + step) and text[hi].isspace():
                    hi += 1
                if hi - lo >= step:
                    return True
        return False

    def _whole(self, text: str):
        """What tokenizers itself makes of a text."""
        if self._slow is None:
            import tokenizers

            self._slow = tokenizers.Tokenizer.from_file(self._path)
            self._slow.no_truncation()
        return self._slow.encode(text, add_special_tokens=False)

    def additive(self, text: str) -> bool:
        """Whether tokens of text, cut before words, add up but for each part's first word.

        The engine's pattern never joins what stands before white space with what follows it. White
        space is what Python takes for it but four separators; special tokens would end a part's pattern.
        """
        return self._fast is not None and not self._blank_run(text) and not _SEPARATORS.search(text) and not any(t in text for t in self._special)

    def __call__(self, text: str) -> np.ndarray:
        if self._fast is not None and not self._blank_run(text):
            return np.array(self._fast(text), np.uint32)
        return np.array(self._whole(text).ids, np.uint32)

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in characters; one that ends within a character ends behind it."""
        if self._fast is None or self._blank_run(text):
            return np.array([b for _, b in self._whole(text).offsets], np.int64)
        stops = np.cumsum(self._bytes[self._fast(text)]) if text else np.empty(0, np.int64)
        if text.isascii():
            return stops
        firsts = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        return np.cumsum(firsts)[stops - 1]


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker."""
    return Encoder(path)
