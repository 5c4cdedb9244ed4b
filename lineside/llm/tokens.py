"""Token ids of whole texts with a public tokenizer file, at a rate fit for a corpus.

The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``. Splitting a text into pieces is
most of that call's time, and a corpus repeats its words, so texts are cut at blanks here and each new word goes through
the library once per worker. That is exact only where no step of the tokenizer looks across a blank: texts with a
character outside the range below, and tokenizers of another make, take the library's own path.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

# What a tokenizer file must declare for the word-wise path to hold.
NORMALIZER = ["NFC", "Replace", "Lowercase"]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# Precomposed Latin letters only: lower-casing is one character at a time, and there is nothing to compose.
# The angle bracket could begin the name of a special token, U+0085 is a blank to one library only.
ODD = re.compile(r"[^\t\n\v\f\r\x20-;=-~\xa1-įı-ɏ]")
CACHED = 700_000


class Encoder:
    """One per worker process and tokenizer file; holds ``CACHED`` words and as many pieces, and those of one call."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        norm, pre, model = made.get("normalizer") or {}, made.get("pre_tokenizer") or {}, made["model"]
        split = (pre.get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        self.wordwise = (
            [n["type"] for n in norm.get("normalizers", [])] == NORMALIZER
            and split == PIECES and model.get("end_of_word_suffix") == WORD_END)
        if not self.wordwise:
            return
        self.pieces = regex.compile(PIECES).findall
        vocab = self.library.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
        # The same merges without the regular expressions in front; pieces come apart at the ends of words.
        self.merges = Tokenizer(self.library.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = (b for b in range(256) if b not in visible)
        self.letters = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.word: dict[str, bytes] = {}
        self.piece: dict[str, bytes] = {}

    def _parts(self, word: str) -> list[str]:
        if word.isalpha():
            return [word]
        if word[:-1].isalpha() and word[-1] in ".,":
            return [word[:-1], word[-1]]
        return self.pieces(word)

    def _learn(self, new: list[str]) -> None:
        parts = [self._parts(w) for w in new]
        unknown = [p for p in set(chain.from_iterable(parts)) if p not in self.piece]
        if unknown:
            written = [p.encode().decode("latin-1").translate(self.letters) for p in unknown]
            lines = [" ".join(written[i:i + 200]) for i in range(0, len(written), 200)]
            done = self.merges.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, "<u4") for e in done])
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) != len(unknown):
                raise ValueError("a piece does not end where a word ends")
            raw, start = ids.tobytes(), 0
            for p, stop in zip(unknown, stops.tolist()):
                self.piece[p] = raw[start:stop]
                start = stop
        for w, ps in zip(new, parts):
            self.word[w] = b"".join([self.piece[p] for p in ps])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a NULL text has none."""
        if max(len(self.word), len(self.piece)) > CACHED:
            self.word.clear()
            self.piece.clear()
        out: list[bytes] = []
        open_texts: list[tuple[int, list[str], list[bytes | None]]] = []
        get, new = self.word.get, set()
        for i, text in enumerate(texts):
            out.append(b"")
            if not text:
                continue
            if not self.wordwise or ODD.search(text):
                out[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            own = text.lower().split()
            found = list(map(get, own))
            if None in found:
                new.update([w for w, ids in zip(own, found) if ids is None])
                open_texts.append((i, own, found))
            else:
                out[i] = b"".join(found)
        if new:
            self._learn(list(new))
        for i, own, found in open_texts:
            out[i] = b"".join([self.word[w] if ids is None else ids for w, ids in zip(own, found)])
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own encoder; the file is read on the worker, where it must exist under the same path."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
