"""Token ids of whole texts by a tokenizers file, and lossless cuts of long documents.

Texts are cut before single spaces, and what stands between is encoded once a
process and kept: words repeat. A byte-level BPE whose pre-tokenizer joins one
space to what follows gives the same ids for the parts as for the whole, as
long as no white space follows the space and no special token is in the text;
texts for which that doesn't hold are encoded whole.

New parts of Latin letters are encoded from the same vocabulary as ranks,
which is faster for short strings and gives the ids that the tokenizer gives:
the file's own merges have to be in order of their ids, and a sample is
compared when it is loaded. All other parts go to the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa

#: Default vocabulary; its path is a parameter wherever it is used.
VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Parts that a process keeps at most before it starts anew.
KEPT_PARTS = 120_000
#: FIXED: how a byte-level BPE tokenizer cuts text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Anything but Latin letters, common signs and controls.
_OTHER = re.compile("[^\x00-\u024f]")
_SAMPLE = "The quick brown fox's 123 words, naïve façade über-straße año; don't!? #%& x=y/z Ünïcödé aaaa bbbbb the tion"


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _rank_encoder(path: str, tokenizer):
    """(text -> ids as bytes, length in bytes of each id) from the file's vocabulary as ranks, or None where ids could differ from the tokenizer's."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
        return None
    letters = _byte_letters()
    try:
        ranks = {bytes(letters[c] for c in token): k for token, k in model["vocab"].items() if not token.startswith("<|")}
    except KeyError:
        return None
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or len(ranks) != len({*ranks.values()}):
        return None
    encode = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_to_tiktoken_buffer
    same = np.frombuffer(encode(_SAMPLE, set()), "<u4").tolist() == tokenizer.encode(_SAMPLE, add_special_tokens=False).ids
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(t) for t in ranks]
    return (lambda text: bytes(encode(text, set())), sizes) if same else None


class Encoder:
    """Ids as little-endian 32-bit numbers, with END last."""

    def __init__(self, path: str, end: int = END):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = np.array([end], "<u4").tobytes()
        self.fast, self.sizes = _rank_encoder(path, self.tokenizer) or (None, None)
        self.kept: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        if self.fast and not _OTHER.search(text) and not any(s in text for s in self.special):
            return self.fast(text)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, parts: list[str]) -> None:
        """Keep the ids of parts, each with its space before it. Those of Latin letters are encoded in one string and told apart by the bytes of their ids."""
        latin = ([p for p in parts if not _OTHER.search(p)] if _OTHER.search("".join(parts)) else parts) if self.fast else []
        if latin:
            ids = self.fast(" " + " ".join(latin))
            at = np.searchsorted(np.cumsum(self.sizes[np.frombuffer(ids, "<u4")]), np.cumsum([1 + (len(p) if p.isascii() else len(p.encode())) for p in latin])) + 1
            begin = 0
            for p, until in zip(latin, (4 * at).tolist(), strict=True):
                self.kept[p] = ids[begin:until]
                begin = until
        if len(latin) < len(parts):
            for p in parts:
                if p not in self.kept:
                    self.kept[p] = self._whole(" " + p)

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, in order."""
        split = [None if any(s in t for s in self.special) else t.split(" ") for t in texts]
        heads = [p.pop(0) if p else "" for p in split]
        words = set().union(*filter(None, split))
        if len(self.kept) > KEPT_PARTS:
            self.kept = {w: self.kept[w] for w in words if w in self.kept}  # frequent parts stay
        new = [w for w in words if w not in self.kept]
        odd = {w for w in new if not w or w[0].isspace()}  # these are never kept
        self._learn([w for w in new if w not in odd] if odd else new)
        ids = self.kept.__getitem__
        for text, head, parts in zip(texts, heads, split, strict=True):
            if parts is None or odd and not odd.isdisjoint(parts):
                yield self._whole(text) + self.end
            else:
                yield b"".join([self._whole(head) if head else b"", *map(ids, parts), self.end])


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end: int = END) -> Encoder:
    """One a process."""
    if (path, end) not in _ENCODERS:
        _ENCODERS[path, end] = Encoder(path, end)
    return _ENCODERS[path, end]


def encoded(texts: pa.Array, path: str, end: int = END, at_once: int = 256) -> Iterator[bytes]:
    """Ids of a column of texts, a few texts at a time."""
    for at in range(0, len(texts), at_once):
        yield from encoder(path, end).batch([t or "" for t in texts.slice(at, at_once).to_pylist()])


def cuts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all but the first have the full length."""
    k = max(1, -(-n // most))
    head = n - most * (k - 1)
    return [(0, head), *((head + most * i, most) for i in range(k - 1))]
