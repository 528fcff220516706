"""Ids of whole texts by a ``tokenizers`` file of the byte-level BPE kind, through a worker's piece cache."""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

from crawlweave.llm.pieces import HEAD, PieceCache, piece_of

#: Entries of a worker's cache: those of some 140 MB of varied text, at about 200 bytes each.
CACHE_ENTRIES = 1_500_000
#: Letters of which every tokenizer's pattern makes one pre-token with the space before them.
_LETTERS = re.compile("[ A-Za-zÀ-ÖØ-öø-ÿ]*")


class IdEncoder:
    """Ids as little-endian unsigned 32-bit bytes, special strings as the file treats them by default."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        # the tokenizer writes a space as U+0120 and a line feed as U+010A
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for t, i in vocab.items() if t[:1] in ("Ġ", "Ċ")]] = True
        self.words = self._of_words(path)
        self.cache = PieceCache(self._encode_keys, alone=self.added, limit=CACHE_ENTRIES)

    @staticmethod
    def _of_words(path: str):
        """The file's tokenizer with pre-tokens cut at spaces, which for words of letters are the same; None for
        files with another way of cutting."""
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        how = told.get("pre_tokenizer") or {}
        if told.get("normalizer") or (how.get("type"), how.get("add_prefix_space"), how.get("use_regex", True)) != (
                "ByteLevel", False, True):
            return None
        words = Tokenizer.from_file(path)
        words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "merged_with_next"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return words

    def _whole(self, texts: list[str], tokenizer=None) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_keys(self, keys: list[str]) -> list[bytes]:
        """Led pieces in one text, cut where an id opens a piece; others (first words) one by one."""
        out = [b""] * len(keys)
        heads = [i for i, k in enumerate(keys) if k[0] == HEAD]
        led = [i for i, k in enumerate(keys) if k[0] != HEAD]
        letters = [keys[i].isalpha() for i in led]
        mixed = [i for i, x in zip(led, letters, strict=True) if not x]
        led = [i for i, x in zip(led, letters, strict=True) if x]
        for i, ids in zip(heads, self._whole([piece_of(keys[i]) for i in heads]), strict=True):
            out[i] = ids
        for part in (ones[begin:begin + 4096] for ones in (led, mixed) for begin in range(0, len(ones), 4096)):
            pieces = [piece_of(keys[i]) for i in part]
            text = "".join(pieces)
            joined = self._whole([text], self.words if _LETTERS.fullmatch(text) else None)[0]
            cuts = (np.flatnonzero(self.opens[np.frombuffer(joined, "<u4")]) * 4).tolist()
            if len(cuts) == len(part):
                ids = [joined[a:b] for a, b in zip(cuts, [*cuts[1:], len(joined)], strict=True)]
            else:
                ids = self._whole(pieces)
            for i, x in zip(part, ids, strict=True):
                out[i] = x
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        keys = self.cache.learn(texts)
        known = self.cache.known.__getitem__
        out = [b"" if k is None else b"".join(map(known, k)) for k in keys]
        rest = [i for i, k in enumerate(keys) if k is None]
        for i, ids in zip(rest, self._whole([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out


@functools.lru_cache(2)
def id_encoder(path: str) -> IdEncoder:
    """One per worker process."""
    return IdEncoder(path)
