"""Token ids of a tokenizer file inside a task, in batches of bounded bytes.

A byte-level BPE file whose ids follow its merge order is encoded by ``tiktoken`` on the
same vocabulary, at three times the speed of ``tokenizers``; every other ``.json`` goes through
``tokenizers``, a ``.model`` through ``sentencepiece``. The ids are the same either way.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import regex

# Texts longer than this many characters are encoded in pieces.
PIECE_CHARS = 1 << 16

# Fixed value: the split pattern of byte-level BPE vocabularies of this family.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# In front of a run of white space the split pattern always ends a piece, and what follows
# is split in the same way whether or not it has text before it.
_SAFE = regex.compile(r"(?<=\S)(?=\s)")


def _byte_alphabet() -> dict[str, int]:
    """Printable bytes stand for themselves, the others for code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """Parts of a long text whose ids, joined, are the ids of the whole."""
    if len(text) <= limit:
        return [text]
    out, a = [], 0
    while len(text) - a > limit:
        cut = _SAFE.search(text, a + limit)
        if cut is None:
            break
        out.append(text[a : cut.start()])
        a = cut.start()
    return [*out, text[a:]]


class Encoder:
    """``ids(text)`` of one tokenizer file."""

    def __init__(self, path: str) -> None:
        self.path, self.whole, self.fast = path, None, None
        if path.endswith(".model"):
            import sentencepiece

            self.piece = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        self.piece = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if self._ranked(spec):
            import tiktoken

            alphabet = _byte_alphabet()
            special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            ranks = {bytes(alphabet[c] for c in k): i for k, i in spec["model"]["vocab"].items() if k not in special}
            self.fast = tiktoken.Encoding(
                os.path.basename(path), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special
            )
        self.spec = spec

    @staticmethod
    def _ranked(spec: dict) -> bool:
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or spec.get("normalizer") or model.get("byte_fallback"):
            return False
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            return False
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            return False
        merged = ("".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"])
        return all(model["vocab"].get(m) == 256 + i for i, m in enumerate(merged))

    def _by_library(self, text: str) -> np.ndarray:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
            self.whole.no_truncation()
            self.whole.no_padding()
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def ids(self, text: str) -> np.ndarray:
        if self.piece is not None:
            return np.array(self.piece.encode(text, num_threads=1), dtype=np.uint32)
        if self.fast is None:
            return self._by_library(text)
        parts = []
        for piece in pieces(text):
            try:
                parts.append(self.fast.encode_to_numpy(piece, allowed_special="all"))
            except ValueError:
                # A run of white space too long for the pattern of the fast library.
                parts.append(self._by_library(piece))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


    def counts(self, batch: Sequence[str]) -> np.ndarray:
        """Number of ids of each text; one call of the library encodes the whole batch."""
        if self.piece is not None:
            return np.fromiter(map(len, self.piece.encode(list(batch), num_threads=1)), dtype=np.int64, count=len(batch))
        if self.fast is None:
            self._by_library("")
            encoded = self.whole.encode_batch(list(batch), add_special_tokens=False)
            return np.fromiter((len(e.ids) for e in encoded), dtype=np.int64, count=len(batch))
        parts = [pieces(t) for t in batch]
        owner = np.repeat(np.arange(len(batch)), [len(p) for p in parts])
        flat = [piece for own in parts for piece in own]
        try:
            sizes = [len(ids) for ids in self.fast.encode_batch(flat, num_threads=1, allowed_special="all")]
        except ValueError:
            # A run of white space too long for the pattern of the fast library: text by text.
            sizes = [len(self.ids(piece)) for piece in flat]
        return np.bincount(owner, weights=sizes, minlength=len(batch)).astype(np.int64)


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def texts(column: pa.Array) -> Iterator[str]:
    """Texts one by one; null as the empty text."""
    for value in column:
        yield value.as_py() or ""
