"""Token ids of whole texts, encoded chunk by chunk.

The word tokenizer drops white space, so a text's ids are the ids of its
space-separated chunks in order.  Each distinct chunk is encoded once per cache
life and texts become dictionary look-ups.  A chunk that is a plain word
between punctuation takes the word's ids from the merge model alone; any other
goes through the tokenizer's whole pipeline.  The cache is cut back to the chunks of the last slice when it
exceeds ``cache_chunks``.
"""

from __future__ import annotations

import json
import sys
import types
import unicodedata

import numpy as np

#: Marks that the tokenizer splits off a word as one run (the apostrophe starts contractions and is not one).
EDGE = ".,;:!?()[]{}|*#/\\<>=+~^&%$@\"-"
SLICE_CHARS = 2_000_000


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file by its name."""
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_state() -> dict:
    """A dict that lives as long as the Python worker process (functions pickled by value have no lasting globals)."""
    return sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__


def worker_encoder(path: str) -> "ChunkEncoder":
    """One encoder per Python worker process and file, so its cache serves all of the worker's tasks."""
    kept = worker_state()
    if ("encoder", path) not in kept:
        kept["encoder", path] = ChunkEncoder(path)
    return kept["encoder", path]


def drop_encoders() -> None:
    """Forget the encoders of this worker process and their caches."""
    kept = worker_state()
    for key in [k for k in kept if k[0] == "encoder"]:
        del kept[key]


class ChunkEncoder:
    """Exact ids of ``Tokenizer.encode(text, add_special_tokens=False)`` for a tokenizer that drops white space."""

    def __init__(self, path: str, cache_chunks: int = 300_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder()
        self.marks = [t.content for t in added.values()]
        self.words = self._word_tokenizer(path)
        self.cache_chunks = cache_chunks
        self.cache: dict[str, bytes] = {}
        probe = "One two,\nthree's  FOUR 5678. Été"
        self.by_chunk = b"".join(self._ids(c) for c in self._chunks(probe)) == self._ids(probe)

    def _ids(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word_tokenizer(self, path: str):
        """The merge model alone, for lower-cased words between spaces; None if the file's steps are others than known."""
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        suffix = spec["model"].get("end_of_word_suffix")
        if steps != ["NFC", "Replace", "Lowercase"] or not suffix:
            return None
        spec["normalizer"] = None
        level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, level]}
        self.ends = np.zeros(self.tok.get_vocab_size(True), dtype=bool)
        self.ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
        return Tokenizer.from_str(json.dumps(spec))

    def _chunks(self, text: str) -> list[str]:
        if self.words and (text.isascii() or ("Σ" not in text and unicodedata.is_normalized("NFC", text))):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def _learn_words(self, words: list[str]) -> None:
        lines = [" ".join(words[i : i + 256]) for i in range(0, len(words), 256)]
        for n, line in enumerate(self.words.encode_batch_fast(lines, add_special_tokens=False)):
            ids = np.asarray(line.ids, dtype="<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            data, a = ids.tobytes(), 0
            for word, b in zip(words[256 * n : 256 * n + 256], cuts, strict=True):
                self.cache[word] = data[a:b]
                a = b

    def _learn(self, chunks: set[str]) -> None:
        parts, new, other, known = [], set(), set(), self.cache
        for c in chunks:
            if self.words and c.isalpha() and c.isascii() and c.islower():
                new.add(c)
                continue
            word = c.strip(EDGE) if self.words else ""
            if word.isalpha() and (word.islower() and word.isascii() or word == word.lower() and unicodedata.is_normalized("NFC", word)):
                if word not in known:
                    new.add(word)
                if len(word) < len(c):
                    head, _, tail = c.partition(word)
                    parts.append((c, head, word, tail))
                    if head:
                        other.add(head)
                    if tail:
                        other.add(tail)
            else:
                other.add(c)
        if new:
            self._learn_words(list(new))
        for c in other.difference(known):
            known[c] = self._ids(c)
        for c, head, word, tail in parts:
            known[c] = (known[head] if head else b"") + known[word] + (known[tail] if tail else b"")

    def _slice(self, texts: list[str]) -> list[bytes]:
        whole = [not self.by_chunk or any(m in t for m in self.marks) for t in texts]
        lists = [None if w else self._chunks(t) for t, w in zip(texts, whole)]
        need = set()
        for x in lists:
            if x:
                need.update(x)
        if len(self.cache) > self.cache_chunks:
            self.cache = {c: self.cache[c] for c in need.intersection(self.cache)}
        self._learn(need.difference(self.cache))
        get = self.cache.__getitem__
        return [self._ids(t) if x is None else b"".join(map(get, x)) for t, x in zip(texts, lists)]

    def encode(self, texts):
        """Yields the ids of each text (null: none) as little-endian uint32 bytes, a bounded slice at a time."""
        part: list[str] = []
        size = 0
        for t in texts:
            part.append(t or "")
            size += len(part[-1])
            if size >= SLICE_CHARS:
                yield from self._slice(part)
                part, size = [], 0
        if part:
            yield from self._slice(part)
