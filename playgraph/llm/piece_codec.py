"""SentencePiece encoding and decoding with a shared-prefix forward pass.

A text becomes marked words (runs of the space mark followed by other
characters); no piece crosses from a character to a mark, so words encode
independently.  The distinct new words of a slice are sorted, which walks their
trie depth-first, and the forward table of a word is kept for the prefix it
shares with the next.

The public model is a merge (BPE) model, for which a best sum of scores gives
wrong ids.  Its forward pass therefore keeps, per prefix, the last piece of
that prefix's encoding: piece ``t`` may follow when merging leaves the boundary
between the two alone, which is decided by undoing merges, latest first.  The
pieces that end at a character come from a matching automaton over the pieces,
whose state is kept with the prefix.  The words' ids are those of the pass; the library's own
encoder checks them, and what it sees differently is counted (``n_differs``).
"""

from __future__ import annotations

from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import lean_batches, texts_of
from .tokens import SLICE_CHARS, tokenizer_path, worker_state

MARK = "▁"


def worker_walker(path: str) -> "PieceWalker":
    """One walker per Python worker process and model, so its word cache serves all of the worker's tasks."""
    kept = worker_state()
    if ("walker", path) not in kept:
        kept["walker", path] = PieceWalker(path)
    return kept["walker", path]


class PieceWalker:
    """Ids of marked words by a forward pass over their trie."""

    def __init__(self, path: str, cache_words: int = 300_000):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.piece = {self.text[i]: i for i in plain}
        order = sorted((i for i in plain if len(self.text[i]) > 1), key=lambda i: -sp.get_score(i))
        self.rank = {i: -1 for i in plain} | {i: r for r, i in enumerate(order)}
        self.byte = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        if any(MARK in t.lstrip(MARK) for t in self.piece):
            raise ValueError("a piece crosses a space mark; words would not encode independently")
        self.parts: dict[int, tuple[int, int]] = {}
        self.apart: dict[int, dict[int, bool]] = {i: {} for i in plain}  # by piece: whether it stays apart from the piece before
        self.n_apart = 0
        self.cache_words = cache_words
        self.cache: dict[str, bytes] = {}  # words of this generation; the one before is kept for words that come again
        self.older: dict[str, bytes] = {}
        self.differing: set[str] = set()
        self._build_automaton()

    def _build_automaton(self) -> None:
        """States are beginnings of pieces: ``next`` one character on, ``fail`` the longest other state that ends it,
        ``found`` the (length, id, table of ``apart``) of the pieces that end there, longest first."""
        self.next: list[dict[str, int]] = [{}]
        own: list[tuple] = [()]
        for text, i in self.piece.items():
            state = 0
            for c in text:
                to = self.next[state].get(c)
                if to is None:
                    to = self.next[state][c] = len(self.next)
                    self.next.append({})
                    own.append(())
                state = to
            own[state] = ((len(text), i, self.apart[i]),)
        self.fail, self.found = [0] * len(own), own
        queue = list(self.next[0].values())
        for state in queue:  # grows while it is read: breadth first
            self.found[state] = own[state] + self.found[self.fail[state]]
            for c, to in self.next[state].items():
                at = self.fail[state]
                while at and c not in self.next[at]:
                    at = self.fail[at]
                self.fail[to] = self.next[at].get(c, 0)
                queue.append(to)
        self.size_of = {i: len(text) for text, i in self.piece.items()}
        self.jumps: list[tuple[int, str]] = []  # steps over ``fail`` links that ``next`` remembers

    def _jump(self, state: int, c: str) -> int:
        at = state
        while at and c not in self.next[at]:
            at = self.fail[at]
        to = self.next[at].get(c, 0)
        if len(self.jumps) > 1_000_000:
            for known, x in self.jumps:
                del self.next[known][x]
            self.jumps.clear()
        self.next[state][c] = to
        self.jumps.append((state, c))
        return to

    def _split(self, t: int) -> tuple[int, int]:
        """The two pieces whose merge made piece ``t`` (by merging its characters)."""
        if t not in self.parts:
            symbols = list(self.text[t])
            while len(symbols) > 2:
                best = min((self.rank[self.piece[a + b]], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in self.piece)[1]
                symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]
            self.parts[t] = (self.piece[symbols[0]], self.piece[symbols[1]])
        return self.parts[t]

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether merging leaves the boundary between pieces ``a`` and ``b``: undo the latest merge beside it, again and again."""
        if a in self.apart[b]:
            return self.apart[b][a]
        left, right, limit, text, rank = a, b, float("inf"), self.text, self.rank
        while True:
            joined = self.piece.get(text[left] + text[right])
            if joined is not None and rank[joined] < limit:
                out = False
                break
            if rank[left] > rank[right]:
                limit, left = rank[left], self._split(left)[1]
            elif rank[right] >= 0:
                limit, right = rank[right] + 0.5, self._split(right)[0]
            else:
                out = True
                break
        if self.n_apart > 500_000:
            for known in self.apart.values():  # the tables stay, the automaton refers to them
                known.clear()
            self.n_apart = 0
        self.apart[b][a] = out
        self.n_apart += 1
        return out

    def walk(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of each distinct word, visiting them in trie order.

        Of each prefix two things are kept: the automaton's state and the last piece of its encoding.
        """
        out, before = {}, ""
        last = [-1]  # -1: nothing before; -2: a character outside the vocabulary
        states = [0]
        step, found, apart, sizes = self.next, self.found, self.stay_apart, self.size_of
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], states[shared + 1 :]
            state, i = states[shared], shared
            for c in word[shared:]:
                i += 1
                to = step[state].get(c)
                state = self._jump(state, c) if to is None else to
                for size, t, known in found[state]:  # the longest piece that may follow
                    left = last[i - size]
                    if left < 0:
                        break
                    free = known.get(left)
                    if apart(left, t) if free is None else free:
                        break
                else:
                    t = -2
                states.append(state)
                last.append(t)
            ids = []
            while i:
                t = last[i]
                if t >= 0:
                    ids.append(t)
                    i -= sizes[t]
                else:
                    i -= 1
                    ids += [self.byte[b] for b in reversed(word[i].encode("utf-8", "surrogatepass"))]
            ids.reverse()
            out[word] = ids
            before = word
        return out

    def _learn(self, words: list[str]) -> None:
        found = self.walk(words)
        names = [w for w in found if w != MARK]
        for w, exact in zip(names, self.sp.encode([w[1:].replace(MARK, " ") for w in names], num_threads=1)):
            if found[w] != exact:
                self.differing.add(w)
        self.cache.update((w, pack("<%dI" % len(x), *x)) for w, x in found.items())

    @staticmethod
    def marked_words(text: str) -> list[str]:
        """The text's words, each with the marks before it; none for an empty text."""
        if not text:
            return []
        parts = text.replace(MARK, " ").split(" ")
        if all(parts):  # single spaces only
            return [MARK + p for p in parts]
        words, marks = [], ""
        for part in parts:
            marks += MARK
            if part:
                words.append(marks + part)
                marks = ""
        return words + [marks] if marks else words

    @property
    def corrected(self) -> int:
        """Distinct words so far whose ids the library's encoder disputes."""
        return len(self.differing)

    def encode(self, texts):
        """Yields each text's ids as uint32 bytes; null like empty."""
        return (ids for ids, _ in self.encode_checked(texts))

    def encode_checked(self, texts):
        """Yields each text's ids and its number of words that the library sees differently, a bounded slice at a time."""
        for part in _slices(texts):
            lists = [self.marked_words(t) for t in part]
            if len(self.cache) > self.cache_words // 2:
                self.older, self.cache = self.cache, {}
            need = [w for w in set().union(*lists) if w not in self.cache]
            self.cache.update((w, self.older[w]) for w in need if w in self.older)
            self._learn([w for w in need if w not in self.older])
            get, differing = self.cache.__getitem__, self.differing
            for words in lists:
                yield b"".join(map(get, words)), sum(w in differing for w in words) if differing else 0

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        if not hasattr(self, "bytes"):
            self.bytes = [bytes([int(t[3:5], 16)]) if self.sp.is_byte(i) else b"" if self.sp.is_control(i) else t.replace(MARK, " ").encode() for i, t in enumerate(self.text)]
        text = b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _slices(texts):
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode_pieces(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, n_ids, n_differs)``: whole texts as uint32 LE piece ids, one row per input row.

    ``n_differs`` counts the words whose ids the library's encoder disputes (none in any test).

    Null and empty texts have no ids; null ids stay; other columns are ignored;
    an empty table gives no rows.  No shuffle; memory is bounded by a slice of
    texts and the word cache.
    """
    path = model or tokenizer_path("piece_bpe_32k.model")

    def run(batches):
        walker = worker_walker(path)
        for batch in batches:
            ids, differs = zip(*walker.encode_checked(texts_of(batch.column(1)))) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(differs, pa.int64())], ["doc_id", "ids", "n_ids", "n_differs"])

    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")
    lean_batches(docs.sparkSession)
    return rows.mapInArrow(run, "doc_id bigint, ids binary, n_ids bigint, n_differs bigint")


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encode_pieces`` rows with their text again (column ``text``; null ids give a null text)."""
    path = model or tokenizer_path("piece_bpe_32k.model")

    def run(batches):
        walker = worker_walker(path)
        for batch in batches:
            texts = [None if x is None else walker.decode(np.frombuffer(x, "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "n_ids", "n_differs", "text"])

    return encoded.select("doc_id", "ids", "n_ids", "n_differs").mapInArrow(run, "doc_id bigint, ids binary, n_ids bigint, n_differs bigint, text string")
