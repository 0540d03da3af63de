"""SentencePiece encoding and decoding by a Viterbi pass shared over common prefixes.

The distinct marked words of a batch are sorted, which lays them out as a depth-first
walk of their trie: a word keeps the forward states of the prefix it has in common with
its predecessor and computes only those behind it.

The forward state of a prefix is the last piece of the prefix's encoding. For a model of
merges that piece is the only vocabulary piece that ends there, follows a reachable state
and *holds its border*: merging the two pieces' characters gives back the same two pieces.
(A sequence of pieces is an encoding exactly if every neighbouring pair holds its border,
so one state per prefix is enough and the last state gives the whole encoding backwards.)
For a unigram model the state is the best-scoring last piece. Both give what the library
gives. Characters without a piece are written as byte pieces.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import text_slices

MARK, CUT = "▁", "\0"
# Encoded words a worker process remembers; then the older half is forgotten.
WORD_MEMORY = 250_000
_CODERS: dict[str, PieceCoder] = {}


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


class _Raw(dict):
    """Id → bytes of its piece; other ids stand for nothing."""

    def __missing__(self, _) -> bytes:
        return b""


class PieceCoder:
    """Encoder and decoder over one SentencePiece model file (read, never trained)."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.border: dict[str, dict[str, bool]] = {}
        self.borders = 0
        self.model = sp = SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.piece_id = {sp.id_to_piece(i): i for i in plain}
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.longest = max(map(len, self.piece_id))
        self.byte_id = {int(sp.id_to_piece(i)[3:-1], 16): i for i in ids if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        # Without byte pieces an unknown character is the model's unknown piece.
        self.merges = not self._is_unigram()
        chars = set("".join(self.piece_id))
        inner = any(MARK in p.lstrip(MARK) for p in self.piece_id)
        self.walls = [c for c in "\n\t\r" if c not in chars]
        walls = "".join(map(re.escape, self.walls))
        # Words: marks, then characters up to the next mark or a character no piece has.
        self.words = re.compile(f"{MARK}+[^{MARK}{walls}]*|[^{MARK}{walls}]+|[{walls}]" if walls else
                                f"{MARK}+[^{MARK}]*|[^{MARK}]+") if not inner else re.compile("(?s).+")
        # Most texts split at single marks alone; the pattern is for the others.
        self.simple = not inner and CUT not in chars
        self.unknown_score = min(self.score.values()) - 10.0
        # Pieces that merging can make.
        self.whole = {p for p in self.piece_id if self.merged(p) == [p]} if self.merges else set()
        # The states of the trie of these pieces are their beginnings: a text's state is its longest
        # ending among them, with the pieces of several characters that end there, long first. The
        # steps between states are noted when first taken.
        self.starts = {p[:i] for p in self.whole for i in range(1, len(p) + 1)} | {""}
        self.endings: dict[str, tuple] = {}
        self.noted = 0
        self.root = self._state("")
        self.raw = _Raw({i: p.replace(MARK, " ").encode() for p, i in self.piece_id.items()})
        self.raw.update({i: bytes([b]) for b, i in self.byte_id.items()})
        self.packed = {p: _packed([i]) for p, i in self.piece_id.items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.dummy = sp.normalize("a").startswith(MARK)

    def _is_unigram(self) -> bool:
        # Scores of merge models are minus the merge's rank: whole numbers.
        return any(s != int(s) for s in self.score.values() if np.isfinite(s))

    # -- the merge rule, on the characters of two pieces ------------------------------

    def merged(self, text: str) -> list[str]:
        """Characters merged pairwise, best score first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def holds(self, left: str, right: str) -> bool:
        if self.borders >= 4 * WORD_MEMORY:
            self.border.clear()
            self.borders = 0
        self.borders += 1
        known = self.border.setdefault(left, {})[right] = self.merged(left + right) == [left, right]
        return known

    # -- the trie of the pieces ---------------------------------------------------------

    def _state(self, start: str) -> tuple:
        """``(beginning, its steps by character, pieces that end it as (size, piece))``."""
        state = self.endings.get(start)
        if state is None:
            ends = (start[i:] for i in range(len(start) - 1))
            state = self.endings[start] = (start, {}, tuple((len(p), p) for p in ends if p in self.whole))
        return state

    def _step(self, state: tuple, char: str) -> tuple:
        longer = state[0] + char
        at = next(i for i in range(len(longer) + 1) if longer[i:] in self.starts)
        to = self._state(longer[at:])
        if longer[at:]:
            # Characters in no piece lead back to the root; they are not noted, as there are many.
            if self.noted >= 2 * WORD_MEMORY:
                for _, noted, _ in self.endings.values():
                    noted.clear()
                self.noted = 0
            state[1][char] = to
            self.noted += 1
        return to

    # -- the shared forward pass ------------------------------------------------------

    def encode_words(self, words) -> dict[str, bytes]:
        """Distinct words → ids as little-endian 32-bit integers, walking their trie depth-first."""
        out: dict[str, bytes] = {}
        before = ""
        last: list[str] = [""]          # piece that ends the best path to each position
        best: list = [self.root if self.merges else 0.0]    # state of the trie, or the path's score
        step = self._step_merges if self.merges else self._step_unigram
        for word in sorted(words):
            keep, most = 0, min(len(word), len(before))
            while keep < most and word[keep] == before[keep]:
                keep += 1
            del last[keep + 1:], best[keep + 1:]
            step(word, keep + 1, last, best)
            out[word] = self._back(word, last)
            before = word
        return out

    def _step_merges(self, word: str, begin: int, last: list[str], best: list[tuple]) -> None:
        ids, border = self.piece_id, self.border
        state = best[begin - 1]
        for end in range(begin, len(word) + 1):
            char = word[end - 1]
            state = state[1].get(char) or self._step(state, char)
            for size, piece in state[2]:
                left = last[end - size]
                # A character without a piece merges with nothing.
                if not left or left not in ids:
                    break
                known = border.get(left)
                holds = known.get(piece) if known else None
                if self.holds(left, piece) if holds is None else holds:
                    break
            else:
                piece = char
            last.append(piece)
            best.append(state)

    def _step_unigram(self, word: str, begin: int, last: list[str], best: list[float]) -> None:
        for end in range(begin, len(word) + 1):
            top, top_piece = -np.inf, ""
            for start in range(max(0, end - self.longest), end):
                piece = word[start:end]
                s = self.score.get(piece, self.unknown_score if end - start == 1 else None)
                if s is not None and best[start] + s > top:
                    top, top_piece = best[start] + s, piece
            last.append(top_piece)
            best.append(top)

    def _back(self, word: str, last: list[str]) -> bytes:
        ids, at = [], len(word)
        while at:
            piece = last[at]
            known = self.packed.get(piece)
            if known is None:
                known = _packed([self.byte_id[b] for b in piece.encode()] if self.byte_id else [self.unknown])
            ids.append(known)
            at -= len(piece)
        ids.reverse()
        return b"".join(ids)

    # -- whole texts -------------------------------------------------------------------

    def split_words(self, text: str) -> list[str]:
        norm = self.model.normalize(text)
        if not self.simple or 2 * MARK in norm or CUT in norm:
            return self.words.findall(norm)
        for wall in self.walls:
            norm = norm.replace(wall, CUT + wall + CUT)
        return [w for w in norm.replace(MARK, CUT + MARK).split(CUT) if w]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit integers; empty text has none."""
        split = [self.split_words(t) if t else [] for t in texts]
        if len(self.known) >= WORD_MEMORY:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*split).difference(known)
        for word in [w for w in new if w in older]:
            known[word] = older[word]
            new.remove(word)
        known.update(self.encode_words(new))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode_ids(self, ids) -> str:
        """Text of a sequence of ids; control ids stand for nothing."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode(errors="replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


def coder(path: str) -> PieceCoder:
    if path not in _CODERS:
        _CODERS[path] = PieceCoder(path)
    return _CODERS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs(doc_id, text, …)`` → ``(doc_id, n_tokens, ids_crc32, ids, round_trip)``, one row
    per input row; narrow, no shuffle. Null and empty texts have no ids; ``round_trip``
    says that the ids decode to the text."""
    def run(batches):
        own = coder(path)
        for batch in text_slices(batches, limit=4 << 20):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = own.encode_texts(texts)
            flat = np.frombuffer(b"".join(ids), dtype="<i4")
            counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            back = [own.decode_ids(np.frombuffer(x, "<i4").tolist()) == t for x, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(back)],
                names=["doc_id", "n_tokens", "ids_crc32", "ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, ids array<int>, round_trip boolean")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens(doc_id, ids)`` → ``(doc_id, text)``; null ids decode to empty text."""
    def run(batches):
        own = coder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([own.decode_ids(x or []) for x in batch.column(1).to_pylist()], pa.string())],
                names=["doc_id", "text"])

    return tokens.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
