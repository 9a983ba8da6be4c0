"""Word-piece token counts by a linear longest-match automaton (op 6).

Greedy word-piece segmentation takes the longest vocabulary piece that starts
at the current place, again and again. The automaton is the vocabulary's trie
with failure links: when no child fits, the pieces that are certain by then are
popped, only their number is kept (``pops``), and the failure link leads to the
node of the remaining characters. So each byte is read once and no piece is
built. ``rest`` is the number of pieces left when a word ends at a node.

Words are runs without ASCII white space; a word is matched as marker + bytes,
where vocabulary entries with the marker in front are word beginnings and all
others continue a word. A word that cannot be cut counts as one unknown piece.

The automaton (some MB, bounded by the vocabulary) is built on the driver from
the vocabulary file the caller names and shipped with the tasks; tasks run it
over the distinct words of a chunk in lock step. One narrow pass, no shuffle.

Edge cases: null or empty text has 0 words and 0 tokens; very long words are
walked alone; repeated rows repeat their result; null ids stay null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ByteHash, ship_package, text_chunks, word_spans

_LONG_WORD = 256


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a rank file (base64 piece and rank per line); a leading space marks word beginnings."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class PieceAutomaton:
    """Counts greedy longest-match pieces of marker + word."""

    def __init__(self, pieces: Iterable[bytes], marker: bytes = b" "):
        child: dict[int, int] = {}
        is_piece = [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                node = child.setdefault(node << 8 | byte, len(is_piece))
                if node == len(is_piece):
                    is_piece.append(False)
            is_piece[node] = bool(piece) or is_piece[node]
        n = len(is_piece)
        fail, pops = [-1] * n, [0] * n
        below: dict[int, list[tuple[int, int]]] = {}
        for key, node in child.items():
            below.setdefault(key >> 8, []).append((key & 255, node))
        queue, order = deque([0]), []
        while queue:
            u = queue.popleft()
            order.append(u)
            for byte, v in below.get(u, ()):
                queue.append(v)
                if is_piece[v]:
                    fail[v], pops[v] = 0, 1
                    continue
                z, popped = fail[u], pops[u]
                while z != -1 and z << 8 | byte not in child:
                    popped += pops[z]
                    z = fail[z]
                if z != -1:
                    fail[v], pops[v] = child[z << 8 | byte], popped
        rest = [0] * n  # -1: the word cannot be cut
        for v in order[1:]:
            tail = -1 if fail[v] == -1 else rest[fail[v]]
            rest[v] = -1 if tail == -1 else pops[v] + tail
        keys = np.fromiter(child.keys(), np.int64, len(child))
        by_key = np.argsort(keys)
        self._keys = keys[by_key]
        self._targets = np.fromiter(child.values(), np.int64, len(child))[by_key]
        self._fail, self._pops, self._rest = (np.array(x, np.int64) for x in (fail, pops, rest))
        start = 0
        for byte in marker:
            start = -1 if start == -1 else child.get(start << 8 | byte, -1)
        if start == -1:
            raise ValueError("no vocabulary entry begins with the marker")
        self._start = start

    def _step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node << 8 | byte
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._targets[at], -1)

    def _one(self, word: np.ndarray) -> int:
        child = self.__dict__.setdefault("_child", dict(zip(self._keys.tolist(), self._targets.tolist())))
        fail, pops = self._fail, self._pops
        node, count = self._start, 0
        for byte in word.tolist():
            while (to := child.get(node << 8 | byte, -1)) == -1:
                count += int(pops[node])
                node = int(fail[node])
                if node == -1:
                    return -1
            node = to
        return -1 if self._rest[node] == -1 else count + int(self._rest[node])

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start:end]; -1 when it cannot be cut."""
        out = np.zeros(len(start), np.int64)
        long = end - start > _LONG_WORD
        for k in np.flatnonzero(long):
            out[k] = self._one(data[start[k]: end[k]])
        live = np.flatnonzero(~long)
        at, stop = start[live], end[live]
        node = np.full(len(live), self._start, np.int64)
        while len(live):
            to = self._step(node, data[at].astype(np.int64))
            stuck = to == -1
            out[live[stuck]] += self._pops[node[stuck]]
            node = np.where(stuck, self._fail[node], to)
            at = at + ~stuck
            lost, over = node == -1, at == stop
            out[live[lost]] = -1
            ended = over & ~lost
            rest = self._rest[node[ended]]
            out[live[ended]] = np.where(rest == -1, -1, out[live[ended]] + rest)
            go = ~(lost | over)
            live, at, stop, node = live[go], at[go], stop[go], node[go]
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_child"}


def _count_pass(automaton: PieceAutomaton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in text_chunks(batch.column(1)):
                start, end, doc = word_spans(data, offs)
                if len(start):
                    _, first, back = np.unique(ByteHash(data).ranges(start, end), return_index=True, return_inverse=True)
                    pieces = automaton.counts(data, start[first], end[first])[back]
                else:
                    pieces = np.zeros(0, np.int64)
                lost = pieces == -1
                sums = [np.bincount(doc, weights=w, minlength=j - i).astype(np.int64)
                        for w in (np.ones(len(doc)), np.where(lost, 1, pieces), lost)]
                yield pa.record_batch([batch.column(0).slice(i, j - i), *map(pa.array, sums)],
                                      names=["doc_id", "n_words", "n_tokens", "n_unknown"])
    return run


def token_counts(docs: DataFrame, automaton: PieceAutomaton) -> DataFrame:
    """One row per input row: doc_id, n_words, n_tokens, n_unknown (words that cannot be cut)."""
    ship_package(docs.sparkSession)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return table.mapInArrow(_count_pass(automaton), "doc_id long, n_words long, n_tokens long, n_unknown long")
