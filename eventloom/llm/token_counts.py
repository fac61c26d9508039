"""Operator 2, token counts by a linear longest-match automaton.

Greedy word pieces: a word takes the longest vocabulary entry that begins it,
then again and again the longest continuation entry; a word of which some rest
has no entry is one unknown token. The vocabulary is a trie with two roots (word
starts, continuations). Each node has a failure link, to the node that holds
what is left after popping whole pieces from its string, and the number of
pieces popped. A word is counted in one walk along its bytes, without building
a piece and without going back. Many distinct words walk side by side in
numpy; each worker walks a word once.

Words are runs of characters other than space and \\t to \\r. Null and empty texts have no
words and count 0. Rows that repeat are counted each. Empty tables give empty
results; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import kernel as K
from eventloom.llm.wordcache import WordCache

START, REST, NONE = 0, 1, -1


class LongestMatch:
    """Automaton over the UTF-8 bytes of ``starts`` (entries that begin a word) and ``rests`` (continuations)."""

    def __init__(self, starts: Iterable[bytes], rests: Iterable[bytes]):
        child: list[dict[int, int]] = [{}, {}]
        entry = [False, False]
        for root, pieces in ((START, starts), (REST, rests)):
            for piece in pieces:
                if not piece:
                    continue
                node = root
                for byte in piece:
                    if byte not in child[node]:
                        child[node][byte] = len(child)
                        child.append({})
                        entry.append(False)
                    node = child[node][byte]
                entry[node] = True
        fail, popped = [NONE] * len(child), [0] * len(child)
        level = [START, REST]
        while level:
            below = []
            for node in level:
                for byte, to in child[node].items():
                    below.append(to)
                    if entry[to]:
                        fail[to], popped[to] = REST, 1
                        continue
                    at, n = fail[node], popped[node]
                    while at != NONE and byte not in child[at]:
                        at, n = fail[at], n + popped[at]
                    if at != NONE:
                        fail[to], popped[to] = child[at][byte], n
            level = below
        edges = np.array(sorted((node << 8 | byte, to) for node, to_by in enumerate(child) for byte, to in to_by.items()), np.int64).reshape(-1, 2)
        self.edge, self.to = edges[:, 0].copy(), edges[:, 1].copy()
        self.fail, self.popped = np.array(fail, np.int64), np.array(popped, np.int64)

    def _step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node << 8 | byte
        at = np.minimum(np.searchsorted(self.edge, key), max(len(self.edge) - 1, 0))
        return np.where(self.edge[at] == key, self.to[at], NONE) if len(self.edge) else np.full(len(node), NONE)

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start:end]; 0 for a word that has no full match."""
        length = end - start
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        node, tokens = np.full(len(start), START, np.int64), np.zeros(len(start), np.int64)
        dead = np.zeros(len(start), bool)
        alive = len(start)
        for i in range(int(length[0]) if len(length) else 0):
            alive = int(np.searchsorted(-length[:alive], -i, side="left"))  # the words longer than i
            todo = np.flatnonzero(~dead[:alive])
            byte = data[start[todo] + i].astype(np.int64)
            while len(todo):
                to = self._step(node[todo], byte)
                moved = to != NONE
                node[todo[moved]] = to[moved]
                todo, byte = todo[~moved], byte[~moved]
                dead[todo[self.fail[node[todo]] == NONE]] = True
                live = ~dead[todo]
                todo, byte = todo[live], byte[live]
                tokens[todo] += self.popped[node[todo]]
                node[todo] = self.fail[node[todo]]
        todo = np.flatnonzero(~dead & (node > REST))
        while len(todo):
            dead[todo[self.fail[node[todo]] == NONE]] = True
            todo = todo[~dead[todo]]
            tokens[todo] += self.popped[node[todo]]
            node[todo] = self.fail[node[todo]]
            todo = todo[node[todo] > REST]
        out = np.empty(len(start), np.int64)
        out[order] = np.where(dead, 0, tokens)
        return out


_COUNTERS: dict[str, WordCache] = {}


def read_vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """(word starts, continuations) of a sentencepiece file: pieces with a leading U+2581 begin
    words; control, byte and white-space pieces take no part."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    starts, rests = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        bare = piece.removeprefix("▁")
        if bare and "▁" not in bare:
            (starts if bare != piece else rests).append(bare.encode())
    return starts, rests


def _counter(path: str) -> WordCache:
    if path not in _COUNTERS:
        automaton = LongestMatch(*read_vocabulary(path))

        def solve(data, start, end):
            return np.ones(len(start), np.int64), automaton.count(data, start, end)

        _COUNTERS[path] = WordCache(solve)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_tokens, n_unknown); an unknown word is one token."""
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        cache = _counter(vocabulary_path)
        for batch in batches:
            columns = [[], [], []]
            for _, data, bounds in K.blocks(batch.column(1)):
                w, hashes = K.word_hashes(data, bounds)
                first, _ = cache.look_up(data, w, hashes)
                pieces = cache.flat[first].astype(np.int64)
                unknown = pieces == 0
                for column, value in zip(columns, (np.ones(len(pieces), np.int64), pieces + unknown, unknown.astype(np.int64))):
                    column.append(np.diff(np.concatenate([[0], np.cumsum(value)])[w.first]))
            out = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], [id_col, "n_words", "n_tokens", "n_unknown"])

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return narrow.mapInArrow(count, f"`{id_col}` {kind}, n_words long, n_tokens long, n_unknown long")
