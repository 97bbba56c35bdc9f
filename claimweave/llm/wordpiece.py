"""Token counts by a linear longest-match automaton: a trie of pieces with failure links and popped-token counts."""

from __future__ import annotations

from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .texts import text_rows, with_null_ids

VOCABULARY = "piece_bpe_32k.model"
START = "▁"  # marks pieces that begin a word
CACHED_WORDS = 500_000
CACHED_CHARS = 40

_AUTOMATA: dict[str, "Automaton"] = {}


class Automaton:
    """Counts greedy longest-match pieces of a word in time linear in its length, and builds no piece.

    A node is a prefix of pieces. Where no child matches, the automaton pops the longest pieces off the node's
    text and goes on from what is left: ``pops`` says how many pieces that takes, ``fail`` at which node it ends.
    Only the first piece of a word begins with ``START``; the others are found from the root.
    """

    def __init__(self, pieces):
        self.child: list[dict[str, int]] = [{}]
        self.final = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.final.append(False)
                node = self.child[node][c]
            self.final[node] = True
        self.final[0] = False
        self.fail: list[int | None] = [None] * len(self.child)
        self.pops = [0] * len(self.child)
        queue = [0]
        for node in queue:  # by depth
            for c, down in self.child[node].items():
                queue.append(down)
                if self.final[down]:
                    self.fail[down], self.pops[down] = 0, 1
                    continue
                at, pops = self.fail[node], self.pops[node]
                while at is not None and c not in self.child[at]:
                    pops += self.pops[at]
                    at = self.fail[at]
                if at is not None:
                    self.fail[down], self.pops[down] = self.child[at][c], pops

    def count(self, word: str) -> int:
        """Pieces of the word; 1, the unknown piece, where greedy matching gets stuck. No word has none."""
        node = total = 0
        for c in word:
            while c not in self.child[node]:
                if self.fail[node] is None:
                    return 1
                total += self.pops[node]
                node = self.fail[node]
            node = self.child[node][c]
        while node:
            if self.fail[node] is None:
                return 1
            total += self.pops[node]
            node = self.fail[node]
        return total


def vocabulary(name: str) -> list[str]:
    """Ordinary pieces of a public sentence-piece file, or of a path to one; no control or byte pieces."""
    import os

    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=name if os.sep in name else public_tokenizers.path(name))
    ids = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return [model.id_to_piece(i) for i in ids]


def automaton(name: str) -> Automaton:
    if name not in _AUTOMATA:
        _AUTOMATA[name] = Automaton(vocabulary(name))
    return _AUTOMATA[name]


def _count(batches, name: str):
    machine, known = automaton(name), {}
    for pdf in batches:
        words, tokens = [], []
        for text in pdf["text"]:
            n = 0
            parts = text.split()
            for w in parts:
                k = known.get(w)
                if k is None:
                    k = machine.count(START + w)
                    if len(w) <= CACHED_CHARS:
                        if len(known) >= CACHED_WORDS:
                            known = {}
                        known[w] = k
                n += k
            words.append(len(parts))
            tokens.append(n)
        yield pdf[["doc_id"]].assign(n_words=words, n_tokens=tokens)


def count_tokens(docs: DataFrame, pieces: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens: words split at white space, each cut greedily into the longest known pieces.

    A word that cannot be cut is one unknown token. Null or blank text has no words and no tokens; repeated rows
    and null ids are counted as rows of their own.
    """
    return with_null_ids(text_rows(docs).mapInPandas(partial(_count, name=pieces), "doc_id long, n_words long, n_tokens long"))
