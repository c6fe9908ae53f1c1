"""Token counts by a linear longest-match automaton over a word-piece vocabulary.

The vocabulary is a set of byte strings; those that begin with a space open a word, the others
continue one.  A word is matched as a space and its bytes: the longest piece first, then the
longest that continues, and so on.  The automaton is the vocabulary's trie, where each node has a
failure link and the number of pieces that following it pops, so the greedy piece count comes out
in one pass without building a piece.  Each node also knows how many pieces are popped if the word
ends there.  All single bytes are added to the vocabulary, so every word has pieces.

A chunk's distinct words go through the automaton side by side, one byte a round.

Edge cases: null and empty texts count zero; words of any length are whole words (long ones go
through alone); repeated rows come back once each; other columns are not read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fragloom.llm import arrays as A
from fragloom.llm.spans import picked, received, sent

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Words beyond this many bytes are matched one by one.
LONG = 64


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The byte strings of a rank file: base64, a space and a rank in each line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """edges: sorted node * 256 + byte, with the child of each; fail, pops: failure link and pieces popped on it; ends: pieces popped at a word's end."""

    def __init__(self, vocabulary):
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in {bytes(x) for x in vocabulary if x} | {bytes([i]) for i in range(256)}:
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    final.append(False)
                node = children[node][byte]
            final[node] = True
        fail, pops, ends = [0] * len(children), [0] * len(children), [0] * len(children)
        level = [(0, byte, child) for byte, child in children[0].items()]
        while level:
            below = []
            for parent, byte, node in level:
                if final[node]:
                    fail[node], pops[node] = 0, 1
                else:  # pop what the parent pops, and on, until this byte can follow
                    popped, at = pops[parent], fail[parent]
                    while byte not in children[at]:
                        popped, at = popped + pops[at], fail[at]
                    fail[node], pops[node] = children[at][byte], popped
                ends[node] = pops[node] + ends[fail[node]]
                below += [(node, b, c) for b, c in children[node].items()]
            level = below
        edges = np.array([(node * 256 + byte, child) for node, own in enumerate(children) for byte, child in own.items()], np.int64)
        edges = edges[np.argsort(edges[:, 0])]
        self.edges, self.child = np.ascontiguousarray(edges[:, 0]), edges[:, 1].astype(np.int32)
        self.fail, self.pops, self.ends = (np.array(x, np.int32) for x in (fail, pops, ends))
        self.root = np.array([children[0][byte] for byte in range(256)], np.int32)

    def _follow(self, state, byte, count):
        """The states after one more byte; count gains what is popped."""
        out = np.empty(len(state), np.int32)
        live = np.arange(len(state))
        while len(live):
            here = state[live]
            key = here.astype(np.int64) * 256 + byte[live]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            known = self.edges[at] == key
            out[live[known]] = self.child[at[known]]
            live = live[~known]
            stuck = state[live]
            count[live] += self.pops[stuck]
            state[live] = self.fail[stuck]
            restart = state[live] == 0
            out[live[restart]] = self.root[byte[live[restart]]]
            live = live[~restart]
        return out

    def count(self, text, at, length):
        """Pieces of each word text[at : at + length]."""
        count = np.zeros(len(at), np.int64)
        state = np.full(len(at), self.root[32], np.int32)
        for one in np.flatnonzero(length > LONG):
            count[one] = self._long(text[at[one] : at[one] + length[one]].tobytes())
        order = np.flatnonzero(length <= LONG)
        order = order[np.argsort(-length[order], kind="stable")]
        at, length, inner, gained = at[order], length[order], state[order], count[order]
        for place in range(int(length.max(initial=0))):
            n = int(np.searchsorted(-length, -place, "left"))  # words longer than place come first
            part = gained[:n]
            inner[:n] = self._follow(inner[:n], text[at[:n] + place].astype(np.int64), part)
        count[order] = gained + self.ends[inner]
        return count

    def _long(self, word):
        state, count = int(self.root[32]), 0
        for byte in word:
            while True:
                key = state * 256 + byte
                at = int(np.searchsorted(self.edges, key))
                if at < len(self.edges) and self.edges[at] == key:
                    state = int(self.child[at])
                    break
                count += int(self.pops[state])
                state = int(self.fail[state])
        return count + int(self.ends[state])


def _counter(model):
    def count(batches):
        automaton = received(model)
        for rows, data, bounds in A.text_chunks(batches):
            starts, ends, word_bounds = A.words(data, bounds)
            hashes = A.span_hash(A.prefix(A.BYTE_VALUES[data]), starts, ends)
            _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            length = ends - starts
            pieces = automaton.count(data, starts[first], length[first])[which] if len(starts) else starts
            # Words of one hash are counted once; should two of them differ, each is counted by itself.
            one = first[which] if len(starts) else starts
            again = np.flatnonzero(one != np.arange(len(starts)))
            alike = length[again] == length[one[again]]
            alike[alike] = A.same_bytes(A.big_words(data), starts[again[alike]], starts[one[again[alike]]], length[again[alike]])
            odd = again[~alike]
            pieces[odd] = automaton.count(data, starts[odd], length[odd])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(x, pa.int64()) for x in (np.diff(bounds), np.diff(word_bounds), A.per_document(pieces, word_bounds)))],
                names=["doc_id", "n_bytes", "n_words", "n_tokens"],
            )

    return count


def token_counts(docs: DataFrame, vocabulary: str | list[bytes] = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_words, n_tokens of each document.  vocabulary: a rank file that the driver reads, or the pieces."""
    pieces = read_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary
    model = sent(docs.sparkSession, Automaton(pieces))
    rows = picked(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(_counter(model), "doc_id bigint, n_bytes bigint, n_words bigint, n_tokens bigint")


def query(spark, sf_dir):
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
