"""Token counts of a unigram vocabulary, by Viterbi over the matches that Aho-Corasick finds.

The counts are those of the public tokenizers library's unigram model after its metaspace
pre-tokenizer. For each end in a pre-token the automaton enumerates the pieces that end there,
longest first. Dynamic programming carries the best score, the number of pieces on the best path
and whether that ends with an unknown character; no path is stored. Ties: as in that library a
later candidate must score more, and candidates come by their start, so the longest piece wins;
sums are made from left to right in double precision. A character that is no piece of its own
scores 10 less than the worst piece; neighbouring unknown characters are one unknown piece, or
one piece for each byte if the vocabulary has pieces for all of its bytes.

Pre-tokens: spaces become the mark U+2581, one is put before a text that doesn't begin with one,
and a pre-token begins at each mark. The library keeps no tie or score across pre-tokens, so each
is counted once and remembered within bounds. Defined cases: a null text is empty and has no
tokens; a text of spaces has one token for each mark that is a piece (and what its rule for
unknown ones gives otherwise); texts are never cut, long pre-tokens cost their length times the
longest piece. The counts are a column of the caller's frame: repeated rows get the same count
each, an empty table gives no rows, other columns of any name are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.memory import release

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: A worker remembers between one and two times so many pre-tokens.
REMEMBERED = 300_000
BLOCK_CHARS = 1 << 21


@dataclass
class Pieces:
    """(piece, score) by id, and whether unknown characters become byte pieces."""

    pieces: list[tuple[str, float]]
    byte_fallback: bool = True
    _automaton: object = field(default=None, repr=False)
    _new: dict = field(default_factory=dict, repr=False)
    _old: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"pieces": self.pieces, "byte_fallback": self.byte_fallback,
                "_automaton": None, "_new": {}, "_old": {}}

    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for piece, score in self.pieces:
                if piece:
                    self._automaton.add_word(piece, (len(piece), score))
            self._automaton.make_automaton()
            self.unknown = min(score for _, score in self.pieces) - UNKNOWN_PENALTY
            known = {piece for piece, _ in self.pieces}
            self.byte_pieces = [f"<0x{b:02X}>" in known for b in range(256)]
        return self._automaton

    def unknown_size(self, text: str) -> int:
        """Pieces that a run of unknown characters gives."""
        raw = text.encode("utf-8", "surrogatepass")
        return len(raw) if self.byte_fallback and all(self.byte_pieces[b] for b in raw) else 1

    def count(self, token: str) -> int:
        """Pieces of the best path through one pre-token."""
        matches = self.automaton().iter(token)
        size = len(token)
        score, pieces, run = [0.0] * (size + 1), [0] * (size + 1), [-1] * (size + 1)
        end, found = next(matches, (size, None))
        for at in range(size):
            best, single = None, False
            while end == at:  # longest first
                length, own = found
                start = at + 1 - length
                total = own + score[start]
                if best is None or total > best:
                    best, origin = total, start
                single |= length == 1
                end, found = next(matches, (size, None))
            if not single:
                total = self.unknown + score[at]
                if best is None or total > best:
                    # an unknown run goes on or begins: its pieces are counted when it ends
                    score[at + 1] = total
                    run[at + 1] = run[at] if run[at] >= 0 else at
                    pieces[at + 1] = pieces[at]
                    continue
            score[at + 1] = best
            pieces[at + 1] = pieces[origin] + 1
            if run[origin] >= 0:
                pieces[at + 1] += self.unknown_size(token[run[origin]:origin])
        return pieces[size] + (self.unknown_size(token[run[size]:]) if run[size] >= 0 else 0)

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [_pretokens(t) for t in texts]
        if len(self._new) > REMEMBERED:
            self._old, self._new = self._new, {}
        missing = set().union(*split) - self._new.keys()
        for token in missing:
            n = self._old.get(token)
            self._new[token] = self.count(MARK + token) if n is None else n
        known = self._new
        return [sum([known[t] for t in s]) for s in split]


def _pretokens(text: str) -> list[str]:
    """What follows each mark."""
    if not text:
        return []
    parts = text.replace(MARK, " ").split(" ")
    return parts[1:] if not parts[0] else parts


def load_pieces(path: str) -> Pieces:
    """Pieces and scores of a sentencepiece file, as a unigram vocabulary."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    return Pieces(pieces, any(model.is_byte(i) for i in range(model.get_piece_size())))


class Counter:
    """A column of token counts. The vocabulary is read on the driver and broadcast."""

    def __init__(self, spark: SparkSession, pieces: Pieces) -> None:
        self.shared = spark.sparkContext.broadcast(pieces)

    def count(self, text: Column) -> Column:
        shared = self.shared

        @F.arrow_udf("long")
        def of(texts: pa.Array) -> pa.Array:
            release()
            out, block, held = [], [], 0
            for value in texts:
                text = value.as_py() or ""
                block.append(text)
                held += len(text)
                if held > BLOCK_CHARS:
                    out += shared.value.counts(block)
                    block, held = [], 0
            return pa.array(np.array(out + shared.value.counts(block), np.int64))
        return of(text)
