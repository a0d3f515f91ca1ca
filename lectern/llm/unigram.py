"""Token counts by a unigram vocabulary: a Viterbi pass that carries score and number of pieces only."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from lectern.llm.bpe import check_file

#: Stands for a space, as in the vocabulary's pieces.
SPACE = "▁"
#: What a character that no piece covers costs, below the lowest score of a piece.
UNKNOWN_PENALTY = 10.0
#: Words, of under 256 characters, that a worker remembers at most (some 30 MB); then it starts afresh.
MEMO_WORDS = 200_000
WORD = re.compile(f"{SPACE}[^{SPACE}]*|[^{SPACE}]+")


class UnigramCounter(dict):
    """word -> number of pieces of its best segmentation; missing words are worked out and remembered.

    An Aho-Corasick automaton over the pieces gives the matches that end at each character, the longest first. The dynamic program keeps, for each end, the best score and the
    pieces that lead to it; a later match must be strictly better, so of equal scores the one that begins first stays. A character without a piece of its own may also be taken as unknown;
    unknown runs count their UTF-8 bytes if the vocabulary has all byte pieces, else one for each run. Scores are double sums.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool):
        super().__init__()
        self.byte_fallback = byte_fallback
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.pieces = ahocorasick.Automaton()
        self.cuts = not any("\n" in p for p, _ in vocabulary) and byte_fallback
        for p, s in vocabulary:
            if p:
                self.pieces.add_word(p, (len(p), s))
        self.pieces.make_automaton()
        self.matches = self.pieces.iter if len(self.pieces) else lambda w: iter(())

    @classmethod
    def from_file(cls, path: str) -> UnigramCounter:
        """The pieces and scores of a SentencePiece file; control and unknown pieces match nothing."""
        sp = SentencePieceProcessor(model_file=path)
        kept = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        return cls([(sp.id_to_piece(i), sp.get_score(i)) for i in kept], sum(sp.is_byte(i) for i in kept) == 256)

    def __missing__(self, word: str) -> int:
        n = len(word)
        score, pieces, fused = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.matches(word):
            ends[end].append(match)
        for end, found in enumerate(ends, 1):
            best, at, size = None, 0, 0
            for size, s in found:
                total = score[end - size] + s
                if best is None or total > best:
                    best, at = total, size
            if size != 1:  # the shortest match comes last
                total = score[end - 1] + self.unknown
                if best is None or total > best:
                    best, at = total, 0
            score[end] = best
            if at:
                pieces[end] = pieces[end - at] + 1
            else:
                fused[end] = True
                more = len(word[end - 1].encode()) if self.byte_fallback else not fused[end - 1]
                pieces[end] = pieces[end - 1] + more
        if len(self) >= MEMO_WORDS:
            self.clear()
        if n < 256:
            self[word] = pieces[n]
        return pieces[n]

    def count(self, text: str | None) -> int:
        """Tokens of a text: spaces become SPACE, one is put before a text that begins without, and words begin at each. Null and empty: 0."""
        if not text:
            return 0
        marked = text.replace(" ", SPACE)
        marked = marked if marked[0] == SPACE else SPACE + marked
        breaks = 0
        if self.cuts and "\n" in marked:  # no piece holds a line break: each is one byte piece, and what it parts is independent
            breaks = marked.count("\n")
            return breaks + sum(map(self.__getitem__, (w for line in marked.split("\n") for w in WORD.findall(line))))
        return sum(map(self.__getitem__, WORD.findall(marked)))


@lru_cache(1)
def counter(path: str) -> UnigramCounter:
    return UnigramCounter.from_file(path)


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of each text; the vocabulary's file must lie at the same place on every machine."""

    @F.arrow_udf("long")
    def unigram_tokens(texts: pa.Array) -> pa.Array:
        return pa.array([counter(path).count(t) for t in texts.to_pylist()], pa.int64())

    return unigram_tokens(text)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens. Null and empty texts: 0. Null ids and repeated rows stay; other columns are not read; no rows give none."""
    check_file(path)
    return docs.select(F.col(id_col).alias("doc_id"), token_count(F.col(text_col), path).alias("n_tokens"))
