"""Operator 9, token counts: pieces of the best unigram segmentation, without building the pieces.

Method. The vocabulary (piece, score) comes from a SentencePiece file. An Aho-Corasick automaton enumerates
all pieces in a text; dynamic programming over end positions carries the best score and the number of pieces
of the best path. Tie rule of the unigram tokenizers: paths to an end are tried by rising start of their last
piece and only a strictly better one replaces the path found before, so the longest last piece wins a tie.
``piece_bpe_32k.model`` is a BPE file whose scores are merge ranks: the counts are those of the best unigram
segmentation over its pieces, not of the file's own BPE encoder (README has figures).
A character without a piece of its own may also be an unknown piece that scores ``min score - 10``; it counts
as one piece a byte if the vocabulary has byte pieces, else neighbouring unknown characters count as one.

Spaces become U+2581 and one is put before a text. No piece has a U+2581 behind another character (checked
when the vocabulary is read; else whole texts are segmented), so every stretch from a run of them to the
next is segmented on its own and remembered. Scores are summed as doubles, exact for integer scores.

Defined results. Null or empty text: no pieces, score 0. Repeated rows give repeated rows; a null doc_id
stays null. An empty table gives no rows. Texts of any length are counted whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bounded_batches, doc_id, public_id

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 300_000
LONG = 256
_STRETCH = re.compile(f"{SPACE}+[^{SPACE}]*")


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], float, bool]:
    """(pieces that text can match, least score of all, byte pieces present)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    scores = [sp.get_score(i) for i in range(n)]
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return [(sp.id_to_piece(i), scores[i]) for i in plain], min(scores), sum(map(sp.is_byte, range(n))) == 256


class Counter:
    """Counts the pieces of texts; one per Python worker."""

    def __init__(self, pieces: list[tuple[str, float]], least: float, byte_pieces: bool):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown, self.byte_pieces = least - UNKNOWN_PENALTY, byte_pieces
        self.stretches = not any(SPACE in p.lstrip(SPACE) for p, _ in pieces)
        self.known: dict[str, tuple[int, float]] = {}

    def segment(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best path through ``text``."""
        n = len(text)
        score, count, start, unknown = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1), [False] * (n + 1)
        done = 0

        def close(end):
            """Unknown characters up to ``end``: tried last, as they start last."""
            nonlocal done
            for e in range(done + 1, end + 1):
                ch = text[e - 1]
                if ch not in self.single:
                    s = score[e - 1] + self.unknown
                    if start[e] < 0 or s > score[e]:
                        pieces = len(ch.encode("utf-8", "surrogatepass")) if self.byte_pieces else int(not unknown[e - 1])
                        score[e], count[e], start[e], unknown[e] = s, count[e - 1] + pieces, e - 1, True
            done = end

        for last, (length, value) in self.automaton.iter(text):
            end = last + 1
            if end - 1 > done:
                close(end - 1)
            at = end - length
            s = score[at] + value
            if start[end] < 0 or s > score[end] or (s == score[end] and at < start[end]):
                score[end], count[end], start[end] = s, count[at] + 1, at
        close(n)
        return count[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = SPACE + text.replace(" ", SPACE)
        known, total, sum_score = self.known, 0, 0.0
        for stretch in _STRETCH.findall(marked) if self.stretches else [marked]:
            found = known.get(stretch)
            if found is None:
                found = self.segment(stretch)
                if len(stretch) <= LONG:
                    if len(known) >= CACHE:
                        known.clear()
                    known[stretch] = found
            total += found[0]
            sum_score += found[1]
        return total, sum_score


def _count(path: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(*read_vocabulary(path))
        for f in frames:
            found = [counter.count(t) for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "n_tokens": [c for c, _ in found], "score": [s for _, s in found]})
    return run


def count_tokens(documents: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, score) for every row of ``documents`` (doc_id, text)."""
    docs = bounded_batches(documents).select(doc_id().alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = docs.mapInPandas(_count(vocabulary), "doc_id long, n_tokens long, score double")
    return counted.withColumn("doc_id", public_id("doc_id"))


def query(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    from sluice.llm.common import table
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
