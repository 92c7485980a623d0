"""Token counts of a unigram tokenizer: Aho-Corasick matches and a Viterbi pass that carries counts only."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from .common import col, packed, pieces, unpacked

SPACE = "▁"  # stands for a blank, and opens every word
UNKNOWN_PENALTY = 10.0  # how far an unknown character's score lies below the lowest piece's
TOKENIZER_FOLDER = os.environ.get("TOKENIZER_FOLDER", "/opt/tokenizers")
#: Most pieces of a vocabulary that is broadcast to the workers (about 100 bytes each).
MAX_PIECES = 2_000_000


def piece_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces of a sentencepiece model with log scores by rank, as a Zipf law has them; and the unknown's id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces_ = [(model.id_to_piece(i), -math.log(i + 2.0)) for i in range(model.get_piece_size())]
    return pieces_, model.unk_id()


class UnigramCounter(dict):
    """Number of tokens of a word, by word; remembers up to ``LIMIT`` short words and then starts anew.

    Of all ways to cut a word into pieces the one with the highest sum of scores counts, summed from the
    left. Of equal sums at a position, the one whose last piece begins first stays. A character that is
    no piece by itself may be unknown; neighbouring unknown characters are one token, or with
    ``byte_fallback``, if the vocabulary has all byte pieces they need, a token per byte.
    """

    LIMIT, SHORT = 400_000, 64

    def __init__(self, vocabulary: Sequence[tuple[str, float]], unknown: int, byte_fallback: bool = True):
        super().__init__()
        self.matches = ahocorasick.Automaton()
        for number, (piece, score) in enumerate(vocabulary):
            if piece and piece not in self.matches:
                self.matches.add_word(piece, (len(piece), score, number == unknown))
        self.matches.make_automaton()
        self.known = {piece for piece, _ in vocabulary}
        self.single = {p for p in self.known if len(p) == 1}
        self.unknown_score = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.unknown_piece = vocabulary[unknown][0]
        self.bytes = {b for b in range(256) if f"<0x{b:02X}>" in self.known} if byte_fallback else set()

    def __missing__(self, rest: str) -> int:
        count = self._count(SPACE + rest)
        if len(rest) <= self.SHORT:
            if len(self) >= self.LIMIT:
                self.clear()
            self[rest] = count
        return count

    def _count(self, word: str) -> int:
        if not self.single.issuperset(word) or self.unknown_piece in word:
            return self._count_unknown(word)
        best, count = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
        for last, (length, score, _) in self.matches.iter(word):  # at each end the longest piece first
            start, end = last + 1 - length, last + 1
            score += best[start]
            if score > best[end]:
                best[end], count[end] = score, count[start] + 1
        return count[-1]

    def _unknown_tokens(self, run: str) -> int:
        if run in self.known:
            return 1
        data = run.encode()
        return len(data) if self.bytes.issuperset(data) else 1

    def _count_unknown(self, word: str) -> int:
        """As above, where characters may be unknown; ``run`` is where the unknown run that ends here begins."""
        size = len(word)
        best, count, run = [0.0] + [-math.inf] * size, [0] * (size + 1), [-1] * (size + 1)
        found: list[list] = [[] for _ in range(size + 1)]
        for last, value in self.matches.iter(word):
            found[last + 1].append(value)
        for end in range(1, size + 1):
            if not found[end] or found[end][-1][0] != 1:
                found[end].append((1, self.unknown_score, True))
            for length, score, unknown in found[end]:
                start = end - length
                score += best[start]
                if score > best[end]:
                    best[end] = score
                    if unknown:
                        run[end] = run[start] if run[start] >= 0 else start
                        count[end] = count[run[end]] + self._unknown_tokens(word[run[end] : end])
                    else:
                        run[end], count[end] = -1, count[start] + 1
        return count[-1]

    def of_text(self, text: str) -> tuple[int, int]:
        """Tokens and words of a text. A word begins at each blank, and at the start of the text."""
        if not text:
            return 0, 0
        words = text.replace(" ", SPACE)
        words = (words if words[0] == SPACE else SPACE + words).split(SPACE)
        return sum(map(self.__getitem__, words[1:])), len(words) - 1


def token_counts(
    docs: DataFrame,
    vocabulary: Sequence[tuple[str, float]],
    unknown: int,
    text_col: str = "text",
    byte_fallback: bool = True,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) plus ``n_tokens`` and ``n_pretokens``.

    Counts equal those of a unigram model with this vocabulary behind a pre-tokenizer that replaces
    blanks by SPACE, puts one in front and splits before each. Texts are taken as they are, whole. The
    vocabulary is broadcast; its size is checked. Null and empty texts have no tokens. Rows are neither
    dropped nor merged; output columns replace columns of the same name.
    """
    if not 0 < len(vocabulary) <= MAX_PIECES:
        raise ValueError(f"a vocabulary has 1 to {MAX_PIECES} pieces, not {len(vocabulary)}")
    outputs = ("n_tokens", "n_pretokens")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outputs]
    shared = docs.sparkSession.sparkContext.broadcast((list(vocabulary), unknown, byte_fallback))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter(*shared.value)
        for batch in batches:
            for first, texts in pieces(batch, 1):
                counts = [counter.of_text((t or b"").decode()) for t in texts]
                columns = [batch.column(0).slice(first, len(texts))]
                columns += [pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", *outputs])

    rows = docs.select(packed(docs, kept), col(text_col).cast("binary").alias("text"))
    out = StructType([rows.schema["row"], *[StructField(o, LongType()) for o in outputs]])
    return rows.mapInArrow(scan, out).select(*unpacked(kept), *outputs)
