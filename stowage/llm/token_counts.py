"""Token counts by a unigram vocabulary: matches from an Aho-Corasick automaton, a Viterbi pass that only counts."""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")
#: What an unknown character costs beyond the least score of the vocabulary (fixed value of the tokenizer's rules).
UNKNOWN_PENALTY = 10.0


def vocabulary(path: str | None = None) -> tuple[tuple[str, float], ...]:
    """Pieces with scores, in the order of their ids, of a vocabulary file; by default the 32,000 pieces provided."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))


class Counter:
    """Counts pieces of the best segmentation of a word, without keeping the segmentation.

    The rules are those of the unigram tokenizer: the greatest sum of scores wins; of equal sums the one whose last
    piece begins first; a character that no piece matches alone may be unknown, at ``UNKNOWN_PENALTY`` below the least
    score, and is then counted as its bytes.
    """

    def __init__(self, pieces):
        self.automaton, self.single = ahocorasick.Automaton(), set()
        #: Whether some piece goes on after a space that follows other characters: then texts cannot be cut there.
        self.joins = any(SPACE in piece.lstrip(SPACE) for piece, _ in pieces)
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
            if len(piece) == 1:
                self.single.add(piece)
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.known = {}

    def count(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            found = self._count(word)
            if len(word) <= 64:
                if len(self.known) >= 500_000:
                    self.known.clear()
                self.known[word] = found
        return found

    def _count(self, word: str) -> int:
        best, pieces = [0.0], [0]
        matches, end = self.automaton.iter(word), -1
        waiting = next(matches, None)
        for end, character in enumerate(word):
            top, count = None, 0
            candidates = []
            while waiting is not None and waiting[0] == end:
                candidates.append(waiting[1])
                waiting = next(matches, None)
            # The longest first: its start is the earliest, and an equal sum does not replace it.
            for length, score in sorted(candidates, reverse=True):
                total = best[end + 1 - length] + score
                if top is None or total > top:
                    top, count = total, pieces[end + 1 - length] + 1
            if character not in self.single:
                total = best[end] + self.unknown
                if top is None or total > top:
                    top, count = total, pieces[end] + len(character.encode())
            best.append(top)
            pieces.append(count)
        return pieces[-1]


def _marked(text: str) -> str:
    marked = text.replace(" ", SPACE)
    return marked if marked[0] == SPACE else SPACE + marked


def words(text: str) -> list[str]:
    """A text's words as the tokenizer sees them, each with the run of spaces before it; a text begins with a space.

    Cut before each run, so that pieces of several spaces match. Exact for vocabularies without a piece in which a space
    follows another character.
    """
    if not text:
        return []
    marked = _marked(text)
    return _RUNS.findall(marked) if SPACE * 2 in marked else [SPACE + w for w in marked[1:].split(SPACE)]


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key``, ``n_tokens``, ``n_words`` for every row, over the whole text.

    Null and empty texts have no tokens. Every space begins a word in ``n_words``, also one of a run. Repeated rows give repeated results; other columns are ignored. The vocabulary
    is a parameter and has a fixed size; every task builds its automaton once.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    kept = docs.select(key, text)

    def step(batches):
        counter = Counter(held.value)
        count = counter.count
        for batch in batches:
            tokens, number = [], []
            for t in batch.column(1).to_pylist():
                marked = _marked(t) if t else ""
                tokens.append(sum(map(count, words(t))) if not counter.joins else count(marked))
                number.append(marked.count(SPACE))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.int64()), pa.array(number, pa.int64())],
                                             names=[key, "n_tokens", "n_words"])

    zero = F.lit(0).cast("long")
    return kept.mapInArrow(step, kept.select(key, zero.alias("n_tokens"), zero.alias("n_words")).schema)
