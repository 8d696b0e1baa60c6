"""Token counts by a unigram model, with forward scores shared over the prefixes of a trie."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import WORD, bounded_batches, once

MARK = "▁"
#: Words whose counts a task keeps between its batches; it starts anew beyond, with the same results.
HELD = 400_000
_WORD = re.compile(WORD)


@dataclass
class Unigram:
    """Pieces of a public vocabulary with their log probabilities.

    The vocabulary lists pieces by rank and gives no probabilities, so Zipf's law stands for them: a piece of rank r
    has a probability in proportion to 1 / (r + 1). A character that no piece covers is written as its UTF-8 bytes,
    which are pieces of the vocabulary as well, each as likely as the last piece.
    """

    scores: dict[str, float]
    byte_score: float

    @classmethod
    def load(cls, path: str) -> Unigram:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        total = math.log(sum(1 / (r + 1) for r in range(len(plain))))
        scores = {model.id_to_piece(i): -math.log(r + 1) - total for r, i in enumerate(plain)}
        return cls(scores, -math.log(len(plain) + 1) - total)


class Trie:
    """Token counts of words. The words of a batch are inserted in a trie; each of its nodes holds the best score of
    the prefix that it stands for and the tokens of that best path, computed once for all words that share it.

    Words are visited in sorted order, which is the depth-first walk of the trie, so only the nodes from the root to
    the present word are held.
    """

    def __init__(self, model: Unigram, held: int = HELD):
        self.model, self.most, self.known = model, held, {}
        # Every end of a piece with the piece's score, None where it is no piece itself: where a text's end is none of
        # them, no longer end of the text is a piece either.
        self.ends = dict.fromkeys(piece[i:] for piece in model.scores for i in range(len(piece))) | model.scores

    def insert(self, words) -> None:
        """Store the counts of ``words`` at the ends of their paths."""
        scores, byte, ends = self.model.scores, self.model.byte_score, self.ends
        best, tokens, path = [0.0], [0], ""
        for word in sorted(words):
            text = MARK + word
            same = 0
            for a, b in zip(text, path):
                if a != b:
                    break
                same += 1
            del best[same + 1:], tokens[same + 1:]
            for end in range(same + 1, len(text) + 1):
                top, count = -math.inf, 0
                for start in range(end - 1, -1, -1):
                    part = text[start:end]
                    if part not in ends:
                        break
                    piece = ends[part]
                    if piece is not None and best[start] + piece >= top:
                        top, count = best[start] + piece, tokens[start] + 1
                if text[end - 1] not in scores:
                    size = len(text[end - 1].encode("utf-8", "surrogatepass"))
                    if best[end - 1] + size * byte > top:
                        top, count = best[end - 1] + size * byte, tokens[end - 1] + size
                best.append(top)
                tokens.append(count)
            path = text
            self.known[word] = tokens[len(text)]

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """Words and tokens of each text of a batch; the new words of all of them make one trie."""
        words = [_WORD.findall(text) for text in texts]
        fresh = set().union(*words).difference(self.known)
        if len(self.known) + len(fresh) > self.most:
            self.known.clear()
            fresh = set().union(*words)
        self.insert(fresh)
        return [(len(w), sum(map(self.known.__getitem__, w))) for w in words]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``n_words`` and ``n_tokens`` of each row of ``docs``: id and these two columns.

    Words are runs of characters other than blanks, tabs and line ends; each is split into the pieces with the best
    sum of log probabilities, of equal ones that with the longest last piece. Nothing is shuffled: a task counts
    each distinct word of its texts once. Null and empty texts have no words and no tokens. Repeated rows get equal
    results; an empty table gives no rows; further columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(Unigram.load(model_path))  # one vocabulary

    def run(batches):
        trie = once(("trie", model_path), lambda: Trie(held.value))
        for batch in batches:
            made = trie.count([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([w for w, _ in made], pa.int64()), pa.array([t for _, t in made], pa.int64())],
                                             names=[id_col, "n_words", "n_tokens"])
    rows = docs.select(docs[id_col], docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, rows.select(rows[0]).schema.add("n_words", "long").add("n_tokens", "long"))
