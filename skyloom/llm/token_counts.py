"""Token counts by a unigram model, with dynamic programming shared along a trie of pre-tokens.

A text is split at ASCII white space, and every word, marked at its front, is a pre-token. The best segmentation of a
prefix does not depend on what follows, so the distinct pre-tokens of a batch are taken in sorted order, which is the
depth-first order of their trie: forward scores stay on a stack, and a pre-token extends those of the prefix that it
shares with the one before. What is stored at its terminal, the number of tokens of the best segmentation, serves every
occurrence. Nothing is shuffled; a task keeps at most `keep` terminals.

Pieces are those of a public vocabulary; it has no probabilities, so scores are trained on the corpus by Viterbi EM. The
words of all texts are counted (a task sums its own before the shuffle), and in each of ROUNDS rounds every distinct
word is segmented by the scores so far, the pieces it takes are summed with the word's count, and a piece's new score is
the logarithm of its share, with one more of each. The first round's scores are all alike, so that it takes the fewest
pieces. What the driver gets is a count for each piece of the vocabulary. A character outside all pieces costs one token
a byte. Of equal scores, fewer tokens win.

Defined results: null, empty and white texts have no tokens. Repeated rows count alike. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
ROUNDS = 3


def vocabulary(path: str) -> list[str]:
    """The pieces of a vocabulary file that stand for text."""
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path)
    return [own.id_to_piece(i) for i in range(own.get_piece_size()) if not (own.is_control(i) or own.is_unknown(i) or own.is_byte(i))]


class Pieces:
    """Scores of pieces, from how often each was taken; none: all alike."""

    def __init__(self, names: list[str], taken: dict[str, int] | None = None):
        taken = taken or {}
        total = math.log(sum(taken.values()) + len(names))
        self.score = {p: math.log(taken.get(p, 0) + 1) - total for p in names}
        self.unknown = min(self.score.values(), default=0.0) - 10
        #: Pieces from their last character to their first: each node is (following nodes by character, score or None).
        self.back: dict[str, tuple[dict, float | None]] = {}
        for p, s in self.score.items():
            node = self.back
            for c in p[:0:-1]:
                node = node.setdefault(c, ({}, None))[0]
            node[p[0]] = (node[p[0]][0] if p[0] in node else {}, s)


class Trie:
    """Counts of pre-tokens, in ascending order, sharing the scores of common prefixes."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.word = pieces, ""
        self.best, self.count, self.start = [0.0], [0], [0]  # of each prefix of word, and where its last piece begins

    def tokens(self, word: str) -> int:
        back, unknown = self.pieces.back, self.pieces.unknown
        shared, most = 0, min(len(word), len(self.word))
        while shared < most and word[shared] == self.word[shared]:
            shared += 1
        best, count, begin = self.best, self.count, self.start
        del best[shared + 1 :], count[shared + 1 :], begin[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            c = word[end - 1]
            n = 1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
            top, least, at = best[end - 1] + unknown * n, count[end - 1] + n, end - 1
            node, start = back, end
            while start and (hit := node.get(word[start - 1])) is not None:
                start -= 1
                node, s = hit
                if s is not None and (t := best[start] + s) >= top and (t > top or count[start] + 1 < least):
                    top, least, at = t, count[start] + 1, start
            best.append(top)
            count.append(least)
            begin.append(at)
        self.word = word
        return count[-1]

    def path(self) -> list[str]:
        """The pieces, and characters outside them, of the word last given."""
        out, end = [], len(self.word)
        while end:
            out.append(self.word[self.start[end] : end])
            end = self.start[end]
        return out[::-1]


def word_counts(docs: DataFrame, keep: int = 500_000) -> DataFrame:
    """word, n over all texts. A task hands its sums on whenever it holds `keep` words."""

    def run(batches):
        import pyarrow as pa

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.int64())], names=["word", "n"])

        known: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                known.update((t or "").encode("utf-8", "surrogatepass").split())
                if len(known) > keep:
                    yield rows()
                    known = Counter()
        yield rows()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, names: list[str], rounds: int = ROUNDS) -> dict[str, int]:
    """How often each piece is taken in the corpus, after so many rounds."""
    counts, taken = cut(word_counts(docs)), {}
    for _ in range(rounds):
        seed = docs.sparkSession.sparkContext.broadcast(taken)  # bounded by the vocabulary

        def run(batches, seed=seed):
            import pyarrow as pa

            trie, found = Trie(Pieces(names, seed.value)), Counter()
            for batch in batches:
                for w, n in sorted(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                    trie.tokens(MARK + w)
                    for p in trie.path():
                        if p in trie.pieces.score:
                            found[p] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["piece", "n"])

        taken = {r[0]: r[1] for r in counts.mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n")).collect()}  # at most the vocabulary
    return taken


def count_tokens(docs: DataFrame, model: str | None = None, keep: int = 500_000, taken: dict[str, int] | None = None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_words, n_tokens. taken: counts of pieces from a training before; none: trained on docs."""
    names = vocabulary(model or public_tokenizers.path(MODEL))
    docs = docs.select("doc_id", "text")
    taken = docs.sparkSession.sparkContext.broadcast(train(docs, names) if taken is None else taken)

    def run(batches):
        import pyarrow as pa

        pieces, known = Pieces(names, taken.value), {}
        for batch in batches:
            ids, texts = batch.column(0).cast(pa.int64()), batch.column(1).to_pylist()
            words, tokens = [], []
            for at in range(0, len(texts), 256):
                split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts[at : at + 256]]
                new = set().union(*split) - known.keys()
                if len(known) + len(new) > keep:
                    known.clear()
                    new = set().union(*split)
                trie = Trie(pieces)
                for w in sorted(new):  # bytes of UTF-8 sort as their characters do
                    known[w] = trie.tokens(MARK + w.decode("utf-8", "surrogatepass"))
                words += [len(doc) for doc in split]
                tokens += [sum(map(known.__getitem__, doc)) for doc in split]
            yield pa.RecordBatch.from_arrays([ids, pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op6_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"))
