"""Token counts by a linear longest-match automaton.

Greedy word-piece segmentation takes the longest piece of the vocabulary that
starts a word, then again and again the longest continuation piece. The
automaton is a trie of both kinds of pieces. Where a word leaves the trie, a
failure link leads to the node for what remains once the longest matches are
taken off, and the link holds how many pieces those are. A word is read once,
character by character, and no piece is built.

Words are segmented with the vocabulary's word mark before them, as one of
their characters: where no marked piece matches, the bare mark is a piece of
its own. A character at which no piece matches counts as its byte pieces, or
as one unknown piece in a vocabulary without them; the rest of the word is cut
as usual.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from regline.llm.common import text_or_empty
from regline.session import ship_package

#: Words whose counts a worker remembers before it starts afresh.
REMEMBERED = 400_000
#: Marks pieces that begin a word in the vocabulary.
WORD_START = "▁"


class Automaton:
    """Counts of greedy longest-match pieces.

    ``first`` are the pieces a word may begin with, ``rest`` those it may go
    on with. A word that cannot be cut into pieces to its end counts as one
    unknown piece, unless ``spelled`` is given: the number of pieces that a
    character counts for where no piece matches.
    """

    def __init__(self, first: Iterable[str], rest: Iterable[str], spelled: Callable[[str], int] | None = None):
        self.children: list[dict[str, int]] = [{}, {}]
        self.start, self.go_on = 0, 1
        self.spelled = spelled
        #: Nodes at which a piece ends, and how many pieces it counts for.
        final: dict[int, int] = {}
        for root, pieces in ((self.start, first), (self.go_on, rest)):
            for piece in pieces:
                node = root
                for char in piece:
                    node = self._child(node, char)
                if node != root:
                    final[node] = 1
        if spelled:
            # Then a walk is stuck only at a root, before a character that is in no piece.
            for char in {char for node in self.children for char in node}:
                for root in (self.start, self.go_on):
                    final.setdefault(self._child(root, char), spelled(char))
        self._link(final)

    def _child(self, node: int, char: str) -> int:
        found = self.children[node].get(char)
        if found is None:
            found = self.children[node][char] = len(self.children)
            self.children.append({})
        return found

    def _link(self, final: dict[int, int]) -> None:
        """Failure links and the number of pieces each takes off; -1: nothing matches any more."""
        self.fail = [-1] * len(self.children)
        self.popped = [0] * len(self.children)
        queue = deque((self.start, self.go_on))
        while queue:
            node = queue.popleft()
            for char, child in self.children[node].items():
                queue.append(child)
                if child in final:
                    self.fail[child], self.popped[child] = self.go_on, final[child]
                    continue
                link, taken = self.fail[node], self.popped[node]
                while link >= 0 and char not in self.children[link]:
                    taken += self.popped[link]
                    link = self.fail[link]
                if link >= 0:
                    self.fail[child], self.popped[child] = self.children[link][char], taken

    def count(self, word: str) -> int:
        children, fail, popped = self.children, self.fail, self.popped
        node, pieces = self.start, 0
        for char in word:
            while (step := children[node].get(char)) is None:
                if fail[node] < 0:
                    if self.spelled is None:
                        return 1
                    pieces += self.spelled(char)
                    step = self.go_on
                    break
                pieces += popped[node]
                node = fail[node]
            node = step
        while node != self.go_on:
            if fail[node] < 0:
                return 1 if word else 0
            pieces += popped[node]
            node = fail[node]
        return pieces


class Counts(dict):
    """Piece counts by word (UTF-8, without its mark); fills itself."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        found = self[word] = self.automaton.count(WORD_START + word.decode("utf-8", "surrogatepass"))
        return found

    def of_text(self, text: str) -> tuple[int, int]:
        """Words (runs of anything but ASCII white space) and pieces."""
        if len(self) > REMEMBERED:
            self.clear()
        words = text.encode("utf-8", "surrogatepass").split()
        return len(words), sum(map(self.__getitem__, words))


def pieces_of_model(path: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Word-initial pieces without their mark (the bare mark is the empty one) and continuation pieces of a
    sentencepiece vocabulary, without its control, unknown and byte pieces."""
    model = _model(path)
    usual = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    first = tuple(p.removeprefix(WORD_START) for p in usual if p.startswith(WORD_START))
    return first, tuple(p for p in usual if WORD_START not in p)


def has_byte_pieces(path: str) -> bool:
    """Whether a sentencepiece vocabulary spells the characters it does not hold in bytes."""
    model = _model(path)
    return any(model.is_byte(i) for i in range(model.get_piece_size()))


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _n_bytes(char: str) -> int:
    return len(char.encode("utf-8", "surrogatepass"))


def _one(char: str) -> int:
    return 1


@cache
def _counts(vocabulary: tuple[tuple[str, ...], tuple[str, ...]], in_bytes: bool) -> Counts:
    first, rest = vocabulary
    # A word may hold the mark's character itself, so marked pieces may also go on.
    pieces = [*(WORD_START + p for p in first), *rest]
    return Counts(Automaton(pieces, pieces, _n_bytes if in_bytes else _one))


class TokenCounter:
    """Column function of one vocabulary, which is sent to the executors once (under 1 MB)."""

    def __init__(self, spark: SparkSession, path: str):
        ship_package(spark)
        self.vocabulary = spark.sparkContext.broadcast((pieces_of_model(path), has_byte_pieces(path)))

    def count(self, text: Column) -> Column:
        """A struct of ``n_words`` and ``n_tokens``; a null text counts as empty."""
        vocabulary = self.vocabulary

        def counted(texts: pa.Array) -> pa.Array:
            counts = _counts(*vocabulary.value)
            both = [counts.of_text(t.as_py()) for t in texts]
            return pa.StructArray.from_arrays(
                [pa.array([w for w, _ in both], pa.int64()), pa.array([n for _, n in both], pa.int64())], ["n_words", "n_tokens"]
            )

        return F.arrow_udf(counted, "n_words bigint, n_tokens bigint")(text_or_empty(text))
