"""Token counts: a BPE tokenizer compiled, state by state, into a deterministic transducer.

A text is right when each pair of neighbouring tokens is right: the tokenizer, given the two alone,
leaves them as they are. So each prefix of a text has exactly one last token, and it is found from
the last tokens of shorter prefixes. The transducer's state is what later letters can still
change: the longest suffix that begins some piece, with the last token and the (relative) token
count at each of its positions. Reading a letter leads to another state and emits the change of
the token count. Transitions are compiled when first met and kept in each Python worker.

Between two letters that no piece holds side by side the state forgets all that came before. Spaces are
such places, so a text is cut there into chunks whose state maps are constant: whatever state
comes in, the same state and count come out. Their counts are kept by chunk, and composing the maps
of a text's chunks in order (a scan) is summing their counts. A chunk without such a place
inside is read letter by letter, whatever its length.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import Generations, appended

#: The letter that stands for a space in pieces (fixed value of the format).
SPACE = "▁"
_NORMAL = 1  # kind of ordinary pieces in the format
MAX_TRANSITIONS = 1_500_000


class Transducer:
    """Counts the tokens that a byte-fallback BPE model of the sentencepiece library gives."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in range(model.get_piece_size()) if not special(i)}
        self.begins = {piece[:n] for piece in self.rank for n in range(1, len(piece))}
        self.beside = {piece[n : n + 2] for piece in self.rank for n in range(len(piece) - 1)}
        if any(SPACE in piece.strip(SPACE) or piece.endswith(SPACE) and piece.strip(SPACE) for piece in self.rank):
            raise ValueError("pieces hold a space after other letters: texts can't be cut at spaces")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.chunks = Generations(self._count_word, limit=250_000)
        self._start()

    def _start(self) -> None:
        """Forget compiled transitions. State 0: nothing before can join with what comes."""
        self.states = [("", (("", 0),))]
        self.number = {self.states[0]: 0}
        self.moves: dict[tuple[int, str], tuple[int, int]] = {}

    def merged(self, letters: str) -> list[str]:
        """Pieces of a short string by the merging rule itself: best piece first, leftmost among equals."""
        parts = list(letters)
        while True:
            best = min(
                ((self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank),
                default=None,
            )
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, left: str, piece: str) -> bool:
        """Do these two stay as they are, side by side?"""
        found = self.pairs.get((left, piece))
        if found is None:
            if len(self.pairs) > MAX_TRANSITIONS:
                self.pairs.clear()
            found = self.pairs[left, piece] = self.merged(left + piece) == ([left, piece] if left else [piece])
        return found

    def move(self, state: int, letter: str) -> tuple[int, int]:
        """(next state, change of the token count), compiled on first use."""
        found = self.moves.get((state, letter))
        if found is not None:
            return found
        open_, entries = self.states[state]
        if letter not in self.rank:  # bytes stand for it, and nothing joins with them
            self.moves[state, letter] = (0, len(letter.encode()))
            return self.moves[state, letter]
        if open_ and open_[-1] + letter not in self.beside:
            open_, entries = "", (("", 0),)
        elif not open_ and entries[0][0] and entries[0][0][-1] + letter not in self.beside:
            entries = (("", 0),)
        seen = open_ + letter
        for k in range(len(seen)):
            piece = seen[k:]
            if piece in self.rank and self.fits(entries[k][0], piece):
                count = entries[k][1] + 1
                break
        else:
            raise ValueError(f"no piece ends at {seen!r}")
        entries = (*entries, (piece, count))
        start = next((k for k in range(len(seen)) if seen[k:] in self.begins), len(seen))
        target = (seen[start:], tuple((token, n - count) for token, n in entries[start:]))
        if target not in self.number:
            self.number[target] = len(self.states)
            self.states.append(target)
        self.moves[state, letter] = (self.number[target], count)
        return self.moves[state, letter]

    def count_chunk(self, letters: str, state: int = 0) -> int:
        """Tokens of a chunk that begins where nothing joins with what came before."""
        if len(self.moves) > MAX_TRANSITIONS:
            self._start()
        total, moves = 0, self.moves
        for letter in letters:
            found = moves.get((state, letter))
            if found is None:
                found = self.move(state, letter)
            state = found[0]
            total += found[1]
        return total

    def _count_word(self, word: str) -> int:
        return self.count_chunk(word if word[:1] == "\n" else SPACE + word)

    def count(self, text: str) -> int:
        """Tokens of a whole text, which the library reads with one space put before it."""
        if not text:
            return 0
        if text[0] in " \n" or "  " in text or SPACE in text:
            letters = SPACE + text.replace(" ", SPACE)
            return sum(map(self.count_chunk, re.findall(f"{SPACE}+[^{SPACE}]*", letters)))
        # A line feed is a byte token: the word after it has no space before it and begins with it here.
        return sum(map(self.chunks.__getitem__, text.replace("\n", " \n").split(" ")))


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One for each Python worker."""
    return Transducer(path)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (n_tokens > limit), from its column text.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each; an empty table
    gives no rows; columns with the new names are replaced, others stay. Texts are read whole. The
    file of the model must be at the same path on every executor.
    """
    counted = appended(docs, ["text"], lambda texts: [list(map(transducer(model).count, texts))], "n_tokens bigint")
    return counted.withColumns(
        {"n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"), "over_limit": F.col("n_tokens") > limit}
    )
