"""Token counts by the whole-token shortcut.

Offline, on the driver, every vocabulary string is run through the merges, which proves which strings encode alone as one
token; the vocabulary also proves where a text may be cut without changing its merges (before a run of spaces, around
a line feed). Tasks then cut texts into such pieces, count the proven ones as one token, and merge only the rest, each
distinct piece once.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 4096
#: Distinct merged pieces that a task remembers; it starts anew beyond that. Longer pieces are not kept.
REMEMBERED, LONGEST_KEPT = 500_000, 64
SPACE = "▁"


@dataclass
class Pieces:
    """What the counts need of a model: the rank of each piece (lowest merges first), spaces written as such."""

    rank: dict[str, float]
    prefix: bool
    lines_alone: bool = False
    known: dict[str, int] = field(default_factory=dict)

    def count(self, piece: str) -> int:
        """Tokens of a piece that stands alone: adjacent symbols that spell a piece merge, lowest rank first, leftmost
        first; a character outside the vocabulary makes one token per byte."""
        rank = self.rank
        parts = list(piece)
        if len(parts) > 48:
            parts = self._merged_by_heap(parts)
        else:
            near = [rank.get(a + b) for a, b in zip(parts, parts[1:])]
            while True:
                best, at = None, -1
                for i, r in enumerate(near):
                    if r is not None and (best is None or r < best):
                        best, at = r, i
                if best is None:
                    break
                parts[at] += parts.pop(at + 1)
                del near[at]
                if at < len(near):
                    near[at] = rank.get(parts[at] + parts[at + 1])
                if at:
                    near[at - 1] = rank.get(parts[at - 1] + parts[at])
        return sum(1 if p in rank else len(p.encode()) for p in parts)

    def _merged_by_heap(self, parts: list[str]) -> list[str]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := self.rank.get(both := parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (r, i, both))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, both = heapq.heappop(queue)
            j = after[i] if parts[i] else n
            if j >= n or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p]

    def key_count(self, key: str) -> int:
        """Tokens of what a key stands for: a piece behind one space, or behind a line feed, which is then one more."""
        if key[:1] == "\n" and self.lines_alone:
            return self.count("\n") + (self.count(key[1:]) if len(key) > 1 else 0)
        return self.count(" " + key)

    def tokens(self, text: str) -> int:
        """Tokens of a text."""
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        if self.prefix:
            text = " " + text
        elif text[0] != " " and not (self.lines_alone and text[0] == "\n"):
            # Without a prefix the first piece has no space before it.
            first = re.match(r"[^ \n]+" if self.lines_alone else "[^ ]+", text)[0]
            return self.count(first) + self._rest(text[len(first) :])
        return self._rest(text)

    def _rest(self, text: str) -> int:
        if not text:
            return 0
        cut = text.replace("\n", " \n") if self.lines_alone else text
        if "  " in cut:
            found = re.findall(r"\n[^ \n]*| +[^ \n]*" if self.lines_alone else " +[^ ]*", text)
            keys = [k if self.lines_alone and k[0] == "\n" else k[1:] for k in found]
        else:
            keys = cut.split(" ")[1:]
        known = self.known
        later: dict[str, int] = {}
        for key in set(keys).difference(known):
            n = self.key_count(key)
            if len(key) <= LONGEST_KEPT:
                known[key] = n
            else:
                later[key] = n
        if later:
            return sum(known[k] if k in known else later[k] for k in keys)
        return sum(map(known.__getitem__, keys))


def prove(model_path: str) -> Pieces:
    """Read a sentencepiece BPE model without normalisation, and prove its whole tokens and its cuts."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    rank = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            rank[model.id_to_piece(i).replace(SPACE, " ")] = -model.get_score(i)
    if any(" " in piece.lstrip(" ") for piece in rank):
        raise ValueError("a piece of this vocabulary goes across a space, so texts cannot be cut there")
    made = Pieces(rank, prefix=model.encode("a", out_type=str)[0].startswith(SPACE))
    made.lines_alone = not any("\n" in piece for piece in rank if len(piece) > 1)
    # Proven: pieces behind a space that the merges give as one token.
    made.known = {piece[1:]: 1 for piece in rank if piece[:1] == " " and made.count(piece) == 1 and piece[1:2] != "\n"}
    return made


def token_counts(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of every row: the tokens that the sentencepiece library gives for the text,
    without begin and end. Null and empty texts have none. Repeated rows and rows without a key are counted each; an
    empty table gives an empty result; other columns are not looked at. What is broadcast is the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(prove(model_path))

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        pieces = shared.value
        if not hasattr(pieces, "proven"):
            pieces.proven = dict(pieces.known)
        if len(pieces.known) > REMEMBERED:
            pieces.known = dict(pieces.proven)
        return pa.array([pieces.tokens(t) if t else 0 for t in texts.to_pylist()], pa.int64())

    counted = docs.select(F.col(key), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"), count(F.col(text)).alias("n_tokens"))
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
