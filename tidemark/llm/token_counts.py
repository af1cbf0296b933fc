"""Exact token counts of a piece tokenizer by a finite-state transducer that is compiled from its vocabulary.

Merging pieces greedily by score has two properties that make it finite-state. The last token of every prefix of a text
decides, together with the pieces that end at the next character, which token ends there; and no piece reaches further
back than the longest one. So a state is the longest suffix of the text from which a longer piece may still come, plus, for
each position of that suffix, the pieces that may come from there and the token count (relative to the newest), plus the
last token. Positions from which no piece can follow any more are dropped, so that different histories share a state. Each
transition reads one character and emits by how many tokens the count changes. States and transitions are compiled when
first met; when there are too many, all are dropped and those in use are compiled again (memory is bounded, the path is the
same).

A space after another character is a synchronising symbol: no piece holds a space after something else, so whatever came
before, the transducer is then in the same state. A chunk of text is thus a small state map: the characters before the
first such symbol (``head``), the tokens emitted after it (``body``) and the last state (``tail``). Maps compose
associatively. Every text is cut into chunks, whose maps are computed apart; the maps of all texts of a batch are arrays,
and a segmented prefix scan composes them in log steps.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, text_of, tokenizer_path

SPACE = "▁"
#: A synchronised chunk: spaces, then other characters.
CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")
SYNC = re.compile(f"(?<=[^{SPACE}]){SPACE}")
#: Bounds of a worker's memory: compiled transitions, memorised chunks (of at most 64 characters) and pairs of tokens.
MOST_TRANSITIONS, MOST_CHUNKS, MOST_PAIRS = 400_000, 300_000, 300_000
#: From a longer suffix the few pieces that may still come are told apart; from a shorter one the last token stands for them.
SHORT = 3


class _Chunks(dict):
    """Token counts of synchronised chunks."""

    def __init__(self, owner: CountingTransducer):
        super().__init__()
        self.owner = owner

    def __missing__(self, chunk: str) -> int:
        if len(self) >= MOST_CHUNKS:
            self.clear()
        n = self.owner.run(0, chunk)[1]
        if len(chunk) <= 64:
            self[chunk] = n
        return n


class CountingTransducer:
    """The transducer of one SentencePiece BPE vocabulary with byte fallback and a dummy space before the text."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(model))
        normal = (i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)))
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("a piece holds a space after another character: spaces do not synchronise")
        #: Pieces by the order in which they are merged; of those that can be tokens, also the last merge. A character has none.
        merged = sorted((p for p in self.scores if len(p) > 1), key=self.scores.__getitem__, reverse=True)
        self.rank = {p: k for k, p in enumerate(merged)}
        self.order, self.split = {p: -1 for p in self.scores if len(p) == 1}, {}
        for p in merged:
            parts, last = self._merged(p)
            if len(parts) == 1:
                self.order[p], self.split[p] = self.rank[p], last
        if sp.encode("a b", out_type=str) != self._merged(f"{SPACE}a{SPACE}b")[0]:
            raise ValueError("the tokenizer normalises its input: only identity with a dummy space is compiled")
        #: The longer pieces that begin with each beginning of a piece.
        self.longer: dict[str, list[str]] = {}
        for p in self.scores:
            for k in range(1, len(p)):
                self.longer.setdefault(p[:k], []).append(p)
        self.pairs: dict[tuple[str | None, str], bool] = {}
        self.transitions = 0  # all that were ever compiled
        self.taken = 0  # all steps that were ever made
        self.chunks = _Chunks(self)
        self._dropped()

    def _dropped(self) -> None:
        """No state but the first, in which a text begins."""
        self.states: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.moves: list[dict[str, int]] = []
        self.size = 0
        self._state(("", ((None, 0, None),), None))

    def _state(self, state: tuple) -> int:
        k = self.ids.get(state)
        if k is None:
            k = self.ids[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return k

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Merges the neighbours whose piece scores highest, the first of equals, until none is left; and the last merge."""
        rank, none = self.rank.get, len(self.rank)
        parts, last = list(text), None
        found = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while found and (best := min(found)) < none:
            at = found.index(best)
            last = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at:
                found[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(found):
                found[at] = rank(parts[at] + parts[at + 1], none)
        return parts, last

    def _joins(self, left: str, right: str) -> bool:
        """Whether a merge across the border would come before those that make left and right.

        Their merges are undone from the last, and each time the pieces at the border are tried.
        """
        rank, of = self.rank.get, self.order
        before = len(self.rank)
        while True:
            if rank(left + right, before) < before:
                return True
            a, b = of[left], of[right]
            if a > b:
                before, left = a, self.split[left][1]
            elif b >= 0:
                before, right = b + 1, self.split[right][0]
            else:
                return False

    def _follows(self, left: str | None, right: str) -> bool:
        """Whether right can be the token after left."""
        if right not in self.order:
            return False
        if left is None:
            return True
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = not self._joins(left, right)
        return known

    def _compile(self, k: int, c: str) -> tuple[tuple, int]:
        """The state that state k leads to on c, and the tokens emitted.

        A state has the suffix, the open positions in it as (last token there, count there less the newest count, pieces
        that may come from there), from the oldest to the newest, and None for closed ones; and the tokens are told by
        the pieces wherever these are few.
        """
        if c not in self.scores:  # falls back to its bytes, which nothing merges with
            return self.states[0], len(c.encode("utf-8", "surrogatepass"))
        suffix, opened, _ = self.states[k]
        if c == SPACE and suffix.strip(SPACE):
            return self._compile(0, c)
        seen = suffix + c
        token, n = c, 0
        for size in range(len(seen), 0, -1):
            place = opened[-size]
            if place is not None and (part := seen[-size:]) in self.scores:
                before, count, may = place
                if part in may if may is not None else self._follows(before, part):
                    token, n = part, count + 1
                    break
        kept: list[tuple | None] = []
        for size in range(len(seen), 0, -1):
            place, part = opened[-size], seen[-size:]
            longer = self.longer.get(part) if place is not None else None
            if longer is None:
                new = None
            else:
                before, count, may = place
                if may is not None:
                    left = frozenset(p for p in may if len(p) > size and p.startswith(part))
                elif size >= SHORT or len(longer) <= 24:
                    left = frozenset(p for p in longer if self._follows(before, p))
                else:
                    left = None
                new = (before if left is None else None, count - n, left) if left is None or left else None
            if new is not None or kept:
                kept.append(new)
        depth = len(kept)
        return (seen[len(seen) - depth :], (*kept, (token, 0, None)), None), n

    def run(self, k: int, text: str) -> tuple[int, int]:
        """The state after text from state k, and the tokens emitted."""
        moves, total = self.moves, 0
        for c in text:
            move = moves[k].get(c)
            if move is None:
                state, n = self._compile(k, c)
                self.transitions += 1
                if self.size >= MOST_TRANSITIONS:
                    self._dropped()
                    moves, k = self.moves, self._state(state)
                    total += n
                    continue
                self.size += 1
                move = moves[k][c] = (self._state(state) << 8) + n + 128
            k = move >> 8
            total += (move & 255) - 128
        self.taken += len(text)
        return k, total

    def map_of(self, chunk: str) -> tuple[str, bool, int, tuple]:
        """The state map of a chunk of a text whose spaces are escaped: head, whether it is synchronised, body, last state.

        Without a synchronising symbol the head is the whole chunk.
        """
        at = SYNC.search(chunk)
        if at is None:
            return chunk, False, 0, self.states[0]
        parts = CHUNK.findall(chunk, at.start())
        body = sum(map(self.chunks.__getitem__, parts[:-1]))
        tail, n = self.run(0, parts[-1])
        return chunk[: at.start()], True, body + n, self.states[tail]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """First a, then b. Associative."""
        if not a[1]:
            return a[0] + b[0], *b[1:]
        tail, n = self.run(self._state(a[3]), b[0])
        return a[0], True, a[2] + n + b[2], b[3] if b[1] else self.states[tail]

    def counts(self, texts: list[str], chunk_chars: int) -> np.ndarray:
        """The number of tokens of each text: maps of all chunks, then a segmented scan in log steps.

        The scan's arrays hold the composed map of each chunk with those before it in its text, the sums by ``body``; a
        step joins maps at a distance of 1, 2, 4 and so on, all texts and chunks at once.
        """
        owner, maps = [], []
        for k, text in enumerate(texts):
            if text:
                escaped = SPACE + text.replace(" ", SPACE)
                for at in range(0, len(escaped), chunk_chars):
                    owner.append(k)
                    maps.append(self.map_of(escaped[at : at + chunk_chars]))
        own = np.array(owner, dtype=np.int64)
        body = np.array([m[2] for m in maps], dtype=np.int64)
        synced = np.array([m[1] for m in maps], dtype=bool)
        # What crosses a border is the tail before it and the head after it: emitted where a synchronised map comes before.
        heads, tails = [m[0] for m in maps], [m[3] for m in maps]
        step = 1
        while len(own) > step and (own[step:] == own[:-step]).any():
            at = np.flatnonzero(own[step:] == own[:-step]) + step
            before = at - step
            new_body, new_synced = body[at].copy(), synced[at] | synced[before]
            new_heads, new_tails = [], []
            for j, (i, b) in enumerate(zip(at.tolist(), before.tolist(), strict=True)):
                if synced[b]:
                    joined = self.compose((heads[b], True, int(body[b]), tails[b]), (heads[i], bool(synced[i]), int(body[i]), tails[i]))
                    new_body[j] = joined[2]
                    new_heads.append(joined[0])
                    new_tails.append(joined[3])
                else:
                    new_heads.append(heads[b] + heads[i])
                    new_tails.append(tails[i])
            body[at], synced[at] = new_body, new_synced
            for i, head, tail in zip(at.tolist(), new_heads, new_tails, strict=True):
                heads[i], tails[i] = head, tail
            step *= 2
        out = np.zeros(len(texts), dtype=np.int64)
        last = np.flatnonzero(np.append(own[1:] != own[:-1], True)) if len(own) else own
        for i in last.tolist():
            out[own[i]] = body[i] + self._headed(heads[i])
        return out

    def _headed(self, head: str) -> int:
        """The tokens emitted before the first synchronising symbol: the head is entered in the first state."""
        return self.chunks[head] if len(head) <= 64 else self.run(0, head)[1]

    def count(self, text: str, chunk_chars: int = 1 << 14) -> int:
        return int(self.counts([text], chunk_chars)[0])


#: One for each vocabulary and Python worker.
_compiled: dict[str, CountingTransducer] = {}


def transducer(model: str) -> CountingTransducer:
    if model not in _compiled:
        _compiled[model] = CountingTransducer(model)
    return _compiled[model]


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096, chunk_chars: int = 1 << 14) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each row of docs.

    One pass without a shuffle. A null text is empty (0 bytes, 0 tokens); a null doc_id stays null; repeated rows are
    counted each; an empty table gives no rows; other columns are not read. Texts of any length are counted whole.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for x in batches:
            for at in range(0, x.num_rows, 512):
                part = x.slice(at, 512)
                yield appended(part, ("doc_id", "n_bytes"), n_tokens=pa.array(t.counts(part.column("text").to_pylist(), chunk_chars)))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
