"""Byte-pair encoding as a deterministic transducer, compiled while it reads.

Byte-pair encoding can be read from left to right: the encoding of a prefix is that of a
shorter prefix plus one last token, and the last token is the only one whose junction with
the token before it survives the merges. What lies ahead therefore depends on a bounded
state: the longest suffix read that begins some token, with the last token and the token
count at each position inside it. Transitions carry the change of the token count, so a
run adds integers and never builds the tokens. States are made when first reached and are
dropped together when there are too many.
"""

from __future__ import annotations

import json

import numpy as np

MAX_TRANSITIONS = 400_000
NEVER = 1 << 60


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    for b in range(256):
        if b not in plain:
            table[chr(256 + len(table) - len(plain))] = b
    return table


class State(dict):
    """symbol -> (next state, change of the count, length of the last token)"""

    __slots__ = ("suffix", "chain")


class Transducer:
    """Symbols are characters below 256 for bytes, and 256 + byte for a word's last byte
    where the vocabulary marks word ends."""

    def __init__(self, vocab: dict[str, int], merges: list, end_mark: str | None = None):
        table = byte_symbols()

        def read(token: str) -> str | None:
            last = bool(end_mark) and token.endswith(end_mark) and len(token) > len(end_mark)
            body = token[:-len(end_mark)] if last else token
            if any(c not in table for c in body):
                return None
            codes = [table[c] for c in body]
            if last:
                codes[-1] += 256
            return "".join(map(chr, codes))

        self.ids: dict[str, int] = {}
        self.rank: dict[tuple[str, str], int] = {}
        for token, number in vocab.items():
            text = read(token)
            if text:
                self.ids[text] = number
        for order, pair in enumerate(merges):
            left, right = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            self.rank[read(left), read(right)] = order
        # Only what merging its own symbols yields can be a last token.
        self.tokens = {t for t in self.ids if len(t) == 1 or self.merge(t) == [t]}
        self.prefixes = {t[:i] for t in self.tokens for i in range(1, len(t))} | {""}
        self.longest = max(map(len, self.tokens), default=1)
        self._edges: tuple[dict, dict] = ({}, {})
        self._reset()

    @classmethod
    def from_file(cls, path: str) -> Transducer:
        with open(path, encoding="utf-8") as source:
            model = json.load(source)["model"]
        return cls(model["vocab"], model["merges"], model.get("end_of_word_suffix") or None)

    def _reset(self) -> None:
        self.start = State()
        self.start.suffix, self.start.chain = "", ((None, 0),)
        self.states = {("", self.start.chain): self.start}
        self.transitions = 0

    def merge(self, symbols: str) -> list[str]:
        """The tokens of a short piece, by the merges themselves."""
        parts, rank = list(symbols), self.rank.get
        orders = [rank(pair, NEVER) for pair in zip(parts, parts[1:])]
        while orders:
            best = min(orders)
            if best == NEVER:
                break
            at = orders.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del orders[at]
            if at:
                orders[at - 1] = rank((parts[at - 1], parts[at]), NEVER)
            if at < len(orders):
                orders[at] = rank((parts[at], parts[at + 1]), NEVER)
        return parts

    def _edge(self, token: str, side: int) -> list[tuple[str, float]]:
        """What stands at the token's right (0) or left (1) edge while it is merged: each
        part with the rank of the merge that absorbs it."""
        known = self._edges[side].get(token)
        if known is None:
            parts, known = list(token), []
            while len(parts) > 1:
                best, at = min((self.rank.get((a, b), NEVER), i)
                               for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if at == (0 if side else len(parts) - 2):
                    known.append((parts[at + 1 - side], best))
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            known.append((parts[0], NEVER))
            self._edges[side][token] = known
        return known

    def _survives(self, left: str, right: str) -> bool:
        """Whether no merge crosses the junction: while two parts face each other, their
        merge must come no earlier than those that absorb them. Of equal ranks the left one
        goes first."""
        one, two = self._edge(left, 0), self._edge(right, 1)
        i = j = 0
        while True:
            (x, x_gone), (y, y_gone) = one[i], two[j]
            crossing = self.rank.get((x, y))
            if crossing is not None and crossing < x_gone and crossing <= y_gone:
                return False
            if x_gone <= y_gone:
                if i + 1 == len(one):
                    return True
                i += 1
            else:
                j += 1

    def _compile(self, state: State, symbol: str) -> tuple[State, int, int]:
        seen = state.suffix + symbol
        for size in range(min(len(seen), self.longest), 0, -1):
            token = seen[len(seen) - size:]
            if token in self.tokens:
                before, count = state.chain[len(seen) - size]
                if before is None or self._survives(before, token):
                    break
        else:
            raise KeyError(f"no token ends in symbol {ord(symbol)}")
        change = count + 1
        keep = next(n for n in range(len(seen), -1, -1) if seen[len(seen) - n:] in self.prefixes)
        ahead = seen[len(seen) - keep:]
        chain = [*state.chain, (token, change)][len(seen) - keep:]
        # Only where some token may still begin does the past matter.
        chain = tuple((c[0], c[1] - change) if ahead[i:] in self.prefixes else None
                      for i, c in enumerate(chain))
        key = (ahead, chain)
        target = self.states.get(key)
        if target is None:
            target = self.states[key] = State()
            target.suffix, target.chain = key
        self.transitions += 1
        entry = state[symbol] = (target, change, size)
        return entry

    def count(self, symbols: str) -> int:
        """Tokens of a piece."""
        if self.transitions > MAX_TRANSITIONS:
            self._reset()
        state, total = self.start, 0
        for symbol in symbols:
            entry = state.get(symbol) or self._compile(state, symbol)
            state = entry[0]
            total += entry[1]
        return total

    def encode(self, symbols: str) -> list[int]:
        """Token ids of a piece: last tokens, read back from the end."""
        if self.transitions > MAX_TRANSITIONS:
            self._reset()
        state, sizes = self.start, []
        for symbol in symbols:
            entry = state.get(symbol) or self._compile(state, symbol)
            state = entry[0]
            sizes.append(entry[2])
        out, at = [], len(symbols)
        while at:
            size = sizes[at - 1]
            out.append(self.ids[symbols[at - size:at]])
            at -= size
        return out[::-1]


class Merges:
    """The merges of a transducer's vocabulary, applied to many short pieces at once.

    In every piece the merge of least rank, the leftmost of equal ones, is made in each step,
    as `Transducer.merge` does. Places of merged symbols die; the others are linked.
    """

    def __init__(self, machine: Transducer):
        number: dict[str, int] = {}
        symbol = lambda text: number.setdefault(text, len(number))       # noqa: E731
        self.first = np.array([symbol(chr(c)) for c in range(512)], dtype=np.int64)
        rows = sorted((symbol(a) << 32 | symbol(b), rank, symbol(a + b)) for (a, b), rank in machine.rank.items())
        self.pairs, self.ranks, self.made = np.array(rows, dtype=np.int64).reshape(-1, 3).T.copy()
        self.never = int(self.ranks.max(initial=-1)) + 1
        self.ids = np.array([machine.ids.get(text, -1) for text in number], dtype=np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank of a pair's merge, or never; its row)."""
        if not len(self.pairs):
            return np.full(len(left), self.never), np.zeros(len(left), np.int64)
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at], self.never), at

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, whose last byte ends a word, as little-endian unsigned 32-bit numbers."""
        if not pieces:
            return []
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        wide = int(size.max()) + 1                       # the last place of a row is the end
        column = np.arange(wide)
        alive = column < size[:, None]
        code = np.zeros(alive.shape, np.int64)
        code[alive] = np.frombuffer(b"".join(pieces), np.uint8)
        code[np.arange(len(size)), size - 1] += 256
        code = self.first[code].ravel()
        alive = alive.ravel()
        after = np.tile(np.minimum(column + 1, wide - 1), len(size))
        before = np.tile(column - 1, len(size))
        rank = np.full(len(code), self.never)
        made = np.zeros(len(code), np.int64)
        inner = np.flatnonzero(alive[:-1] & alive[1:])
        rank[inner], made[inner] = self._find(code[inner], code[inner + 1])
        by_row = rank.reshape(len(size), wide)
        rows = np.arange(len(size))
        while len(rows):
            column_at = by_row[rows].argmin(axis=1)
            at = rows * wide + column_at
            some = rank[at] < self.never
            rows, at = rows[some], at[some]
            start = rows * wide
            gone = start + after[at]
            code[at] = self.made[made[at]]
            alive[gone] = False
            rank[gone] = self.never
            after[at] = after[gone]
            following = start + after[at]
            before[following] = at - start
            rank[at] = self.never
            has = alive[following]
            rank[at[has]], made[at[has]] = self._find(code[at[has]], code[following[has]])
            back = before[at] >= 0
            preceding, here = (start + before[at])[back], at[back]
            rank[preceding], made[preceding] = self._find(code[preceding], code[here])
        ids = self.ids[code[alive]]
        if (ids < 0).any():
            raise KeyError("a symbol is no token")
        cut = np.concatenate(([0], np.cumsum(alive.reshape(len(size), wide).sum(axis=1)))) * 4
        every = ids.astype("<u4").tobytes()
        return [every[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


class Recent:
    """A bounded memo of two generations: what is in use survives a turn-over."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
