"""Token counts of byte-level BPE by finite-state transducers.

Two machines run one after the other. The splitter reads character classes and marks where
pieces begin; it has 13 states, so a chunk of text is a map from entry state to exit state.
The maps of all chunks are computed at once, composed by a parallel prefix scan, and the
scan gives every chunk its entry state. The second machine is the compiled BPE transducer
(`bpe.Transducer`), whose transitions carry the number of tokens emitted; each piece enters
it in the start state.

Cases: a NULL or empty text has 0 tokens; special strings of the vocabulary inside a text
count one token each; NULL ids, repeated rows and other columns are kept as they are.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Recent, Transducer, byte_symbols
from .common import hidden, ship, slices, texts_of

# The splitting pattern's contractions are 's 't 'm 'd 're 've 'll.
LETTER, NUMBER, OTHER, BLANK, SPACE, QUOTE, STMD, R, V, L, E, END = range(12)
CLASSES = 12
# States: what the splitter has just read.
(START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, BLANK_1, SPACE_1, BLANK_N, SPACE_N,
 AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, CONTRACTED) = range(13)
STATES = 13
HERE, BEFORE = 1, 2            # a piece begins at this character; at the one before it
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
         0x202F, 0x205F, 0x3000)
CHUNKS = 2048


@functools.cache
def class_table() -> np.ndarray:
    kind = np.full(0x110000, OTHER, dtype=np.uint8)
    for code in range(0x110000):
        category = unicodedata.category(chr(code))[0]
        if category == "L":
            kind[code] = LETTER
        elif category == "N":
            kind[code] = NUMBER
    kind[list(WHITE)] = SPACE
    kind[32], kind[39] = BLANK, QUOTE
    kind[[ord(c) for c in "stmd"]] = STMD
    kind[ord("r")], kind[ord("v")], kind[ord("l")], kind[ord("e")] = R, V, L, E
    return kind


@functools.cache
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks), both indexed by state * CLASSES + class."""
    step = np.zeros((STATES, CLASSES), dtype=np.uint8)
    mark = np.zeros((STATES, CLASSES), dtype=np.uint8)
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, BLANK: BLANK_1,
           SPACE: SPACE_1, QUOTE: AFTER_QUOTE, STMD: IN_LETTERS, R: IN_LETTERS,
           V: IN_LETTERS, L: IN_LETTERS, E: IN_LETTERS, END: START}
    for state in range(STATES):
        for kind in range(CLASSES):
            step[state, kind], mark[state, kind] = run[kind], HERE
    letters = (LETTER, STMD, R, V, L, E)
    words = (*letters, NUMBER, OTHER, QUOTE)
    mark[IN_LETTERS, letters] = 0
    mark[IN_NUMBERS, NUMBER] = 0
    for kind in (OTHER, QUOTE):                  # a quote inside a run of others opens nothing
        step[IN_OTHERS, kind], mark[IN_OTHERS, kind] = IN_OTHERS, 0
        step[AFTER_QUOTE, kind], mark[AFTER_QUOTE, kind] = IN_OTHERS, 0
    for kind in words:                           # one blank leads the piece after it
        for state, marks in ((BLANK_1, 0), (BLANK_N, BEFORE)):
            step[state, kind] = IN_OTHERS if kind == QUOTE else run[kind]
            mark[state, kind] = marks
        mark[SPACE_N, kind] = HERE | BEFORE
    for state in (BLANK_1, SPACE_1, BLANK_N, SPACE_N):
        step[state, BLANK], step[state, SPACE] = BLANK_N, SPACE_N
        mark[state, [BLANK, SPACE]] = 0
    for kind, state in ((STMD, CONTRACTED), (R, QUOTE_R), (V, QUOTE_V), (L, QUOTE_L)):
        step[AFTER_QUOTE, kind], mark[AFTER_QUOTE, kind] = state, 0
    for state, last in ((QUOTE_R, E), (QUOTE_V, E), (QUOTE_L, L)):
        for kind in range(CLASSES):              # no contraction: letters began after the quote
            step[state, kind] = step[IN_LETTERS, kind]
            mark[state, kind] = mark[IN_LETTERS, kind] | BEFORE
        step[state, last], mark[state, last] = CONTRACTED, 0
    return step.ravel(), mark.ravel()


def entry_states(kinds: np.ndarray) -> np.ndarray:
    """Entry state of each chunk; kinds is (steps, chunks), read down, chunk after chunk."""
    step, _ = splitter()
    maps = np.repeat(np.arange(STATES, dtype=np.intp)[:, None], kinds.shape[1], axis=1)
    for i in range(kinds.shape[0]):
        maps = step[maps * CLASSES + kinds[i]].astype(np.intp)
        if i % 32 == 31 and (maps == maps[0]).all():      # every entry state has met
            one = maps[0]
            for j in range(i + 1, kinds.shape[0]):
                one = step[one * CLASSES + kinds[j]].astype(np.intp)
            maps = np.repeat(one[None, :], STATES, axis=0)
            break
    reach = 1
    while reach < maps.shape[1]:                          # prefix scan: compose with the left
        maps[:, reach:] = np.take_along_axis(maps[:, reach:], maps[:, :-reach].copy(), axis=0)
        reach *= 2
    return np.concatenate(([START], maps[START, :-1]))


def piece_starts(kinds: np.ndarray) -> np.ndarray:
    """Positions at which a piece begins, for the classes of a text that END closes."""
    step, mark = splitter()
    size = len(kinds)
    chunks = max(1, min(CHUNKS, size // 64))
    steps = -(-size // chunks)
    padded = np.full(steps * chunks, END, dtype=np.intp)
    padded[:size] = kinds
    grid = np.ascontiguousarray(padded.reshape(chunks, steps).T)
    state = entry_states(grid).astype(np.intp)
    marks = np.empty((steps, chunks), dtype=np.uint8)
    for i in range(steps):
        at = state * CLASSES + grid[i]
        marks[i] = mark[at]
        state = step[at].astype(np.intp)
    flat = marks.T.ravel()[:size]
    begins = (flat & HERE) > 0
    begins[:-1] |= (flat[1:] & BEFORE) > 0
    return np.flatnonzero(begins)


class Counter:
    """Counts tokens of texts with one vocabulary; lives as long as its Python worker."""

    def __init__(self, path: str, memo: int = 300_000):
        self.machine = Transducer.from_file(path)
        with open(path, encoding="utf-8") as source:
            self.special = [t["content"] for t in json.load(source).get("added_tokens", [])]
        self.symbols = {b: chr(b) for b in byte_symbols().values()}
        self.memo = Recent(memo)

    def _segments(self, text: str) -> tuple[list[str], int]:
        parts, found = [text], 0
        for special in sorted(self.special, key=len, reverse=True):
            if special in text:
                parts = [p for part in parts for p in part.split(special)]
                found += text.count(special)
        return parts, found

    def piece(self, piece: str) -> int:
        n = self.memo.get(piece)
        if n is None:
            n = self.machine.count(piece.encode("utf-8", "surrogatepass").decode("latin-1"))
            if len(piece) < 40:
                self.memo.put(piece, n)
        return n

    def count(self, texts: list[str]) -> np.ndarray:
        totals = np.zeros(len(texts), dtype=np.int64)
        segments, owner = [], []
        for i, text in enumerate(texts):
            parts, found = self._segments(text)
            totals[i] = found
            segments += parts
            owner += [i] * len(parts)
        joined = "\0".join(segments) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kinds = class_table()[codes]
        ends = np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)) + 1) - 1
        kinds[ends] = END
        starts = piece_starts(kinds)
        keep = kinds[starts] != END
        stops = np.append(starts[1:], len(kinds))[keep]
        starts = starts[keep]
        known, slow = self.memo.young, self.piece
        counts = [known.get(p) or slow(p) for p in
                  [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist())]]
        which = np.asarray(owner)[np.searchsorted(ends, starts)]
        return totals + np.bincount(which, weights=counts, minlength=len(texts)).astype(np.int64)


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """df with the token count of each whole text; no shuffle."""
    ship(df.sparkSession)
    work = hidden(df, "text")["text"]
    schema = df.drop(out).schema.add(out, "long", False)
    names = [c for c in df.columns if c.lower() != out.lower()]
    plain = df.select(*[F.col(f"`{c}`") for c in names], F.col(text).alias(work))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, work):
            n = counter(path).count(texts_of(batch, work))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n, type=pa.int64())], names=[*names, out])

    return plain.mapInArrow(run, schema)
