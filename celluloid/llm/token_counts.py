"""Token counts by finite-state transducers, equal to a byte-level BPE tokenizer's.

Two deterministic machines are compiled from the tokenizer's file.

* The splitter runs over classes of characters and marks where a pre-token starts. Its transitions
  carry marks for the current and for the previous character, so that no look-ahead is needed. A
  text is cut into chunks of ``CHUNK`` characters; each chunk is run from all states at once, which
  gives its state map; a prefix scan composes the maps and so fixes the state each chunk starts in;
  a second run, all chunks side by side, writes the marks.
* The counter runs over the bytes of a pre-token. Its transitions carry the change of the number of
  tokens, so that the sum along a path is the count. Two prefixes of pre-tokens are the same state
  when the longest suffix that can still grow into a token, and the last token at each cut inside
  it, agree. That makes the machine finite; it is compiled as bytes ask for new transitions (and
  begun anew at ``MAX_STATES``). The next last token is the longest vocabulary suffix that stays
  apart from the last token before it, a test on two tokens alone.

All pre-tokens of a batch run side by side, one byte a step, in numpy. The special string of the
tokenizer is one token and parts the text, as is the library's default.

Edge cases: a null or empty text has 0 bytes and 0 tokens. A text may be of any length; state maps
carry over its chunks. Repeated rows and null ids stay as they are; other columns pass through, but
for one named like the added columns (n_bytes, n_tokens).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celluloid.llm.common import ship

CHUNK = 256  # characters of a chunk
SLICE = 1 << 21  # characters that are processed at a time
MAX_STATES = 1 << 17

# Character classes: those the splitting pattern tells apart. END stands behind each piece of text.
LETTER, NUMBER, OTHER, SPACE, WHITE, QUOTE, STMD, R, V, L, E, END = range(12)
# Splitter states: at a token's start; in a run of letters, numbers, others; after white space (one
# character or more, the last a plain space or not); after a quote that may open a contraction, and
# after the first letter of a two-letter one.
START, IN_L, IN_N, IN_O, ONE_SP, ONE_WS, MORE_SP, MORE_WS, AT_QUOTE, AT_R, AT_V, AT_L = range(12)
HERE, BEFORE = 1, 2
N_STATES = N_CLASSES = 12


def _character_classes() -> np.ndarray:
    every = [chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000)]
    text = "".join(every)
    classes = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", WHITE)):
        for found in regex.finditer(pattern, text):
            classes[found.start() : found.end()] = kind
    for characters, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        for character in characters:
            classes[ord(character)] = kind
    return classes


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks, by state and class."""
    following = np.zeros((N_STATES, N_CLASSES), dtype=np.intp)
    marks = np.zeros((N_STATES, N_CLASSES), dtype=np.uint8)
    letters = (LETTER, STMD, R, V, L, E)

    def step(state: int, kind: int) -> tuple[int, int]:
        if kind == END:
            late = BEFORE if state in (AT_R, AT_V, AT_L) else 0
            return START, HERE | late
        if state == AT_QUOTE:
            if kind == STMD:
                return START, 0
            if kind in (R, V, L):
                return {R: AT_R, V: AT_V, L: AT_L}[kind], 0
            if kind in (OTHER, QUOTE):
                return IN_O, 0
            return step(START, kind)
        if state in (AT_R, AT_V, AT_L):
            if kind == (L if state == AT_L else E):
                return START, 0
            goes, mark = step(IN_L, kind)
            return goes, mark | BEFORE
        if state in (ONE_SP, ONE_WS, MORE_SP, MORE_WS):
            if kind in (SPACE, WHITE):
                return (MORE_SP if kind == SPACE else MORE_WS), 0
            late = BEFORE if state in (MORE_SP, MORE_WS) else 0
            if state in (ONE_SP, MORE_SP):  # the space belongs to what follows
                return (IN_L if kind in letters else IN_N if kind == NUMBER else IN_O), late
            goes, mark = step(START, kind)
            return goes, mark | late
        if kind in (SPACE, WHITE):
            return (ONE_SP if kind == SPACE else ONE_WS), HERE
        if kind == QUOTE:
            return (IN_O, 0) if state == IN_O else (AT_QUOTE, HERE)
        goes = IN_L if kind in letters else IN_N if kind == NUMBER else IN_O
        return goes, 0 if goes == state else HERE

    for state in range(N_STATES):
        for kind in range(N_CLASSES):
            following[state, kind], marks[state, kind] = step(state, kind)
    return following, marks


class TokenMachine:
    """Both transducers of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        if content["pre_tokenizer"]["type"] != "ByteLevel" or content["normalizer"] is not None:
            raise ValueError("a byte-level tokenizer without normalizer is needed")
        self.specials = [t["content"] for t in content["added_tokens"]]
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        to_byte = _byte_alphabet()
        spell = lambda token: bytes(to_byte[c] for c in token)
        special = set(self.specials)
        self.vocabulary = {spell(t) for t in model["vocab"] if t not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(spell(a), spell(b)): i for i, (a, b) in enumerate(pairs)}
        self.prefixes = {t[:k] for t in self.vocabulary for k in range(1, len(t))}
        self.longest = max(map(len, self.vocabulary))
        self.classes = _character_classes()
        self.following, self.marks = _splitter()
        pairs_of = self.following[self.following]  # state, class, class
        self.double = np.ascontiguousarray(pairs_of.reshape(N_STATES, N_CLASSES * N_CLASSES))
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self._reset()

    # The counter

    def _reset(self) -> None:
        self.go = np.full((1024, 256), -1, dtype=np.int32)
        self.gain = np.zeros((1024, 256), dtype=np.int16)
        self.states: dict[tuple, int] = {}
        self.state_keys: list[tuple] = []
        self.root = self._state((b"", ((b"", 0),)))

    def _state(self, key: tuple) -> int:
        """key: the live suffix; at each cut from its start to its end, the last token before the cut
        and the number of tokens there less that at the end."""
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.state_keys)
            self.state_keys.append(key)
            if number >= len(self.go):
                more = min(len(self.go), 1 << 14)
                self.go = np.concatenate([self.go, np.full((more, 256), -1, dtype=np.int32)])
                self.gain = np.concatenate([self.gain, np.zeros((more, 256), dtype=np.int16)])
        return number

    def merge(self, symbols: list[bytes]) -> list[bytes]:
        """Tokens of a sequence of symbols by the ranked merges."""
        while len(symbols) > 1:
            best, at = min((self.rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
            if best == 1 << 60:
                break
            symbols = symbols[:at] + [symbols[at] + symbols[at + 1]] + symbols[at + 2 :]
        return symbols

    def _apart(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens stay as they are when they meet; nothing before (b"") asks for the token alone."""
        known = self.apart.get((left, right))
        if known is None:
            text = left + right
            tokens = self.merge([text[i : i + 1] for i in range(len(text))])
            known = self.apart[left, right] = tokens == ([left, right] if left else [right])
            if len(self.apart) > 2_000_000:
                self.apart.clear()
        return known

    def compile(self, state: int, byte: int) -> None:
        suffix, cuts = self.state_keys[state]
        grown = suffix + bytes([byte])
        for start, (last, behind) in enumerate(cuts):  # the longest token first
            token = grown[start:]
            if token in self.vocabulary and self._apart(last, token):
                break
        else:
            raise ValueError(f"no token ends with byte {byte}")
        change = behind + 1
        cuts = (*((last, n - change) for last, n in cuts), (token, 0))
        live = 0
        while live < len(grown) and grown[live:] not in self.prefixes:
            live += 1
        goes = self._state((grown[live:], cuts[live:]))
        self.go[state, byte] = goes
        self.gain[state, byte] = change

    def tokens(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Number of tokens of each pre-token, given as its place in the UTF-8 data."""
        if len(self.state_keys) > MAX_STATES:
            self._reset()
        order = np.argsort(-sizes, kind="stable")
        at, left = starts[order].astype(np.intp), sizes[order]
        state = np.full(len(at), self.root, dtype=np.intp)
        total = np.zeros(len(at), dtype=np.int64)
        active = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), side="right")
        for step, live in enumerate(active):
            key = (state[:live] << 8) | data[at[:live] + step]
            goes = self.go.reshape(-1).take(key)
            if goes.min() < 0:
                for pair in np.unique(key[goes < 0]):
                    self.compile(int(pair) >> 8, int(pair) & 255)
                goes = self.go.reshape(-1).take(key)
            total[:live] += self.gain.reshape(-1).take(key)
            state[:live] = goes
        result = np.empty_like(total)
        result[order] = total
        return result

    # The splitter

    def state_maps(self, kinds: np.ndarray) -> np.ndarray:
        """End state of each chunk (a row of classes) by the state it is entered in."""
        wide = N_CLASSES * N_CLASSES
        pairs = np.ascontiguousarray((kinds[:, ::2].astype(np.intp) * N_CLASSES + kinds[:, 1::2]).T)
        table = self.double.reshape(-1) * wide
        state = np.repeat(np.arange(N_STATES, dtype=np.intp) * wide, kinds.shape[0]).reshape(N_STATES, -1)
        for pair in pairs:
            state = table.take(state + pair)
        return (state // wide).T

    def token_starts(self, kinds: np.ndarray) -> np.ndarray:
        """Where pre-tokens (and END marks) start in a row of classes that ends with END."""
        size = len(kinds)
        chunks = -(-size // CHUNK)
        grid = np.full(chunks * CHUNK, END, dtype=np.uint8)
        grid[:size] = kinds
        grid = grid.reshape(chunks, CHUNK)
        entered = scan(self.state_maps(grid))
        columns = np.ascontiguousarray(grid.T).astype(np.intp)
        table, marks = self.following.reshape(-1) * N_CLASSES, self.marks.reshape(-1)
        written = np.empty((CHUNK, chunks), dtype=np.uint8)
        state = entered * N_CLASSES
        for column, out in zip(columns, written):
            key = state + column
            marks.take(key, out=out)
            state = table.take(key)
        written = np.ascontiguousarray(written.T).reshape(-1)[:size]
        starts = (written & HERE).astype(bool)
        starts[:-1] |= (written[1:] & BEFORE).astype(bool)
        return np.flatnonzero(starts)

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Text between special strings, cut further where a long text may be cut; number of special strings."""
        parts = self.special_pattern.split(text) if self.special_pattern and any(s in text for s in self.specials) else [text]
        found = []
        for part in parts:
            at = 0
            while len(part) - at > SLICE:
                cut = CUT.search(part, at + SLICE)
                if cut is None:
                    break
                found.append(part[at : cut.start()])
                at = cut.start()
            found.append(part[at:] if at else part)
        return found, len(parts) - 1

    def count(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(bytes, tokens) of each text."""
        sizes = np.array([len(t.encode()) if t else 0 for t in texts], dtype=np.int64)
        totals = np.zeros(len(texts), dtype=np.int64)
        held: list[str] = []
        owners: list[int] = []
        load = 0

        def flush() -> None:
            nonlocal load
            if held:
                np.add.at(totals, np.array(owners), self._count_pieces(held))
            held.clear()
            owners.clear()
            load = 0

        for number, text in enumerate(texts):
            if not text:
                continue
            found, specials = self.pieces(text)
            totals[number] += specials
            for piece in found:
                if piece:
                    held.append(piece)
                    owners.append(number)
                    load += len(piece)
                    if load >= SLICE:
                        flush()
        flush()
        return list(zip(sizes.tolist(), totals.tolist()))

    def _count_pieces(self, pieces: list[str]) -> np.ndarray:
        lengths = np.array([len(p) + 1 for p in pieces])
        ends = np.cumsum(lengths) - 1  # place of each piece's END
        points = np.frombuffer("\0".join([*pieces, ""]).encode("utf-32-le"), dtype=np.uint32)
        kinds = self.classes.take(points)
        kinds[ends] = END
        widths = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        widths[ends] = 0
        offsets = np.zeros(len(points) + 1, dtype=np.int64)
        np.cumsum(widths, out=offsets[1:])
        data = np.frombuffer("".join(pieces).encode(), dtype=np.uint8)
        starts = self.token_starts(kinds)
        places = offsets[starts]
        counts = np.zeros(len(starts), dtype=np.int64)
        real = kinds[starts] != END
        spans = np.diff(np.append(places, offsets[-1]))
        counts[real] = self.tokens(data, places[real], spans[real])
        first = np.searchsorted(starts, np.concatenate([[0], ends[:-1] + 1]))
        return np.add.reduceat(counts, first)


# White space behind something else: a pre-token starts there, whatever stands before.
CUT = regex.compile(r"(?<=\S)\p{White_Space}")


def scan(maps: np.ndarray) -> np.ndarray:
    """State in which each chunk is entered: composed maps of all chunks before it, by doubling."""
    composed = maps.copy()
    reach = 1
    while reach < len(composed):
        earlier = composed[:-reach]
        composed[reach:] = np.take_along_axis(composed[reach:], earlier, axis=1)
        reach *= 2
    return np.concatenate([[START], composed[:-1, START]]).astype(np.intp)


def _byte_alphabet() -> dict[str, int]:
    """Byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters
    for themselves, the rest in order from code point 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_machines: dict[str, TokenMachine] = {}


def machine(path: str) -> TokenMachine:
    if path not in _machines:
        _machines[path] = TokenMachine(path)
    return _machines[path]


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The document rows with n_bytes and n_tokens of the whole text."""
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compiled = machine(tokenizer_path)
        for texts in batches:
            yield pd.DataFrame(compiled.count(texts.tolist()), columns=["n_bytes", "n_tokens"], dtype="int64")

    counted = F.pandas_udf(count, schema).asNondeterministic()
    counts = docs.withColumn("_counts", counted("text"))
    return counts.withColumns({"n_bytes": F.col("_counts.n_bytes"), "n_tokens": F.col("_counts.n_tokens")}).drop("_counts")
