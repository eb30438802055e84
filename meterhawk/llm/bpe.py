"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of text the table holds the last token of the prefix's encoding. It is unique: a
token that ends the prefix is that token exactly if it stands next to the last token of the prefix before it
without a merge across their border. So a piece is encoded left to right by looking up tokens that end at
each byte and testing one border each; an automaton over the vocabulary names those tokens. Appending bytes
only adds to the table, and after an edit the table is recomputed from the edit until it agrees with the old
one again. The pieces of many texts are encoded in order, each from the prefix it shares with the one before.

Whether two tokens may stand side by side is told from the order in which merges happen: the merges that
made both are undone, latest first, and at no moment may the two tokens at the border have a merge that comes
before the merges that took them up.

``encode_documents`` cuts each whole text by the split pattern and encodes each match; ``decode_documents``
joins the bytes of the ids. Defined cases: a null text is the empty text and has no tokens; null and repeated
ids are carried as they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhawk.llm.common import give_back, giving_back

# Bounds what is sent to the executors.
MOST_RANK_BYTES = 32 << 20
# Encoded pieces and tested borders a worker remembers; both are forgotten when full.
REMEMBERED = 250_000
LONG_PIECE = 64
# Texts are split and encoded in groups of about this many characters.
GROUP_CHARS = 1_500_000

_NEVER = 1 << 62


class Vocabulary:
    """Tokens by rank, with the merge that makes each token from its parts."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        self.made: set[int] = set()
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            if len(token) == 1:
                self.made.add(rank)
                continue
            left = self._merged_below(token, rank)
            if len(left) == 2:
                self.parts[rank] = (left[0], left[1])
                self.merges[left[0], left[1]] = rank
                self.made.add(rank)
        self._build_automaton()
        self.borders: dict[int, bool] = {}

    def _build_automaton(self) -> None:
        """States for all token beginnings; each knows the made tokens that end there, longest first."""
        self.step: dict[int, int] = {}
        ends, depth_first = [-1], [[0]]
        parents = [(0, 0)]
        for token, rank in self.ids.items():
            state = 0
            for depth, byte in enumerate(token, 1):
                after = self.step.get(state << 8 | byte)
                if after is None:
                    after = self.step[state << 8 | byte] = len(ends)
                    ends.append(-1)
                    parents.append((state, byte))
                    if len(depth_first) == depth:
                        depth_first.append([])
                    depth_first[depth].append(after)
                state = after
            if rank in self.made:
                ends[state] = rank
        self.shorter = [0] * len(ends)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(ends)
        for states in depth_first[1:]:
            for state in states:
                parent, byte = parents[state]
                if parent:
                    at = self.shorter[parent]
                    while at and (at << 8 | byte) not in self.step:
                        at = self.shorter[at]
                    self.shorter[state] = self.step.get(at << 8 | byte, 0)
                own = ((ends[state], len(self.tokens[ends[state]])),) if ends[state] >= 0 else ()
                self.ending[state] = own + self.ending[self.shorter[state]]

    def _merged_below(self, token: bytes, limit: int) -> list[int]:
        """Ids after all merges of a lower rank, lowest rank and leftmost first."""
        ids = [self.ids[token[i : i + 1]] for i in range(len(token))]
        while len(ids) > 2:
            merges = [(self.merges.get(pair, _NEVER), at) for at, pair in enumerate(zip(ids, ids[1:], strict=False))]
            rank, at = min(merges)
            if rank >= limit:
                break
            ids[at : at + 2] = [rank]
        return ids

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens together are encoded as these two tokens."""
        key = left << 32 | right
        known = self.borders.get(key)
        if known is None:
            if len(self.borders) >= REMEMBERED:
                self.borders.clear()
            known = self.borders[key] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        left_taken = right_taken = _NEVER
        while True:
            across = self.merges.get((left, right), _NEVER)
            # Of equal ranks the merge further left comes first.
            if across < left_taken and across <= right_taken:
                return False
            left_parts, right_parts = self.parts.get(left), self.parts.get(right)
            if left_parts is None and right_parts is None:
                return True
            if right_parts is None or (left_parts is not None and left > right):
                left_taken, left = left, left_parts[1]
            else:
                right_taken, right = right, right_parts[0]


class PrefixEncoder:
    """The tables of one piece's prefixes: automaton state and last token. It can be appended to and edited."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.states = [0]
        self.last = [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(more)

    def become(self, data: bytes) -> None:
        """Turn to other bytes, keeping the entries of the prefix that both share."""
        shared, most = 0, min(len(data), len(self.data))
        while shared < most and data[shared] == self.data[shared]:
            shared += 1
        del self.states[shared + 1 :], self.last[shared + 1 :]
        self.data = data
        self._extend(data[shared:])

    def _extend(self, more: bytes, settled=None) -> None:
        """Add an entry for each byte; ``settled`` may stop it early."""
        step, shorter, ending = self.vocabulary.step, self.vocabulary.shorter, self.vocabulary.ending
        borders, fits = self.vocabulary.borders, self.vocabulary.side_by_side
        states, last = self.states, self.last
        state, end = states[-1], len(last)
        for byte in more:
            while (after := step.get(state << 8 | byte)) is None and state:
                state = shorter[state]
            state = after or 0
            for token, length in ending[state]:
                before = last[end - length]
                if before < 0:
                    break
                fit = borders.get(before << 32 | token)
                if fit or (fit is None and fits(before, token)):
                    break
            else:
                raise ValueError("the vocabulary has no token for a byte")
            states.append(state)
            last.append(token)
            end += 1
            if settled is not None and settled(end - 1):
                return

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of ``data[start:stop]``; returns how many table entries were computed.

        An entry follows from the bytes and entries of one longest token before it, so once that many entries
        after the edit are the old ones, all that follow are.
        """
        old, old_states, shift = self.last, self.states, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, self.states = old[: start + 1], old_states[: start + 1]
        first, same = start + len(new), 0

        def settled(end: int) -> bool:
            nonlocal same
            agrees = end > first and self.last[end] == old[end - shift] and self.states[end] == old_states[end - shift]
            same = same + 1 if agrees else 0
            return same >= self.vocabulary.longest

        self._extend(self.data[start:], settled)
        done = len(self.last)
        self.last += old[done - shift :]
        self.states += old_states[done - shift :]
        return done - 1 - start

    def ids(self) -> list[int]:
        vocabulary, end, found = self.vocabulary, len(self.data), []
        whole = vocabulary.ids.get(self.data)
        if whole is not None:
            return [whole]
        while end:
            found.append(self.last[end])
            end -= len(vocabulary.tokens[self.last[end]])
        return found[::-1]


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _groups(texts: list[str], chars: int) -> Iterator[list[str]]:
    group: list[str] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


class TextEncoder:
    """Encodes whole texts, piece by piece."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern)
        self._pieces: dict[str, bytes] = {}

    def forget(self) -> None:
        self._pieces.clear()
        self.vocabulary.borders.clear()

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces in order of their bytes, so that each starts from the prefix it shares with the last."""
        known, whole = self._pieces, self.vocabulary.ids
        table = PrefixEncoder(self.vocabulary)
        for piece in sorted(pieces):
            data = piece.encode("utf-8")
            token = whole.get(data)
            if token is None:
                table.become(data)
                known[piece] = _packed(table.ids())
            else:
                known[piece] = _packed([token])

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for group in _groups(texts, GROUP_CHARS):
            split = [self.split.findall(text) for text in group]
            known = self._pieces
            if len(known) > REMEMBERED:
                known.clear()
            new = set().union(*split).difference(known)
            self._learn(list(new))
            out += [b"".join(map(known.__getitem__, pieces)) for pieces in split]
            for piece in new:
                if len(piece) > LONG_PIECE:
                    del known[piece]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def append(self, text: str, ids: bytes, more: str) -> tuple[str, bytes]:
        """Encode ``text + more`` from the encoding of ``text``; only pieces near its end are cut again."""
        spans = [m.span() for m in self.split.finditer(text)]
        # The pattern looks at most two characters past a piece's first one, so pieces near the end may change.
        while spans and spans[-1][1] >= len(text) - 2:
            ids = ids[: len(ids) - len(self.encode(text[slice(*spans.pop())]))]
        kept = spans[-1][1] if spans else 0
        return text + more, ids + self.encode(text[kept:] + more)


def decode(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return b"".join(map(tokens.__getitem__, numbers))


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        ranks = file.read()
    if len(ranks) > MOST_RANK_BYTES:
        raise ValueError("the rank file is too large to send to the executors")
    return ranks


def parse_ranks(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}


@lru_cache(maxsize=2)
def text_encoder(ranks: bytes, pattern: str) -> TextEncoder:
    """One encoder per Python worker. What it holds stays for good, so the garbage collector need not look at it."""
    encoder = TextEncoder(Vocabulary(parse_ranks(ranks)), pattern)
    gc.collect()
    gc.freeze()
    return encoder


@lru_cache(maxsize=2)
def token_table(ranks: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in parse_ranks(ranks).items()}


def _changed(column: str, to: str, change):
    """A task that puts ``change(values)`` in the place of a column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(change(batch.column(column).to_pylist()), pa.binary())
            at = batch.schema.get_field_index(column)
            yield batch.set_column(at, pa.field(to, pa.binary()), values)

    return run


def encode_documents(docs: DataFrame, ranks: bytes, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the text's ids, as little-endian unsigned 32-bit integers, in the place of its text.

    A column of ``docs`` that is called ``ids`` already is refused, as the result would have two.
    """
    if "ids" in docs.columns and text_col != "ids":
        raise ValueError("docs has a column ids; rename it first")
    fields = [T.StructField("ids", T.BinaryType()) if f.name == text_col else f for f in docs.schema.fields]
    filled = docs.withColumn(text_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return filled.mapInArrow(_changed(text_col, "ids", lambda texts: text_encoder(ranks, pattern).encode_many(texts)), T.StructType(fields))


def decode_documents(encoded: DataFrame, ranks: bytes, to: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes its ids stand for in the place of the ids."""
    fields = [T.StructField(to, T.BinaryType()) if f.name == "ids" else f for f in encoded.schema.fields]
    return encoded.mapInArrow(_changed("ids", to, lambda rows: [decode(ids, token_table(ranks)) for ids in rows]), T.StructType(fields))


def _both_ways(ranks: bytes, pattern: str):
    """One worker does both, so that an executor holds half the processes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # An earlier stage may have worked in this process.
        give_back()
        encoder = text_encoder(ranks, pattern)
        for batch in batches:
            texts = batch.column("text")
            for start in range(0, batch.num_rows, 200):
                encoded = encoder.encode_many(texts.slice(start, 200).to_pylist())
                decoded = [decode(ids, encoder.vocabulary.tokens) for ids in encoded]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, 200),
                        pa.array([len(ids) // 4 for ids in encoded], pa.int64()),
                        pa.array([hashlib.sha256(ids).hexdigest() for ids in encoded]),
                        pa.array([hashlib.sha256(data).hexdigest() for data in decoded]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        encoder.forget()

    return run


def encode_and_decode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens and the digests of its ids and of the bytes they decode to."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(giving_back(_both_ways(ranks, pattern)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
