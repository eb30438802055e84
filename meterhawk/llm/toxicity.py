"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel compares two windows of text by the ordered letter triples they share, letters not necessarily side by
side: each letter skipped between two of a triple costs a factor ``LAMBDA``, up to ``GAP`` skipped at a
time. So ``idiot`` is close to ``i-d-i-o-t``, ``i d i o t`` and ``idxiot``. Symbols stand for code points, not
bytes. White space counts as a letter, so that openings of words are told from their insides. What stands between two
letters and is none is one symbol: white space if it holds any, else a gap; characters without width are left out.
A window starts before each letter that follows white space or a gap, and inside runs of more than ``REACH`` letters
also at each ``STRIDE``-th one. It takes the triples that start in its first ``REACH`` symbols; its feature vector is
divided by its length.

Windows are mapped through ``K(landmarks, landmarks) ** -1/2`` of the kernel to the landmarks, and a squared-hinge
support vector machine is fitted there. Documents are labelled, sentences are not: sentences of clean documents
are labelled clean, and in toxic documents the windows that look toxic are labelled toxic, at first by how much more often
their first letters open a word in toxic documents, then by the machine itself, for ``ROUNDS`` rounds. A sentence
scores as its worst window; a document's worst sentences and what its windows have above 0, in sum and in proportion to its
length, give its probability. That step is learnt from windows judged by machines that never saw their document: the sample
is dealt into ``PARTS``, a machine is fitted without each, and the model's machine is their mean.

Windows that start inside a word or after a gap have a machine of their own, as the same letters say less there than at
the opening of a word. It is taught the toxic windows written into clean text, at each offset from a window's start.

The machine is a weighted sum over landmarks and a landmark is a vector over triples, so the sum is folded into one
table of triple weights. Scoring looks up each triple of the whole text once, whatever the number of landmarks.

The fit sees a bounded sample: ``TRAIN_DOCS`` labelled documents of each class with all their
windows; a machine's clean windows are ``BACKGROUND`` drawn ones (parameter ``background`` of ``fit``) and, round by round,
the worst of each clean document.
Defined cases: a null text is the empty text; a text without letters has no window
and gets the score of one whose worst sentences are clean; repeated rows get equal scores; with labels of one
class or none every score is the smoothed share of label 1 (0.5 without labels); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhawk.llm.common import held_out, labelled_sample, text_of

LAMBDA = 0.5
GAP = 2
REACH = 7
# Letters from one window to the next inside a long run. Any REACH - STRIDE + 1 starts in a row are in one window.
STRIDE = 4
# Characters that a window's triples can touch.
SPAN = REACH + 2 * (GAP + 1)
SYMBOL_BITS = 6
SYMBOLS = 1 << SYMBOL_BITS
TRIPLES = SYMBOLS**3
BOUNDARY = 27
LANDMARKS = 256
TRAIN_DOCS = 2_000
# Clean windows that a machine learns from besides the worst of each clean document.
BACKGROUND = 12_000
ROUNDS = 4
# Weight of the gapped windows against all clean or all other toxic ones.
GAPPED_SHARE = 0.3
# Clean texts that each toxic word is written into at each offset.
WRITTEN = 4
RIDGE = 1e-3
# Toxic documents that must hold an opening of a word before it is taken as telling.
SUPPORT = 4
# Letters that open a word, words a document and standard errors in the first search for telling words.
OPENINGS = (4, 5, 6)
LEVELS = 3
SURE = 2.0
# Log odds from which a word is telling.
TELLING = 1.4
TOXIC = 0.3
OPENING = 5
# Sentences that a document is judged by, besides the sum over all of them.
WORST = 3
# Value of a plainly clean sentence, so that documents of few sentences are judged like others.
FLOOR = -0.5
# Parts of the sample; the windows of each are judged by machines that were fitted on the others.
PARTS = 3

_STEPS = [(a, b) for a in range(1, GAP + 2) for b in range(1, GAP + 2)]
_COSTS = np.array([LAMBDA ** (a + b - 2) for a, b in _STEPS], np.float32)
# Fixed value: the characters that end a sentence.
SENTENCE_ENDS = ".!?\n"
TEXTS_AT_ONCE = 32
DROPPED = -1


def _symbol(code: int) -> int:
    """a-z are 1 to 26, white space is the boundary, other letters share the rest; 0 is a gap."""
    if code < 0x80:
        letter = chr(code).lower()
        return ord(letter) - ord("a") + 1 if "a" <= letter <= "z" else BOUNDARY if code in (9, 10, 11, 12, 13, 32) else 0
    kind = unicodedata.category(chr(code))
    # Joiners, zero-width spaces, soft hyphens, variation selectors, and marks that are laid over a letter.
    if kind in ("Cf", "Me") or unicodedata.combining(chr(code)) >= 200 or 0xFE00 <= code <= 0xFE0F or code in (0x34F, 0x336, 0x338):
        return DROPPED
    if kind[0] == "Z" or code == 0x85:
        return BOUNDARY
    return BOUNDARY + 1 + code % (SYMBOLS - BOUNDARY - 1) if kind[0] in "LM" else 0


_BASIC = 1 << 16
_SYMBOL_OF = np.array([_symbol(code) for code in range(_BASIC)], np.int32)


def _symbols(codes: np.ndarray) -> np.ndarray:
    out = _SYMBOL_OF[np.minimum(codes, _BASIC - 1)]
    far = np.flatnonzero(codes >= _BASIC)
    if len(far):
        names, number = np.unique(codes[far], return_inverse=True)
        out[far] = np.array([_symbol(int(code)) for code in names], np.int32)[number]
    return out


def _layout(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols after a leading boundary, where each window starts, sentence number of each window)."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    symbols = np.concatenate([[np.int32(BOUNDARY)], _symbols(codes)])
    ends = np.isin(codes, np.array([ord(x) for x in SENTENCE_ENDS], np.uint32))
    sentence = np.concatenate([[0], np.cumsum(ends)])
    seen = symbols != DROPPED
    symbols, sentence = symbols[seen], sentence[seen]

    apart = (symbols == 0) | (symbols == BOUNDARY)
    opens = apart & ~np.concatenate(([False], apart[:-1]))
    run = np.cumsum(opens)[apart] - 1
    symbols[opens] = np.where(np.bincount(run, symbols[apart] == BOUNDARY) > 0, BOUNDARY, 0)
    kept = ~apart | opens
    symbols, sentence, apart = symbols[kept], sentence[kept], apart[kept]

    before = np.flatnonzero(apart)
    letters = np.diff(np.append(before, len(symbols))) - 1
    before, letters = before[letters > 0], letters[letters > 0]
    windows = np.where(letters > REACH, 1 + (letters - 2) // STRIDE, 1)
    turn = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = np.repeat(before, windows) + STRIDE * turn
    return symbols, starts, sentence[starts + 1]


def _triple_codes(symbols: np.ndarray, step: tuple[int, int], count: int) -> np.ndarray:
    """Codes of the triples that start at each of the first ``count`` symbols, 0 where one is no letter."""
    a, b = symbols[:count], symbols[step[0] : step[0] + count]
    c = symbols[step[0] + step[1] : step[0] + step[1] + count]
    code = (a << 2 * SYMBOL_BITS) | (b << SYMBOL_BITS) | c
    return np.where((a > 0) & (b > 0) & (c > 0), code, 0)


def window_triples(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and costs of all triples of windows (n, SPAN), as (n, triples)."""
    windows = windows.astype(np.int32)
    codes = [
        _triple_codes(windows[:, at : at + SPAN].T, step, 1)[0]
        for at in range(REACH)
        for step in _STEPS
    ]
    return np.stack(codes, axis=1), np.tile(_COSTS, REACH)


def _norms(codes: np.ndarray, costs: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((codes > 0) * costs**2).sum(axis=1), 1e-6))


@dataclass
class Landmarks:
    """Normalised feature vectors of the landmarks, over the triples that any of them holds."""

    row_of: np.ndarray
    table: np.ndarray
    windows: np.ndarray

    @classmethod
    def of(cls, windows: np.ndarray) -> Landmarks:
        codes, costs = window_triples(windows)
        held = np.unique(codes[codes > 0])
        row_of = np.zeros(TRIPLES, np.int32)
        row_of[held] = np.arange(1, len(held) + 1)
        table = np.zeros((len(held) + 1, len(windows)), np.float32)
        for number, (row, norm) in enumerate(zip(codes, _norms(codes, costs), strict=True)):
            np.add.at(table[:, number], row_of[row], costs / norm)
        table[0] = 0.0
        return cls(row_of, table, windows)

    def kernel_to(self, windows: np.ndarray) -> np.ndarray:
        """Kernel of each window to each landmark."""
        out = np.zeros((len(windows), self.table.shape[1]), np.float32)
        for start in range(0, len(windows), 4096):
            codes, costs = window_triples(windows[start : start + 4096])
            part = out[start : start + 4096]
            for at, cost in enumerate(costs):
                part += cost * self.table[self.row_of[codes[:, at]]]
            part /= _norms(codes, costs)[:, None]
        return out

    def folded(self, coefficients: np.ndarray) -> np.ndarray:
        """Weight of every triple in the sum of the landmarks by their coefficients."""
        return (self.table @ coefficients).astype(np.float32)[self.row_of]


def _fit_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Squared-hinge machine by Newton steps; y is -1 or 1."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)
    weight = weight / weight.sum()
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(30):
        short = 1 - y * (x @ w)
        active = short > 0
        xa, wa = x[active], weight[active]
        gradient = keep * w - xa.T @ (wa * y[active] * short[active])
        move = np.linalg.solve(xa.T @ (xa * wa[:, None]) + np.diag(keep), gradient)
        w = w - move
        if np.abs(move).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    weight = weight / weight.mean()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 0.5 * w
        move = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + 0.5 * np.eye(len(w)), gradient)
        w = w - np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-6:
            break
    return w


def _document_features(values: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """What a document is judged by, from its windows' values and sentences: its ``WORST`` highest sentences, falling, each
    the value of its highest window (at least ``FLOOR``, as a missing one counts), and what windows have above 0, in sum and
    per hundred windows, both as log(1 + x). Length alone tells nothing."""
    out = np.full(WORST + 2, FLOOR)
    out[WORST:] = 0.0
    if len(values):
        cuts = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
        worst = np.sort(np.maximum.reduceat(values, cuts))[::-1]
        out[: min(WORST, len(worst))] = np.maximum(worst[:WORST], FLOOR)
        above = np.maximum(values, 0).sum()
        out[WORST:] = np.log1p(above), np.log1p(100 * above / len(values))
    return out


@dataclass
class KernelModel:
    """Triple weights and bias of windows at the opening of a word and of those inside one, and the calibration of a
    document's features."""

    weights: np.ndarray
    bias: np.ndarray
    calibration: np.ndarray
    share: float | None = None

    @classmethod
    def constant(cls, share: float) -> KernelModel:
        return cls(np.zeros((0, 2), np.float32), np.zeros(2), np.zeros(WORST + 3), share)

    def _gains(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running sums, over the triples that start at each symbol, of weights and of squared costs."""
        count = len(symbols)
        padded = np.concatenate([symbols, np.zeros(SPAN, symbols.dtype)]).astype(np.intp)
        first, second = padded[:count] << 2 * SYMBOL_BITS, padded << SYMBOL_BITS
        gain = np.zeros((count, 2), np.float32)
        for skipped in range(2 * GAP + 1):
            same = np.zeros((count, 2), np.float32)
            for a, b in _STEPS:
                if a + b - 2 == skipped:
                    same += self.weights[first | second[a : a + count] | padded[a + b : a + b + count]]
            gain += np.float32(LAMBDA**skipped) * same
        letter = (padded > 0).astype(np.float32)
        tail = np.concatenate([letter, np.zeros(SPAN, np.float32)])
        shares = [LAMBDA ** (2 * at) for at in range(GAP + 1)]
        last = sum(share * tail[at + 1 : at + 1 + len(padded)] for at, share in enumerate(shares)) * letter
        size = letter[:count] * sum(share * last[at + 1 : at + 1 + count] for at, share in enumerate(shares))
        return tuple(np.concatenate([np.zeros_like(x[:1], np.float64), np.cumsum(x, axis=0, dtype=np.float64)]) for x in (gain, size))

    def window_values(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per whole text the machine's value for each window, and the windows' sentences."""
        out = []
        for start in range(0, len(texts), TEXTS_AT_ONCE):
            layouts = [_layout(text) for text in texts[start : start + TEXTS_AT_ONCE]]
            apart = np.zeros(SPAN, np.int32)
            gain, size = self._gains(np.concatenate([x for symbols, _, _ in layouts for x in (symbols, apart)]))
            base = 0
            for symbols, starts, sentence in layouts:
                low, high = base + starts, base + np.minimum(starts + REACH, len(symbols))
                norm = np.sqrt(np.maximum(size[high] - size[low], 1e-6))
                inner = (symbols[starts] != BOUNDARY).astype(np.intp)
                values = (gain[high, inner] - gain[low, inner]) / norm + self.bias[inner]
                out.append((values.astype(np.float32), sentence))
                base += len(symbols) + SPAN
        return out

    def scores(self, texts: list[bytes]) -> list[float]:
        if self.share is not None:
            return [self.share] * len(texts)
        found = [np.append(_document_features(v, s), 1.0) for v, s in self.window_values(texts)]
        logits = np.array(found).reshape(-1, WORST + 3) @ self.calibration
        return (1 / (1 + np.exp(-np.clip(logits, -30, 30)))).tolist()


def _inverse_root(kernel: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    kept = values > 1e-4 * values.max()
    return (vectors[:, kept] / np.sqrt(values[kept])) @ vectors[:, kept].T


def _openings(windows: np.ndarray, length: int = OPENING) -> np.ndarray:
    """The first letters of each window as one number."""
    code = np.zeros(len(windows), np.int64)
    for at in range(1, length + 1):
        code = code * SYMBOLS + windows[:, at]
    return code


def _first_picks(windows: np.ndarray, of_doc: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """How much more toxic than clean documents hold words with the window's first letters, as log odds less ``SURE``
    standard errors: the highest over ``OPENINGS`` letters and over one to ``LEVELS`` such words a document. Clean documents
    may name a word once that toxic ones repeat."""
    looks = np.zeros(len(windows))
    bad_docs, clean_docs = toxic.sum(), (~toxic).sum()
    for length in OPENINGS:
        names, number = np.unique(_openings(windows, length), return_inverse=True)
        pairs, times = np.unique(number * len(toxic) + of_doc, return_counts=True)
        bad = toxic[pairs % len(toxic)]
        for level in range(1, LEVELS + 1):
            held = times >= level
            name = pairs[held] // len(toxic)
            hits, others = (np.bincount(name[bad[held] == kind], minlength=len(names)) for kind in (True, False))
            odds = np.log((hits + 0.5) / (bad_docs + 1)) - np.log((others + 0.5) / (clean_docs + 1))
            odds -= SURE * np.sqrt(1 / (hits + 0.5) + 1 / (others + 0.5))
            odds[hits < SUPPORT] = 0.0
            looks = np.maximum(looks, odds[number])
    return looks


def _distinct(windows: np.ndarray) -> np.ndarray:
    return np.unique(windows, axis=0, return_index=True)[1]


def _spaced(windows: np.ndarray) -> np.ndarray:
    """The first words of windows written with a space after each letter."""
    out = np.zeros_like(windows)
    out[:, 0] = BOUNDARY
    inside = np.ones(len(windows), bool)
    for at in range(1, SPAN):
        inside &= (windows[:, at] > 0) & (windows[:, at] != BOUNDARY)
        if 2 * at < SPAN:
            out[:, 2 * at - 1] = np.where(inside, windows[:, at], 0)
            out[:, 2 * at] = np.where(inside, BOUNDARY, 0)
    return out


def _best_of_docs(values: np.ndarray, of_doc: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Index of the highest window of each of ``docs``."""
    if not len(values):
        return np.empty(0, np.int64)
    order = np.lexsort((-values, of_doc))
    first = order[np.concatenate(([True], of_doc[order][1:] != of_doc[order][:-1]))]
    return first[np.isin(of_doc[first], docs)]


def _values(windows: np.ndarray, folded: np.ndarray) -> np.ndarray:
    """Weights of the windows' triples over the windows' lengths."""
    out = np.empty(len(windows), np.float32)
    for at in range(0, len(windows), 4096):
        codes, costs = window_triples(windows[at : at + 4096])
        out[at : at + 4096] = (folded[codes] * costs).sum(axis=1) / _norms(codes, costs)
    return out


def _fit_machine(
    windows: np.ndarray, of_doc: np.ndarray, toxic: np.ndarray, first: np.ndarray, taught: np.ndarray, share: float,
    marks: Landmarks, rng: np.random.Generator, background: int = BACKGROUND,
) -> tuple[np.ndarray, float]:
    """(weight of every triple, bias), from the windows at ``first`` and ``taught`` ones as toxic at first."""
    root = _inverse_root(marks.kernel_to(marks.windows))
    clean = rng.permutation(np.flatnonzero(~toxic[of_doc]))[:background]
    picked, hard = first, np.empty(0, np.int64)
    folded, bias = np.zeros(TRIPLES, np.float32), 0.0
    for _ in range(ROUNDS):
        chosen = np.unique(np.concatenate([picked, clean, hard]))
        y = np.where(np.isin(chosen, picked), 1.0, -1.0)
        y = np.concatenate([y, np.ones(len(taught))])
        weight = np.where(y > 0, 1 / max((y > 0).sum(), 1), 1 / max((y < 0).sum(), 1))
        weight[len(chosen) :] = share / max(len(taught), 1)
        seen = np.concatenate([windows[chosen], taught])
        w, bias = _fit_hinge(marks.kernel_to(seen) @ root, y, weight)
        folded = marks.folded(root @ w)
        values = _values(windows, folded) + bias
        hard = np.unique(np.concatenate([hard, _best_of_docs(values, of_doc, np.flatnonzero(~toxic))]))
        picked = np.union1d(first, np.flatnonzero(toxic[of_doc] & (values > 0.5)))
    return folded, bias


def _written_into(carriers: np.ndarray, words: np.ndarray, offset: int) -> np.ndarray:
    """The first words of ``words`` written into ``carriers``, ``offset`` letters after their start."""
    out = carriers.copy()
    if offset == 0:
        out[:, 0] = 0
    inside = np.ones(len(words), bool)
    for at in range(1, SPAN - offset):
        inside &= (words[:, at] > 0) & (words[:, at] != BOUNDARY)
        out[:, at + offset] = np.where(inside, words[:, at], out[:, at + offset])
    return out


def _fit_inner(windows: np.ndarray, of_doc: np.ndarray, toxic: np.ndarray, words: np.ndarray, rng: np.random.Generator, background: int = BACKGROUND) -> tuple[np.ndarray, float]:
    """The machine of the windows inside words. ``words`` are toxic windows, the commonest first."""
    clean = np.flatnonzero(~toxic[of_doc])
    if not len(clean) or not len(words):
        return np.zeros(TRIPLES, np.float32), -1.0
    words = words[:LANDMARKS]
    taught = [
        _written_into(windows[rng.choice(clean, len(words))], words, offset) for offset in range(STRIDE) for _ in range(WRITTEN)
    ]
    marks = np.concatenate([*[x[: LANDMARKS // 8] for x in taught[::WRITTEN]], windows[rng.permutation(clean)[: LANDMARKS // 4]]])
    return _fit_machine(windows, of_doc, toxic, np.empty(0, np.int64), np.concatenate(taught), 1.0, Landmarks.of(marks), rng, background)


def _fit_machines(
    windows: np.ndarray, of_doc: np.ndarray, toxic: np.ndarray, rng: np.random.Generator, background: int
) -> tuple[np.ndarray, np.ndarray]:
    """(weights of every triple, biases) of the machines for openings of words and for windows inside them."""
    front = windows[:, 0] == BOUNDARY
    inner, inner_docs = windows[~front], of_doc[~front]
    windows, of_doc = windows[front], of_doc[front]
    looks = _first_picks(windows, of_doc, toxic)
    clean_at = np.flatnonzero(~toxic[of_doc])
    # All windows of toxic documents nearly as telling as the document's best are taken as toxic at first.
    best = np.full(len(toxic), -np.inf)
    np.maximum.at(best, of_doc, looks)
    picked = np.flatnonzero(toxic[of_doc] & (looks > TELLING) & (looks >= best[of_doc] - 1.0))
    if not len(picked):
        picked = _best_of_docs(looks, of_doc, np.flatnonzero(toxic))
    if not len(picked) or not len(clean_at):
        return np.zeros((TRIPLES, 2), np.float32), np.full(2, -1.0)
    common = np.argsort(-np.bincount(np.unique(_openings(windows[picked]), return_inverse=True)[1]))
    by_opening = np.unique(_openings(windows[picked]), return_index=True)[1][common]
    spread = rng.permutation(picked[_distinct(windows[picked])])
    toxic_marks = np.unique(np.concatenate([picked[by_opening][: LANDMARKS // 2], spread[: LANDMARKS // 4]]))
    clean_marks = rng.permutation(clean_at)[: LANDMARKS // 4]
    # What a gapped insult looks like is taught by the toxic windows themselves, written with gaps.
    gapped = np.unique(_spaced(windows[picked]), axis=0)
    common_gapped = np.unique(_spaced(windows[picked[by_opening][: LANDMARKS // 4]]), axis=0)
    marks = Landmarks.of(np.concatenate([windows[np.concatenate([toxic_marks, clean_marks])], common_gapped]))
    table, bias = _fit_machine(windows, of_doc, toxic, picked, gapped, GAPPED_SHARE, marks, rng, background)
    inner_table, inner_bias = _fit_inner(inner, inner_docs, toxic, windows[picked[by_opening]], rng, background)
    return np.stack([table, inner_table], axis=1), np.array([bias, inner_bias])


def fit_windows(
    windows: np.ndarray, sentence: np.ndarray, of_doc: np.ndarray, labels: np.ndarray, weights: np.ndarray,
    seed: int = 5, background: int = BACKGROUND, parts: int = PARTS,
) -> KernelModel:
    """Learn from windows (n, SPAN) in document order; labels and weights are per document.

    The calibration sees each document through machines that never saw it. The model's machine is the mean of the
    parts', which is one table again."""
    rng = np.random.default_rng(seed)
    toxic = labels == 1
    part = np.empty(len(labels), np.int64)
    for kind in (True, False):
        docs = rng.permutation(np.flatnonzero(toxic == kind))
        part[docs] = np.arange(len(docs)) % parts
    front = windows[:, 0] == BOUNDARY
    values = np.empty(len(windows), np.float32)
    tables, biases = np.zeros((TRIPLES, 2), np.float32), np.zeros(2)
    for judged in range(parts):
        away = part[of_doc] == judged
        kept = np.flatnonzero(part != judged)
        number = np.zeros(len(labels), np.int64)
        number[kept] = np.arange(len(kept))
        table, bias = _fit_machines(windows[~away], number[of_doc[~away]], toxic[kept], rng, background)
        for kind, side in ((0, away & front), (1, away & ~front)):
            values[side] = _values(windows[side], table[:, kind]) + bias[kind]
        tables += table / parts
        biases += bias / parts
    cuts = np.searchsorted(of_doc, np.arange(len(labels) + 1))
    features = np.array([_document_features(values[a:b], sentence[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    return KernelModel(tables, biases, _fit_logistic(features, labels.astype(float), weights))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        windows, sentences = [], []
        for text in batch.column("text").to_pylist():
            symbols, starts, sentence = _layout(text)
            padded = np.concatenate([symbols, np.zeros(SPAN, symbols.dtype)]).astype(np.uint8)
            windows.append(padded[starts[:, None] + np.arange(SPAN)].tobytes())
            sentences.append(sentence.astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(windows, pa.binary()), pa.array(sentences, pa.binary())],
            names=["doc_id", "label", "windows", "sentences"],
        )


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS, background: int = BACKGROUND, seed: int = 5
) -> KernelModel:
    """Learn ``labels.toxic`` outside the held-out fold. The driver gets windows of at most 2 * per_class documents."""
    sample, totals = labelled_sample(docs, labels, "toxic", per_class)
    share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    if min(totals.get(0, 0), totals.get(1, 0)) == 0:
        return KernelModel.constant(share)
    rows = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), "label").mapInArrow(
        _sampled, "doc_id long, label int, windows binary, sentences binary"
    )
    taken = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["label"]))
    given = np.array([r["label"] for r in taken])
    windows = [np.frombuffer(r["windows"], np.uint8).reshape(-1, SPAN) for r in taken]
    sizes = [len(w) for w in windows]
    held = np.bincount(given, minlength=2)
    if held.min() == 0 or sum(n for n, k in zip(sizes, given, strict=True) if k) == 0:
        return KernelModel.constant(share)
    sentence = np.concatenate([np.frombuffer(r["sentences"], np.int32) for r in taken])
    of_doc = np.repeat(np.arange(len(taken)), sizes)
    weights = np.array([totals[0] / held[0], totals[1] / held[1]])[given]
    return fit_windows(np.concatenate(windows), sentence, of_doc, given, weights, seed, background)


def _score_task(model: KernelModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def score_documents(docs: DataFrame, model: KernelModel, toxic: float = TOXIC) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text"))
    scored = rows.mapInArrow(_score_task(model), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= toxic).cast("int").alias("predicted"))
