"""Secret scans: fixed patterns, and a character convolutional network over every other candidate.

The base patterns report assignments, access keys and hexadecimal runs. The network reads each candidate (a run of
key characters) with its context, a long one in overlapping pieces of which the highest score counts; it learns from
all candidates, labelled by the base patterns: first weights on the driver, then all of them task by task. Calibration and
threshold come from scores of all windows by networks that had not seen them; the threshold is the highest that keeps the wanted recall of fresh findings with the wanted confidence.
"""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.shared import dropped, unused, written

KINDS = ("assign", "access", "hex", "learned")
#: The base patterns. Letters of the words before an assignment are matched in either case (A-Z only).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: What can be a secret: a run of 8 key characters or more, with digits or without; the network decides.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
#: Texts without these, lower-cased, have no assignment; those without 24 bytes of hexadecimal digits (x) have no such run.
HINTS = ("passw", "secret", "token", "api_key", "apikey")
_HEXED = bytes(ord("x" if chr(i) in "0123456789abcdef" else ".") for i in range(256))

CORE, AROUND = 48, 24
WIDTH = CORE + 2 * AROUND
#: Characters as the network sees them: classes of code points.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n\t=:\"'_-./+@#$%&*,;()[]{}<>|\\!?"
#: Labelled windows of either label from which the first weights come; all others are learnt after them.
SAMPLE = 3000
#: Windows a step of that learning, and its rate.
BLOCK, RATE = 2048, 0.05
#: Logits are counted in steps of 1 / STEPS from -SPAN to SPAN.
STEPS, SPAN = 64, 64
#: The weights of a network.
NAMES = ("embed", "kernel", "bias", "out")
#: Labelled windows, and of either label, without which there is no network.
LEAST, LEAST_EACH = 20, 3
#: Share of fresh positive windows that the threshold has to keep, and how sure that is to be.
RECALL, CONFIDENCE = 0.98, 0.9


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings, in that order; positions are code points."""
    if not text:
        return []
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"x" * 24 in text.encode("latin-1", "replace").translate(_HEXED):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str | None) -> list[tuple[int, int]]:
    return [m.span() for m in RUN.finditer(text)] if text else []


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """A candidate in stretches of CORE characters at most, each half a CORE after the one before; the last ends with it."""
    if end - start <= CORE:
        return [(start, end)]
    return [(a, a + CORE) for a in (*range(start, end - CORE, CORE // 2), end - CORE)]


_CODE = np.full(256, 1, np.uint8)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i + 2
_TABLE = _CODE.tobytes()
_KEYS = np.zeros(256, bool)
_KEYS[[_CODE[_i] for _i in range(128) if RUN.fullmatch(chr(_i) * 8)]] = True
CLASSES = len(ALPHABET) + 2


def coded(text: str) -> bytes:
    """One code per character."""
    return text.encode("latin-1", "replace").translate(_TABLE)


def _window(code: bytes, start: int, end: int) -> bytes:
    left, core, right = code[max(0, start - AROUND) : start], code[start:end], code[end : end + AROUND]
    return left.rjust(AROUND, b"\0") + core.ljust(CORE, b"\0") + right.ljust(AROUND, b"\0")


def window(text: str, start: int, end: int) -> bytes:
    """Codes of a piece (CORE characters at most) and of AROUND characters on either side of it; 0 is padding."""
    return _window(coded(text), start, end)


@dataclass
class Network:
    """Embedding, one convolution, maximum over places, logistic output; calibrated by a scale and an offset."""

    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    offset: float = 0.0
    threshold: float = 1.0
    recall: float = 0.0  #: what the threshold keeps of fresh positive windows, with CONFIDENCE

    def hidden(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e = self.embed[codes]
        k = self.kernel.shape[0]
        patches = np.lib.stride_tricks.sliding_window_view(e, k, axis=1).transpose(0, 1, 3, 2).reshape(len(codes), codes.shape[1] - k + 1, -1)
        a = patches @ self.kernel.reshape(-1, self.kernel.shape[2]) + self.bias
        at = a.argmax(axis=1)
        return patches, at, np.take_along_axis(a, at[:, None, :], 1)[:, 0, :]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.maximum(self.hidden(codes)[2], 0) @ self.out + self.out_bias

    def convolved(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, their codes, the convolution at each place without bias), a few windows at a time.

        Each pair of classes is convolved once beforehand, so a place costs one row per two taps. Windows go by the length
        of their cores, and padding behind a core beyond one kernel's width is left out: it holds the same place over and over.
        """
        taps = np.einsum("cd,wdf->wcf", self.embed, self.kernel).astype(np.float32)
        pairs = [(taps[j][:, None] + taps[j + 1][None]).reshape(-1, taps.shape[2]) if j + 1 < len(taps) else taps[j] for j in range(0, len(taps), 2)]
        core = np.count_nonzero(codes[:, AROUND : AROUND + CORE], axis=1)
        order = np.argsort(core, kind="stable")
        for i in range(0, len(codes), 64):
            rows = order[i : i + 64]
            part, m = codes[rows].astype(np.intp), core[rows[-1]] + len(taps)
            if m < CORE:
                part = np.concatenate([part[:, : AROUND + m], part[:, AROUND + CORE :]], axis=1)
            n = part.shape[1] - len(taps) + 1
            two = part[:, :-1] * CLASSES + part[:, 1:]
            a = pairs[0][two[:, :n]]
            for j, table in enumerate(pairs[1:], 1):
                a += table[(two if 2 * j + 1 < len(taps) else part)[:, 2 * j : 2 * j + n]]
            yield rows, part, a

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated scores."""
        z = np.zeros(len(codes))
        for rows, _, a in self.convolved(codes):
            z[rows] = np.maximum(a.max(axis=1) + self.bias, 0) @ self.out + self.out_bias
        return self.calibrated(z)

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * z + self.offset)))

    def learnt(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One step down the gradient of the windows' weighted mean loss; returns the logits from before it."""
        z, width, filters = np.empty(len(codes)), len(self.kernel), len(self.bias)
        grads = {n: np.zeros_like(getattr(self, n)) for n in NAMES}
        places, moved, shift = [], [], 0.0
        for rows, part, a in self.convolved(codes):
            at = a.argmax(axis=1)
            best = np.take_along_axis(a, at[:, None, :], 1)[:, 0, :] + self.bias
            act = np.maximum(best, 0)
            z[rows] = act @ self.out + self.out_bias
            g = weights[rows] * (1 / (1 + np.exp(-z[rows])) - labels[rows]) / len(codes)
            ga = g[:, None] * self.out * (best > 0)
            taken = part[np.arange(len(rows))[:, None, None], at[:, :, None] + np.arange(width)]  # window, filter, tap
            places.append(((np.arange(width) * CLASSES + taken) * filters + np.arange(filters)[:, None]).reshape(-1))
            moved.append(np.repeat(ga.reshape(-1), width))
            grads["bias"] += ga.sum(axis=0)
            grads["out"] += act.T @ g
            shift += g.sum()
        taps = np.bincount(np.concatenate(places), np.concatenate(moved), width * CLASSES * filters).reshape(width, CLASSES, filters)
        grads["kernel"] = np.einsum("cd,wcf->wdf", self.embed, taps)
        grads["embed"] = np.einsum("wcf,wdf->cd", taps, self.kernel)
        rate = RATE / max(1.0, math.sqrt(shift**2 + sum((x**2).sum() for x in grads.values())))
        for n, x in grads.items():
            getattr(self, n)[...] -= rate * x
        self.out_bias -= rate * shift
        return z

    def flat(self) -> np.ndarray:
        return np.concatenate([*[getattr(self, n).reshape(-1) for n in NAMES], [self.out_bias]])

    def like(self, flat: np.ndarray) -> Network:
        """A network of this one's shape with those parameters, not calibrated."""
        ends = np.cumsum([getattr(self, n).size for n in NAMES])
        own = [x.reshape(getattr(self, n).shape).copy() for n, x in zip(NAMES, np.split(flat[:-1], ends[:-1]))]
        return Network(*own, float(flat[-1]))


def least_rank(n: int) -> int:
    """The greatest r for which the r-th smallest of n lies above the quantile 1 - RECALL with less than 1 - CONFIDENCE; 0: none."""
    mass, r, term = 0.0, 0, n * math.log(RECALL)
    for k in range(n):
        mass += math.exp(term)
        if mass > 1 - CONFIDENCE:
            break
        r, term = k + 1, term + math.log((n - k) / (k + 1)) + math.log((1 - RECALL) / RECALL)
    return r


def least_score(scores: np.ndarray) -> tuple[float, float]:
    """A threshold for the scores of positive windows that no net saw, and the recall it keeps with CONFIDENCE.

    The highest of the sorted scores for which fresh positives fall below it in no more than 1 - RECALL of the cases, by
    the binomial law of order statistics and whatever the scores' distribution. Where they are too few for that it is the
    least of them, and the recall is what so many can vouch for.
    """
    found, n = np.sort(scores), len(scores)
    r = least_rank(n)
    return (float(found[r - 1]), RECALL) if r else (float(found[0]), float((1 - CONFIDENCE) ** (1 / n)))


def train(codes: np.ndarray, labels: np.ndarray, folds: int = 4, seed: int = 3) -> Network:
    """A network from these windows; calibration and threshold from scores of windows that the scoring network did not see.

    Each fold is scored by a network fitted to the others. Platt's two parameters are fitted to those logits, and the
    threshold is the ``least_score`` of their positive ones.
    """
    net, z = cross_fitted(codes, labels, folds, seed)
    scale, offset = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(scale * z + offset)))
        scale -= 0.05 * (np.mean((p - labels) * z) + 0.001 * (scale - 1))
        offset -= 0.05 * np.mean(p - labels)
    net.scale, net.offset = float(max(scale, 0.05)), float(offset)
    net.threshold, net.recall = least_score(net.calibrated(z[labels == 1]))
    _warn(net.recall, int(labels.sum()))
    return net


def _warn(recall: float, positives: int) -> None:
    if recall < RECALL:
        warnings.warn(f"{positives} positive windows vouch for a recall of {recall:.2f}, not {RECALL}", stacklevel=3)


def cross_fitted(codes: np.ndarray, labels: np.ndarray, folds: int = 4, seed: int = 3) -> tuple[Network, np.ndarray]:
    """A network from these windows, and for each the logit of one that was fitted to the other folds."""
    fold = np.empty(len(labels), int)
    rng = np.random.default_rng(seed)
    for label in (0, 1):
        at = rng.permutation(np.flatnonzero(labels == label))
        fold[at] = np.arange(len(at)) % folds
    z = np.empty(len(labels))
    for k in range(folds):
        z[fold == k] = fitted(codes[fold != k], labels[fold != k], seed=seed + 1 + k).logits(codes[fold == k])
    return fitted(codes, labels, seed=seed), z


def fitted(codes: np.ndarray, labels: np.ndarray, filters: int = 24, width: int = 5, size: int = 8, epochs: int = 6, rate: float = 0.01, seed: int = 3) -> Network:
    """Weights by Adam."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.3, (CLASSES, size)), rng.normal(0, 0.2, (width, size, filters)), np.zeros(filters), rng.normal(0, 0.2, filters), 0.0)
    own = rng.permutation(len(labels))
    m = {n: (np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))) for n in NAMES}
    step = 0
    for _ in range(epochs):
        for i in range(0, len(own), 64):
            part = rng.permutation(own)[:64] if len(own) <= 64 else own[i : i + 64]
            x, y = codes[part], labels[part]
            patches, at, best = net.hidden(x)
            act = np.maximum(best, 0)
            g = (1 / (1 + np.exp(-(act @ net.out + net.out_bias))) - y) / len(part)
            ga = np.outer(g, net.out) * (best > 0)
            picked = np.take_along_axis(patches, at[:, :, None], 1)  # example, filter, patch
            gk = np.einsum("nf,nfp->pf", ga, picked).reshape(net.kernel.shape)
            ge = np.zeros_like(net.embed)
            back = np.einsum("nf,wdf->nfwd", ga, net.kernel)
            places = at[:, :, None] + np.arange(width)
            np.add.at(ge, np.take_along_axis(x[:, None, :].repeat(filters, 1), places, 2).reshape(-1), back.reshape(-1, size))
            step += 1
            for n, grad in (("embed", ge), ("kernel", gk), ("bias", ga.sum(0)), ("out", act.T @ g)):
                a, b = m[n]
                a += 0.1 * (grad - a)
                b += 0.001 * (grad * grad - b)
                getattr(net, n)[...] -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
            net.out_bias -= rate * g.sum() * 8
    return net


def labelled(text: str | None) -> list[tuple[bool, bytes]]:
    """(label, window) of the pieces of all candidates.

    Of the pieces that overlap a base finding's value the one that holds most of it is positive and the others are left
    out, as is the name before an assigned value; pieces that touch no finding are negative.
    """
    found = candidates(text)
    if not found:
        return []
    spans, code, out = base_spans(text), coded(text), []
    values = [(ASSIGN.match(text, a).start(2) if kind == 0 else a, b) for a, kind, b in spans]
    best = set()
    for a, b in values:
        held = [(min(b, q) - max(a, p), -p, q) for s, e in found if s < b and a < e for p, q in pieces(s, e) if p < b and a < q]
        if held:
            _, p, q = max(held)
            best.add((-p, q))
    for s, e in found:
        for p, q in pieces(s, e):
            if (p, q) in best:
                out.append((True, _window(code, p, q)))
            elif not any(a < q and p < b for a, _, b in spans):
                out.append((False, _window(code, p, q)))
    return out


def _pieces(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end, window) of each piece of each candidate of the texts, start and end being the candidate's."""
    codes, gap = [coded(t or "") for t in texts], bytes(AROUND + CORE)
    big = np.frombuffer(gap + gap.join(codes) + gap + gap, np.uint8)
    begins = len(gap) + np.cumsum([0, *[len(c) + len(gap) for c in codes[:-1]]])
    key = _KEYS[big]
    edges = np.flatnonzero(key[1:] != key[:-1]) + 1  # gaps are at either end
    s, e = edges[::2], edges[1::2]
    s, e = s[e - s >= 8], e[e - s >= 8]
    at, p, q = np.arange(len(s)), s, e
    if (long := e - s > CORE).any():
        more = np.array([(i, a, b) for i in np.flatnonzero(long).tolist() for a, b in pieces(int(s[i]), int(e[i]))])
        at, p, q = (np.concatenate([x[~long], y]) for x, y in zip((at, p, q), more.T))
        order = np.lexsort((p, at))
        at, p, q = at[order], p[order], q[order]
    windows = np.empty((len(p), WIDTH), np.uint8)
    windows[:, : AROUND + CORE] = np.lib.stride_tricks.sliding_window_view(big, AROUND + CORE)[p - AROUND]
    windows[:, AROUND : AROUND + CORE][np.arange(CORE) >= (q - p)[:, None]] = 0
    windows[:, AROUND + CORE :] = np.lib.stride_tricks.sliding_window_view(big, AROUND)[q]
    own = np.searchsorted(begins, s, side="right") - 1
    return own[at], (s - begins[own])[at], (e - begins[own])[at], windows


def _groups(texts: list[str | None], most: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """(number of the first, texts) of about ``most`` characters, or one longer text."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most or i == len(texts) - 1:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0


def _all_labelled(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(labels, windows) as ``labelled`` has them: texts without base findings together, then the others."""
    for _, group in _groups(texts):
        found = [bool(base_spans(t)) for t in group]
        windows = _pieces([t for t, f in zip(group, found) if not f])[3] if not all(found) else np.zeros((0, WIDTH), np.uint8)
        own = [x for t, f in zip(group, found) if f for x in labelled(t)]
        windows = np.concatenate([windows, np.frombuffer(b"".join(c for _, c in own), np.uint8).reshape(-1, WIDTH)])
        yield np.concatenate([np.zeros(len(windows) - len(own), bool), np.array([y for y, _ in own], bool)]), windows


_draw = np.random.default_rng(6)
_A, _B = _draw.integers(1, 2**63, (2, WIDTH // 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(windows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(windows), np.uint64)
    for i, w in enumerate(np.ascontiguousarray(windows).view(np.uint64).T):
        x = (w + _B[i]) * _A[i]
        h = (h ^ x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class _Smallest:
    """The SAMPLE distinct windows with the smallest hashes, and how many were seen."""

    def __init__(self):
        self.held, self.bound, self.seen = {}, 2**64 - 1, 0

    def add(self, windows: np.ndarray) -> None:
        self.seen += len(windows)
        h = _hashes(windows)
        for i in np.flatnonzero(h < np.uint64(self.bound)).tolist():
            self.held[int(h[i])] = windows[i].tobytes()
        if len(self.held) > 2 * SAMPLE:
            self.cut()

    def cut(self) -> list[tuple[int, bytes]]:
        least = sorted(self.held.items())[:SAMPLE]
        self.held = dict(least)
        if len(least) == SAMPLE:
            self.bound = least[-1][0]
        return least


def _labelled(df: DataFrame, text: str) -> DataFrame:
    """(label, codes, place, seen) of each task's labelled windows, of either label the SAMPLE with the smallest places; seen
    counts all of the task's, in one row of each label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {True: _Smallest(), False: _Smallest()}
        for batch in batches:
            for labels, windows in _all_labelled(batch.column(0).to_pylist()):
                for label, part in least.items():
                    part.add(windows[labels == label])
        for label, part in least.items():
            rows = part.cut()
            places = pa.array(np.array([h for h, _ in rows], np.uint64).view(np.int64))
            seen = pa.array([part.seen, *[0] * (len(rows) - 1)][: len(rows)], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(rows), pa.bool_()), pa.array([c for _, c in rows], pa.binary()), places, seen], names=["label", "codes", "place", "seen"])

    return written(df.select(text).mapInArrow(run, "label boolean, codes binary, place long, seen long"), "labelled")


def _learnt(df: DataFrame, text: str, net: Network, weight: float, places: np.ndarray, logits: np.ndarray) -> DataFrame:
    """What each task learns from its windows, starting with ``net``: (weights, n), one row a task, and (label, step, n), how
    many windows had which logit before they were learnt.

    Windows of the first fit, those of the sorted ``places``, count with their cross-fitted ``logits``. Positive windows weigh
    ``weight``, negative ones 1. A window counts as often as it occurs.
    """
    sent = df.sparkSession.sparkContext.broadcast((net, places, logits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, known, fresh = sent.value
        own, counts, waiting, n = first.like(first.flat()), np.zeros((2, 2 * SPAN * STEPS), np.int64), [], 0

        def learn(all_: bool) -> None:
            labels, windows = (np.concatenate(x) for x in zip(*waiting))
            waiting.clear()
            end = len(labels) if all_ else len(labels) - len(labels) % BLOCK
            for i in range(0, end, BLOCK):
                y, codes = labels[i : min(i + BLOCK, end)], windows[i : min(i + BLOCK, end)]
                z, h = own.learnt(codes, y, np.where(y, weight, 1.0)), _hashes(codes)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                z = np.where(known[at] == h, fresh[at], z)
                steps = np.clip(np.floor(z * STEPS) + SPAN * STEPS, 0, 2 * SPAN * STEPS - 1).astype(np.int64)
                for label in (0, 1):
                    counts[label] += np.bincount(steps[y == label], minlength=2 * SPAN * STEPS)
            if end < len(labels):
                waiting.append((labels[end:], windows[end:]))

        for batch in batches:
            for labels, windows in _all_labelled(batch.column(0).to_pylist()):
                waiting.append((labels, windows))
                n += len(labels)
                if sum(len(x) for x, _ in waiting) >= BLOCK:
                    learn(False)
        if waiting:
            learn(True)
        if n:
            label, step = np.nonzero(counts)
            columns = [pa.array([own.flat().tobytes(), *[None] * len(label)], pa.binary()), pa.array([n, *counts[label, step].tolist()], pa.int64())]
            columns += [pa.array([None, *label.astype(bool).tolist()], pa.bool_()), pa.array([None, *step.tolist()], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["weights", "n", "label", "step"])

    return written(df.select(text).mapInArrow(run, "weights binary, n long, label boolean, step long"), "learnt")


def _platt(z: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Scale and offset of the logits z, of which n were seen and ``positive`` of them were; by Newton's steps."""
    share, total = n / n.sum(), positive.sum() / n.sum()
    scale, offset = 1.0, math.log(total / (1 - total)) - float((share * z).sum())
    loss = lambda s, o: float((share * np.logaddexp(0, s * z + o)).sum() - (positive / n.sum() * (s * z + o)).sum() + 0.0005 * (s - 1) ** 2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-(scale * z + offset)))
        g = share * p - positive / n.sum()
        h = share * p * (1 - p)
        slope = np.array([(g * z).sum() + 0.001 * (scale - 1), g.sum()])
        bend = np.array([[(h * z * z).sum() + 0.001, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-12]])
        by, rate = np.linalg.solve(bend, slope), 1.0
        while rate > 1e-6 and loss(scale - rate * by[0], offset - rate * by[1]) > loss(scale, offset):
            rate /= 2
        scale, offset = scale - rate * by[0], offset - rate * by[1]
        if abs(rate * by).max() < 1e-9:
            break
    return float(max(scale, 0.05)), float(offset)


def fit(df: DataFrame, text: str = "text") -> Network | None:
    """A network from all candidates of ``df``.

    The first weights, and cross-fitted logits of the windows they come from, are those of SAMPLE distinct windows of either
    label, those with the smallest hashes. From there every window is learnt, task by task, and the tasks' weights are averaged
    by their numbers of windows. Calibration and threshold come from the logits of all windows: the cross-fitted ones, and for
    all others those from before the window was learnt. The texts are read twice.

    None, with a warning, where there are fewer than LEAST distinct labelled windows or than LEAST_EACH of a label: one each
    is needed for the fit, the calibration and the threshold.
    """
    found = _labelled(df, text)
    picked = None
    for label in (True, False):
        part = found.where(F.col("label") == label).groupBy("codes", "place").agg(F.lit(label).alias("label"))
        part = part.orderBy(F.col("place").bitwiseXOR(F.lit(-(2**63))), "codes").limit(SAMPLE).select("codes", "label", "place")
        picked = part if picked is None else picked.union(part)
    rows = picked.toArrow().to_pylist()
    labels = np.array([r["label"] for r in rows], float)
    if len(rows) < LEAST or min((labels == 1).sum(), (labels == 0).sum()) < LEAST_EACH:
        warnings.warn(f"no network for secrets: {int(labels.sum())} positive and {int((labels == 0).sum())} negative windows", stacklevel=2)
        return None
    rows.sort(key=lambda r: (r["codes"], r["label"]))
    labels = np.array([r["label"] for r in rows], float)
    net, z = cross_fitted(np.array([np.frombuffer(r["codes"], np.uint8) for r in rows]), labels)
    places = np.array([r["place"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(places)
    seen = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.sum("seen").alias("n")).collect()}
    weight = (labels == 1).sum() / (labels == 0).sum() * seen[False] / seen[True]  # labels weigh as in the first fit
    told = _learnt(df, text, net, float(weight), places[order], z[order])
    tasks = sorted((r["n"], r["weights"]) for r in told.where("weights is not null").select("n", "weights").toArrow().to_pylist())
    net = net.like(sum(n * np.frombuffer(w) for n, w in tasks) / sum(n for n, _ in tasks))
    counts = told.where("weights is null").groupBy("step").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("label"), F.col("n")).otherwise(0)).alias("positive"))
    counts = counts.orderBy("step").toArrow()
    step, n, positive = (counts.column(c).to_numpy() for c in ("step", "n", "positive"))
    net.scale, net.offset = _platt((step + 0.5) / STEPS - SPAN, n, positive)
    r = least_rank(int(positive.sum()))
    net.recall = RECALL if r else float((1 - CONFIDENCE) ** (1 / positive.sum()))
    least = step[np.searchsorted(np.cumsum(positive), max(r, 1))] / STEPS - SPAN  # the step's lower end
    net.threshold = float(net.calibrated(np.array(least)))
    dropped(found, told)
    _warn(net.recall, int(positive.sum()))
    return net


SPANS = "array<struct<start: int, kind: int, end: int>>"


def with_secrets(df: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """Adds ``base`` and ``spans``: arrays of (start, kind, end) in code points, ordered by start, then kind.

    kind counts from 0 as in KINDS. spans holds the base findings and the candidates that overlap none of them and that
    the network scores at its threshold or above. Null and empty texts have none. Without a network spans is base.
    Columns of those names are replaced, all others stay; equal texts get equal spans; an empty table gives an empty one.
    """
    sent = df.sparkSession.sparkContext.broadcast(net)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(f"struct<base: {SPANS}, spans: {SPANS}>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = sent.value
        for column in batches:
            texts = column.to_pylist()
            bases = [base_spans(t) for t in texts]
            all_spans = [list(base) for base in bases]
            for first, group in _groups(texts) if known is not None else ():
                own, start, end, codes = _pieces(group)
                bare = np.array([not base for base in bases[first : first + len(group)]])
                use = bare[own]
                for i in np.flatnonzero(~use).tolist():
                    use[i] = not any(a < end[i] and start[i] < b for a, _, b in bases[first + own[i]])
                at = np.flatnonzero(use)
                at = at[known.scores(codes[at]) >= known.threshold]
                for i, s, e in dict.fromkeys(zip(own[at].tolist(), start[at].tolist(), end[at].tolist())):
                    all_spans[first + i].append((s, 3, e))
            as_rows = lambda found: pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in sorted(x)] for x in found], kind)
            yield pa.StructArray.from_arrays([as_rows(bases), as_rows(all_spans)], ["base", "spans"])

    name = unused(df, "_told")
    told = df.withColumn(name, scan(F.col(text)))
    return told.withColumns({c: F.col(f"{name}.{c}") for c in ("base", "spans")}).drop(name)
