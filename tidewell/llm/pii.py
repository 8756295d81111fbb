"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions, trained in numpy.

A text is cut into overlapping windows. Forward and backward cells, with straight-line gates, read every character of
every window; their sums score each character's kinds, and a CRF's best path labels the window. A window whose scores
can't beat the path of no kind needs no decoding. Where windows overlap, the one whose edge is further away decides, and the
joined labels of the whole text give stretches, each with a beginning of its own. A stretch is trimmed to the values in it;
a value that holds no data of its kind, by a plain check of it alone, or touches a base span is left out. Base spans always
stay.

Training spans are the base patterns' in a bounded sample of documents, and made-up ones in made-up prose with forms that
the base patterns miss: values written twice or side by side, in words or in other signs. Numbers of the documents that are
no personal data, and made-up ones, are trained as nothing.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.arrow import pieces, text_strings
from tidewell.llm.storage import create, open_input

KINDS = ("email", "ip", "card", "phone")
#: Windows of WINDOW characters begin STRIDE apart.
WINDOW, STRIDE = 512, 448
#: Cells of a direction, and windows that are read side by side.
CELLS, SIDE = 12, 2048
#: Documents of the training sample, about: its documented bound.
FIT_DOCS = 2400
STEPS, BATCH, LENGTH, RATE = 500, 64, 72, 0.025
#: Pieces that each document of the sample gives, at most: around spans, around other numbers, and anywhere.
OWN, NUMBERS, OTHERS = 8, 3, 2

# The contract's patterns. An ip match can only begin where its digits begin; saying so spares long numbers
# from being read once for each digit.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_MAIL_BODY = re.compile(r"[A-Za-z0-9._%+-]+")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in found.split("."))
    if kind == "card":
        return 13 <= len(d := digits(found)) <= 19 and luhn(d)
    return kind != "phone" or 9 <= len(digits(found)) <= 15


_ANY_DIGIT = re.compile(r"[0-9]")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of the base patterns' spans, by kind, then start."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if _ANY_DIGIT.search(text):
        for k, kind in enumerate(KINDS[1:], 1):
            if kind != "phone" or "+" in text:
                out += [(k, m.start(), m.end()) for m in PATTERNS[kind].finditer(text) if valid(kind, m.group())]
    return out


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The email pattern's leftmost matches, looked for around each @ alone: a long run without one costs nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _MAIL_BODY.fullmatch(text[start - 1]):
            start -= 1
        found = PATTERNS["email"].match(text, start) if start < at else None
        if found:
            yield found.span()
            done = found.end()
        at = text.find("@", max(at + 1, done))


# --- the model -----------------------------------------------------------------------------------------------------

#: No kind, then for each kind the beginning of a span and the rest of it.
LABELS = 1 + 2 * len(KINDS)
#: Classes of characters: ASCII as it is, then letters, capitals and others beyond.
CLASSES = 132


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(points) and points.max() < 128:
        return points.astype(np.uint8)
    beyond = points >= 128
    out = np.where(beyond, 130, points).astype(np.uint8)
    out[beyond] = _BEYOND[np.minimum(points[beyond], len(_BEYOND) - 1)]
    return out


_BEYOND = np.array([130 if not chr(c).isalpha() else 129 if chr(c).isupper() else 128 for c in range(0x250)] + [131], np.uint8)


def new_parameters(seed: int = 5) -> dict[str, np.ndarray]:
    """For each direction: input table (classes x 4 cells: input, forget, output, candidate), recurrent weights; and scores."""
    rng, out = np.random.default_rng(seed), {}
    for way in "fb":
        out[f"x{way}"] = rng.normal(0, 0.3, (CLASSES, 4 * CELLS))
        out[f"u{way}"] = rng.normal(0, 0.3, (CELLS, 4 * CELLS))
        out[f"x{way}"][:, CELLS : 2 * CELLS] += 0.5
        out[f"v{way}"] = rng.normal(0, 0.3, (CELLS, LABELS))
    out["bias"] = np.zeros(LABELS)
    out["bias"][0] = 1.0
    out["move"] = np.eye(LABELS) * 1.0
    return out


def _scores(p: dict, chars: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Scores of each character's labels (steps x batch x labels), and what training needs of each step.

    Both directions advance together; the backward one reads the characters from the end.
    """
    steps, batch = chars.shape
    read = np.stack((chars, chars[::-1]), axis=1)  # steps x directions x batch
    table, u = (np.stack((p[f"{k}f"], p[f"{k}b"])) for k in "xu")
    h = c = np.zeros((2, batch, CELLS))
    states, kept, way = np.empty((steps, 2, batch, CELLS)), [], np.arange(2)[:, None]
    for t in range(steps):
        z = table[way, read[t]] + h @ u
        gates, cand = np.clip(0.25 * z[..., : 3 * CELLS] + 0.5, 0, 1), np.clip(z[..., 3 * CELLS :], -1, 1)
        i, f, o = gates[..., :CELLS], gates[..., CELLS : 2 * CELLS], gates[..., 2 * CELLS :]
        new = f * c + i * cand
        squashed = np.clip(new, -1, 1)
        kept.append((h, c, z, i, f, o, cand, new, squashed))
        c, h = new, o * squashed
        states[t] = h
    return states[:, 0] @ p["vf"] + states[::-1, 1] @ p["vb"] + p["bias"], (read, states, kept, u)


def _scores_gradient(p: dict, held: tuple, by_score: np.ndarray) -> dict[str, np.ndarray]:
    read, states, kept, u = held
    grad = {"bias": by_score.sum(axis=(0, 1)), "vf": np.einsum("tbc,tbl->cl", states[:, 0], by_score), "vb": np.einsum("tbc,tbl->cl", states[::-1, 1], by_score)}
    above = np.stack((by_score @ p["vf"].T, (by_score @ p["vb"].T)[::-1]), axis=1)
    to_u, found = np.zeros_like(u), np.empty((len(kept), 2, states.shape[2], 4 * CELLS))
    dh = np.zeros_like(kept[0][0])
    dc, back = np.zeros_like(dh), u.transpose(0, 2, 1)
    for t in range(len(kept) - 1, -1, -1):
        h, c, z, i, f, o, cand, new, squashed = kept[t]
        dh = dh + above[t]
        dc = dc + dh * o * (np.abs(new) < 1)
        dz = np.concatenate((dc * cand, dc * c, dh * squashed, dc * i), axis=2)
        dz[..., : 3 * CELLS] *= 0.25 * (np.abs(z[..., : 3 * CELLS]) < 2)
        dz[..., 3 * CELLS :] *= np.abs(z[..., 3 * CELLS :]) < 1
        to_u += h.transpose(0, 2, 1) @ dz
        found[t] = dz
        dh, dc = dz @ back, dc * f
    to_table = [(np.arange(CLASSES)[:, None] == read[:, k].reshape(-1)).astype(float) @ found[:, k].reshape(-1, 4 * CELLS) for k in (0, 1)]
    return grad | {"xf": to_table[0], "xb": to_table[1], "uf": to_u[0], "ub": to_u[1]}


def _crf_gradient(scores: np.ndarray, move: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood of the labels, and its gradients by scores (steps x batch x labels) and moves.

    Sums over paths are carried forward and backward as shares, scaled anew at each step.
    """
    steps, batch, _ = scores.shape
    most = scores.max(axis=2, keepdims=True)
    emit, go = np.exp(scores - most), np.exp(move - move.max())
    ahead, behind, scale = np.empty_like(scores), np.ones_like(scores), np.empty((steps, batch, 1))
    for t in range(steps):
        ahead[t] = (ahead[t - 1] @ go) * emit[t] if t else emit[0]
        scale[t] = ahead[t].sum(axis=1, keepdims=True)
        ahead[t] /= scale[t]
    for t in range(steps - 1, 0, -1):
        behind[t - 1] = (emit[t] * behind[t] / scale[t]) @ go.T
    by_score = ahead * behind
    by_move = np.einsum("tbi,tbj->ij", ahead[:-1], emit[1:] * behind[1:] / scale[1:]) * go
    every, at = np.arange(batch)[None], np.arange(steps)[:, None]
    gold = scores[at, every, labels].sum() + move[labels[:-1], labels[1:]].sum()
    by_score[at, every, labels] -= 1
    np.subtract.at(by_move, (labels[:-1], labels[1:]), 1)
    whole = np.log(scale).sum() + most.sum() + batch * (steps - 1) * move.max()
    return float(whole - gold) / batch, by_score / batch, by_move / batch


def train(samples: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, seed: int = 5) -> tuple[dict[str, np.ndarray], list[float]]:
    """Parameters and the losses, from pieces of LENGTH characters: classes and labels of each."""
    p, rng = new_parameters(seed), np.random.default_rng(seed)
    chars = np.stack([x for x, _ in samples])
    labels = np.stack([y for _, y in samples]).astype(np.int64)
    first, second, losses = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, []
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(chars), BATCH)
        scores, held = _scores(p, chars[pick].T)
        loss, by_score, by_move = _crf_gradient(scores, p["move"], labels[pick].T)
        losses.append(loss)
        grad = _scores_gradient(p, held, by_score) | {"move": by_move}
        rate = RATE * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k in p:
            g = np.clip(grad[k], -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p, losses


class Tagger:
    """The trained model, in the form that reads many windows side by side."""

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.parameters, self.ways = p, []
        for way in "fb":
            # All gates as clip(z, 0, 1): the candidate, of range -1 to 1, is 2 g - 1 of such a gate.
            scale = np.repeat([0.25, 0.25, 0.25, 0.5], CELLS)
            x, u = p[f"x{way}"] * scale + 0.5, p[f"u{way}"] * scale
            by_gate = lambda m: np.ascontiguousarray(m.reshape(len(m), 4, CELLS).transpose(1, 0, 2), np.float32)
            self.ways.append((by_gate(x), by_gate(u), np.ascontiguousarray(p[f"v{way}"], np.float32)))
        self.bias, self.move = p["bias"].astype(np.float32), p["move"].astype(np.float32)
        stay = self.move[0, 0]
        #: What a step on a kind can gain by its move over a step from no kind to none, and what the ways in and out cost.
        self.lead = max(0.0, float((self.move[1:, 1:] - stay).max()))
        self.enter, self.leave = float((stay - self.move[0, 1:]).min()), float((stay - self.move[1:, 0]).min())

    def scores(self, chars: np.ndarray) -> np.ndarray:
        """steps x windows x labels, of chars: steps x windows."""
        steps, n = chars.shape
        out = np.empty((steps, n, LABELS), np.float32)
        out[:] = self.bias
        z, part, more = np.empty((4, n, CELLS), np.float32), np.empty((4, n, CELLS), np.float32), np.empty((n, CELLS), np.float32)
        for backward, (table, u, v) in enumerate(self.ways):
            h, c = np.zeros((n, CELLS), np.float32), np.zeros((n, CELLS), np.float32)
            for t in range(steps - 1, -1, -1) if backward else range(steps):
                own = chars[t].astype(np.intp)
                for gate in range(4):
                    np.take(table[gate], own, axis=0, out=z[gate], mode="clip")
                np.matmul(h, u, out=part)
                z += part
                np.clip(z, 0, 1, out=z)
                i, f, o, g = z
                c *= f
                c -= i
                np.multiply(i, g, out=more)
                c += more
                c += more
                np.clip(c, -1, 1, out=h)
                h *= o
                out[t] += h @ v
        return out

    def labels(self, chars: np.ndarray) -> list[np.ndarray | None]:
        """The best path of each window (columns of chars); None where it is no kind throughout.

        Against that path, a stretch of kinds gains at most the sum of its steps' leads over no kind, and pays for the way
        in, unless the window begins with it, and out, unless the window ends with it. Where no stretch can win, there is
        nothing to decode.
        """
        scores, out = self.scores(chars), [None] * chars.shape[1]
        lead = scores[:, :, 1].copy()
        for k in range(2, LABELS):
            np.maximum(lead, scores[:, :, k], out=lead)
        lead += self.lead
        lead -= scores[:, :, 0]
        ending = np.zeros(len(out), np.float32)
        total, inside, low, high = ending.copy(), ending.copy(), ending.copy(), np.full(len(out), -np.inf, np.float32)
        for step in lead:
            np.maximum(ending, 0, out=ending)
            ending += step
            np.maximum(inside, ending, out=inside)
            np.minimum(low, total, out=low)
            total += step
            np.maximum(high, total, out=high)
        slack = 1e-3  # for rounding
        live = np.flatnonzero((inside > self.enter + self.leave - slack) | (high > self.leave - slack) | (total - low > self.enter - slack) | (total > -slack))
        for k in range(0, len(live), 256):
            own = live[k : k + 256]
            for w, path in zip(own, self._viterbi(scores[:, own])):
                out[w] = path if path.any() else None
        return out

    def _viterbi(self, scores: np.ndarray) -> np.ndarray:
        steps, n, _ = scores.shape
        value, back = scores[0], np.empty((steps, n, LABELS), np.uint8)
        for t in range(1, steps):
            way = value[:, :, None] + self.move[None]
            back[t] = way.argmax(axis=1)
            value = way.max(axis=1) + scores[t]
        path, state, every = np.empty((n, steps), np.uint8), value.argmax(axis=1), np.arange(n)
        for t in range(steps - 1, -1, -1):
            path[:, t] = state
            if t:
                state = back[t][every, state]
        return path

    def tag(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Kind, start and end of the model's spans in each text."""
        rows, owner, starts = [], [], []
        for k, text in enumerate(texts):
            chars = classes(text)
            for at in range(0, max(1, len(chars) - (WINDOW - STRIDE)), STRIDE):
                rows.append(chars[at : at + WINDOW])
                owner.append(k)
                starts.append(at)
        size = np.array([len(r) for r in rows])
        order = np.argsort(-size, kind="stable")
        found: dict[int, list] = {}
        for k in range(0, len(order), SIDE):
            pick = order[k : k + SIDE]
            if not size[pick[0]]:
                break
            chars = np.full((size[pick[0]], len(pick)), 32, np.uint8)
            for j, w in enumerate(pick):
                chars[: size[w], j] = rows[w]
            for w, path in zip(pick, self.labels(chars)):
                if path is not None:
                    found.setdefault(owner[w], []).append((starts[w], path[: size[w]]))
        return [_joined(found[k], len(t)) if k in found else [] for k, t in enumerate(texts)]


def _joined(windows: list[tuple[int, np.ndarray]], length: int) -> list[tuple[int, int, int]]:
    """Spans of a whole text: half of an overlap is the earlier window's, half the later one's. A beginning ends a span before it."""
    half, out, last = (WINDOW - STRIDE) // 2, [], None
    for start, path in sorted(windows, key=lambda x: x[0]):
        a = start + half if start else 0
        b = start + len(path) if start + len(path) == length else start + WINDOW - half
        own = path[a - start : b - start]
        edge = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if len(own) else np.empty(0, int)
        for s, e in zip(edge.tolist(), [*edge[1:].tolist(), len(own)]):
            if own[s]:
                kind, begins = (int(own[s]) - 1) // 2, own[s] & 1
                if last and last[0] == kind and last[2] == a + s and not begins:
                    out[-1] = last = (kind, last[1], a + e)
                else:
                    last = (kind, a + s, a + e)
                    out.append(last)
    return out


# --- training spans ------------------------------------------------------------------------------------------------

_SYLLABLES = "the an er on re in ed th ou ha en ti st ng le de la que un der ein sch ich la os ci ra men te lo mar to be is é è ê ç ó ñ ä ö ü ß ción ée".split()


def _prose(rng: np.random.Generator) -> str:
    words = ["".join(rng.choice(_SYLLABLES, rng.integers(1, 4))) for _ in range(rng.integers(2, 9))]
    if rng.random() < 0.4:
        words[0] = words[0].capitalize()
    if rng.random() < 0.25:
        words.insert(int(rng.integers(0, len(words))), str(rng.integers(0, 10 ** int(rng.integers(1, 7)))))
    if rng.random() < 0.1:
        words = [w + str(rng.choice(["###", "***", "%%%", "!!", " |"])) for w in words]
    return " ".join(words) + str(rng.choice([" ", ". ", ", ", "\n", ": "]))


def _number(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _made(kind: str, rng: np.random.Generator) -> str:
    word = lambda: "".join(c for c in rng.choice(_SYLLABLES, rng.integers(1, 4)) if c.isascii()) or "mail"
    if kind == "email":
        at, dot = (str(rng.choice(x)) for x in (["@", "@", " at ", "(at)", " [at] ", " (at) ", "[at]", " AT "], [".", ".", ".", " dot ", "(dot)", " [dot] ", "[dot]"]))
        if at == "@":
            dot = "."
        host = [word() + str(rng.choice(["", str(rng.integers(1, 99))])), *str(rng.choice(["com", "org", "net", "example com", "de", "co uk"])).split()]
        return f"{word()}{rng.choice(['', '.', '_'])}{rng.choice(['', str(rng.integers(1, 99))])}{at}{dot.join(host)}"
    if kind == "ip":
        return str(rng.choice([".", ".", "[.]", " . ", "(.)"])).join(str(rng.integers(0, 256)) for _ in range(4))
    if kind == "card":
        body = _number(rng, 15)
        body += next(d for d in "0123456789" if luhn(body + d))
        gap = str(rng.choice(["", "", " ", "-", ".", "/", "  "]))
        return gap.join(body[k : k + 4] for k in range(0, 16, 4))
    a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
    return str(rng.choice([f"+1 ({a}) {b}-{c}", f"+{rng.integers(1, 99)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1-{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{rng.integers(1, 99)} {a} {b}{c}", f"0{a}/{b}{c}"]))


def _nothing(rng: np.random.Generator) -> str:
    """A number, or something like one, that is no personal data."""
    n = lambda a, b: int(rng.integers(a, b))
    hexed = "".join(rng.choice(list("0123456789abcdef"), n(12, 48)))
    return str(rng.choice([_number(rng, n(1, 9)), _number(rng, n(20, 40)), hexed, f"{n(0, 99)}.{n(0, 9999)}", f"{n(0, 20)}.{n(0, 20)}.{n(0, 20)}", f"20{n(10, 30)}-0{n(1, 9)}-{n(10, 29)}", f"{n(0, 24)}:{n(10, 60)}:{n(10, 60)}", f"{n(1, 9)},{_number(rng, 3)},{_number(rng, 3)}", f"{n(10, 90)}/{n(10, 90)}", _number(rng, n(20, 30)) + " " + _number(rng, n(20, 30)), "at home.", f"key={hexed}"]))


def made_up(n: int, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Made-up texts with the spans in them; two in five hold none, and most of these numbers that are nothing."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(n):
        text, spans = _prose(rng), []
        if rng.random() < 0.6:
            kind, made = int(rng.integers(0, len(KINDS))), ""
            for k in range(1 + int(rng.random() < 0.4) + int(rng.random() < 0.1)):
                text += str(rng.choice([" ", " ", ", ", "; ", "\n"])) if k else ""
                made = made if k and rng.random() < 0.5 else _made(KINDS[kind], rng)
                spans.append((kind, len(text), len(text) + len(made)))
                text += made
            text += str(rng.choice([" ", " ", ". ", "! ", "### ", ") "]))
        elif rng.random() < 0.8:
            text += _nothing(rng) + str(rng.choice([" ", ". ", "-", ":", "$$$ "]))
        out.append((text + _prose(rng) + _prose(rng), spans))
    return out


#: Runs of signs that numbers are written in; those without a span around them are the numbers that are nothing.
_NUMBERS = re.compile(r"[0-9a-f+(][0-9a-f().\x20/+-]{3,}[0-9a-f]")


def cut(text: str, spans: list[tuple[int, int, int]], seed: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pieces of LENGTH characters: around OWN of the spans and NUMBERS of the other numbers, and OTHERS anywhere.

    All spans are labelled in every piece. Numbers in which the plain check finds a value, as in a card written twice, are
    neither span nor nothing: pieces with one are left out.
    """
    labels, unsure = np.zeros(len(text), np.uint8), np.zeros(len(text), bool)
    for kind, a, b in reversed(spans):
        labels[a], labels[a + 1 : b] = 2 * kind + 1, 2 * kind + 2
    chars, out, rng = classes(text), [], np.random.default_rng(seed)
    numbers = [m.span() for m in _NUMBERS.finditer(text) if not labels[m.start() : m.end()].any()]
    for a, b in numbers:
        unsure[a:b] = any(values(k, text, a, b) for k in (2, 3))
    pick = lambda found, n: [found[i] for i in sorted(rng.permutation(len(found))[:n])]
    around = [(a, b) for _, a, b in pick(spans, OWN)] + pick(numbers, NUMBERS)
    for at in [max(0, (a + b) // 2 - int(rng.integers(20, 52))) for a, b in around] + rng.integers(0, max(1, len(text) - LENGTH), OTHERS).tolist():
        if unsure[at : at + LENGTH].any():
            continue
        x, y = np.full(LENGTH, 32, np.uint8), np.zeros(LENGTH, np.uint8)
        own = chars[at : at + LENGTH]
        x[: len(own)], y[: len(own)] = own, labels[at : at + LENGTH]
        out.append((x, y))
    return out


#: Made-up texts to learn from.
MADE = 3000


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = FIT_DOCS) -> Tagger:
    """A model of the made-up spans and of the base spans in about fit_docs documents, chosen by a hash of id and text.

    Rows alike in both count as one. Only pieces of LENGTH characters come to the driver.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(c.tobytes(), y.tobytes()) for t in text_strings(batch.column(0)) for c, y in cut(t, base_spans(t), zlib.crc32(t.encode()))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in range(2)], ["chars", "labels"])

    share = min(1.0, fit_docs / max(1, docs.count()))
    chosen = rows.filter("text is not null").filter(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < (1 << 20) * share).distinct().select("text")
    own = [(np.frombuffer(c, np.uint8), np.frombuffer(y, np.uint8)) for c, y in sorted((bytes(r[0]), bytes(r[1])) for r in chosen.mapInArrow(sample, "chars binary, labels binary").collect())]
    made = [x for k, (text, spans) in enumerate(made_up(MADE)) for x in cut(text, spans, k)]
    # Made-up pieces and documents' pieces with a span, and as many of the documents' others again.
    held = [x for x in own if x[1].any()]
    rest = [x for x in own if not x[1].any()][: 2 * len(made)]
    return Tagger(train(made + held + rest)[0])


# --- the operator --------------------------------------------------------------------------------------------------

#: How a value that the model adds is written; what else it tags is trimmed.
_AT, _DOT = r"(?:@|\x20?[(\[]at[)\]]\x20?|\x20at\x20|\x20AT\x20)", r"(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)"
CORES = (
    re.compile(rf"[\w.%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+"),
    re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\x20?\.\x20?|\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])"),
    re.compile(r"(?<![0-9a-fA-F])[0-9](?:[\x20./-]{0,2}[0-9])+(?![0-9a-fA-F])"),
    re.compile(r"(?<![0-9a-fA-F])[+(]?[0-9][0-9().\x20/-]*[0-9](?![0-9a-fA-F])"),
)
#: Usual numbers of digits of cards, the most usual first.
CARD_DIGITS = (16, 15, 19, 13, 14, 17, 18)
_GROUP = re.compile(r"[0-9]+")
_TOKEN = re.compile(r"[^\x20]+")
#: Characters on either side of a stretch in which its values may begin or end.
MARGIN = 24


def plausible(kind: int, found: str) -> bool:
    """The plain check of a value that the model adds."""
    name, number = KINDS[kind], digits(found)
    if name == "ip":
        return all(int(x) <= 255 for x in _GROUP.findall(found))
    if name == "card":
        return 13 <= len(number) <= 19 and luhn(number)
    return name != "phone" or 9 <= len(number) <= 15 and bool(re.search(r"[-()\x20+/.]", found))


def values(kind: int, text: str, a: int, b: int) -> list[tuple[int, int]]:
    """Places of the values of a kind in text[a:b], each checked alone.

    A run of digits is a card as a whole, or its groups of digits are, from left to right, the most usual number of digits
    first. A phone number that is too long as a whole begins anew at a space where enough digits are behind it.
    """
    out = []
    for m in CORES[kind].finditer(text, a, b):
        start, end = m.span()
        if plausible(kind, text[start:end]):
            out.append((start, end))
        elif KINDS[kind] in ("card", "phone"):
            groups = [g.span() for g in (_GROUP if KINDS[kind] == "card" else _TOKEN).finditer(text, start, end)][:MARGIN]
            k = 0
            while k < len(groups):
                ends = [e for _, e in groups[k:] if plausible(kind, text[groups[k][0] : e])]
                if KINDS[kind] == "card":
                    ends.sort(key=lambda e, s=groups[k][0]: CARD_DIGITS.index(len(digits(text[s:e]))))
                if ends:
                    out.append((groups[k][0], ends[0]))
                    k = next((j for j in range(k, len(groups)) if groups[j][0] >= ends[0]), len(groups))
                else:
                    k += 1
    return out


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """For each text its base spans, and all spans by kind, then start.

    The values that the model adds lie for the most part in a stretch of its path, or are a card, by its check digit, that is
    written right behind one that does; of values that overlap, the first stays.
    """
    out = []
    for text, tagged in zip(texts, tagger.tag(texts)):
        base, added = base_spans(text), []
        for kind, a, b in tagged:
            if any(k == kind and s <= a and b <= e for k, s, e in base):
                continue
            for s, e in values(kind, text, max(0, a - MARGIN), b + MARGIN):
                beside = KINDS[kind] == "card" and bool(added) and added[-1][0] == kind and 0 < s - added[-1][2] <= 2
                if (beside or 2 * (min(b, e) - max(a, s)) > e - s) and all(e <= x or y <= s for _, x, y in base + added):
                    added.append((kind, s, e))
        out.append((base, sorted(base + added)))
    return out


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Callable[[DataFrame], Tagger] | Tagger = fit) -> DataFrame:
    """doc_id, n_<kind> of base spans, base_sha256 of these, spans (base and added), private: a row for each row of docs.

    Spans are kind:start:end by kind as listed, then start, in code points with the end exclusive. private says whether there
    are any. Null counts as empty, and an empty text has none. Repeated rows each give a row. An empty table gives none.
    model trains a Tagger on docs, or is one, as load() gives it.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model if isinstance(model, Tagger) else model(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = all_spans(text_strings(piece.column(1)), held.value)
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
                sha = pa.array([hashlib.sha256(_written(base).encode()).hexdigest() for base, _ in found], pa.string())
                spans, private = pa.array([_written(s) for _, s in found], pa.string()), pa.array([bool(s) for _, s in found])
                yield pa.RecordBatch.from_arrays([piece.column(0), *counts, sha, spans, private], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "private"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, private boolean")


def save(tagger: Tagger, uri: str) -> None:
    """Writes the model's parameters to a file, for scans that needn't train again."""
    held = io.BytesIO()
    np.savez(held, **tagger.parameters)
    with create(uri) as file:
        file.write(held.getvalue())


def load(uri: str) -> Tagger:
    with open_input(uri) as file:
        return Tagger(dict(np.load(io.BytesIO(file.read()))))
