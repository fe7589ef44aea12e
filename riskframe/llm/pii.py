"""Personal data: patterns for the known forms, and a character BiLSTM with a CRF for the others.

The network is trained in numpy, from spans that the patterns label in a bounded
sample of documents, and from copies of them in forms that the patterns miss: a
phone number without its country code, with brackets or a double zero, a card
with dots or wide gaps, letters outside ASCII in an address, digits of other
scripts. Every kind of span holds a digit or an at sign, of any script, so the
network reads all text within CONTEXT characters of one and on to the next
white space, as overlapping windows. Each character takes its emissions from the
window in which it lies deepest, and one Viterbi pass over the whole stretch
decides its labels, so windows never disagree. An address goes on to the ends of
its run. Found spans are kept if they pass the check of their kind; of one that
meets spans of the patterns, the parts outside them are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import LeastHashed, chunks, id_and_text, spark_hash, stored
from riskframe.llm.spans import ARROW_SPANS, SPANS, Rule, Span, found_by, masked, ordered, pattern_spans

KINDS = ["email", "ip", "card", "phone"]
TAGS = 1 + 2 * len(KINDS)  # O, then begin and inside of each kind
WIDTH, STEP, CONTEXT = 64, 32, 16
HIDDEN = 12
_BATCH_CHARS = 1 << 22
_BATCH_WINDOWS = 1024
_BATCH_PLACES = 1 << 17  # characters whose emissions are held at once, or one stretch


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _is_card(m: re.Match) -> bool:
    d = _digits(m[0])
    return 14 <= len(d) <= 19 and luhn(d)


def _has_digit(text: str) -> bool:
    return _ANY_DIGIT.search(text) is not None


_ANY_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of a local part, @ and a host, found from each @: every character is read once,
    also in a long run without an @."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _HOST.match(text, at + 1)):
            end = m.end()
            yield start, end
        else:
            end = at + 1  # a local part holds no @
        at = text.find("@", max(end, at + 1))


def _in_range(m: re.Match) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))


RULES: list[Rule] = [
    ("email", lambda t: "@" in t, _emails),
    # no match starts inside a run of digits whose start has none
    ("ip", _has_digit, found_by(re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}"), _in_range)),
    ("card", _has_digit, found_by(re.compile(r"[0-9](?:[\x20-]?[0-9])+"), _is_card)),
    ("phone", lambda t: "+" in t, found_by(re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(_digits(m[0])) <= 15)),
]
_TRIGGER = re.compile("[\\d@\uff20]")
_REST = re.compile(r"\S*")
_ADDRESS = re.compile(r"[\w.%+-]*")


def base_spans(text: str) -> list[Span]:
    return pattern_spans(text, RULES)


def folded(text: str) -> str:
    """The text with digits of all scripts and full-width marks as ASCII, character by character."""
    if text.isascii():
        return text
    return "".join(c if c < "\x80" else chr(ord(c) - 0xFEE0) if "\uff01" <= c <= "\uff5e" else
                   str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


def plausible(kind: str, text: str) -> bool:
    """Check of a span that only the network found."""
    text = folded(text)
    if kind == "email":
        local, at, host = text.partition("@")
        return bool(local and at and "." in host.strip(".")) and not re.search(r"[\s@,;:!?\"'<>|]", local + host) and "@" not in host
    d = _digits(text)
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d) and bool(re.fullmatch(r"[0-9][0-9 ./-]+[0-9]", text))
    return 10 <= len(d) <= 15 and bool(re.fullmatch(r"[+(]?[0-9][0-9 ().-]+[0-9]", text)) and bool(re.search(r"[ ().-]", text))


def char_codes(text: str) -> np.ndarray:
    """Class of each character: ASCII as it is, with digits, lower and upper case letters folded, other scripts by kind."""
    p = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = np.where(p < 128, p, 1)
    out[(p >= 48) & (p < 58)] = 48
    out[(p >= 97) & (p < 123)] = 97
    out[(p >= 65) & (p < 91)] = 65
    for i in np.flatnonzero(p >= 128).tolist():
        c = folded(text[i])
        if c < "\x80":
            out[i] = 48 if c.isdigit() else 97 if c.islower() else 65 if c.isupper() else ord(c)
        else:
            out[i] = {"L": 2, "Z": 32, "N": 3}.get(unicodedata.category(c)[0], 1)
    return out


@dataclass
class Tagger:
    """Weights of the two directions (input by character class, recurrent), the emission layer and the CRF changes."""
    wx: list[np.ndarray]
    wh: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    change: np.ndarray
    start: np.ndarray

    @staticmethod
    def initial(seed: int = 5) -> Tagger:
        rng = np.random.default_rng(seed)
        wx = [rng.normal(0, 0.3, (128, 4 * HIDDEN)) for _ in range(2)]
        for w in wx:
            w[:, HIDDEN:2 * HIDDEN] += 1.0  # open forget gates
        return Tagger(wx, [rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN)) for _ in range(2)],
                      rng.normal(0, 0.3, (2 * HIDDEN, TAGS)), np.zeros(TAGS), np.zeros((TAGS, TAGS)), np.zeros(TAGS))

    def parameters(self) -> list[np.ndarray]:
        return [*self.wx, *self.wh, self.out, self.bias, self.change, self.start]

    def run(self, codes: np.ndarray, keep: bool = False):
        """Emissions (n, T, TAGS) of windows of classes (n, T); keep also returns what back-propagation needs."""
        n, steps = codes.shape
        states, saved = [], []
        for d in range(2):
            x = codes if d == 0 else codes[:, ::-1]
            h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            hs, memory = np.empty((n, steps, HIDDEN)), []
            for t in range(steps):
                g = self.wx[d][x[:, t]] + h @ self.wh[d]
                ifo = 1 / (1 + np.exp(-g[:, :3 * HIDDEN]))
                i, f, o = np.split(ifo, 3, axis=1)
                u = np.tanh(g[:, 3 * HIDDEN:])
                before, last = h, c
                c = f * c + i * u
                tc = np.tanh(c)
                h = o * tc
                hs[:, t] = h
                if keep:
                    memory.append((before, last, i, f, o, u, tc))
            states.append(hs if d == 0 else hs[:, ::-1])
            saved.append(memory)
        both = np.concatenate(states, axis=2)
        return both @ self.out + self.bias, both, saved

    def gradients(self, codes: np.ndarray, tags: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log likelihood of tag windows under the CRF, and its gradients."""
        emit, both, saved = self.run(codes, keep=True)
        n, steps, _ = emit.shape
        fwd, bwd = np.empty_like(emit), np.zeros_like(emit)
        fwd[:, 0] = self.start + emit[:, 0]
        for t in range(1, steps):
            new = _lse(fwd[:, t - 1, :, None] + self.change, 1) + emit[:, t]
            fwd[:, t] = np.where(mask[:, t, None], new, fwd[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = _lse(self.change + (emit[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
            bwd[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
        z = _lse(fwd[:, -1], 1)
        node = np.exp(fwd + bwd - z[:, None, None]) * mask[..., None]
        truth = np.eye(TAGS)[tags] * mask[..., None]
        d_change, gold = np.zeros_like(self.change), 0.0
        for t in range(1, steps):
            p = np.exp(fwd[:, t - 1, :, None] + self.change + (emit[:, t] + bwd[:, t])[:, None, :] - z[:, None, None])
            d_change += (p * mask[:, t, None, None]).sum(0) - truth[:, t - 1].T @ truth[:, t]
            gold += (self.change[tags[:, t - 1], tags[:, t]] * mask[:, t]).sum()
        gold += (emit * truth).sum() + self.start[tags[:, 0]].sum()
        d_emit = (node - truth) / n
        grads: list = [np.zeros_like(w) for w in self.wx] + [np.zeros_like(w) for w in self.wh]
        d_both = d_emit @ self.out.T
        for d in range(2):
            x = codes if d == 0 else codes[:, ::-1]
            dh_out = d_both[..., :HIDDEN] if d == 0 else d_both[:, ::-1, HIDDEN:]
            dh, dc, every = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), np.empty((n, steps, 4 * HIDDEN))
            for t in range(steps - 1, -1, -1):
                before, last, i, f, o, u, tc = saved[d][t]
                dh = dh + dh_out[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dg = np.concatenate([dc * u * i * (1 - i), dc * last * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)], axis=1)
                every[:, t] = dg
                grads[2 + d] += before.T @ dg
                dh, dc = dg @ self.wh[d].T, dc * f
            grads[d] = np.eye(128)[x.ravel()].T @ every.reshape(-1, 4 * HIDDEN)
        grads += [np.einsum("nth,ntk->hk", both, d_emit), d_emit.sum((0, 1)), d_change / n,
                  (node[:, 0] - truth[:, 0]).sum(0) / n]
        return float((z.sum() - gold) / n), grads

    def decode(self, emit: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Viterbi tags of stretches from their emissions (n, T, TAGS); places past a stretch's size repeat its last tag."""
        n, steps, _ = emit.shape
        best, back = self.start + emit[:, 0], np.empty((steps, n, TAGS), np.int8)
        same = np.arange(TAGS, dtype=np.int8)
        for t in range(1, steps):
            via = best[:, :, None] + self.change
            live = t < size
            back[t] = np.where(live[:, None], via.argmax(1), same)
            best = np.where(live[:, None], via.max(1) + emit[:, t], best)
        tags = np.empty((n, steps), np.int8)
        tags[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        return tags


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def tag_row(size: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(size, np.int64)
    for kind, s, e in spans:
        k = 1 + 2 * KINDS.index(kind)
        s, e = max(s, 0), min(e, size)
        if s < e:
            tags[s:e] = k + 1
            tags[s] = k
    return tags


def train(windows: list[tuple[str, list[Span]]], epochs: int = 12, batch: int = 96, rate: float = 0.02, seed: int = 5) -> Tagger | None:
    """Tagger from labelled windows (text, spans in it) by Adam; None without a labelled span."""
    windows = [(t[:WIDTH], s) for t, s in windows if t]
    if not any(s for _, s in windows):
        return None
    n = len(windows)
    codes, tags, mask = np.full((n, WIDTH), 32), np.zeros((n, WIDTH), np.int64), np.zeros((n, WIDTH), bool)
    for i, (text, spans) in enumerate(windows):
        codes[i, :len(text)], tags[i, :len(text)], mask[i, :len(text)] = char_codes(text), tag_row(len(text), spans), True
    model, rng = Tagger.initial(seed), np.random.default_rng(seed)
    params = model.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        lr = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for at in range(0, n, batch):
            rows = order[at:at + batch]
            _, grads = model.gradients(codes[rows], tags[rows], mask[rows])
            norm = np.sqrt(sum((g * g).sum() for g in grads))
            step += 1
            for p, g, m1, m2 in zip(params, grads, first, second):
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m1 *= 0.9
                m1 += 0.1 * g
                m2 *= 0.999
                m2 += 0.001 * g * g
                p -= lr * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return model


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches within CONTEXT characters of a digit or an @, and on to white space on both sides."""
    out: list[list[int]] = []
    last = 0
    for m in _TRIGGER.finditer(text):
        hi = min(len(text), m.end() + CONTEXT)
        if out and hi <= last:
            continue
        lo = max(0, m.start() - CONTEXT)
        while lo > last and not text[lo - 1].isspace():
            lo -= 1
        if hi < len(text) and not text[hi - 1].isspace():
            hi = _REST.match(text, hi).end()
        if out and lo <= last:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
        last = hi
    return [(a, b) for a, b in out]


def windows_of(lo: int, hi: int) -> list[tuple[int, int]]:
    """Overlapping windows over a stretch; each place but the stretch's ends is well inside one of them."""
    if hi - lo <= WIDTH:
        return [(lo, hi)]
    starts = list(range(lo, hi - WIDTH, STEP)) + [hi - WIDTH]
    return [(s, s + WIDTH) for s in starts]


def read_tags(tags: np.ndarray, at: int) -> list[Span]:
    """Spans of a stretch of tags that begins at `at`: a begin tag, or an inside tag of another kind than before, opens one."""
    out, open_kind, start = [], -1, 0
    for i, t in enumerate([*tags.tolist(), 0]):
        kind = (t - 1) // 2 if t else -1
        if kind != open_kind or t % 2 == 1:
            if open_kind >= 0:
                out.append((KINDS[open_kind], at + start, at + i))
            open_kind, start = kind, i
    return out


def whole_address(text: str, s: int, e: int) -> tuple[int, int]:
    """A span with an @, on to the ends of its run of address characters."""
    while s > 0 and _ADDRESS.fullmatch(text, s - 1, s):
        s -= 1
    return s, _ADDRESS.match(text, e).end()


def merged_emissions(model: Tagger, jobs: list[tuple[str, int, int]]) -> list[np.ndarray]:
    """Emissions (characters, TAGS) of each stretch (text, from, to): a character has those of the window it is deepest in."""
    windows = [(k, a, b) for k, (_, lo, hi) in enumerate(jobs) for a, b in windows_of(lo, hi)]
    out = [np.empty((hi - lo, TAGS), np.float32) for _, lo, hi in jobs]
    deep = [np.full(hi - lo, -1) for _, lo, hi in jobs]
    for at in range(0, len(windows), _BATCH_WINDOWS):
        part = windows[at:at + _BATCH_WINDOWS]
        codes = np.full((len(part), WIDTH), 32)
        for row, (k, a, b) in enumerate(part):
            codes[row, :b - a] = char_codes(jobs[k][0][a:b])
        emit = model.run(codes)[0]
        for row, (k, a, b) in enumerate(part):
            _, lo, hi = jobs[k]
            place = np.arange(b - a)
            depth = np.minimum(place if a > lo else place + WIDTH, place[::-1] if b < hi else place + WIDTH)
            own = slice(a - lo, b - lo)
            better = depth > deep[k][own]
            out[k][own][better] = emit[row, :b - a][better]
            deep[k][own][better] = depth[better]
    return out


def decoded(model: Tagger, jobs: list[tuple[str, int, int]]) -> list[np.ndarray]:
    """Tags of each stretch, by one Viterbi pass over all of it."""
    emit = merged_emissions(model, jobs)
    out: list[np.ndarray] = [np.empty(0, np.int8)] * len(jobs)
    order = sorted(range(len(jobs)), key=lambda k: len(emit[k]))
    for _, part in chunks(order, lambda k: len(emit[k]), _BATCH_PLACES):
        size = np.array([len(emit[k]) for k in part])
        padded = np.zeros((len(part), int(size.max()), TAGS), np.float32)
        for row, k in enumerate(part):
            padded[row, :size[row]] = emit[k]
        for row, tags in enumerate(model.decode(padded, size)):
            out[part[row]] = tags[:size[row]]
    return out


def network_spans(model: Tagger, texts: list[str]) -> list[list[Span]]:
    """Plausible spans that the network finds in each text."""
    jobs = [(i, lo, hi) for i, text in enumerate(texts) for lo, hi in regions(text)]
    out: list[list[Span]] = [[] for _ in texts]
    for _, part in chunks(jobs, lambda j: j[2] - j[1], _BATCH_PLACES):
        for (i, lo, _), tags in zip(part, decoded(model, [(texts[i], lo, hi) for i, lo, hi in part])):
            for kind, s, e in read_tags(tags, lo):
                if kind == "email" and re.search("[@\uff20]", texts[i][s:e]):
                    s, e = whole_address(texts[i], s, e)
                body = texts[i][s:e]
                lead = len(body) - len(body.lstrip(" .,;:-"))
                body = body.strip(" .,;:-")
                if plausible(kind, body):
                    out[i].append((kind, s + lead, s + lead + len(body)))
    return out


def outside(span: Span, text: str, base: list[Span]) -> list[Span]:
    """The parts of a span outside the base spans, without separators at their ends; base is in order."""
    kind, s, e = span
    if not any(s < b and a < e for _, a, b in base):
        return [span]
    out, at = [], s
    for a, b in [*((a, b) for _, a, b in base if s < b and a < e), (e, e)]:
        if at < a:
            body = text[at:a]
            lead = len(body) - len(body.lstrip(" .,;:-+()"))
            body = body.strip(" .,;:-+()")
            if body:
                out.append((kind, at + lead, at + lead + len(body)))
        at = max(at, b)
    return out


def spans_of(model: Tagger | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base, all) spans of each whole text, in order."""
    base = [ordered(base_spans(t), KINDS) for t in texts]
    if model is None:
        return [(b, b) for b in base]
    out = []
    for t, b, more in zip(texts, base, network_spans(model, texts)):
        new = [y for x in more for y in outside(x, t, b)]
        out.append((b, ordered([*b, *new], KINDS) if new else b))
    return out


def examples(text: str) -> list[str]:
    """Windows around digits and @ signs of a text, for training."""
    return [text[a:b] for lo, hi in regions(text) for a, b in windows_of(lo, hi)]


_SCRIPTS = [str.maketrans("0123456789@.-", "".join(chr(0xFEE0 + ord(c)) for c in "0123456789@.-")),
            str.maketrans("0123456789", "".join(chr(0x0660 + d) for d in range(10))),
            str.maketrans("0123456789", "".join(chr(0x0966 + d) for d in range(10)))]


def forms(kind: str, body: str, n: int) -> list[str]:
    """Other ways to write a labelled span, which the patterns miss; n turns through those that exclude each other."""
    d = _digits(body)
    if kind == "phone":
        x, y, z = d[-10:-7], d[-7:-4], d[-4:]
        land = ["49", "44", "33", "1", "351"][n % 5]
        return [[f"({x}) {y}-{z}", f"{x}-{y}-{z}", f"{x}.{y}.{z}", f"({x}) {y} {z}", re.sub(r"^\+[0-9]+[ .-]?", "", body)][n % 5],
                [f"00{land} {x[:2]} {y}{z}", f"00{land} {x} {y} {z}", f"00{land}-{x}-{y}-{z}", f"00{land} {x[:2]} {y} {z}"][n % 4],
                [f"+{land} {x} {y} {z}", f"{x}-{y}-{z}", body][n % 3].translate(_SCRIPTS[n // 3 % 3])]
    if kind == "card":
        four = re.findall("....", d[:16])
        return [".".join(four), "  ".join(four), [" - ", "/", "--"][n % 3].join(four), body.translate(_SCRIPTS[n % 3])]
    if kind == "email":
        local, _, host = body.partition("@")
        odd, top = "üéøłñ"[n % 5], ["com", "de", "fr", "org", "co.uk", "example.net"][n % 6]
        name = re.sub("[^a-z]", "", local) or "info"
        firm = (re.sub("[^a-z]", "", host) or "mail")[: 3 + n % 7]
        return [odd + body, [f"{name}{odd}@{firm}.{top}", f"{name}.{odd}{firm}@{host}", f"{name[:2]}{odd}{name[2:]}@{firm}.{top}",
                             f"{local}{odd}@{host}"][n % 4],
                f"{name}@{firm[:1]}{odd}{firm[1:]}.{top}" if n % 2 else f"{local}@{odd}{firm}.{top}",
                f"{name}\uff20{firm}.{top}" if n % 2 else body.replace("@", "\uff20")]
    return [body.translate(_SCRIPTS[n % 3])]


def lookalike(body: str, n: int) -> str:
    """What holds the digits of a span and is none: a book number, a list, a date with a time, amounts, a range."""
    d = (_digits(body) * 3)[:16].ljust(13, "7")
    return [f"978-{d[0]}-{d[1:5]}-{d[5:9]}-{d[9]}", f"{d[:3]},{d[3:6]},{d[6:9]}", f"20{d[:2]}-0{d[2]}-1{d[3]} 1{d[4]}:2{d[5]}:3{d[6]}",
            f"{d[:3]}.{d[3:5]} {d[5:8]}.{d[8:10]}", f"19{d[:2]}-20{d[2:4]}", f"{d[:5]}, {d[5:9]}, {d[9:12]}", f"@{'abcdefg'[n % 7]}ndre"][n % 7]


def altered(window: str, spans: list[Span], n: int = 0) -> list[tuple[str, list[Span]]]:
    """Copies of a window with its first span in forms that the patterns miss, labelled alike, and one with a look-alike."""
    if not spans:
        return []
    kind, s, e = spans[0]
    body = window[s:e]
    out = []
    for form in dict.fromkeys(forms(kind, body, n)):
        if form != body and plausible(kind, form):
            moved = [(k, a + len(form) - len(body), b + len(form) - len(body)) for k, a, b in spans[1:]]
            out.append((window[:s] + form + window[e:], [(kind, s, s + len(form)), *moved]))
    other = lookalike(body, n)
    return [*out, (window[:s] + other + window[e:], [(k, a + len(other) - len(body), b + len(other) - len(body)) for k, a, b in spans[1:]])]


def learn(docs: DataFrame, fit_rows: int = 300, text_col: str = "text") -> Tagger | None:
    """Tagger from at most fit_rows windows of each first kind of span and of windows without one, those of least hash
    over all documents. A task sends no more than that many of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = LeastHashed(fit_rows)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for w in examples(t) if t and _TRIGGER.search(t) else ():
                    found = base_spans(w)
                    least.add(min(found, key=lambda x: x[1])[0] if found else "", w)
        cols = list(zip(*least.rows())) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["kind", "piece"])

    found = stored(docs.select(F.col(text_col).alias("text")).mapInArrow(run, "kind string, piece string").distinct(), "windows")
    windows: list[tuple[str, list[Span]]] = []
    for kind in ["", *KINDS]:
        rows = found.where(F.col("kind") == kind).orderBy(spark_hash("piece"), "piece").limit(fit_rows).collect()
        for n, piece in enumerate(sorted(r["piece"] for r in rows)):
            spans = ordered(base_spans(piece), KINDS)
            windows.append((piece, spans))
            windows += altered(piece, spans, n)
    return train(windows)


def scan(docs: DataFrame, model: Tagger | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): one row per input row; spans of patterns and network in order of start, then kind.

    Null and empty texts have no span. Repeated rows and null ids each give their row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, part in chunks(texts, len, _BATCH_CHARS):
                out = []
                for base, every in spans_of(model, part):
                    known = set(base)
                    out.append([{"kind": k, "start": s, "end": e, "base": (k, s, e) in known} for k, s, e in every])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), pa.array(out, ARROW_SPANS)],
                                                 names=["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, spans {SPANS.simpleString()}")


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by a mark of its kind."""
    return masked(text, spans, lambda kind: f"[{kind.upper()}]")
